"""Connected components of a table of links, by contraction of numbered nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.runtime import materialize

MAX_ROUNDS = 60


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) of every node that has a link; the root is the least node of its component.

    Links may repeat, run either way or join a node to itself; a null end links nothing. Nodes are numbered once in
    their order, and only numbers take part in the rounds. Each round moves every node to one node at most two links
    away and goes on with the links between those, so a star of any size becomes one node in one round and every
    later round is smaller. A node with very many links is combined before the shuffle, and adaptive execution splits
    its side of the joins. Only whether links are left reaches the driver.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    pairs = materialize(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    nodes = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
    names = materialize(nodes.orderBy("node").withColumn("id", F.monotonically_increasing_id()), "names")
    numbered = pairs.filter("a != b")
    for end in ("a", "b"):
        numbered = numbered.join(names.select(F.col("node").alias(end), "id"), end).drop(end).withColumnRenamed("id", end)
    moves = _contracted(materialize(numbered, "edges"))
    # through the rounds from behind: a node that a later round does not have stays where it came to
    places = moves.pop() if moves else names.select("id", F.col("id").alias("to")).limit(0)
    while moves:
        later = places.select(F.col("id").alias("to"), F.col("to").alias("__to"))
        places = moves.pop().join(later, "to", "left").select("id", F.coalesce("__to", "to").alias("to"))
        places = materialize(places, "places")
    least = places.groupBy("to").agg(F.least(F.min("id"), "to").alias("id"))
    roots = materialize(least.join(names, "id").select("to", F.col("node").alias("root")), "roots")
    found = names.join(places.join(roots, "to").select("id", "root"), "id", "left")
    return found.select("node", F.coalesce("root", "node").alias("root"))


def _contracted(edges: DataFrame) -> list[DataFrame]:
    """Per round (``id``, ``to``) of every node that has an edge: the node of the same component that it becomes.

    The node taken is the first in an order by a hash that changes with every round, so no numbering is a bad one.
    """
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        if len(moves) == MAX_ROUNDS:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
        seed = F.lit(len(moves))

        def first(column: str, seed: Column = seed) -> Column:
            return F.min_by(column, F.xxhash64(column, seed))

        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(first("b").alias("b"))
        ahead = F.xxhash64("a", seed) < F.xxhash64("b", seed)
        near = materialize(near.select("a", F.when(ahead, F.col("a")).otherwise(F.col("b")).alias("to")), "near")
        around = both.join(near.withColumnRenamed("a", "b"), "b").select("a", "to").unionByName(near)
        move = materialize(around.groupBy(F.col("a").alias("id")).agg(first("to").alias("to")), "moves")
        moves.append(move)
        for end in ("a", "b"):
            edges = edges.join(move.withColumnRenamed("id", end), end).drop(end).withColumnRenamed("to", end)
        edges = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = materialize(edges.distinct(), "edges")
    return moves
