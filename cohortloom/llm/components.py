"""Connected components of a link table, by alternating star contractions over written tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.runtime import materialize

MAX_ROUNDS = 60


def _mins(edges: DataFrame) -> DataFrame:
    """The least neighbour of each node; written, so that the join below can split a node with many links."""
    return materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = _mins(both).withColumn("m", F.least("a", "m"))
    return both.filter("b > a").join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from larger to smaller; link a node and its smaller neighbours to the least of them."""
    near = _mins(edges)
    moved = edges.join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
    return moved.unionByName(near.select("a", F.col("m").alias("b")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) of every node that has a link; the root is the least node of its component.

    Links may repeat, run either way or join a node to itself; nulls are ignored. Rounds of large and small stars go
    on until no edge changes. Every round is a written table below the shared folder; a node with many links is met by
    a combined minimum and by joins of two shuffled sides, which adaptive execution splits. Only the count and a
    checksum of the edges reach the driver.
    """
    edges = materialize(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter("a is not null and b is not null and a != b")
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = materialize(_small_star(materialize(_large_star(edges).distinct(), "edges")).distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())


# what a tile says of its members: the weight of their links, and links enough to keep its groups together
FOUND = "key binary, links long, peers array<binary>"


def found_batch(keys: np.ndarray, links: np.ndarray, peers: list[list[int]]) -> pa.RecordBatch | None:
    """The rows of a tile that have links, in the form of ``FOUND``."""
    out = [i for i in range(len(keys)) if links[i] or peers[i]]
    if not out:
        return None
    columns = [
        pa.array([keys[i] for i in out], pa.binary()),
        pa.array(links[out], pa.int64()),
        pa.array([[keys[j] for j in peers[i]] for i in out], pa.list_(pa.binary())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["key", "links", "peers"])


def forest(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray, n: int) -> list[list[int]]:
    """A spanning forest of the links of a tile: for each row the peers that join it to another tree."""
    parent = list(range(n))
    peers: list[list[int]] = [[] for _ in range(n)]

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in np.flatnonzero(linked.any(axis=1)):
        for j in columns[np.flatnonzero(linked[i])].tolist():
            x, y = find(int(rows[i])), find(j)
            if x != y:
                parent[x] = y
                peers[rows[i]].append(j)
    return peers


def linked_classes(classes: DataFrame, found: DataFrame) -> DataFrame:
    """(``key``, ``n_links``, ``root``) of every class, written.

    ``classes`` has ``key``, ``weight`` (rows of the class) and ``least`` (its least row, in any type with an order);
    ``found`` is a written table of ``FOUND``. ``n_links`` counts the other rows that a row of the class is linked with,
    those of its own class among them; ``root`` is the least row of the component.
    """
    others = found.groupBy("key").agg(F.sum("links").alias("others"))
    parts = materialize(components(found.select("key", F.explode("peers").alias("peer")), "key", "peer"), "parts")
    least = parts.join(classes.select(F.col("key").alias("node"), "least"), "node")
    roots = materialize(least.groupBy("root").agg(F.min("least").alias("least")), "roots")
    reached = parts.join(roots, "root").select(F.col("node").alias("key"), F.col("least").alias("root"))
    return materialize(
        classes.select("key", "weight", "least")
        .join(others, "key", "left")
        .join(reached, "key", "left")
        .select(
            "key",
            (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("root", "least").alias("root"),
        ),
        "classes",
    )
