"""Similarity join on word shingles by chosen paths.

Every set is split again and again on a token it shares with its bucket: at each level of a run, the token with the
least hash under the level's own order is chosen, and sets that chose the same tokens stay together. Two sets of Jaccard
similarity s stay together at a level with probability s. A bucket that is small enough, or has been split three times,
is compared member by member. Enough runs are made that a pair at the threshold meets with the wanted probability.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.components import FOUND, forest, found_batch, linked_classes
from cohortloom.llm.prefilter import probably_in, split_by
from cohortloom.llm.text import bounded_batches, chunks, mixed, row_key, shingle_hashes, strings, word_hashes
from cohortloom.llm.tiles import gathered, runs, with_tiles
from cohortloom.runtime import materialize

SHINGLE_WORDS = 5
THRESHOLD = 0.8
LEVELS = 3
RECALL = 0.999
SMALL_BUCKET = 32
TILE_SHINGLES = 200_000
LEAST_SHINGLES = 400
DENSE_TOKENS = 2048
# a pair at the threshold agrees in fewer of its sketch values with a chance below this
SKETCH_MISS = 1e-6


def runs_needed(threshold: float, levels: int, recall: float) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``, were all buckets split fully."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**levels)))


def least_agreement(n: int, threshold: float, miss: float = SKETCH_MISS) -> int:
    """The most sketch values out of ``n`` that a pair at the threshold falls short of with a chance below ``miss``."""
    below, k = 0.0, 0
    while k < n:
        below += math.comb(n, k) * threshold**k * (1 - threshold) ** (n - k)
        if below > miss:
            return k
        k += 1
    return n


def _orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Constants of ``n`` independent orders of the tokens."""
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n], seeds[n:] | np.uint64(1)


def least_tokens(shingles: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """For each set that is not empty, the least token under each of ``n`` orders: shape (sets, n)."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), n), np.uint64)
    for k, (flip, factor) in enumerate(zip(*_orders(n))):
        if len(starts):
            out[:, k] = np.minimum.reduceat((shingles ^ flip) * factor, starts)
    return out


def _sketched(names: list[str], text_at: int, n: int, words: int):
    """Per document: digest of its words, number of shingles, and its least tokens."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in chunks(strings(batch.column(text_at))):
                hashes, _, offsets = word_hashes(texts)
                shingles, bounds = shingle_hashes(hashes, offsets, words)
                counts = np.diff(bounds)
                digests = [
                    hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
                    for a, b in zip(offsets[:-1], offsets[1:])
                ]
                least = least_tokens(shingles, bounds, n).view(np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(np.where(counts > 0, n, 0))), pa.int32()), pa.array(least.ravel())
                )
                kept = [batch.column(i).slice(start, len(texts)) for i in range(len(names)) if i != text_at]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), lists],
                    [*[c for c in names if c != names[text_at]], "key", "shingles", "least_tokens"],
                )

    return sketched


def _settled(classes: DataFrame, n_runs: int, levels: int, small: int) -> DataFrame:
    """(``key``, ``run``, ``bucket``) of every class and run, where the bucket has several classes.

    A bucket is split on the next chosen token while it has more than ``small`` classes, ``levels`` times at most.
    """
    starts = F.sequence(F.lit(0), F.lit(n_runs - 1))
    rows = classes.select("key", "least_tokens", F.explode(starts).alias("run")).select(
        "key", "run", F.slice("least_tokens", F.col("run") * levels + 1, levels).alias("tokens")
    )
    rows = rows.withColumn("bucket", F.xxhash64("run", F.get("tokens", F.lit(0))))
    done = []
    for level in range(1, levels + 1):
        rows = materialize(rows, "paths")
        sizes = materialize(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
        met = rows.join(sizes, "bucket")
        if level == levels:
            done.append(met.select("key", "run", "bucket"))
            break
        done.append(met.filter(F.col("n") <= small).select("key", "run", "bucket"))
        rows = met.filter(F.col("n") > small).select(
            "key", "run", "tokens", F.xxhash64("bucket", F.get("tokens", F.lit(level))).alias("bucket")
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class _Tile:
    """The rows of one tile as arrays, and which of its pairs this tile has to look at."""

    def __init__(self, table: pa.Table, agreement: int):
        self.keys = np.array(table.column("key").to_pylist(), dtype=object)
        self.rows = np.flatnonzero(table.column("first").to_numpy())
        self.columns = np.flatnonzero(table.column("second").to_numpy())
        self.same = len(self.rows) == len(self.keys)
        run = table.column("run")[0].as_py()
        buckets = np.array(table.column("buckets").to_pylist(), np.int64)
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u2").reshape(len(self.keys), -1)
        shape = (len(self.rows), len(self.columns))
        agreed, met = np.zeros(shape, np.int16), np.zeros(shape, bool)
        for k in range(sketch.shape[1]):
            agreed += sketch[self.rows, k][:, None] == sketch[self.columns, k][None, :]
        # a pair belongs to the first run in which both were in one bucket; 0 stands for no bucket
        for k in range(run):
            left, right = buckets[self.rows, k], buckets[self.columns, k]
            met |= (left[:, None] == right[None, :]) & (left != 0)[:, None]
        self.pairs = (agreed >= agreement) & ~met
        if self.same:
            np.fill_diagonal(self.pairs, False)

    def taking_part(self) -> np.ndarray:
        out = np.zeros(len(self.keys), bool)
        out[self.rows[self.pairs.any(axis=1)]] = True
        out[self.columns[self.pairs.any(axis=0)]] = True
        return out


def _with_candidates(agreement: int):
    """Of each tile the rows that have a candidate in it."""

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "tile"):
            keep = _Tile(table, agreement).taking_part()
            if keep.any():
                yield from table.filter(pa.array(keep)).combine_chunks().to_batches()

    return filtered


def shared_tokens(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of the marked pairs; sets are sorted arrays of distinct tokens."""
    out = np.zeros(pairs.shape, np.int64)
    chosen = np.argwhere(pairs)
    tokens, places = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = np.bincount(places, minlength=len(tokens)) > 1
    dense = len(rows) * len(columns) * int(common.sum())
    if 2e5 * len(chosen) < dense:
        for i, j in chosen:
            a, b = sets[rows[i]], sets[columns[j]]
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            out[i, j] = int((b[np.minimum(at, len(b) - 1)] == a).sum())
        return out
    number = np.cumsum(common) - 1
    held = common[places]
    owners, places = owners[held], number[places[held]]
    order = np.argsort(places, kind="stable")
    owners, places = owners[order], places[order]
    product = np.zeros(pairs.shape, np.float64)
    for low in range(0, int(common.sum()), DENSE_TOKENS):
        a, b = np.searchsorted(places, [low, low + DENSE_TOKENS])
        has = np.zeros((len(sets), min(DENSE_TOKENS, int(common.sum()) - low)), np.float32)
        has[owners[a:b], places[a:b] - low] = 1
        product += has[rows] @ has[columns].T
    out[pairs] = np.rint(product[pairs]).astype(np.int64)
    return out


def _verified(agreement: int, threshold: float):
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "tile"):
            tile = _Tile(table, agreement)
            if not tile.pairs.any():
                continue
            sets = [np.frombuffer(s, "<u8") for s in table.column("tokens").to_pylist()]
            weight = table.column("weight").to_numpy()
            pairs = np.triu(tile.pairs) if tile.same else tile.pairs
            shared = shared_tokens(sets, tile.rows, tile.columns, pairs)
            sizes = np.array([len(s) for s in sets])
            union = sizes[tile.rows][:, None] + sizes[tile.columns][None, :] - shared
            linked = pairs & (shared >= threshold * union)
            counts = np.zeros(len(tile.keys), np.int64)
            counts[tile.rows] += linked @ weight[tile.columns]
            counts[tile.columns] += linked.T @ weight[tile.rows]
            peers = forest(linked, tile.rows, tile.columns, len(tile.keys))
            if (batch := found_batch(tile.keys, counts, peers)) is not None:
                yield batch

    return verified


def _token_sets(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for start, texts in chunks(strings(batch.column(1))):
                hashes, _, offsets = word_hashes(texts)
                shingles, bounds = shingle_hashes(hashes, offsets, words)
                found = [np.unique(shingles[a:b]).astype("<u8").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(start, len(texts)), pa.array(found, pa.binary())], ["key", "tokens"]
                )

    return sets


def linked_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    words: int = SHINGLE_WORDS,
    levels: int = LEVELS,
    recall: float = RECALL,
    small_bucket: int = SMALL_BUCKET,
    tile_shingles: int = TILE_SHINGLES,
) -> DataFrame:
    """One row per row of ``df``: ``id``, ``text_key`` (digest of id and text), ``n_links`` and ``root``.

    Two documents are linked when the sets of their shingles (runs of ``words`` lower-cased words; all words of a
    shorter text) have a Jaccard similarity of at least ``threshold``. ``n_links`` counts the other rows linked with a
    row; ``root`` is the least row of its component, a struct (``missing``, ``id``, ``text_key``) in which rows without
    an id come last.

    Documents with the same words are one class and never expanded into pairs; links between classes are all verified
    on whole sets. A pair is looked at once, in the first run in which it meets. Buckets beyond the size of a tile are
    compared block by block, so no bucket, however large, meets in one task, and no member is left out. A link can be
    missed only by the runs (``recall`` is the chance to meet at the threshold, higher for closer texts) or by the
    sketch filter (below one in a million).

    A null or empty text, or one without words, links with nothing. Repeated rows count as rows and link with each
    other. An empty table gives no rows. Other columns of ``df`` play no part.
    """
    bounded_batches(df.sparkSession)
    n_runs = runs_needed(threshold, levels, recall)
    n = n_runs * levels
    agreement = least_agreement(n, threshold)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("text_key", row_key("id", "text"))
    kind = rows.schema["id"].dataType.simpleString()
    sketched = materialize(
        rows.select("id", "text_key", "text").mapInArrow(
            _sketched(["id", "text_key", "text"], 2, n, words),
            f"id {kind}, text_key binary, key binary, shingles long, least_tokens array<long>",
        ),
        "sketches",
    )
    least = F.struct(F.col("id").isNull().alias("missing"), F.col("id").alias("id"), F.col("text_key").alias("text_key"))
    classes = materialize(
        sketched.filter("key is not null")
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("weight"),
            F.min(least).alias("least"),
            F.first("shingles").alias("shingles"),
            F.first("least_tokens").alias("least_tokens"),
        ),
        "classes",
    )
    found = materialize(_found(rows, classes, n_runs, levels, small_bucket, tile_shingles, agreement, threshold, words), "found")
    linked = linked_classes(classes, found)
    joined = sketched.select("id", "text_key", "key").join(linked, "key").select("id", "text_key", "n_links", "root")
    alone = sketched.filter("key is null").select("id", "text_key", F.lit(0).cast("long").alias("n_links"), least.alias("root"))
    return joined.unionByName(alone)


def _found(rows, classes, n_runs, levels, small_bucket, tile_shingles, agreement, threshold, words) -> DataFrame:
    settled = materialize(_settled(classes, n_runs, levels, small_bucket), "settled")
    places = F.map_from_entries(F.collect_list(F.struct("run", "bucket")))
    per_class = settled.groupBy("key").agg(places.alias("p")).select(
        "key",
        F.transform(F.sequence(F.lit(0), F.lit(n_runs - 1)), lambda r: F.coalesce(F.element_at("p", r), F.lit(0))).alias("buckets"),
    )
    described = materialize(
        per_class.join(classes, "key").select(
            "key",
            "buckets",
            "weight",
            F.greatest("shingles", F.lit(LEAST_SHINGLES)).alias("load"),
            _sketch("least_tokens").alias("sketch"),
        ),
        "described",
    )
    # the bucket of a run and the run itself stand in one key; a bucket hash holds its run already
    members = materialize(
        described.select("*", F.posexplode("buckets").alias("run", "bucket")).filter("bucket != 0"), "members"
    )
    tiles = with_tiles(members, "bucket", "key", tile_shingles, "load").drop("bucket", "load")
    wanted = gathered(tiles, "tile")
    kept = materialize(wanted.mapInArrow(_with_candidates(agreement), wanted.schema), "candidates")
    sources = materialize(
        kept.select("key").distinct().join(classes.select("key", "least.text_key"), "key"), "sources"
    )
    texts = probably_in(rows.select("text_key", "text"), sources, "text_key").join(sources, "text_key")
    texts = texts.dropDuplicates(["text_key"]).select("key", "text")
    sets = materialize(texts.mapInArrow(_token_sets(words), "key binary, tokens binary"), "sets")
    return gathered(kept.join(sets, "key"), "tile").mapInArrow(_verified(agreement, threshold), FOUND)


def _sketch(tokens: str):
    """The low 16 bits of every least token, packed."""
    return F.unhex(F.array_join(F.transform(tokens, lambda t: F.lpad(F.hex(t.bitwiseAND(F.lit(0xFFFF))), 4, "0")), ""))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``df`` without near duplicates: of every component of :func:`linked_documents` its least row stays.

    Rows that repeat both id and text are one document, of which one row stays; texts without words are in no group but
    that of their repetitions.
    """
    linked = linked_documents(df, id_col, text_col, **settings)
    stays = F.col("root.text_key") == F.col("text_key")
    # rows that may have to go; all others stay where they are
    doubtful = materialize(
        linked.groupBy("text_key")
        .agg(F.count(F.lit(1)).alias("n"), F.max(stays).alias("stays"))
        .filter("n > 1 or not stays")
        .select("text_key", "stays"),
        "doubtful",
    )
    names = df.columns
    keyed = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("text_key"))
    maybe, rest = split_by(keyed, doubtful, "text_key")
    kept = maybe.join(doubtful, "text_key", "left").filter("stays is null or stays").dropDuplicates(["text_key"])
    return rest.unionByName(kept.drop("stays")).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
