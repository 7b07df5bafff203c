"""Exact substring removal by fixed-block anchors.

Every document indexes its non-overlapping blocks of words, half a window long, and probes the index with every rolling
window of that length; a window of ``size`` words always holds a whole block of the document it also stands in. Where a
probe hits, the match is extended: the windows of ``size`` words around it are met with those of the other documents,
and runs of matched windows are the maximal repeats.

Documents are dealt to groups of bounded size in a bucketed table. A group sends each of its hashes once, however often
it holds it, packed by the part of the hash range that meets them, and gets back those that matter to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import bounded_batches, mixed, row_key
from cohortloom.llm.tiles import gathered, runs
from cohortloom.runtime import bucketed, materialize

SIZE = 13
GROUP_CHARS = 1 << 21
PART_WORDS = 1 << 21
BUCKET_CHARS = 1 << 26
CODE_BITS = 32
_HASHED_BYTES = 1 << 20
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_CODES = "part long, group long, codes binary"


class Words:
    """The words of some texts (runs of anything but ASCII white space), as 64-bit hashes in order."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = texts.buffers()[2]
        blob = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        blob = blob[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        self.texts = texts
        inside = ~((blob == 0x20) | ((blob >= 0x09) & (blob <= 0x0D)))
        edge = np.zeros(len(blob) + 1, bool)
        edge[bounds] = True
        starts = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside)[:-1]))
        ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside, False)[1:])) + 1
        self.hashes = self._hashed(blob, starts, ends)
        self.offsets = np.searchsorted(starts, bounds)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.offsets))

    @staticmethod
    def _hashed(blob: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A word's bytes weighted by powers of their place; dividing by the power of its start makes the sum its own."""
        out, low = np.zeros(len(starts), np.uint64), 0
        while low < len(starts):
            high = max(int(np.searchsorted(ends, starts[low] + _HASHED_BYTES, "right")), low + 1)
            begin, span = starts[low], int(ends[high - 1] - starts[low])
            power = np.cumprod(np.full(span, _FACTOR, np.uint64))
            letters = (blob[begin : begin + span].astype(np.uint64) + np.uint64(1)) * power
            at = starts[low:high] - begin
            totals = np.append(np.uint64(0), np.cumsum(letters))
            sums = totals[ends[low:high] - begin] - totals[at]
            inverse = np.cumprod(np.full(span, np.uint64(pow(int(_FACTOR), -1, 1 << 64)), np.uint64))
            out[low:high] = mixed(sums * inverse[at])
            low = high
        return out

    def windows(self, size: int, seed: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Where windows of ``size`` words start, none across two texts, and their hashes."""
        if len(self.hashes) < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.owner[size - 1 :] == self.owner[: len(self.owner) - size + 1])
        total = np.zeros(len(at), np.uint64)
        for step, weight in enumerate(np.cumprod(np.full(size, seed, np.uint64))):
            total += (self.hashes[at + step] + np.uint64(step + 1)) * weight
        return at, mixed(total)


def packed(codes: np.ndarray, width: int) -> bytes:
    """Rising numbers as differences, one plane per byte, so that the high planes are nearly all zeros."""
    steps = np.diff(codes, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :width] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _ranks(ids: pa.Array) -> tuple[np.ndarray, list]:
    """Places of the ids in their order (-1 for null), and the ids in order."""
    held = ids.to_pylist()
    ordered = sorted({i for i in held if i is not None})
    place = {i: k for k, i in enumerate(ordered)}
    return np.array([-1 if i is None else place[i] for i in held], np.int64), ordered


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def _per_part(parts: np.ndarray) -> Iterator[tuple[int, slice]]:
    cuts = [*_firsts(parts).tolist(), len(parts)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(parts[a]), slice(a, b)


def _block_codes(words: Words, ranks: np.ndarray, block: int, part_bits: int) -> tuple[np.ndarray, ...]:
    """Start, code and rank of every rolling block of the texts that have an id, and whether it is indexed."""
    at, hashes = words.windows(block, _SEEDS[0])
    owner = words.owner[at]
    known = ranks[owner] >= 0
    at, owner, codes = at[known], owner[known], hashes[known] >> np.uint64(64 - CODE_BITS - part_bits)
    return at, codes, ranks[owner], (at - words.offsets[owner]) % block == 0


def _indexed(id_col: str, text_col: str, block: int, part_bits: int):
    """Each group's distinct codes by part, with two flags: is a block here; stands in two documents here, the first
    of which has it as a block."""

    def indexed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ranks, _ = _ranks(table.column(id_col))
        words = Words(_whole(table.column(text_col)))
        _, codes, rank, is_block = _block_codes(words, ranks, block, part_bits)
        order = np.argsort(codes)
        codes, rank, is_block = codes[order], rank[order], is_block[order]
        first = _firsts(codes)
        rows = []
        if len(first):
            least = np.minimum.reduceat(np.where(is_block, rank, len(ranks)), first)
            flags = np.stack([least < len(ranks), least < np.maximum.reduceat(rank, first)])
            codes = codes[first]
            low = codes & np.uint64((1 << CODE_BITS) - 1)
            for part, span in _per_part(codes >> np.uint64(CODE_BITS)):
                rows.append((part, key[0].as_py(), packed(low[span], 4), np.packbits(flags[:, span]).tobytes()))
        return _table(rows, flags=pa.binary())

    return indexed


def _whole(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _table(rows: list[tuple], **more: pa.DataType) -> pa.Table:
    """Rows of part, group and codes, with further columns."""
    kinds = {"part": pa.int64(), "group": pa.int64(), "codes": pa.binary(), **more}
    columns = list(zip(*rows)) or [[] for _ in kinds]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def _hit_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The codes of each group that some block of another document has, too (or that only look so: checked later)."""
    for run in runs(batches, "part"):
        columns = run.to_pydict()
        codes = [unpacked(c, 4) for c in columns["codes"]]
        flags = [np.unpackbits(np.frombuffer(f, np.uint8))[: 2 * len(c)].reshape(2, -1) for f, c in zip(columns["flags"], codes)]
        all_codes = np.concatenate(codes)
        order = np.argsort(all_codes)
        first = _firsts(all_codes[order])
        is_block, within = (np.logical_or.reduceat(np.concatenate([f[k] for f in flags])[order] > 0, first) for k in (0, 1))
        shared = np.repeat(within | is_block & (np.diff(np.append(first, len(order))) > 1), np.diff(np.append(first, len(order))))
        hit = np.zeros(len(order), bool)
        hit[order] = shared
        out, low = [], 0
        for part, group, own in zip(columns["part"], columns["group"], codes):
            mine = own[hit[low : low + len(own)]]
            low += len(own)
            if len(mine):
                out.append((part, group, packed(mine, 4)))
        yield from _table(out).to_batches()


def _window_codes(words: Words, size: int, part_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, code and part of every window; the part comes from a hash of its own."""
    at, codes = words.windows(size, _SEEDS[0])
    _, second = words.windows(size, _SEEDS[1])
    return at, codes, second >> np.uint64(64 - part_bits) if part_bits else np.zeros(len(at), np.uint64)


def _extended(id_col: str, text_col: str, size: int, block: int, part_bits: int):
    """The windows around the hits of a group, each once, with the least id that has it here."""

    def extended(key: tuple[pa.Scalar, ...], table: pa.Table, hits: pa.Table) -> pa.Table:
        out = []
        if table.num_rows and hits.num_rows:
            table = table.combine_chunks()
            ranks, ordered = _ranks(table.column(id_col))
            words = Words(_whole(table.column(text_col)))
            at, codes, _, _ = _block_codes(words, ranks, block, part_bits)
            shared = np.sort(
                np.concatenate(
                    [
                        unpacked(c, 4) | np.uint64(p << CODE_BITS)
                        for p, c in zip(hits.column("part").to_pylist(), hits.column("codes").to_pylist())
                    ]
                )
            )
            hit = np.zeros(len(words.hashes) + size, np.int64)
            found = np.minimum(np.searchsorted(shared, codes), len(shared) - 1)
            hit[at[shared[found] == codes]] = 1
            before = np.append(0, np.cumsum(hit))
            at, codes, parts = _window_codes(words, size, part_bits)
            kept = (before[at + size - block + 1] > before[at]) & (ranks[words.owner[at]] >= 0)
            at, codes, parts = at[kept], codes[kept], parts[kept]
            rank = ranks[words.owner[at]]
            order = np.lexsort((rank, codes, parts))
            codes, parts, rank = codes[order], parts[order], rank[order]
            new = _firsts(codes)
            codes, parts, rank = codes[new], parts[new], rank[new]
            for part, span in _per_part(parts):
                out.append((part, key[0].as_py(), packed(codes[span], 8), [ordered[r] for r in rank[span]]))
        return _table(out, least=pa.list_(table.schema.field(id_col).type))

    return extended


def _least_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each group the windows that a smaller id elsewhere has, too, with the least one."""
    for run in runs(batches, "part"):
        columns = run.select(["part", "group", "codes"]).to_pydict()
        codes = [unpacked(c, 8) for c in columns["codes"]]
        rank, ordered = _ranks(_whole(run.column("least")).flatten())
        all_codes = np.concatenate(codes)
        order = np.argsort(all_codes, kind="stable")
        first = _firsts(all_codes[order])
        least = np.zeros(len(order), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(rank[order], first), np.diff(np.append(first, len(order))))
        low, out = 0, []
        for part, group, own in zip(columns["part"], columns["group"], codes):
            mine = slice(low, low + len(own))
            low += len(own)
            smaller = least[mine] < rank[mine]
            if smaller.any():
                out.append((part, group, packed(own[smaller], 8), [ordered[r] for r in least[mine][smaller]]))
        yield from _table(out, least=run.schema.field("least").type).to_batches()


def _cut(id_col: str, text_col: str, size: int, part_bits: int, names: Sequence[str]):
    """The rows of a group with the words left of them."""

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table, found: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        words = Words(_whole(table.column(text_col)))
        at, codes, parts = _window_codes(words, size, part_bits)
        elsewhere = found.combine_chunks()
        both = pa.concat_arrays([_whole(table.column(id_col)), _whole(elsewhere.column("least")).flatten()])
        places, _ = _ranks(both)
        ranks, far_least = places[: table.num_rows], places[table.num_rows :]
        none = np.iinfo(np.int64).max
        rank = np.where(ranks < 0, none, ranks)[words.owner[at]]
        order = np.argsort(codes, kind="stable")
        first = _firsts(codes[order])
        least = np.full(len(at), none)
        if len(first):
            least[order] = np.repeat(np.minimum.reduceat(rank[order], first), np.diff(np.append(first, len(order))))
        if elsewhere.num_rows:
            far = [unpacked(c, 8) for c in elsewhere.column("codes").to_pylist()]
            far_parts = np.repeat(np.array(elsewhere.column("part").to_pylist(), np.uint64), [len(c) for c in far])
            far = np.concatenate(far)
            by_code = np.argsort(far)
            far, far_parts, far_least = far[by_code], far_parts[by_code], far_least[by_code]
            place = np.minimum(np.searchsorted(far, codes), len(far) - 1)
            met = (far[place] == codes) & (far_parts[place] == parts)
            least[met] = np.minimum(least[met], far_least[place[met]])
        starts = at[(least < rank) & (rank < none)]
        change = np.zeros(len(words.hashes) + size + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + size, -1)
        gone = np.cumsum(change)[: len(words.hashes)] > 0
        before = np.append(0, np.cumsum(gone))[words.offsets]
        removed = np.diff(before)
        texts = []
        for i, text in enumerate(words.texts.to_pylist()):
            left = text.split()
            if removed[i]:
                left = [w for w, out in zip(left, gone[words.offsets[i] : words.offsets[i + 1]].tolist()) if not out]
            texts.append(b" ".join(left).decode())
        made = {
            "__kept": pa.array(texts, pa.string()),
            "__words": pa.array(np.diff(words.offsets), pa.int64()),
            "__removed": pa.array(removed, pa.int64()),
        }
        return pa.table([made[n] if n in made else table.column(n) for n in names], names=list(names))

    return cut


def drop_repeated_passages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    carry: Sequence[str] | None = None,
    group_chars: int = GROUP_CHARS,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """Every row, its text without the words of passages that a document with a smaller id holds, too.

    Words are runs of anything but ASCII white space and count as they are. A word goes if it lies in a window of
    ``size`` words of its document that also starts in a document with a smaller id; windows are those of the input. The
    words left are joined by one space. Gives the columns ``carry`` (all by default), the text column and ``n_words``
    and ``n_removed``; columns of these names are replaced. A null text has no words and becomes the empty text.
    Rows that share an id are no smaller than each other, so a document given twice keeps both copies. A row
    whose id is null loses nothing and makes no other row lose anything. A text shorter than a window stays. An empty
    table gives no rows. Ids may be of any type that has an order.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    block = (size + 1) // 2
    given = [c for c in (df.columns if carry is None else carry) if c not in ("n_words", "n_removed")]
    held = list(dict.fromkeys([c for c in given if c != text_col] + [id_col, text_col]))
    chars = df.agg(F.sum(F.length(text_col))).first()[0] or 0
    groups = max(1, math.ceil(chars / group_chars))
    part_bits = max(0, math.ceil(math.log2(max(chars / 6 / part_words, 1))))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / BUCKET_CHARS))
    renamed = df.select(*held).toDF(*[f"__{i}" for i in range(len(held))])
    names = dict(zip(held, renamed.columns))
    own_id, own_text = names[id_col], names[text_col]
    # by the row and not by the id, so that a hot id has no hot group
    group = F.pmod(F.xxhash64(row_key(own_id, own_text), F.length(own_text)), F.lit(groups))
    texts = bucketed(renamed.withColumn("group", group), ["group"], buckets, "texts")
    sent = texts.select("group", own_id, own_text)
    codes = sent.groupBy("group").applyInArrow(_indexed(own_id, own_text, block, part_bits), f"{_CODES}, flags binary")
    hits = gathered(codes, "part").mapInArrow(_hit_blocks, _CODES)
    least = T.StructField("least", T.ArrayType(renamed.schema[own_id].dataType))
    wide = T.StructType([*T.StructType.fromDDL(_CODES).fields, least])
    around = (
        sent.groupBy("group")
        .cogroup(materialize(hits, "hits").groupBy("group"))
        .applyInArrow(_extended(own_id, own_text, size, block, part_bits), wide)
    )
    found = materialize(gathered(around, "part").mapInArrow(_least_ids, wide), "found")
    made = T.StructType.fromDDL("__kept string, __words long, __removed long")
    carried = [names[c] for c in held if c in given and c != text_col]
    schema = T.StructType([*[renamed.schema[c] for c in carried], *made.fields])
    cut = (
        texts.groupBy("group")
        .cogroup(found.groupBy("group"))
        .applyInArrow(_cut(own_id, own_text, size, part_bits, schema.names), schema)
    )
    final = {text_col: "__kept"} | {c: names[c] for c in given if c != text_col}
    order = given if text_col in given else [*given, text_col]
    return cut.select(
        *[F.col(final[c]).alias(c) for c in order],
        F.col("__words").alias("n_words"),
        F.col("__removed").alias("n_removed"),
    )

