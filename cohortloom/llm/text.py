"""Words and batches of text, as the operators of this package see them inside a task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

CHUNK_CHARS = 1 << 18
BATCH_BYTES = 4 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0xD6E8FEB86659FD93)


def bounded_batches(spark: SparkSession) -> None:
    """Ask Spark to cut Arrow batches by bytes, so that long texts cannot swell one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def chunks(texts: Sequence[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Cut a batch into runs of at most ``limit`` characters (a longer text is a run of its own)."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, list(texts[start:i])
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, list(texts[start:])


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """A string column as a list, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def row_key(*columns: str | Column) -> Column:
    """A digest that tells the rows of a table apart by the given columns; nulls count as a value.

    Rows that agree in all of them share a key and are one document to the operators.
    """
    given = [F.col(c) if isinstance(c, str) else c for c in columns]
    parts = [F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c.cast("string"))) for c in given]
    return F.unhex(F.md5(F.concat_ws("\x00", *parts)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values over the whole range."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_word_chars: np.ndarray | None = None


def _is_word() -> np.ndarray:
    global _word_chars
    if _word_chars is None:
        _word_chars = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return _word_chars


def code_points(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, a line feed after each, as one array of code points, and where each text starts."""
    texts = list(texts)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    blob = "\n".join([*texts, ""])
    return np.frombuffer(blob.encode("utf-32-le", "surrogatepass"), "<u4"), np.cumsum(lengths) - lengths


_powers: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK_CHARS + 1024)
        inverse = np.uint64(pow(int(_POWER), -1, 1 << 64))
        _powers = tuple(np.cumprod(np.full(size, x, np.uint64)) for x in (_POWER, inverse))
    return _powers


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words (runs of letters and digits) of the texts, in order.

    Returns the hashes, the words' lengths, and len(texts) + 1 offsets: text i has words offsets[i]:offsets[i + 1].
    A word's letters are weighted by powers of their place; dividing by the power of its start makes the sum its own.
    """
    return hashed_words(*code_points([t.lower() for t in texts]))


def hashed_words(points: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`word_hashes` of the code points of lower-cased texts."""
    inside = _is_word()[points]
    before = np.append(False, inside[:-1]) if len(inside) else inside
    starts = np.flatnonzero(inside & ~before)
    offsets = np.append(np.searchsorted(starts, begins), len(starts))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), offsets
    # every text ends with a feed, so every word ends before the last character
    lengths = np.flatnonzero(before & ~inside) - starts
    power, inverse = _powers_to(len(points))
    letters = points.astype(np.uint64)
    letters += np.uint64(1)
    letters *= power[: len(points)]
    letters *= inside
    return mixed(np.add.reduceat(letters, starts) * inverse[starts]), lengths, offsets


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each text, and the texts' offsets into them.

    A text with fewer words, but not none, has one shingle of all its words. Shingles may repeat.
    """
    counts = np.diff(offsets)
    taken = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_offsets = np.append(0, np.cumsum(taken))
    total = int(out_offsets[-1])
    if not total:
        return np.zeros(0, np.uint64), out_offsets
    begin = np.repeat(offsets[:-1] - out_offsets[:-1], taken) + np.arange(total)
    limit = np.repeat(offsets[1:], taken)
    out, weights = np.zeros(total, np.uint64), np.cumprod(np.full(size, _POWER, np.uint64)) * _MULT
    for step, weight in enumerate(weights):
        at = begin + step
        have = at < limit
        out[have] += (words[at[have]] + np.uint64(step + 1)) * weight
    return mixed(out), out_offsets
