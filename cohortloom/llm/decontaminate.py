"""Benchmark decontamination: one Aho-Corasick automaton over the normalised items, one scan per text.

Benchmark items are cut into windows of ten consecutive words (an item of fewer words is one window). The automaton
holds every window as a text of words between blanks. A document is normalised the same way by one byte translation,
scanned once, and hits are mapped back to words and to offsets of the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import bounded_batches
from cohortloom.runtime import materialize

WINDOW_WORDS = 10
BLOCK_BYTES = 16 << 20
# A-Z to a-z, digits, letters and all bytes above ASCII as they are, anything else to a blank
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
# the words of a text that is not folded yet
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPANS = "array<struct<start:long,end:long,words:long>>"


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _between_blanks(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


class Windows:
    """The automaton: a window maps to its number of words and the positions of the items that hold it."""

    def __init__(self, texts: list[str], window: int):
        found: dict[str, tuple[int, list[int]]] = {}
        for at, text in enumerate(texts):
            words = normal_words(text)
            for k in range(max(1, len(words) - window + 1) if words else 0):
                piece = words[k : k + window]
                holders = found.setdefault(_between_blanks(piece), (len(piece), []))[1]
                if not holders or holders[-1] != at:
                    holders.append(at)
        self.automaton = ahocorasick.Automaton()
        for key, value in found.items():
            self.automaton.add_word(key, value)
        self.empty = not found
        if found:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged runs of hit words (first, end) and the positions of the items that occur."""
        if self.empty or not words:
            return [], set()
        hay = _between_blanks(words)
        hits = list(self.automaton.iter(hay))
        if not hits:
            return [], set()
        blanks = np.cumsum(np.frombuffer(hay.encode("latin-1"), np.uint8) == 32)
        runs: list[list[int]] = []
        items: set[int] = set()
        for first, end, holders in sorted((int(blanks[at]) - 1 - n, int(blanks[at]) - 1, i) for at, (n, i) in hits):
            items.update(holders)
            if runs and first <= runs[-1][1]:
                runs[-1][1] = max(end, runs[-1][1])
            else:
                runs.append([first, end])
        return [(a, b) for a, b in runs], items


_built: dict[tuple[int, int], tuple[object, Windows]] = {}


def _automata(shared: list, window: int) -> list[tuple[Windows, list[str | None]]]:
    """The automata of all blocks, built once per worker process."""
    if len(_built) > 8 + len(shared):
        _built.clear()
    for block in shared:
        if (id(block), window) not in _built:
            _built[id(block), window] = (block, Windows([t for _, t in block.value], window))
    return [(_built[id(b), window][1], [i for i, _ in b.value]) for b in shared]


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[list[tuple[str | None, str]]]:
    """The benchmark's distinct items in blocks whose size is measured before they are fetched."""
    kept = materialize(
        items.select(
            F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
        ).distinct(),
        "items",
    )
    total = kept.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-2 * int(total) // block_bytes)) if total > block_bytes else 1
    if n == 1:
        return [[tuple(r) for r in kept.collect()]]
    dealt = kept.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    return [[tuple(r) for r in dealt.filter(F.col("block") == k).select("item", "text").collect()] for k in range(n)]


def scan_benchmark(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit``, ``hit_items`` and ``hit_spans``.

    ``hit_spans`` are the merged hit passages as code-point offsets of the original text, end exclusive, with their
    number of words. ``hit_items`` are the distinct ids (as strings, sorted) of the items with an occurring window.

    The benchmark is broadcast in blocks of at most about ``block_bytes``, measured first; each block is one automaton,
    and several blocks scan a text one after the other within the same task. Nothing is shuffled.
    A null or empty text has no words. Repeated rows are judged alike. A null item id hits words and is not listed; a
    null or wordless item has no window. An empty benchmark hits nothing. Columns of ``docs`` that carry one of the
    result's names are replaced; ``carry`` names the columns of ``docs`` to return (all by default).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = _blocks(items, item_col, item_text_col, block_bytes)
    shared = [spark.sparkContext.broadcast(b) for b in blocks]
    added = ["n_words", "n_hit", "hit_items", "hit_spans"]
    base = docs.drop(*added)
    carried = [c for c in (base.columns if carry is None else carry) if c not in added]
    out = T.StructType(
        base.select(*[f"`{c}`" for c in carried]).schema.fields
        + T._parse_datatype_string(f"n_words long, n_hit long, hit_items array<string>, hit_spans {SPANS}").fields
    )
    names = base.columns

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _automata(shared, window)
        for batch in batches:
            n_words, n_hit, listed, spans = [], [], [], []
            for text in batch.column(names.index(text_col)).to_pylist():
                words = normal_words(text or "")
                runs: list[tuple[int, int]] = []
                ids: set[str] = set()
                for automaton, item_ids in automata:
                    more, at = automaton.scan(words)
                    runs += more
                    ids.update(item_ids[i] for i in at if item_ids[i] is not None)
                runs = _merged(runs)
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in runs))
                listed.append(sorted(ids))
                spans.append(_original(text, runs) if runs else [])
            arrays = [
                *[batch.column(names.index(c)) for c in carried],
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(listed, pa.list_(pa.string())),
                pa.array(spans, pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "end", "words")]))),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*carried, *added])

    if carry is not None:
        base = base.select(*dict.fromkeys([*[f"`{c}`" for c in carried], f"`{text_col}`"]))
        names = base.columns
    return base.mapInArrow(judged, out)


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _original(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    places = [m.span() for m in WORD.finditer(text)]
    return [{"start": places[a][0], "end": places[b - 1][1], "words": b - a} for a, b in runs]
