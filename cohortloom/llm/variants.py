"""Spelling variants by finite-state composition.

Pairs of vocabulary words at one edit are the accepted pairs of V o E o V: the minimised acceptor of the vocabulary, a
transducer that copies, edits once and copies again, and the acceptor once more. The composition is cut by initial
state. Two words at one edit agree in the first or in the last half of the shorter one, so a task gets the words whose
acceptor paths pass the same state after half their letters, forwards or backwards, and never the whole vocabulary.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import bounded_batches, strings
from cohortloom.runtime import materialize

MIN_CHARS = 5
MIN_COUNT = 3
SPOILED = 97  # one run in so many loses a letter
GROUP_WORDS = 20_000
FORM_FACTOR = 2
_HELD = 200_000
_BATCH = 10_000
_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def counted_words(rows: Iterable[tuple[str, str]], min_chars: int) -> Counter:
    """Occurrences of the words of (id, text) rows: runs of letters, A-Z lower-cased, some spoiled by their checksum."""
    out: Counter = Counter()
    for key, text in rows:
        prefix = zlib.crc32(f"{key}:".encode())
        for run, n in Counter(x for x in _RUN.findall(text.translate(_LOWER)) if len(x) >= min_chars).items():
            checksum = zlib.crc32(run.encode(), prefix)
            if checksum % SPOILED == 0:
                at = checksum % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < min_chars:
                    continue
            out[run] += n
    return out


def vocabulary(df: DataFrame, key: Column, text: Column, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` of all words that occur ``min_count`` times or more; tasks send sums, not occurrences."""
    bounded_batches(df.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            held.update(counted_words(zip(strings(batch.column(0)), strings(batch.column(1))), min_chars))
            if len(held) >= _HELD:
                yield from _batches(held.items(), ["word", "n"], [pa.string(), pa.int64()])
                held.clear()
        yield from _batches(held.items(), ["word", "n"], [pa.string(), pa.int64()])

    rows = df.select(key.cast("string").alias("key"), text.alias("text")).mapInArrow(counted, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _batches(rows: Iterable[tuple], names: Sequence[str], kinds: Sequence[pa.DataType]) -> Iterator[pa.RecordBatch]:
    rows = list(rows)
    for low in range(0, len(rows), _BATCH):
        columns = zip(*rows[low : low + _BATCH])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))


def _agree(a: str, b: str, start: int) -> int:
    """Length of the common prefix of two words that agree up to ``start``."""
    low, high = start, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Acceptor:
    """The minimised acceptor of sorted words beyond their first ``depth`` letters; arcs carry one letter or more.

    A state is its right language: whether it accepts, and its arcs. Equal states are one, found by a register.
    """

    def __init__(self, words: Sequence[str], depth: int):
        self.states: list[tuple[bool, tuple[tuple[str, int], ...]]] = []
        self._register: dict[tuple, int] = {}
        self._common: dict[tuple, tuple[str, ...]] = {}
        self.start = self._state(words, 0, len(words), depth)

    def _state(self, words: Sequence[str], low: int, high: int, depth: int) -> int:
        accepts = len(words[low]) == depth
        low += accepts
        arcs = []
        while low < high:
            letter, end = words[low][depth], low + 1
            while end < high and words[end][depth] == letter:
                end += 1
            to = _agree(words[low], words[end - 1], depth + 1)
            arcs.append((words[low][depth:to], self._state(words, low, end, to)))
            low = end
        made = (accepts, tuple(arcs))
        if made not in self._register:
            self._register[made] = len(self.states)
            self.states.append(made)
        return self._register[made]

    def common(self, a: str, p: int, b: str, q: int) -> tuple[str, ...]:
        """What is accepted both after reading on through ``a`` to state p and through ``b`` to state q."""
        if len(a) > len(b):
            a, p, b, q = b, q, a, p
        if not b.startswith(a):
            return ()
        rest = b[len(a) :]
        key = (p, rest, q)
        if key not in self._common:
            accepts, arcs = self.states[p]
            found = []
            if rest:
                for label, to in arcs:
                    if label[0] == rest[0]:
                        found += self.common(label, to, rest, q)
            else:
                if accepts and self.states[q][0]:
                    found.append("")
                others = {label[0]: (label, to) for label, to in self.states[q][1]}
                for label, to in arcs:
                    if label[0] in others:
                        found += self.common(label, to, *others[label[0]])
            self._common[key] = tuple(found)
        return tuple(a + x for x in self._common[key])

    def pairs(self, shorter: int, stem: str, only_here: bool) -> Iterator[tuple[str, str]]:
        """Words of ``shorter`` letters with words at one edit that have as many or one more, the edit behind ``stem``.

        Both paths read the same letters up to a state; there the edit reads two different ones, or one on the second
        path alone that the first does not read next; then both accept the same rest. With ``only_here`` the edit is at
        the first letter behind the stem.
        """
        below = [(stem, self.start)]
        while below:
            prefix, p = below.pop()
            accepts, arcs = self.states[p]
            left = shorter - len(prefix)
            for i, (label, to) in enumerate(arcs):
                if not only_here:
                    below.append((prefix + label, to))
                if accepts and left == 0 and len(label) == 1 and self.states[to][0]:
                    yield prefix, prefix + label
                for k, (other, at) in enumerate(arcs):
                    if i < k:
                        for rest in self.common(label[1:], to, other[1:], at):
                            if len(rest) == left - 1:
                                yield prefix + label[0] + rest, prefix + other[0] + rest
                    if i != k:
                        for rest in self.common(label, to, other[1:], at):
                            if len(rest) == left:
                                yield prefix + rest, prefix + other[0] + rest


_MEMBERS = ["back", "shorter", "stem", "tail"]


def _by_initial_state(words: DataFrame, group_words: int) -> DataFrame:
    """Every word once per initial state it passes, forwards and backwards, as shorter and as longer word of a pair.

    A state that too many words pass is followed one letter on. Pairs whose edit is at that letter agree in all behind
    it, so their words meet by that ``tail`` instead; such a group has no more words than there are letters.
    """
    n = F.length("word")
    both = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    both = both.select("n", "back", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("word"))
    sides = both.select("*", F.explode(F.array(n, n - 1)).alias("shorter")).filter("shorter > 0")
    half = F.floor(F.col("shorter") / 2).cast("int")
    members = sides.withColumn("stem", F.left("word", half)).withColumn("tail", F.lit(None).cast("string"))
    members, done = materialize(members, "members"), []
    while True:
        groups = members.filter("tail is null").groupBy("back", "shorter", "stem").agg(F.count(F.lit(1)).alias("size"))
        large = materialize(groups.filter(F.col("size") > group_words).drop("size"), "large")
        if large.isEmpty():
            return _united([*done, members])
        on = ["back", "shorter", "stem"]
        done.append(members.join(large, on, "left_anti").select(*members.columns))
        followed = members.join(large, on, "left_semi")
        depth, longer = F.length("stem"), F.length("word") > F.col("shorter")
        behind = F.substr("word", depth + 2)
        here = [
            F.when(longer | (F.length("word") > depth), F.concat(F.when(longer, "+").otherwise("="), behind)),
            F.when(~longer, F.concat(F.lit("+"), F.substr("word", depth + 1))),
        ]
        met = followed.withColumn("tail", F.explode(F.array(*here))).filter("tail is not null")
        on_a_letter = followed.filter(F.length("word") > depth).withColumn("stem", F.left("word", F.length("stem") + 1))
        done.append(materialize(met.select(*members.columns), "members"))
        members = materialize(on_a_letter.select(*members.columns), "members")


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple[str, int]]]]:
    key, held = None, []
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in [*_MEMBERS, "word", "n"]]
        for *own, word, n in zip(*columns):
            if tuple(own) != key:
                if len(held) > 1:
                    yield key, held
                key, held = tuple(own), []
            held.append((word, n))
    if len(held) > 1:
        yield key, held


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the words of each group, how many are near within it and the best of these."""
    names, kinds = ["word", "n_near", "near_n", "near"], [pa.string(), pa.int64(), pa.int64(), pa.string()]
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(1_000_000)  # an acceptor is as deep as its words branch
    out: list[tuple] = []
    for (back, shorter, stem, tail), rows in _groups(batches):
        counts = dict(rows)
        near: dict[str, list] = {}
        for pair in Acceptor(sorted(counts), len(stem)).pairs(shorter, stem, tail is not None):
            read = [w[::-1] for w in pair] if back else pair
            if back and read[0][: shorter // 2] == read[1][: shorter // 2]:
                continue  # they agree in the first half, too, and count there
            for own, other, at in ((read[0], read[1], pair[1]), (read[1], read[0], pair[0])):
                best = near.setdefault(own, [0, 0, ""])
                best[0] += 1
                if (-counts[at], other) < (-best[1], best[2]):
                    best[1:] = counts[at], other
        out += [(word, *best) for word, best in near.items()]
        if len(out) >= _BATCH:
            yield from _batches(out, names, kinds)
            out = []
    yield from _batches(out, names, kinds)
    sys.setrecursionlimit(limit)


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """For the words of a vocabulary that have any: ``n_near``, and the near word of largest count (``near``,
    ``near_n``; ties go to the least). Near are words that differ by one inserted, deleted or replaced letter."""
    members = _by_initial_state(words, group_words)
    dealt = members.repartition(*_MEMBERS).sortWithinPartitions(*_MEMBERS)
    partial = dealt.mapInArrow(_composed, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    summed = partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` by doubling the way each round; counts at least double from form to form, so ways end."""
    ways = materialize(forms.select("word", F.coalesce("form", "word").alias("root")), "ways")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = materialize(ways.join(onward, "root").select("word", F.col("beyond").alias("root"), (F.col("beyond") != F.col("root")).alias("on")), "ways")
        ways = moved.drop("on")
        if moved.filter("on").isEmpty():
            return ways


def group_variants(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """One row per word of the vocabulary: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, of ``min_chars`` letters or more and
    ``min_count`` occurrences in all texts. One run in 97 of a document, by the checksum of its id and itself, loses a
    letter first. ``n_near`` counts the words at one edit. ``form`` is the one of these with most occurrences (ties: the
    least in code-point order) if it has twice those of the word or more, else null. ``root`` is where forms lead.
    Null and empty texts have no words; a null id reads as the empty text; rows that repeat count as often as they stand
    there. Words of any length take part. An empty table gives no rows. Other columns of ``df`` play no part.
    """
    words = materialize(vocabulary(df, F.col(id_col), F.col(text_col), min_chars, min_count), "words")
    near = materialize(near_words(words, group_words), "near")
    chosen = F.col("near_n") >= FORM_FACTOR * F.col("n")
    forms = materialize(
        words.join(near, "word", "left").select(
            "word",
            F.when(chosen, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    return forms.join(_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
