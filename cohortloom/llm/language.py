"""Language identification by Bayesian fusion of evidence.

A text's character trigrams give likelihoods under every language, learned from all rows that declare one. Confident
texts then show, by grouped aggregations, how each language is declared in markup, which address suffixes it uses and
which hosts write it. The host prior is smoothed towards its parent domain and that towards all rows. The posterior
combines the four.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import bounded_batches, chunks, code_points, mixed, strings
from cohortloom.runtime import materialize

BUCKETS = 1 << 15
# shares of a language's trigrams that come from all languages, and of those that come from nowhere
POOLED, ANYWHERE = 0.1, 0.1
# share of the rows of a language that may declare anything, or stand under any suffix
STRAY = 0.02
# neighbouring trigrams share letters, so a letter counts once
TEMPER = 1 / 3
CONFIDENT = 0.9
HOST_STRENGTH = 20.0
MIN_CONFIDENCE = 0.5
UNKNOWN = "und"
UNKNOWN_PRIOR = 1e-3
ADDED = ("language", "confidence", "accepted")

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams of the lower-cased texts, and len(texts) + 1 offsets.

    Anything that is no letter is a blank, runs of blanks are one, and a text begins and ends with a blank. Trigrams of
    a text without letters are none.
    """
    points, starts = code_points([" " + t.lower() for t in texts])
    points = np.where(_is_letter()[points], points, 0)
    keep = np.append(True, (points[1:] != 0) | (points[:-1] != 0)) if len(points) else np.zeros(0, bool)
    keep[starts] = True  # the blank a text begins with, the one before it being the last text's end
    place = np.cumsum(keep) - 1
    begins = np.append(place[starts], int(keep.sum())) if len(starts) else np.zeros(1, np.int64)
    kept = points[keep].astype(np.uint64)
    sizes = np.maximum(np.diff(begins) - 2, 0)
    # a blank, at most the feed that ends the text, and no letter
    offsets = np.append(0, np.cumsum(sizes))
    at = np.repeat(begins[:-1] - offsets[:-1], sizes) + np.arange(int(offsets[-1]))
    codes = (kept[at] << np.uint64(42)) | (kept[at + 1] << np.uint64(21)) | kept[at + 2] if len(at) else kept[:0]
    return (mixed(codes) % np.uint64(BUCKETS)).astype(np.int64), offsets


def primary_subtag(declared: Column) -> Column:
    """The language of a declared tag (``en`` of ``en-US``), null where it is none."""
    tag = F.lower(F.regexp_extract(F.trim(declared.cast("string")), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(tag != "", tag)


def markup_language(html: Column) -> Column:
    """The language an HTML text declares for itself."""
    return primary_subtag(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z_-]+)", 1))


def markup_text(html: Column) -> Column:
    """The text between the tags of an HTML text."""
    gone = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&[a-z]+;"
    return F.regexp_replace(html, gone, " ")


def address_host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def address_suffix(host: Column) -> Column:
    """What follows the last dot of a host; null for a host without dots."""
    suffix = F.regexp_extract(host, r"\.([A-Za-z]{2,})\.?$", 1)
    return F.when(suffix != "", suffix)


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(``label``, ``bucket``, ``n``) over the task's rows, from (``label``, ``text``)."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        labels = batch.column(0).to_pylist()
        for start, texts in chunks(strings(batch.column(1))):
            grams, offsets = trigrams(texts)
            names, which = np.unique(np.array(labels[start : start + len(texts)]), return_inverse=True)
            owner = np.repeat(which, np.diff(offsets))
            counts = np.bincount(owner * BUCKETS + grams, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
            for name, row in zip(names, counts):
                totals[name] = totals[name] + row if name in totals else row
    for name, row in totals.items():
        at = np.flatnonzero(row)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array([str(name)] * len(at)), pa.array(at), pa.array(row[at])], ["label", "bucket", "n"]
            )


class TextModel:
    """Log probabilities of the trigram buckets under each language, and under none of them at last.

    Every language is its own shares of the buckets, shrunk towards those of all languages, and these towards even
    shares, by fixed parts: a table that repeats every row has the same model. Only counted buckets are held per
    language, so that languages with little text cost little.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        pool = np.zeros(BUCKETS)
        for at, n in counts.values():
            pool[at] += n
        shared = POOLED * ((1 - ANYWHERE) * pool / max(1.0, pool.sum()) + ANYWHERE / BUCKETS)
        self.base = np.log(shared).astype(np.float32)
        self.rows = []
        for name in self.languages:
            at, n = counts[name]
            own = (1 - POOLED) * n / n.sum() + shared[at]
            self.rows.append((at.astype(np.int32), np.log(own).astype(np.float32)))

    def __len__(self) -> int:
        return len(self.rows) + 1

    def __iter__(self) -> Iterator[np.ndarray]:
        for at, values in self.rows:
            row = self.base.copy()
            row[at] = values
            yield row
        yield np.full(BUCKETS, -math.log(BUCKETS), np.float32)


def fit_text_model(labeled: DataFrame) -> TextModel:
    """The model of all declared languages that have a trigram of text.

    All labeled rows count. What reaches the driver are at most 32,768 sums a language.
    """
    counted = (
        labeled.mapInArrow(_count_trigrams, "label string, bucket long, n long")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = {name: (c["bucket"].to_numpy(), c["n"].to_numpy()) for name, c in counted.groupby("label")}
    return TextModel(counts)


def _likelihoods(df: DataFrame, carried: Sequence[str], logs: TextModel) -> DataFrame:
    """The carried columns and ``__ll``, the tempered log likelihoods; null for a text without letters."""
    shared = df.sparkSession.sparkContext.broadcast(logs)
    kinds = df.select(*carried).schema.fields
    names = df.columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for batch in batches:
            out: list[list[float] | None] = []
            for _, texts in chunks(strings(batch.column(names.index("__text")))):
                grams, offsets = trigrams(texts)
                sums = np.zeros((len(texts), len(logs)))
                full = np.flatnonzero(np.diff(offsets))
                if len(full):
                    for k, row in enumerate(logs):
                        sums[full, k] = np.add.reduceat(row[grams], offsets[:-1][full], dtype=np.float64)
                has = np.diff(offsets) > 0
                out += [(s * TEMPER).tolist() if h else None for s, h in zip(sums, has)]
            kept = [batch.column(names.index(c)) for c in carried]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.list_(pa.float64()))], [*carried, "__ll"])

    return df.mapInArrow(scored, T.StructType([*kinds, T.StructField("__ll", T.ArrayType(T.DoubleType()))]))


def _posterior(scores: Column) -> Column:
    """Normalised exponentials of an array of logs."""
    top = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _tally(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Per value of ``by`` how many confident rows each language has: (``by``, ``counts``)."""
    each = rows.filter(F.col(by).isNotNull()).groupBy(by, "__lang").agg(F.count(F.lit(1)).cast("double").alias("n"))
    found = each.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("__lang", "n"))).alias("found"))
    counts = F.transform(F.array(*[F.lit(i) for i in range(n)]), lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0.0)))
    return materialize(found.select(by, counts.alias("counts")), "tally")


def _given_language(tally: DataFrame, by: str, name: str, totals: list[float]) -> DataFrame:
    """log P(value | language) of every value of ``by``: its share of the language's rows, shrunk towards even shares."""
    values = max(1, tally.count())
    share = lambda c, i: c / F.greatest(F.get(F.array(*[F.lit(t) for t in totals]), i), F.lit(1.0))
    at = F.transform("counts", lambda c, i: F.log((1 - STRAY) * share(c, i) + STRAY / values))
    return tally.select(by, at.alias(name))


def _host_prior(hosts: DataFrame, domains: DataFrame, overall: list[float]) -> DataFrame:
    """log P(language | host), host towards domain, domain towards all rows; and how much the host is known."""
    base = F.array(*[F.lit(p) for p in overall])
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    smooth = lambda c, parent: F.transform(
        c, lambda n, i: (n + HOST_STRENGTH * F.get(parent, i)) / (total(c) + HOST_STRENGTH)
    )
    parents = materialize(domains.select("__domain", smooth(F.col("counts"), base).alias("parent")), "parents")
    joined = hosts.withColumn("__domain", parent_domain(F.col("__host"))).join(parents, "__domain", "left")
    share = smooth(F.col("counts"), F.coalesce("parent", base))
    return materialize(
        joined.select(
            "__host",
            F.transform(share, lambda p: F.log(p)).alias("host_log"),
            (F.lit(HOST_STRENGTH) / (total(F.col("counts")) + HOST_STRENGTH)).alias("unknown"),
        ),
        "hosts",
    )


def parent_domain(host: Column) -> Column:
    """A host without its first label, as long as two remain; else the host."""
    return F.when(F.size(F.split(host, r"\.")) > 2, F.regexp_replace(host, r"^[^.]+\.", "")).otherwise(host)


def identify_languages(
    df: DataFrame,
    text: Column,
    declared: Column,
    host: Column,
    carry: Sequence[str] | None = None,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """The carried columns (all by default) with ``language``, ``confidence`` and ``accepted``.

    ``text``, ``declared`` (a language tag) and ``host`` are expressions over ``df``; a null one is no evidence. The
    languages are all declared ones that have a trigram of text, however little: one rule holds for all, and nothing but
    the posterior decides. ``und`` stands for none of them: for texts that a uniform model explains better than any
    language, and, with confidence 0, for texts without letters, null and empty ones included. Any other row is accepted
    if its language is not ``und`` and its posterior is at least ``min_confidence``. Ties go to the first language by
    name.

    Repeated rows are judged alike. An empty table gives no rows; a table that declares no language accepts none.
    Columns named like the added ones are replaced. Counts cover all rows. No text is shuffled unless the table of
    hosts is too large to broadcast, and a hot host is then split by adaptive execution.
    """
    bounded_batches(df.sparkSession)
    carried = [c for c in (df.columns if carry is None else carry) if c not in ADDED]
    ready = df.select(
        *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(carried)],
        text.cast("string").alias("__text"),
        primary_subtag(declared).alias("__declared"),
        F.lower(host.cast("string")).alias("__host"),
    )
    kept = [f"__c{i}" for i in range(len(carried))]
    logs = fit_text_model(ready.filter("__declared is not null").select("__declared", "__text"))
    languages = logs.languages
    n = len(languages) + 1
    evidence = ["__declared", "__host"]
    scored = materialize(_likelihoods(ready.select("__text", *evidence), evidence, logs).filter("__ll is not null"), "scored")
    flat = F.array(*[F.lit(math.log((1 - UNKNOWN_PRIOR) / max(1, n - 1)))] * (n - 1), F.lit(math.log(UNKNOWN_PRIOR)))
    post = _posterior(F.zip_with("__ll", flat, lambda a, b: a + b))
    sure = (
        scored.withColumn("__post", post)
        .withColumn("__lang", (F.array_position("__post", F.array_max("__post")) - 1).cast("int"))
        .filter(F.array_max("__post") >= CONFIDENT)
        .select("__lang", *evidence, address_suffix(F.col("__host")).alias("__suffix"), parent_domain(F.col("__host")).alias("__domain"))
    )
    sure = materialize(sure, "sure")
    seen = {r[0]: float(r[1]) for r in sure.groupBy("__lang").count().collect()}
    totals = [seen.get(i, 0.0) for i in range(n)]
    overall = [(1 - STRAY) * t / max(1.0, sum(totals)) + STRAY / n for t in totals]
    tallies = {by: _tally(sure, by, n) for by in ("__declared", "__suffix", "__domain", "__host")}
    said = materialize(_given_language(tallies["__declared"], "__declared", "said_log", totals), "said")
    ended = materialize(_given_language(tallies["__suffix"], "__suffix", "suffix_log", totals), "ended")
    hosts = _host_prior(tallies["__host"], tallies["__domain"], overall)

    final = _likelihoods(ready, [*kept, *evidence], logs).withColumn("__suffix", address_suffix(F.col("__host")))
    final = final.join(said, "__declared", "left").join(ended, "__suffix", "left").join(hosts, "__host", "left")
    none, base = F.array_repeat(F.lit(0.0), n), F.array(*[F.lit(math.log(p)) for p in overall])
    fused = F.transform(
        "__ll",
        lambda x, i: x
        + F.get(F.coalesce("said_log", none), i)
        # a host that is well known says by itself what its suffix says
        + F.coalesce("unknown", F.lit(1.0)) * F.get(F.coalesce("suffix_log", none), i)
        + F.get(F.coalesce("host_log", base), i),
    )
    final = final.withColumn("__post", _posterior(fused)).withColumn("confidence", F.array_max("__post"))
    names = F.array(*[F.lit(x) for x in [*languages, UNKNOWN]])
    found = F.element_at(names, F.array_position("__post", F.col("confidence")).cast("int"))
    return final.select(
        *[F.col(k).alias(c) for k, c in zip(kept, carried)],
        F.coalesce(found, F.lit(UNKNOWN)).alias("language"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce((found != UNKNOWN) & (F.col("confidence") >= min_confidence), F.lit(False)).alias("accepted"),
    )
