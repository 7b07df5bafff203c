import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import language as L
from cohortloom.llm.text import mixed

WORDS = {
    "en": "the and of that with from this have were which there their about would these".split(),
    "de": "der und die nicht mit auch sich über für können würde einer zwischen während".split(),
    "fr": "les des une dans pour avec être était après très leur même où déjà élève".split(),
}


def plain_trigrams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    words = letters.split()
    joined = f" {' '.join(words)} " if words else ""
    codes = [(ord(a) if a != " " else 0, ord(b) if b != " " else 0, ord(c) if c != " " else 0) for a, b, c in zip(joined, joined[1:], joined[2:])]
    packed = np.array([a << 42 | b << 21 | c for a, b, c in codes], np.uint64)
    return (mixed(packed) % np.uint64(L.BUCKETS)).astype(int).tolist()


def test_trigrams():
    texts = ["", "a", "ab", " ab ", "Ab1c..dé", "...", "x\n\ny", "日本 語", " 1 ", "tail1"]
    grams, offsets = L.trigrams(texts)
    for i, text in enumerate(texts):
        assert grams[offsets[i] : offsets[i + 1]].tolist() == plain_trigrams(text), text


def test_addresses(spark):
    row = spark.range(1).select(
        L.address_host(F.lit("https://me@Sub.Example.DE:8080/x?q")).alias("host"),
        L.address_host(F.lit("no address")).alias("none"),
        L.address_suffix(F.lit("sub.example.de")).alias("suffix"),
        L.address_suffix(F.lit("src0")).alias("bare"),
        L.parent_domain(F.lit("a.b.org")).alias("parent"),
        L.parent_domain(F.lit("b.org")).alias("top"),
        L.primary_subtag(F.lit("EN-us")).alias("tag"),
        L.primary_subtag(F.lit("english!")).alias("bad"),
        L.markup_language(F.lit('<!DOCTYPE html><HTML class="x" lang="fr-CA"><p lang=de>')).alias("markup"),
        L.markup_text(F.lit('<script>var a="<p>";</script>one<br>two<!-- x -->')).alias("text"),
    ).first()
    assert row.asDict() == {
        "host": "sub.example.de", "none": None, "suffix": "de", "bare": None, "parent": "b.org", "top": "b.org",
        "tag": "en", "bad": None, "markup": "fr", "text": " one two ",
    }


def rows():
    random.seed(6)
    out = []
    for i in range(400):
        true = random.choice(["en", "de", "fr"])
        text = " ".join(random.choices(WORDS[true], k=random.choice([3, 20, 60])))
        declared = true if random.random() < 0.9 else random.choice(["en", "de", "fr", "xx", None, "!"])
        host = f"{random.choice('ab')}.{true}site.{true if true != 'en' else 'com'}"
        out.append((i, text, declared, host, true))
    out += [(900, None, "en", "a.ensite.com", "und"), (901, "", None, None, "und"), (902, "12 34 !!", "de", None, "und")]
    out += [(903, " ".join(random.choices(WORDS["de"], k=100_000)), None, None, "de")]
    # too short to tell: the host decides
    out += [(904, "im", None, "a.desite.de", "de"), (905, "im", None, "a.frsite.fr", "fr"), (906, "im", "de-AT", None, "de")]
    out += [(907, "qzxjkvqzx ʘʘ ꙮꙮ wwwwq", None, None, "und")]
    return out + [(1, out[1][1], out[1][2], out[1][3], out[1][4])] * 2 + [(None, out[2][1], out[2][2], out[2][3], out[2][4])]


SCHEMA = "doc_id long, text string, lang string, source string, true string, language string"


def brute(data):
    """The same fusion, row by row."""
    subtag = lambda d: d.split("-")[0].lower() if d and d.split("-")[0].isalpha() and 2 <= len(d.split("-")[0]) <= 3 else None
    counts = defaultdict(Counter)
    for _, text, declared, _, _ in data:
        if subtag(declared):
            counts[subtag(declared)].update(plain_trigrams(text or ""))
    langs = sorted(k for k, c in counts.items() if c)
    n = len(langs) + 1
    totals = {k: sum(counts[k].values()) for k in langs}
    pool = sum(counts.values(), Counter())
    everywhere = lambda g: 0.9 * pool[g] / sum(totals.values()) + 0.1 / L.BUCKETS

    def likelihood(text):
        grams = plain_trigrams(text or "")
        if not grams:
            return None
        each = [sum(math.log(0.9 * counts[k][g] / totals[k] + 0.1 * everywhere(g)) for g in grams) for k in langs]
        return np.array([*each, -len(grams) * math.log(L.BUCKETS)]) * L.TEMPER

    def normal(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    flat = np.log([(1 - L.UNKNOWN_PRIOR) / (n - 1)] * (n - 1) + [L.UNKNOWN_PRIOR])
    suffix = lambda h: h.rsplit(".", 1)[1] if h and "." in h else None
    parent = lambda h: h.split(".", 1)[1] if h.count(".") > 1 else h
    lls = [likelihood(r[1]) for r in data]
    seen, by = np.zeros(n), {k: defaultdict(lambda: np.zeros(n)) for k in ("said", "suffix", "domain", "host")}
    for (_, _, declared, host, _), ll in zip(data, lls):
        if ll is not None and normal(ll + flat).max() >= L.CONFIDENT:
            k = int(normal(ll + flat).argmax())
            seen[k] += 1
            for name, value in (("said", subtag(declared)), ("suffix", suffix(host)), ("domain", host and parent(host)), ("host", host)):
                if value is not None:
                    by[name][value][k] += 1
    overall = 0.98 * seen / max(1, seen.sum()) + 0.02 / n
    share = lambda counted, values: 0.98 * counted / np.maximum(seen, 1) + 0.02 / values
    out = []
    for (_, _, declared, host, _), ll in zip(data, lls):
        if ll is None:
            out.append((L.UNKNOWN, 0.0))
            continue
        score = ll.copy()
        if subtag(declared) in by["said"]:
            score += np.log(share(by["said"][subtag(declared)], len(by["said"])))
        weight, prior = 1.0, overall
        if host in by["host"]:
            c, d = by["host"][host], by["domain"][parent(host)]
            above = (d + L.HOST_STRENGTH * overall) / (d.sum() + L.HOST_STRENGTH)
            prior = (c + L.HOST_STRENGTH * above) / (c.sum() + L.HOST_STRENGTH)
            weight = L.HOST_STRENGTH / (c.sum() + L.HOST_STRENGTH)
        if suffix(host) in by["suffix"]:
            score += weight * np.log(share(by["suffix"][suffix(host)], len(by["suffix"])))
        p = normal(score + np.log(prior))
        out.append(([*langs, L.UNKNOWN][int(p.argmax())], float(p.max())))
    return out


def identified(df, **settings):
    return L.identify_languages(df, F.col("text"), F.col("lang"), F.col("source"), **settings)


def test_fusion(spark):
    data = rows()
    df = spark.createDataFrame([(*r, "clash") for r in data], SCHEMA)
    got = identified(df.repartition(3), carry=["doc_id", "true"]).collect()
    wanted = defaultdict(list)
    for r, w in zip(data, brute(data)):
        wanted[r[0]].append(w)
    assert len(got) == len(data)
    for r in got:
        found, confidence = wanted[r.doc_id][0]
        assert r.language == found and r.confidence == pytest.approx(confidence, abs=1e-4)
        assert r.accepted == (found != "und" and confidence >= 0.5)
    right = [r.language == r.true for r in got]
    assert np.mean(right) > 0.98
    odd = {r.doc_id: r.language for r in got if (r.doc_id or 0) >= 900}
    assert odd == {900: "und", 901: "und", 902: "und", 903: "de", 904: "de", 905: "fr", 906: "de", 907: "und"}


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(*r, "clash") for r in rows()], SCHEMA)
    assert identified(df.filter("false")).count() == 0
    undeclared = identified(df.withColumn("lang", F.lit(None).cast("string")))
    assert undeclared.filter("accepted").count() == 0 and undeclared.columns == ["doc_id", "text", "lang", "source", "true", "language", "confidence", "accepted"]


def test_languages_with_little_text(spark):
    """Some words a language, and more than fifteen languages."""
    data = [(i, " ".join(WORDS[k]), k) for i, k in enumerate(WORDS)]
    data += [(10, "ქართული ენა და ანბანი", "ka"), (11, " ".join(WORDS["de"][3:12]), None), (12, "12 !!", "ka"), (13, "ʘʘʘ ꙮꙮꙮ", None)]
    data += [(100 + i, f"{'abcdefghij'[i % 10] * 3}{chr(0x4E00 + i) * 4} words", f"{chr(97 + i // 26)}{chr(97 + i % 26)}x") for i in range(12)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in L.identify_languages(df, F.col("text"), F.col("lang"), F.lit(None)).collect()}
    assert len(got) == len(data)
    for doc, _, declared in data:
        if declared is not None and doc != 12:
            assert got[doc].language == declared and got[doc].accepted, doc
    assert got[11].language == "de" and not got[12].accepted and got[12].language == "und" and not got[13].accepted


def test_repeating_a_table_changes_nothing(spark):
    """The same rows once and thirty times, an odd one among them: the same answers, whatever the number of rows."""
    data = [(i, text, declared) for i, text, declared, _, _ in rows()[:60]]
    data += [(900, "qzxjk vqzxw zzkqj wvvxq", "de"), (901, "ქართული ენა და ანბანი", "ka"), (902, "the and of that der", "de"), (903, "qq", "en")]
    once = spark.createDataFrame(data, "doc_id long, text string, lang string")
    often = once.crossJoin(spark.range(30).drop("id"))
    judged = lambda df: L.identify_languages(df, F.col("text"), F.col("lang"), F.lit(None), carry=["doc_id"]).distinct().collect()
    one, many = ({r.doc_id: r for r in judged(df)} for df in (once, often))
    assert len(one) == len(many) == len({d[0] for d in data})
    for doc, r in one.items():
        assert (many[doc].language, many[doc].accepted) == (r.language, r.accepted)
        assert many[doc].confidence == pytest.approx(r.confidence, abs=1e-6)
    assert one[901].language == "ka" and one[901].accepted


def test_held_out_accuracy(spark):
    """Documents whose declaration is withheld are told from the rest."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hidden = docs.withColumn("said", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    got = L.identify_languages(hidden, F.col("text"), F.col("said"), F.lit(None), carry=["lang", "said"])
    r = got.filter("said is null").agg(F.avg((F.col("lang") == F.col("language")).cast("int")), F.count(F.lit(1))).first()
    assert r[0] > 0.99 and r[1] > 100
