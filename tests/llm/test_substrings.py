import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm import substrings
from cohortloom.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

SMALL = "/root/testdata/sf0.001"


def brute(rows, size=13):
    """The words left of each row, by the definition."""
    split = [(doc, re.findall("[^\x20\x09-\x0d]+", text or "")) for doc, text in rows]
    least = {}
    for doc, words in split:
        if doc is not None:
            for k in range(len(words) - size + 1):
                window = tuple(words[k : k + size])
                least[window] = min(least.get(window, doc), doc)
    out = []
    for doc, words in split:
        gone = set()
        if doc is not None:
            for k in range(len(words) - size + 1):
                if least[tuple(words[k : k + size])] < doc:
                    gone.update(range(k, k + size))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def plain(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in df.collect()), key=str)


def test_query_against_sql(spark):
    found = QUERIES["op12_substring_dedup"](spark, SMALL).toPandas()
    assert differences(found, connect(SMALL).execute(ORACLES["op12_substring_dedup"]).df()) is None
    assert (found["n_removed"] > 0).any()


def passages(seed, few):
    """Documents made of shared runs of few words, of any length around a window, some under the same id."""
    draw = random.Random(seed)
    pool = [[draw.choice(few) for _ in range(draw.randint(5, 40))] for _ in range(12)]
    rows = []
    for doc in range(60):
        words = []
        for _ in range(draw.randint(0, 5)):
            part = draw.choice(pool)
            a = draw.randint(0, len(part) // 3)
            words += part[a : len(part) - draw.randint(0, 4)] + [f"w{draw.randint(0, 99)}" for _ in range(draw.randint(0, 3))]
        rows.append((draw.choice([doc, doc, doc, 7, None]), draw.choice([" ", "\n", " \t "]).join(words)))
    return rows


ODD = [
    (None, None), (3, None), (4, ""), (5, " \x0b\x0c "), (6, "one two"), (None, "a b c d e f g h i j k l m n"), (8, "a b c d e f g h i j k l m n"),
    (9, "x a b c d e f g h i j k l m n y"), (8, "a b c d e f g h i j k l m n"), (10, "a b c d e f g h i j k l m"), (1, "ä ö b " * 40), (2, "ä ö b " * 30),
    (11, "again " * 5000), (12, "again " * 14), (13, "again " * 12), (14, "z" * 3_000_000 + " " + "a b c d e f g h i j k l m"),
]


@pytest.mark.parametrize("group_chars,part_words", [(1 << 21, 1 << 21), (200, 50)])
def test_against_brute_force(spark, group_chars, part_words):
    for rows in (passages(1, list("abcdefgh")), passages(2, [f"word{i}" for i in range(300)]), ODD):
        df = spark.createDataFrame([(*r, 5, "a", 1) for r in rows], "doc_id long, text string, n_words int, __kept string, group int")
        got = substrings.drop_repeated_passages(df.repartition(3), group_chars=group_chars, part_words=part_words)
        assert got.columns == ["doc_id", "text", "__kept", "group", "n_words", "n_removed"]
        assert plain(got) == brute(rows)
    assert got.filter("n_removed > 0").count() > 2
    assert substrings.drop_repeated_passages(df.filter("false")).collect() == []


def test_ids_of_another_type_and_window(spark):
    rows = [("b", "one two three four"), ("a", "zero one two three"), ("c", "three four"), (None, "one two three"), ("ä", "one two three")]
    df = spark.createDataFrame(rows, "key string, body string")
    got = substrings.drop_repeated_passages(df, "key", "body", size=3, carry=["key"]).collect()
    assert sorted((str(r.key), r.body) for r in got) == [
        ("None", "one two three"), ("a", "zero one two three"), ("b", "four"), ("c", "three four"), ("ä", ""),
    ]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\r\x1c  abö𝄞", max_size=30)), max_size=6))
def test_words(texts):
    words = substrings.Words(pa.array(texts, pa.string()))
    plain_words = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    assert np.diff(words.offsets).tolist() == [len(w) for w in plain_words]
    flat = [w for ws in plain_words for w in ws]
    by_hash = {}
    for w, h in zip(flat, words.hashes.tolist()):
        assert by_hash.setdefault(h, w) == w
    assert len(by_hash) == len(set(flat))
    assert [t.split() for t in words.texts.to_pylist()] == [[w.encode() for w in ws] for ws in plain_words]


@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=50))
def test_packing_of_codes(values):
    codes = np.unique(np.array(values, np.uint64))
    assert substrings.unpacked(substrings.packed(codes, 8), 8).tolist() == codes.tolist()


def test_texts_are_not_shuffled_again(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = substrings.drop_repeated_passages(docs, carry=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
