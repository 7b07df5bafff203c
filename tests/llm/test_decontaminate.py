import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(text, items, window=10):
    """(number of words, spans of hit words in the text, ids) by comparing every window with every place."""
    folded = (text or "").translate(FOLD)
    places = [m.span() for m in WORD.finditer(folded)]
    words = [folded[a:b] for a, b in places]
    hit, ids = set(), set()
    for i, t in items:
        w = WORD.findall((t or "").translate(FOLD))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            piece = w[k : k + window]
            for at in range(len(words) - len(piece) + 1):
                if words[at : at + len(piece)] == piece:
                    hit.update(range(at, at + len(piece)))
                    ids.add(i)
    runs = []
    for h in sorted(hit):
        if runs and runs[-1][1] == h:
            runs[-1][1] = h + 1
        else:
            runs.append([h, h + 1])
    return len(words), [(places[a][0], places[b - 1][1], b - a) for a, b in runs], sorted(str(i) for i in ids if i is not None)


texts = st.lists(st.sampled_from(["a", "B", "b", "É", "é", "日本", "4", "-", ".", "\n", " ", "c1"]), max_size=30).map(" ".join)


@given(texts, st.lists(texts, max_size=4))
@settings(max_examples=300, deadline=None)
def test_scan_against_all_places(text, items):
    windows = D.Windows(items, 3)
    runs, at = windows.scan(D.normal_words(text))
    n, spans, ids = brute(text, list(enumerate(items)), 3)
    assert len(D.normal_words(text)) == n
    assert [(s["start"], s["end"], s["words"]) for s in D._original(text, runs)] == spans
    assert sorted(map(str, at)) == ids


ITEMS = [
    (1, "One TWO three four five six seven eight nine ten eleven"),
    (10, "two three four five six seven eight nine ten eleven twelve"),
    (2, "short item"),
    (3, None),
    (4, " -- "),
    (None, "nobody knows this"),
    (2, "short item"),
]


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 100])
def test_table(spark, block_bytes):
    long = "filler words " * 100_000
    rows = [
        (1, None, 5, "x"),
        (2, "", 5, "x"),
        (3, "see: one-two;three four FIVE six seven eight nine ten eleven, twelve!", 5, "x"),
        (4, long + "Short, ITEM.", 5, None),
        (4, long + "Short, ITEM.", 5, None),
        (5, "shortitem or short items", 5, "x"),
        (None, "nobody knows this short item", 5, "x"),
        (6, "one two three four five six seven eight nine", 5, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit long, item_id string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = D.scan_benchmark(docs, items, block_bytes=block_bytes).toPandas()
    assert list(got.columns) == ["doc_id", "text", "item_id", "n_words", "n_hit", "hit_items", "hit_spans"]
    assert len(got) == len(rows)
    for r in got.itertuples():
        n, spans, ids = brute(r.text, ITEMS)
        assert (r.n_words, list(r.hit_items)) == (n, ids)
        assert [(s["start"], s["end"], s["words"]) for s in r.hit_spans] == spans
        assert r.n_hit == sum(w for _, _, w in spans)
    assert D.scan_benchmark(docs, items.filter("false")).agg({"n_hit": "sum"}).first()[0] == 0
    assert D.scan_benchmark(docs.filter("false"), items).count() == 0
