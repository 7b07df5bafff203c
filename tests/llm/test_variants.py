import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm import variants
from cohortloom.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

SMALL = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, least=3, chars=5):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= chars:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= least}


def brute(words):
    out = {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        form = min(near, key=lambda x: (-words[x], x), default=None)
        if form is not None and words[form] < 2 * n:
            form = None
        out[w] = (form, n, len(near), words.get(form))
    rows = []
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, near, form_n))
    return sorted(rows)


def plain(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_against_sql(spark):
    found = QUERIES["op13_spelling_variants"](spark, SMALL)
    assert [c for c, _ in found.dtypes] == ["word", "form", "root", "n", "n_near", "form_n"]
    found = found.toPandas()
    assert differences(found, connect(SMALL).execute(ORACLES["op13_spelling_variants"]).df()) is None
    assert found["form"].notna().any() and (found["root"] != found["form"]).any()


def variants_of(seed):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abé", k=draw.randint(5, 7))) for _ in range(30)] + ["aaaaa", "aaaaaa", "aaaaaaa", "baaaaa", "aaaaab"]
    rows = [(i, " ".join(draw.choices(words, k=60)) + " Aaaaa,AAAAA;naïve'NAÏVE naÏve naïve") for i in range(40)]
    long = "q" * 2000
    rows += [(100 + i, f"{long} {long[:-1]} {long}x x{long} {long[:999]}z{long[1000:]} " * 3) for i in range(2)]
    rows.append((200, "lemon " * 16 + "lemons " * 6 + "lemonss " * 3))
    return rows + [(None, "stray words stray"), (None, "stray"), (3, None), (4, ""), (5, "1234 _ \x00"), (5, "ab cd " * 5), (5, "ab cd " * 5)]


@pytest.mark.parametrize("group_words", [20_000, 3])
def test_against_brute_force(spark, group_words):
    rows = variants_of(1)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n long").repartition(4)
    got = plain(variants.group_variants(df, group_words=group_words))
    assert got == brute(brute_words(rows))
    assert any(r[2] not in (r[0], r[1]) for r in got) and any(len(r[0]) == 2001 and r[4] for r in got)
    assert variants.group_variants(df.filter("false")).collect() == []


@pytest.mark.parametrize("group_words", [20_000, 4])
def test_all_short_words_of_two_letters(spark, group_words):
    """Every word of one to six letters over two: each position can be inserted, deleted and replaced, runs repeat."""
    words = {"".join(w): 1 + zlib.crc32("".join(w).encode()) % 50 for n in range(1, 7) for w in itertools.product("ab", repeat=n)}
    df = spark.createDataFrame(sorted(words.items()), "word string, n long")
    got = {r.word: (r.n_near, r.near, r.near_n) for r in variants.near_words(df, group_words).collect()}
    for w in words:
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x))
        assert got[w] == (len(near), best, words[best])


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text(alphabet="abc", min_size=4, max_size=5), min_size=1, max_size=40), st.integers(0, 2))
def test_composition_gives_each_pair_once(words, depth):
    by_stem = {}
    for w in words:
        by_stem.setdefault(w[:depth], []).append(w)
    for stem, some in by_stem.items():
        found = [tuple(sorted(p)) for p in variants.Acceptor(sorted(some), depth).pairs(4, stem, False)]
        wanted = [p for p in itertools.combinations(sorted(some), 2) if one_edit(*p) and min(map(len, p)) == 4]
        wanted = [tuple(sorted(p)) for p in wanted]
        assert sorted(found) == sorted(wanted)


def test_acceptor_is_minimal():
    made = variants.Acceptor(sorted(a + b for a in ("con", "pro", "per") for b in ("form", "forms", "formed")), 0)
    # the start, the three words' shared rest, what follows "form", and the end
    assert len(made.states) <= 6 and len(set(made.states)) == len(made.states)
