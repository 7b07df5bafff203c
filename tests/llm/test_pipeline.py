import os
import re
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from cohortloom.llm import decontaminate
from cohortloom.llm import queries as Q
from cohortloom.runtime import shared_dir
from tests.llm.conftest import DOCS
from tests.llm.test_groups import Groups, line_documents, lines_left, shingles
from tests.oracle import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.01"])
def test_against_sql(spark, name, sf_dir):
    assert differences(Q.QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir).execute(Q.ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLES)))
def test_every_row_has_a_result(spark, name):
    found = Q.QUERIES[name](spark, SMALL)
    others = {"language_of_pages": ("page_id", "pages"), "op11_whitening": ("vec_id", "embeddings")}
    key, table = others.get(name, ("doc_id", "documents"))
    ids = spark.read.parquet(f"{SMALL}/{table}.parquet").select(key)
    assert ids.join(found, key, "left_anti").count() == 0
    if name != "op6_packing":
        assert found.count() == ids.count() * (32 if name == "op11_whitening" else 1)


def test_registered():
    names = __spark_entry__.queries()
    assert [n for n in range(1, 14) if sum(q.startswith(f"op{n}_") for q in names) != 1] == []
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "packing"]


def brute_stages(rows, items):
    """(id, text) left after the lines, near-duplicate and benchmark stages, from the rows the first stage accepts."""
    documents, members = lines_left(rows)
    gone = defaultdict(set)
    for m in members.values():
        first = min(m)
        for x in m:
            if x != first:
                gone[documents[x[0]]].add(x[1])
    kept = []
    for d in documents:
        text = "\n".join(x for n, x in enumerate(d[2].split("\n")) if n not in gone[d])
        if not gone[d] or re.search(r"[^\W_]", text):
            kept += [(d[1], text)] * sum((i, t or "") == (d[1], d[2]) for i, t in rows)
    after_lines = sorted(kept, key=str)
    single = list(dict.fromkeys(kept))
    sets = [shingles(t) for _, t in single]
    groups = Groups(range(len(single)))
    for i in range(len(single)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                groups.join(i, j)
    after_near = [single[i] for i in range(len(single)) if groups.find(i) == i]
    windows = decontaminate.Windows(items, 10)
    clean = [(i, t) for i, t in after_near if not windows.scan(decontaminate.normal_words(t))[0]]
    return after_lines, sorted(after_near, key=str), sorted(clean, key=str)


def plain(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_against_plain_versions(spark, tmp_path):
    rows = [r for r in line_documents() if r[0] is not None and re.search(r"[^\W\d_]", r[1] or "")]
    item = " ".join(rows[2][1].split("\n")[0].split()[:8] + ["two", "more"])
    rows.append((70, f"before {item.upper()} after it all"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    lines, near, clean = brute_stages(rows, [item])
    stages = dict(corpus_pipeline.STAGES)
    got = stages["lines"](spark, docs, str(tmp_path)).cache()
    assert got.columns == docs.columns and plain(got) == lines
    assert got.filter("n_chars != length(text)").count() == 0
    got = stages["near_duplicates"](spark, got, str(tmp_path)).cache()
    assert got.columns == docs.columns and plain(got) == near
    got = stages["benchmark"](spark, got, str(tmp_path))
    assert got.columns == docs.columns and plain(got) == clean and 70 not in {i for i, _ in clean}


def test_exact_copies_with_a_short_line_leave_with_their_lines(spark, tmp_path):
    text = "a first line of several words\nThe end"
    docs = spark.createDataFrame([(1, text, "en", "s", len(text)), (2, text, "en", "s", len(text))], DOCS)
    assert plain(corpus_pipeline.drop_lines(spark, docs, str(tmp_path))) == [(1, text)]


def test_run_packs_what_the_stages_leave(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
    left = {r.doc_id: r.text for r in docs.collect()}
    plain_ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    parts = defaultdict(dict)
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    for r in corpus_pipeline.run(spark, SMALL).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32
        parts[r.doc_id][r.start] = bytes(r.ids)
    assert set(parts) == set(left) and len(left) > 100
    shared = shared_dir(spark).removeprefix("file:")
    assert len(set(os.listdir(shared)) - before) == 1
    for i, pieces in parts.items():
        ids = [*plain_ids.encode(left[i], add_special_tokens=False).ids, 2]
        assert b"".join(pieces[k] for k in sorted(pieces)) == b"".join(x.to_bytes(4, "little") for x in ids)


ODD = [
    (None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "the same text of a few words", "en", None, 28),
    (3, "the same text of a few words", "en", None, 28), (4, "the same text of a few words", None, "s", None), (5, "y " * 300_000, "en", "s", 600_000),
    (None, "the of and that have been with it in this and those", "en", "s", 51),
]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, name, stage):
    docs = spark.createDataFrame([(*r, "a", 1, "b") for r in ODD], f"{DOCS}, text_key string, n_hit int, language string")
    for df in (docs, docs.filter("false")):
        out = stage(spark, df, SMALL)
        if name != "packing":
            assert out.columns == df.columns
        n = out.count()
        assert n == 0 if df is not docs else name == "packing" or n <= len(ODD)
    if name == "near_duplicates":
        assert stage(spark, docs, SMALL).filter("text like 'the same%'").count() == 1
    if name == "benchmark":
        assert stage(spark, docs, SMALL).count() == len(ODD)
    if name == "lines":
        assert stage(spark, docs, SMALL).filter("text like 'the same%'").select("doc_id").distinct().count() == 1
