import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortloom.llm import packing, token_files
from cohortloom.llm.packing import Piece, SumOfSquares, pack_documents, pack_stream
from cohortloom.llm.tokens import WordTokenizer, packed

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "It's <|endoftext|> WE'LL don'T", "a\x1cb ½ ²x №5 İstanbul", "“q” — x… € 5", "ﬁ café é 日本 😀 '' 'sa",
    "a'stop !!'s x", "ÀÉÎõü ß ſ ŉ ¼x", "word " * 3000, "x" * 5000, " a\u0085b", "1234567890", "٣٤ Ⅷ",
]


@pytest.mark.parametrize("special", [False, True])
def test_ids_are_those_of_the_library(special):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = special
    own = WordTokenizer(PATH, special)
    random.seed(1)
    letters = "abcdeéèßſ '.,!?0123½<|>\n\t-_日"
    texts = ODD + ["".join(random.choices(letters, k=random.randint(0, 80))) for _ in range(1000)]
    for text in texts:
        assert own.ids(text) == packed(plain.encode(text, add_special_tokens=False).ids), text


def test_level_rule_against_all_levels():
    random.seed(2)
    levels = SumOfSquares(12)
    for _ in range(2000):
        size = random.randint(1, 11)
        counts = levels.counts.copy()

        def after(h):
            c = counts.copy()
            if h:
                c[h] -= 1
            if h + size < 12:
                c[h + size] += 1
            return int((c[:12] ** 2).sum())

        can = [0, *[h for h in range(1, 12 - size + 1) if counts[h]]]
        best = min(after(h) for h in can)
        assert after(levels.level(size)) == best and levels.level(size) == max(h for h in can if after(h) == best)
        levels.place(Piece((), 0, b"\0" * 4 * size, size))


@pytest.mark.parametrize("open_windows", [3, 1000])
def test_stream_keeps_every_id(open_windows):
    random.seed(3)
    docs = [np.arange(random.choice([1, 3, 40, 64, 65, 200]), dtype="<u4") + 1000 * i for i in range(300)]
    windows = list(pack_stream((Piece((i,), 0, d.tobytes(), len(d)) for i, d in enumerate(docs)), 64, open_windows))
    seen = defaultdict(dict)
    for window in windows:
        n = sum(p.length for p in window)
        assert n == 64 or n & (n - 1) == 0
        for p in window:
            seen[p.row[0]][p.start] = p.ids
    for i, d in enumerate(docs):
        assert b"".join(seen[i][k] for k in sorted(seen[i])) == d.tobytes()
    assert sum(sum(p.length for p in w) < 64 for w in windows) <= 6


def test_documents_are_whole_where_they_fit():
    random.seed(4)
    docs = [random.randint(1, 60) for _ in range(4000)]
    windows = list(pack_stream((Piece((i,), 0, b"\0" * 4 * n, n) for i, n in enumerate(docs)), 64, 10_000))
    assert sum(p.length < p.doc_tokens for w in windows for p in w) < 0.1 * len(docs)


ROWS = [(i, t, "x") for i, t in enumerate(ODD)] + [(90, None, "x"), (91, "again and again", None), (91, "again and again", None), (None, "no id", "x")]


def check(rows, got, end=2):
    plain = Tokenizer.from_file(PATH)
    want = sorted(zlib.crc32(packed([*plain.encode(t or "", add_special_tokens=False).ids, end])) for _, t, _ in rows)
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got.itertuples():
        assert r.length * 4 == len(r.ids) and r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.start == 0 and r.length == r.doc_tokens, r.doc_id].append((r.start, r.ids))
    assert sum(r.length for r in got.itertuples()) == sum(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    whole = [zlib.crc32(ids) for (is_whole, _), parts in docs.items() if is_whole for _, ids in parts]
    cut = [zlib.crc32(b"".join(ids for _, ids in sorted(parts))) for (is_whole, _), parts in docs.items() if not is_whole]
    assert sorted(whole + cut) == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0


def test_table(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string").coalesce(1)
    check(ROWS, pack_documents(df, PATH).toPandas())
    several = pack_documents(df.repartition(3), PATH, carry=["source"])
    assert several.select("sequence_id").distinct().count() >= 3
    assert pack_documents(df.filter("false"), PATH).count() == 0
    with pytest.raises(ValueError):
        pack_documents(df.withColumnRenamed("source", "Start"), PATH, carry=["Start"])


def write(path, ids, dtype="<u2"):
    path.write_bytes(np.array(ids, dtype).tobytes())
    return str(path)


def split(ids, end):
    out, run = [], []
    for i in ids:
        if i == end:
            out.append((len(run), True))
            run = []
        else:
            run.append(i)
    return out + [(len(run), False)] * bool(run)


@pytest.mark.parametrize("dtype,block", [("<u2", 2), ("<u2", 6), ("<u2", 1 << 20), ("<u4", 8)])
def test_flat_files(spark, tmp_path, monkeypatch, dtype, block):
    monkeypatch.setattr(token_files, "BLOCKS_A_SPAN", 3)
    random.seed(5)
    files = {f"f{k}": [random.choice([9, 9, 1, 2, 3]) for _ in range(n)] for k, n in enumerate([0, 1, 40, 41, 90])}
    files |= {"ends": [9] * 11, "none": [1] * 11, "long": [1] * 50 + [9] + [2] * 50}
    paths = spark.createDataFrame([(write(tmp_path / k, v, dtype), "x") for k, v in files.items()], "path string, block string")
    got = token_files.count_tokens(spark, paths, 9, dtype, block).toPandas()
    for name, ids in files.items():
        rows = got[got.path == str(tmp_path / name)].sort_values("ordinal")
        assert rows.ordinal.tolist() == list(range(len(rows)))
        assert list(zip(rows.n_tokens, rows.terminated)) == split(ids, 9)
        at = 0
        for r in rows.itertuples():
            assert r.first == at
            at += r.n_tokens + 1
    with pytest.raises(ValueError):
        token_files.count_tokens(spark, paths, 9, dtype, 3)


def test_odd_file_is_noticed(spark, tmp_path):
    (tmp_path / "odd").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole ids"):
        token_files.count_tokens(spark, spark.createDataFrame([(str(tmp_path / "odd"),)], "path string"), 9).count()


def test_written_files(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(90, None, None), (91, "", "x"), (91, "", "x"), (None, "no id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ordinal string").repartition(3)
    contents = token_files.write_token_files(df, PATH, 49407, file_bytes=2000)
    got = token_files.count_tokens(spark, contents, 49407, block_bytes=64).join(contents, ["path", "ordinal"]).toPandas()
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    want = sorted(len(plain.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows)
    assert sorted(got.n_tokens) == want and got.terminated.all() and got.path.nunique() > 3
    empty = token_files.write_token_files(df.filter("false"), PATH, 49407)
    assert token_files.count_tokens(spark, empty, 49407).count() == 0
