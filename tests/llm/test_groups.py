"""Components, tiles, the prefilter and the three operators that find groups, against plain versions."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import fuzzy_lines, jaccard_join, vectors
from cohortloom.llm.components import components
from cohortloom.llm.prefilter import split_by
from cohortloom.llm.text import row_key
from cohortloom.llm.tiles import with_large_tiles, with_tiles


class Groups:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    random.seed(seed)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(280)]
    edges += [(500 + i, 501 + i) for i in range(70)] + [(900, 600 + i) for i in range(100)] + edges[:5]
    groups = Groups(range(1000))
    for a, b in edges:
        groups.join(a, b)
    df = spark.createDataFrame([*edges, (None, 3), (7, None)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {n: groups.find(n) for n in {x for a, b in edges if a != b for x in (a, b)}}
    assert components(df.filter("false")).count() == 0


@pytest.mark.parametrize("large", [False, True])
def test_every_pair_of_a_group_meets_in_a_bounded_tile(spark, large):
    rows = [(0, i) for i in range(90)] + [(1, i) for i in range(90, 95)] + [(2, 99)]
    df = spark.createDataFrame(rows, "g long, m long")
    placed = with_large_tiles(df, "g", "m", 20) if large else with_tiles(df, "g", "m", 20)
    tiles = defaultdict(set)
    for r in placed.collect():
        tiles[bytes(r.tile) if not large else r.tile].add((r.g, r.m))
    assert max(map(len, tiles.values())) <= 70
    met = {frozenset(p) for t in tiles.values() for p in itertools.combinations(t, 2)}
    want = {frozenset(p) for g in (0, 1) for p in itertools.combinations([r for r in rows if r[0] == g], 2)}
    assert met == want


def test_prefilter_loses_nothing(spark):
    df = spark.range(20_000).withColumn("k", row_key("id"))
    wanted = df.filter("id % 40 = 3").select("k")
    maybe, rest = split_by(df, wanted, "k")
    assert maybe.count() + rest.count() == 20_000 and maybe.count() < 600
    assert rest.join(wanted, "k").count() == 0
    assert split_by(df, wanted.filter("false"), "k")[0].count() == 0


# documents: bases, near copies, exact copies, a passage many share
random.seed(7)
VOCABULARY = [f"w{i}" for i in range(3000)]


def sentence(n):
    return [random.choice(VOCABULARY) for _ in range(n)]


def documents():
    rows, at = [], itertools.count()
    passage = sentence(30)
    for _ in range(60):
        rows.append((next(at), " ".join(sentence(random.randint(20, 120)) + passage)))
    base = sentence(200)
    for i in range(150):
        words = list(base)
        for _ in range(random.randint(0, 5)):
            words[random.randrange(200)] = f"x{random.randrange(10**6)}"
        rows.append((next(at), " ".join(words)))
    rows += [(next(at), "Only Four words here")] * 1 + [(next(at), "only four words, here")]
    rows += [(next(at), rows[5][1].upper()), (next(at), "!!! --"), (next(at), ""), (next(at), None)]
    rows += [(3, rows[3][1]), (None, rows[3][1]), (None, rows[80][1]), (None, None)]
    return rows


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard_links(rows):
    sets = [shingles(t) for _, t in rows]
    n, groups = [0] * len(rows), Groups(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            n[i] += 1
            n[j] += 1
            groups.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[groups.find(i)] = min(doc, least.get(groups.find(i), doc))
    return [(doc, n[i], least.get(groups.find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


@pytest.mark.parametrize("small,tile", [(32, 400_000), (4, 8_000)])
def test_jaccard_join(spark, small, tile):
    rows = documents()
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, key string, bucket string")
    got = jaccard_join.linked_documents(df.repartition(3), small_bucket=small, tile_shingles=tile, recall=0.999999)
    found = sorted(((r.id, r.n_links, r.root.id) for r in got.collect()), key=str)
    assert found == sorted(jaccard_links(rows), key=str)


def test_keep_one(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, "a") for r in rows], "doc_id long, text string, text_key string")
    kept = jaccard_join.keep_one(df, recall=0.999999)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = set()
    for (doc, text), (_, _, root) in zip(rows, jaccard_links(rows)):
        if doc == root:
            want.add((doc, text))
    assert got == sorted(want, key=str)
    empty = jaccard_join.keep_one(df.filter("false"))
    assert empty.count() == 0 and jaccard_join.linked_documents(df.filter("false")).count() == 0


def test_one_shared_bucket_is_no_link(spark):
    assert jaccard_join.runs_needed(0.8, 3, 0.999) == 10
    assert jaccard_join.least_agreement(30, 0.8) < 0.5 * 30
    sets = [np.unique(np.random.default_rng(i).integers(0, 500, 200)).astype(np.uint64) for i in range(40)]
    rows, columns = np.arange(20), np.arange(20, 40)
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in columns] for i in rows]
    every = np.ones((20, 20), bool)
    assert (jaccard_join.shared_tokens(sets, rows, columns, every) == want).all()
    few = np.zeros((20, 20), bool)
    few[3, 4] = True
    assert jaccard_join.shared_tokens(sets, rows, columns, few)[3, 4] == want[3][4]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    random.seed(8)
    for _ in range(2000):
        a, b = ("".join(random.choices("abé", k=random.randint(0, 14))) for _ in range(2))
        assert fuzzy_lines.edit_distance(a, b) == distance(a, b)
        for limit in (0, 1.5, 4):
            found = fuzzy_lines.edit_distance(a, b, limit)
            assert found == distance(a, b) if distance(a, b) <= limit else found > limit


def test_distances_side_by_side():
    rng = random.Random(5)
    a, b, limits = [], [], []
    for n in [0, 1, 5, 40, 130, 400] * 40:
        letters = rng.choice(["ab", "abcdefghij é中😀"])
        x = "".join(rng.choices(letters, k=n))
        y = list(x)
        for _ in range(rng.randint(0, rng.choice([3, 12, 90, 200]))):
            at = rng.randint(0, len(y))
            y[at : at + rng.randint(0, 1)] = rng.choices(letters, k=rng.randint(0, 1))
        a.append(x)
        b.append("".join(y))
        limits.append(rng.choice([0, 1, 3, 10, 31, 62, 63, 64, 65, 100, 127, 128, 150]))
    expected = [fuzzy_lines.edit_distance(x, y) <= n for x, y, n in zip(a, b, limits)]
    assert fuzzy_lines.within_limits(a, b, np.array(limits)).tolist() == expected
    assert 40 < sum(expected) < 200


def tile_rows(rows):
    """Rows of (``tile``, ``band``, ``key``, ``words``, ``least``) as the line stage has them."""
    columns = dict(zip(["tile", "band", "key", "words", "least"], zip(*rows)))
    n = len(rows)
    return pa.RecordBatch.from_pydict(
        {
            "tile": pa.array(columns["tile"], pa.int64()),
            "member": pa.array(range(n), pa.int64()),
            "band": pa.array(columns["band"], pa.int8()),
            "chars": pa.array([len(x) for x in columns["words"]], pa.int32()),
            "simhash": pa.array([0] * n, pa.int64()),
            "simhash2": pa.array([0] * n, pa.int64()),
            "key": pa.array(columns["key"], pa.binary()),
            "words": pa.array(columns["words"], pa.string()),
            "least": pa.array(columns["least"], pa.binary()),
        }
    )


def test_lines_of_several_buckets_are_verified_in_the_first():
    line = "one line of a good many words that is met in several of the buckets at once"
    a, b, c = (bytes(30) + x for x in (b"\x01\x00", b"\x02\x00", b"\x03\x00"))
    other = b"\x09" * 4 + bytes(26)
    rows = [
        (1, 0, b"a", line, a), (1, 0, b"b", line + "s", b), (1, 0, b"c", line + "er", c),
        # a bucket of the same lines and one more, which meets them nowhere else
        (2, 1, b"a", line, a), (2, 1, b"b", line + "s", b), (2, 1, b"c", line + "er", c), (2, 1, b"d", line + "!!!", other + b"\x04\x00"),
    ]
    links = [tuple(sorted(x.values())) for t in fuzzy_lines._verified(0.9)(iter([tile_rows(rows)])) for x in t.to_pylist()]
    assert len(links) == len(set(links))
    assert sum(b"d" not in x for x in links) == 2
    joined = {b"a"}
    for _ in links:
        joined |= {k for x in links if joined & set(x) for k in x}
    assert joined == {b"a", b"b", b"c", b"d"}


@pytest.mark.parametrize("n", [2, 3, 60, 200])
def test_lines_near_in_all_bits_are_candidates(n):
    # 24 bits apart in the first half, none in the second
    far = np.zeros(n, np.uint64)
    far[-1] = (1 << 24) - 1
    far[1:-1] = np.uint64(0xFFFFFFFFFF) << np.uint64(24)
    table = tile_rows([(7, 0, bytes([i]), "w" * 300, b"") for i in range(n)])
    table = table.set_column(table.schema.get_field_index("simhash"), "simhash", pa.array(far.view(np.int64)))
    kept = [x["member"] for t in fuzzy_lines._with_candidates(0.9)(iter([table])) for x in t.to_pylist()]
    assert {0, n - 1} <= set(kept)


def test_lines_of_unlike_length_in_a_large_tile_are_no_candidates():
    table = tile_rows([(7, 0, bytes([i]), "w" * int(10 * 1.2**i), b"") for i in range(40)] * 2)
    kept = [x for t in fuzzy_lines._with_candidates(0.9)(iter([table])) for x in t.to_pylist()]
    # only equal lengths are near, so every tile is a pair of them
    assert len(kept) == 80 and len({x["tile"] for x in kept}) == 40
    assert all(len({x["member"] % 40 for x in kept if x["tile"] == t}) == 1 for t in {x["tile"] for x in kept})


def test_rows_of_a_bucket_meet_in_a_bounded_part():
    rng = np.random.default_rng(6)
    n = 600
    least = rng.integers(0, 2**16, (n, fuzzy_lines.LEAST)).astype("<u2")
    least[:300, 4:6], least[300:310, 0:2] = 7, 9  # a bucket of half the lines and one of ten
    classes = pa.RecordBatch.from_pydict(
        {
            "member": pa.array(rng.permutation(n), pa.int64()),
            "chars": pa.array(rng.integers(70, 300, n), pa.int32()),
            "simhash": pa.array(range(n), pa.int64()),
            "simhash2": pa.array(range(n), pa.int64()),
            "least": pa.array([x.tobytes() for x in least], pa.binary()),
        }
    )
    rows, buckets = fuzzy_lines._in_buckets(classes)
    counts = list(fuzzy_lines._cell_counts(iter([classes.slice(0, 200), classes.slice(200)])))
    large = [tuple(r.values()) for x in fuzzy_lines._large_cells(60)(iter(counts)) for r in x.to_pylist()]
    assert sum(n for c, n in large if c < 0) == len(rows) == n * fuzzy_lines.LEAST // 2
    deal = fuzzy_lines._Deal(len(rows), {c: n for c, n in large if c >= 0}, 60)
    assert len(deal.cells) == 1
    dealt = [r for x in deal.dealt(iter([classes])) for r in x.to_pylist()]
    # a row is one of many in a record, and only those of the large bucket are sent more than once
    assert len(dealt) <= deal.parts + int(deal.blocks[0]) ** 2
    assert sum(len(r["rows"]) for r in dealt) == 36 * (len(rows) + 300 * (int(deal.blocks[0]) - 1))
    met = defaultdict(set)
    for r in sorted(dealt, key=lambda r: r["part"]):
        part = pa.RecordBatch.from_pydict({"part": pa.array([r["part"]], pa.int64()), "rows": pa.array([r["rows"]], pa.binary())})
        for table in fuzzy_lines._part_tiles(iter([part])):
            assert r["part"] < deal.parts or table.num_rows <= 3 * 60
            for tile, found in table.to_pandas().groupby("tile"):
                assert found["chars"].is_monotonic_increasing and found["band"].nunique() == 1
                met[tile] |= {frozenset(p) for p in itertools.combinations(sorted(found["member"]), 2)}
    members = classes.column(0).to_numpy()
    for tile, size in zip(*np.unique(buckets, return_counts=True)):
        own = members[rows[buckets == tile]]
        assert len(met.get(int(tile), ())) == size * (size - 1) // 2
        assert size < 10 or met[int(tile)] == {frozenset(p) for p in itertools.combinations(own.tolist(), 2)}


def test_pairs_that_their_letters_exclude_are_not_measured(monkeypatch):
    rng = random.Random(4)
    lines = ["".join(rng.choices("abcdefé日 ", k=rng.randint(1, 60))) for _ in range(60)]
    lines += [x[:i] + "z" * (i % 3) + x[i + 1 :] for i, x in enumerate(lines)] + ["a" * 700, "a" * 690, "a" * 300]
    i, j = (x.ravel() for x in np.indices((len(lines), len(lines))))
    for similarity in (0.9, 0.5):
        maybe = fuzzy_lines._Letters(lines).may_be_similar(i, j, similarity)
        assert maybe[fuzzy_lines.similar_pairs(lines, i, j, similarity)].all()
        assert not maybe.all()
    # unrelated lines of one bucket whose bits are alike
    texts = ["".join(rng.choices(rng.sample("abcdefghijklmnopqrstuvwxyz", 9), k=50)) for _ in range(40)]
    measured = []
    plain = fuzzy_lines.similar_pairs
    monkeypatch.setattr(fuzzy_lines, "similar_pairs", lambda lines, i, j, s: measured.extend(i) or plain(lines, i, j, s))
    batch = tile_rows([(1, 0, bytes([k]), x, b"") for k, x in enumerate([*texts, texts[0] + "!"])])
    links = [x for t in fuzzy_lines._verified(0.9)(iter([batch])) for x in t.to_pylist()]
    assert len(links) == 1 and len(measured) < 10


def line_documents():
    random.seed(10)
    shared = " ".join(sentence(70))
    near = shared.split(" ")
    near[3] = "y"
    rows = []
    for i in range(30):
        lines = [" ".join(sentence(random.randint(8, 60))) for _ in range(4)]
        if i % 3 == 0:
            lines.insert(1, shared.upper() + " !!")
        if i % 4 == 0:
            lines.insert(2, " ".join(near[:-1] + [f"{near[-1]}{i}"]))
        rows.append((i, "\n".join([*lines, "", "short", "short", "--"])))
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, rows[4][1]), (43, rows[4][1]), (None, rows[5][1]), (None, shared)]
    rows.append((44, "\n".join(["the same long line again"] * 3000)))
    rows.append((45, "word " * 60_000 + "\nend of a very long line"))
    return rows


def lines_left(rows, similarity=0.9):
    """Every row's text as a brute-force comparison of all distinct lines by edit similarity leaves it."""
    occurrences = defaultdict(list)
    order = {}
    documents_ = sorted({(doc is None, doc, text or "") for doc, text in rows}, key=lambda d: (d[0], d[1] or 0, d[2]))
    for d, (_, _, text) in enumerate(documents_):
        order[documents_[d]] = d
        for n, line in enumerate(text.split("\n")):
            normal = fuzzy_lines.normal_line(line)
            if len(normal) >= fuzzy_lines.MIN_CHARS:
                occurrences[normal].append((d, n))
    lines = list(occurrences)
    groups = Groups(range(len(lines)))
    for i, j in itertools.combinations(range(len(lines)), 2):
        if fuzzy_lines.similar(lines[i], lines[j], similarity):
            groups.join(i, j)
    members = defaultdict(list)
    for i in range(len(lines)):
        members[groups.find(i)] += occurrences[lines[i]]
    return documents_, members


def test_lines_meet_whatever_the_size_of_the_table(spark, monkeypatch):
    for least in (fuzzy_lines.LEAST, fuzzy_lines.LEAST_SHORT):
        assert fuzzy_lines.bands(least) == [[i, i + 1] for i in range(0, least, 2)]
    rows = spark.createDataFrame([], "text_key binary, text string")
    classes = rows.selectExpr(
        "text_key as key", "named_struct('text_key', text_key, 'line', 0L) as least",
        "named_struct('chars', 9, 'simhash', 0L, 'simhash2', 0L, 'least', text_key) as sketch",
    )
    monkeypatch.setattr(type(classes), "count", lambda self: pytest.fail("lines are counted to choose the buckets"))
    assert fuzzy_lines._links(rows, classes, 0.9, 8).collect() == []


def test_fuzzy_lines(spark):
    rows = line_documents()
    df = spark.createDataFrame([(*r, "a", 5) for r in rows], "doc_id long, text string, text_key string, n_removed int")
    got = fuzzy_lines.drop_repeated_lines(df.repartition(3), block_rows=8)
    assert got.columns == ["doc_id", "text", "text_key", "n_removed"]
    found = got.collect()
    assert len(found) == len(rows)
    documents_, members = lines_left(rows)
    left = defaultdict(set)
    for doc, text in rows:
        left[doc].add(text)
    assert any(len({d for d, _ in m}) > 5 for m in members.values())
    # each group keeps one line: in the first document by id, and there the first
    by_doc = {d: [] for d in documents_}
    for m in members.values():
        ids = {x: documents_[x] for x, _ in m}
        with_id = [x for x, d in ids.items() if not d[0]]
        if with_id:
            first = min((x for x in m if x[0] in with_id), key=lambda x: (documents_[x[0]][1], x[1]))
            for x in m:
                if x != first and (documents_[x[0]][1] != documents_[first[0]][1] or x[0] == first[0]):
                    by_doc[documents_[x[0]]].append(x[1])
    for r in found:
        text = r.text
        source = next(d for d in documents_ if d[0] == (r.doc_id is None) and d[1] == r.doc_id)
        if r.doc_id is None:
            continue
        gone = set(by_doc[source])
        original = next(t for doc, t in rows if doc == r.doc_id)
        if gone:
            assert text == "\n".join(x for n, x in enumerate(original.split("\n")) if n not in gone)
        else:
            assert text == original
        assert r.n_removed == len(gone)
    assert fuzzy_lines.drop_repeated_lines(df.filter("false")).count() == 0


@pytest.mark.parametrize("edits", ["word", "letters"])
def test_fuzzy_lines_recall_by_length(spark, edits):
    """Pairs that edit similarity alone calls similar, whatever their length, are found."""
    random.seed(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    made, wanted = [], defaultdict(int)
    while len(made) < 2 * 350:
        n = (2, 4, 8, 15, 27, 60, 120)[len(made) // 100]
        words = ["".join(random.choices(letters, k=random.randint(4, 9))) for _ in range(n)]
        other = list(words)
        if edits == "word":
            other[random.randrange(n)] = random.choice(VOCABULARY)
        else:
            for _ in range(1 + n // 15):
                at = random.randrange(n)
                other[at] = other[at] + random.choice(letters) if random.random() < 0.5 else other[at][1:]
        a, b = " ".join(words), " ".join(other)
        if n <= 4 and edits == "word":
            b = a[:-1] + ("x" if a[-1] != "x" else "y")
        if a != b and len(a) >= 10 and fuzzy_lines.similar(a, b, 0.9):
            made += [(len(made), a, n), (len(made) + 1, b, n)]
            wanted[n] += 1
    df = spark.createDataFrame(made, "doc_id long, text string, n int")
    removed = fuzzy_lines.drop_repeated_lines(df, block_rows=64).filter("n_removed = 1").groupBy("n").count().collect()
    found = {r["n"]: r["count"] for r in removed}
    assert len(wanted) == 7
    assert all(found.get(n, 0) >= 0.98 * wanted[n] for n in wanted), found


def test_short_lines_repeat_like_others(spark):
    own = [f"a line that only document {w} has, {w * 3}" for w in VOCABULARY[:6]]
    rows = [(i, f"{x}\nOK\n--\n{i}\nok!") for i, x in enumerate(own)] + [(9, f"{own[2]}\nOK\n--\n2\nok!"), (10, "日")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in fuzzy_lines.drop_repeated_lines(df).collect()}
    want = {i: f"{x}\n--\n{i}" for i, x in enumerate(own)} | {9: "--", 10: "日"}
    want[0] = f"{own[0]}\nOK\n--\n0"
    assert got == want


def test_long_texts_have_the_same_simhash_rule():
    random_ = np.random.default_rng(3)
    counts = [0, 1, 255, 256, 700, 3]
    words = random_.integers(0, 2**63, sum(counts)).astype(np.uint64)
    offsets = np.append(0, np.cumsum(counts))
    for i, code in enumerate(fuzzy_lines.simhashes(words, offsets)):
        own = [int(x) for x in words[offsets[i] : offsets[i + 1]]]
        assert int(code) == sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in own) > len(own))


def test_vectors(spark):
    random_ = np.random.default_rng(4)
    base = random_.normal(size=(500, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = base[random_.integers(0, 40, 600)] + random_.normal(size=(600, 16)) * 0.1
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([base, near]))]
    rows += [(5000 + i, rows[7][1]) for i in range(30)] + [(6000, [2 * x for x in rows[7][1]])]
    odd = [(7000, None), (7001, [0.0] * 16), (7002, [float("nan")] * 16), (7003, [float("inf")] + [1.0] * 15), (7004, [None] + [1.0] * 15), (7005, []), (7006, [1.0, 2.0]), (7007, [-0.0] * 16)]
    rows += odd + [(7008, [1e-200] * 16), (7009, [1e200] * 16)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, key string")
    got = vectors.link_vectors(df, cell_rows=150, margin=2.0, block_rows=64, visit_rows=300).toPandas().set_index("vec_id")
    usable = {i: np.array(v) / max(map(abs, v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    ids = [i for i, v in usable.items() if len(v) == 16]
    matrix = np.stack([usable[i] for i in ids])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    linked = matrix @ matrix.T >= 0.9
    np.fill_diagonal(linked, False)
    groups = Groups(ids)
    for a, b in np.argwhere(linked):
        groups.join(ids[a], ids[b])
    assert len(got) == len(rows)
    for k, i in enumerate(ids):
        assert (got.n_links[i], got.component_id[i], got.kept[i]) == (linked[k].sum(), groups.find(i), groups.find(i) == i)
    for i, _ in odd:
        assert (got.n_links[i], got.component_id[i], got.kept[i]) == (0, i, True)
    # the margin of production finds nearly all of it
    margin = vectors.link_vectors(df, cell_rows=150).toPandas()
    assert margin.n_links.sum() >= 0.98 * got.n_links.sum()
    extra = spark.createDataFrame([(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.1])], "vec_id long, embedding array<float>")
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.link_vectors(extra).collect()), key=str)
    assert found == [(3, 2, 3, True), (3, 2, 3, True), (None, 2, None, False)]
    assert vectors.link_vectors(df.filter("false")).count() == 0
