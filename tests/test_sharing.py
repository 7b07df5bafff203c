"""What records, slices and tables share: chains of keys, sketches, buckets, state, and one read of raw files."""

import math
import random

import pytest

from cohortloom.functions import deident
from cohortloom.operators import connected, contracts, fuse, inspect, linkage, slice_quantiles
from cohortloom.operators.connected import connected_components
from cohortloom.plans import clean, ingest
from cohortloom.sources import delimited, layers, records
from cohortloom.streaming.newest import follow_slices, newest_rows
from tests.test_history import slices
from tests.test_lake import count_file, put


def plain_components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("case", ["random", "chain", "star", "none"])
def test_components(spark, case):
    draw = random.Random(3)
    pairs = {
        "random": [(draw.randrange(120), draw.randrange(120)) for _ in range(70)] + [(None, 3), (5, None), (7, 7), (1, 2), (2, 1)],
        "chain": [(i, i + 1) for i in random.Random(1).sample(range(200), 200)],
        "star": [(500, i) for i in range(300)],
        "none": [],
    }[case]
    df = spark.createDataFrame(pairs, "a long, b long")
    assert {r.node: r.root for r in connected_components(df).collect()} == plain_components(pairs)


def test_records_that_share_any_key(spark):
    a = [("1", "x", None), ("2", "x", "p"), ("3", None, "p"), ("4", "y", None), ("5", None, None), ("2", "x", "p"), ("6", "p", None)]
    b = [("1", "z", "q"), ("9", None, "q"), ("8", "y", "r")]
    schema = "_source_patient_id string, k0 string, k1 string"
    one, two = (spark.createDataFrame(rows, schema) for rows in (a, b))
    found = linkage.link_by_any_key((one, "a"), (two, "b"), keys=["k0", "k1"], salt="s").collect()
    ids = {(r._source_name, r._source_patient_id): r.master_patient_id for r in found}
    assert len(found) == len(ids) == 9
    groups = {}
    for record, master in ids.items():
        groups.setdefault(master, set()).add(record)
    # kinds of keys never meet: "p" of the first kind is not "p" of the second
    assert sorted(map(sorted, groups.values())) == [
        [("a", "1"), ("a", "2"), ("a", "3")], [("a", "4"), ("b", "8")], [("a", "5")], [("a", "6")], [("b", "1"), ("b", "9")],
    ]
    again = linkage.link_by_any_key((two.repartition(3), "b"), (one, "a"), keys=["k0", "k1"], salt="s").collect()
    assert {(r._source_name, r._source_patient_id): r.master_patient_id for r in again} == ids
    other = linkage.link_by_any_key((one, "a"), (two, "b"), keys=["k0", "k1"], salt="t").collect()
    assert not {r.master_patient_id for r in other} & set(ids.values())


def test_rounds_of_components_work_on_fewer_and_fewer_numbers(spark, monkeypatch):
    written, kept = [], connected.materialize

    def noted(df, label):
        table = kept(df, label)
        written.append((label, {f.dataType.simpleString() for f in table.schema}, table.count()))
        return table

    monkeypatch.setattr(connected, "materialize", noted)
    # a chain of hubs, each with leaves of its own
    pairs = [(f"hub{i:02d}", f"hub{i + 1:02d}") for i in range(40)] + [(f"hub{i:02d}", f"leaf{i:02d}{j:02d}") for i in range(40) for j in range(30)]
    found = connected.connected_components(spark.createDataFrame(pairs, "a string, b string")).collect()
    assert {r.root for r in found} == {"hub00"} and len(found) == 41 + 1200
    edges = [(kinds, rows) for label, kinds, rows in written if label == "edges"]
    assert len(edges) > 2 and all(kinds == {"bigint"} for kinds, _ in edges)
    # leaves go in the first round, and every round has half the edges at most
    assert edges[1][1] <= 40 and all(2 * after <= before for (_, before), (_, after) in zip(edges, edges[1:]))


def test_records_of_several_rows_link_all_their_keys(spark):
    rows = [("1", "b", None), ("1", "d", "x"), ("1", "c", None), ("2", "c", None), ("3", None, "x"), ("4", "e", None), (None, "e", "y"), (None, "f", None), (None, "g", None), ("5", "f", None)]
    df = spark.createDataFrame(rows, "_source_patient_id string, k0 string, k1 string")
    found = linkage.link_by_any_key((df, "a"), keys=["k0", "k1"], salt="s").collect()
    groups = {}
    for r in found:
        groups.setdefault(r.master_patient_id, set()).add(r._source_patient_id)
    assert sorted(map(str, (sorted(map(str, g)) for g in groups.values()))) == ["['1', '2', '3']", "['4', '5', 'None']"]


def test_bucketed_modalities_meet_without_a_shuffle(spark):
    one = spark.createDataFrame([(i if i else None, i * 2) for i in range(50)], "id long, a long")
    two = spark.createDataFrame([(i, str(i)) for i in range(20, 90)] + [(21, "again"), (None, "x")], "id long, b string")
    three = spark.createDataFrame([(i, None if i % 2 else 1.0, i) for i in range(80)], "id long, c double, a long")
    frames = {"one": one, "two": two, "three": three}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fused = fuse.fuse_bucketed(fuse.bucket_modalities(frames, "id", 4), "id", 4)
        plan = fused._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") >= 4
        wanted = fuse.fuse_modalities(frames, "id", repeated="two")
        key = lambda r: str(tuple(r))
        assert fused.columns == wanted.columns
        assert sorted(fused.collect(), key=key) == sorted(wanted.collect(), key=key)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        fuse.fuse_bucketed({}, "id")


def test_sketches_of_slices(spark, scratch):
    path = f"{scratch}/sketches"
    for part, (low, high) in {"1": (0, 4000), "2": (3000, 9000), "3": (0, 10)}.items():
        inspect.write_key_sketches(spark.range(low, high).selectExpr("id as k", "id % 7 as g"), ["k", "g"], path, part)
    inspect.write_key_sketches(spark.range(0, 4000).selectExpr("id as k", "if(id < 0, 1, null) as g"), ["k", "g"], path, "1")
    found = {r["column"]: r for r in inspect.distinct_from_sketches(spark.read.parquet(path)).collect()}
    assert abs(found["k"]["distinct_values"] - 9000) < 0.06 * 9000 and found["g"]["distinct_values"] == 7
    assert found["k"]["rows"] == 4000 + 6000 + 10
    other = inspect.write_key_sketches(spark.range(8000, 20000).selectExpr("id as k"), ["k"], f"{scratch}/other", "a")
    row = inspect.overlap_from_sketches(spark.read.parquet(path), spark.read.parquet(other), "k", "k").first()
    assert abs(row["both"] - 1000) < 250 and abs(row["right_keys"] - 12000) < 250


def test_zip_codes(spark):
    given = ["03601", " 02134 ", "0213", "03", "021345", "02134-1234", "021341234", "02134-12", "O2134", "", None, "036 1"]
    df = spark.createDataFrame([(z,) for z in given], "z string")
    out = [r["z"] for r in deident.generalize_zip_to_safe_harbor(df, "z").collect()]
    assert out == ["000", "021", None, None, None, "021", "021", None, None, None, None, None]
    assert [r["z"] for r in deident.generalize_zip_to_safe_harbor(df.limit(1), "z", []).collect()] == ["036"]


def test_raw_files_are_read_once(spark, scratch):
    """What the sources return comes from tables in the shared folder, not from the raw files again."""
    put(scratch, "m/1.json", [{"sampleId": "s", "patientId": "p", "gene": {"hugoGeneSymbol": "TP53", "n": [1, "a"]}, "chr": 17, "x": {"y": 1.5}}, {"sampleId": "t", "x": {"y": "z"}}])
    put(scratch, "pm/1.json", {"Header": [{"status": "Success"}], "Data": [{"state_code": "06", "poc": 1}]})
    put(scratch, "c/a.tsv", count_file([("G", 1)]))
    put(scratch, "s/1.json", [{"patientId": "p", "sampleId": "s1", "clinicalAttributeId": "X", "value": "1"}])
    read = [
        records.scan_mutation_records(spark, f"{scratch}/m"),
        records.scan_json_envelope(spark, f"{scratch}/pm", ingest.PM25_RECORD, keep_all=True),
        delimited.scan_count_tsv(spark, f"{scratch}/c"),
        records.scan_eav_clinical(spark, f"{scratch}/s"),
    ]
    for df in read:
        assert df.inputFiles() and not any(scratch in f for f in df.inputFiles()) and df.count()
    rows = {r["sampleId"]: r for r in read[0].collect()}
    assert rows["s"]["chr"] == "17" and rows["t"]["gene"] is None and rows["t"]["chr"] is None
    # where values of several kinds meet, the whole is text
    assert (rows["s"]["x"], rows["t"]["x"]) == ('{"y":1.5}', '{"y":"z"}')


def test_pages_as_they_come(spark, scratch):
    put(scratch, "p/one/1.json", '  {"a": 1, "b": "x"}\n')
    put(scratch, "p/two/2.json", '[{"a": 2, "b": {"c": [1, 2]}}, null, {"a": null, "b": 7}, {}]')
    put(scratch, "p/3.json", "\n")
    rows = sorted(((r.a, r.b) for r in records.scan_json_records(spark, f"{scratch}/p", "a long, b string").collect()), key=str)
    assert rows == [(1, "x"), (2, '{"c":[1,2]}'), (None, "7"), (None, None)]
    put(scratch, "p/4.json", '[{"a": 1}')
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        records.scan_json_records(spark, f"{scratch}/p", "a long").collect()


def test_a_watch_counts_on_the_way(spark, scratch):
    df = spark.createDataFrame([("s", None, None), (None, "TP53", "x")], "sampleId string, gene string, proteinChange string")
    watch = contracts.Watch(df, contracts.MUTATIONS)
    watch.df.write.parquet(f"{scratch}/out")
    wanted = sorted(tuple(r) for r in contracts.contract_report(df, contracts.MUTATIONS).collect())
    assert sorted(watch.rows()) == wanted
    with pytest.raises(contracts.ContractViolation) as raised:
        watch.validate()
    assert ("sampleId", "not_null", 1) in raised.value.failures and ("mutationType", "exists", 1) in raised.value.failures


def test_stream_of_newest_readings(spark, scratch):
    slices(spark, scratch)
    bronze = layers.layer_path(scratch, "bronze", "environmental_pm25")
    key = ["state_code", "county_code", "site_num", "date_local"]
    wanted = sorted(clean.newest_readings(layers.scan_layer(spark, bronze)).collect(), key=str)
    follow_slices(spark, bronze, f"{scratch}/newest", f"{scratch}/state", key)
    got = newest_rows(spark, bronze, f"{scratch}/newest")
    assert sorted(got.collect(), key=str) == wanted
    # a run without a new slice changes nothing, an older slice does not win, a newer one does
    follow_slices(spark, bronze, f"{scratch}/newest", f"{scratch}/state", key)
    schema = ", ".join(f"{c} string" for c in [*key, "arithmetic_mean"])
    late = [("06", "001", "1", "2024-01-11", "99.0"), ("06", "001", "9", "2024-01-11", "1.0")]
    layers.write_bronze_slice(spark.createDataFrame(late, schema), bronze, "2024-01-14")
    layers.write_bronze_slice(spark.createDataFrame([("06", "001", "2", "2024-01-11", "8.0")], schema), bronze, "2024-02-03")
    follow_slices(spark, bronze, f"{scratch}/newest", f"{scratch}/state", key)
    wanted = sorted(clean.newest_readings(layers.scan_layer(spark, bronze)).collect(), key=str)
    assert sorted(newest_rows(spark, bronze, f"{scratch}/newest").collect(), key=str) == wanted
    with pytest.raises(ValueError):
        follow_slices(spark, bronze, f"{scratch}/n", f"{scratch}/s", ["site_num"])


@pytest.mark.parametrize("margin,k,step", [(0.01, 1024, 1000), (1e-5, 8, 7)])
def test_quantiles_of_slices(spark, scratch, monkeypatch, margin, k, step):
    monkeypatch.setattr(slice_quantiles, "MARGIN", margin)
    monkeypatch.setattr(slice_quantiles, "KLL_K", k)
    monkeypatch.setattr(slice_quantiles, "STEP", step)
    draw = random.Random(8)
    rows = []
    for part in range(3):
        for _ in range(700):
            group = draw.choice(["a", "b", None])
            # slices drift, values repeat, and one group is one value a third of the time
            value = 5.0 if group == "b" and draw.random() < 0.3 else round(draw.gauss(10 * part, 8), draw.choice([0, 2]))
            rows.append((part, group, draw.choice([value] * 20 + [None, float("nan")])))
    rows += [(2, "late", 1.0), (2, "late", 3.0), (0, "none", None)]
    df = spark.createDataFrame(rows, "part int, g string, v double")
    for part in (0, 1, 2, 1):
        slice_quantiles.write_rank_slice(df.filter(f"part = {part}"), "v", ["g"], f"{scratch}/r", str(part))
    probs, names = [0.0, 0.1, 0.5, 0.99, 1.0], list("pqrst")
    tables = [spark.read.parquet(f"{scratch}/r/{name}") for name in ("sketches", "ranks")]
    got = {r["g"]: tuple(r)[1:] for r in slice_quantiles.quantiles_of_slices(*tables, ["g"], probs, names).collect()}
    plain = {}
    for _, g, v in rows:
        if v is not None and v == v:
            plain.setdefault(g, []).append(v)
    wanted = {g: tuple(sorted(vs)[max(math.ceil(p * len(vs)), 1) - 1] for p in probs) for g, vs in plain.items()}
    assert got == wanted
    whole = f"{scratch}/w"
    for part in range(3):
        slice_quantiles.write_rank_slice(df.filter(f"part = {part}"), "v", [], whole, str(part))
    tables = [spark.read.parquet(f"{whole}/{name}") for name in ("sketches", "ranks")]
    everything = sorted(v for vs in plain.values() for v in vs)
    row = slice_quantiles.quantiles_of_slices(*tables, [], [0.5], ["m"]).first()
    assert row["m"] == everything[math.ceil(len(everything) / 2) - 1]
