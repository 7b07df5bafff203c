"""Slices that overlap, files as they come, steps that clean up, and small frames at the edges."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from cohortloom import runtime
from cohortloom.operators import contracts, genomic, inspect, missing, reshape
from cohortloom.plans import clean, ingest
from cohortloom.sources import delimited, layers, records
from cohortloom.streaming.landing import ingest_new_files
from suite import composed
from tests.test_lake import count_file, put

READING = "state_code string, county_code string, site_num string, date_local string, arithmetic_mean string"


def slices(spark, scratch):
    path = layers.layer_path(scratch, "bronze", "environmental_pm25")
    old = [("06", "001", "1", "2024-01-10", "10.0"), ("06", "001", "1", "2024-01-11", "50.0"), ("06", "001", "2", "2024-01-11", "7.0")]
    new = [("06", "001", "1", "2024-01-11", "30.0"), ("06", "001", "1", "2024-01-11", "31.0"), ("06", "001", "1", "2024-02-01", None)]
    layers.write_bronze_slice(spark.createDataFrame(old, READING), path, "2024-01-15")
    layers.write_bronze_slice(spark.createDataFrame(new, READING), path, "2024-02-02")


def test_all_slices_count_and_the_newest_wins(spark, scratch):
    slices(spark, scratch)
    out = layers.scan_layer(spark, clean.clean_environmental(spark, scratch, place_cols=("state_code", "county_code", "site_num")))
    got = sorted((r.site_num, r.date_local, r.arithmetic_mean) for r in out.collect())
    # the newest slice has two rows for one key; a gap takes the reading before it, whichever slice that is from
    assert got[:3] == [("1", "2024-01-10", 10.0), ("1", "2024-01-11", 30.0), ("1", "2024-01-11", 31.0)]
    assert got[3][2] in (30.0, 31.0) and got[4] == ("2", "2024-01-11", 7.0) and len(got) == 5
    latest = clean.clean_environmental(spark, scratch, slices="latest", place_cols=("county_code",))
    assert layers.scan_layer(spark, latest).count() == 3


def test_a_later_slice_may_widen_a_table(spark, scratch):
    path = layers.layer_path(scratch, "bronze", "x")
    layers.write_bronze_slice(spark.createDataFrame([(1,)], "a long"), path, "2024-01-01")
    layers.write_bronze_slice(spark.createDataFrame([(2, "b")], "a long, b string"), path, "2024-01-02")
    assert sorted((r.a, r.b) for r in layers.scan_layer(spark, path).collect()) == [(1, None), (2, "b")]
    assert [r.b for r in layers.scan_layer(spark, path, slices="latest").collect()] == ["b"]


def listing(spark, n):
    rows = [(f"f{i}", f"f{i}.tsv", "x", "TSV", "Transcriptome Profiling", "P", "open", [(f"C{i}", f"S{i}")]) for i in range(n)]
    return spark.createDataFrame(rows, ingest.FILE_HIT)


def test_a_listing_has_no_silent_cap(spark, scratch):
    path = ingest.ingest_gdc_metadata(scratch, listing(spark, 1500), "P", "Transcriptome Profiling", "TSV", "2024-01-01")
    assert layers.scan_layer(spark, path).count() == 1500


def test_count_files_are_read_by_their_own_headers(spark, scratch):
    put(scratch, "c/a.tsv", count_file([("G", 1)]))
    names = ["gene_id", "fpkm_uq_unstranded", "gene_name", "gene_type", "note", "unstranded", "stranded_first", "stranded_second", "tpm_unstranded", "fpkm_unstranded"]
    put(scratch, "c/b.tsv", "# comment\n" + "\t".join(names) + "\nidH\t2.5\tH\tcoding\thello\t3\t4\t5\t0.5\t\n")
    got = {r.file_id + r.gene_id: r for r in delimited.scan_count_tsv(spark, f"{scratch}/c").collect()}
    assert set(got) == {"aN_unmapped", "aidG", "bidH"}
    assert got["bidH"].unstranded == 3 and got["bidH"].fpkm_uq_unstranded == 2.5 and got["bidH"].note == "hello"
    assert got["bidH"].fpkm_unstranded is None and got["aidG"].fpkm_uq_unstranded is None and got["aidG"].unstranded == 1
    put(scratch, "c/b.tsv", "\t".join(names) + "\nidH\t2.5\tH\tcoding\thello\tmany\t4\t5\t0.5\t\n")
    with pytest.raises(Exception, match="many"):
        delimited.scan_count_tsv(spark, f"{scratch}/c").collect()
    put(scratch, "c/d.tsv", "idX\t1\n")
    with pytest.raises(ValueError, match="header"):
        delimited.scan_count_tsv(spark, f"{scratch}/c")


def test_absent_files_are_reported_and_unlisted_ones_not_opened(spark, scratch):
    for i in range(6):
        put(scratch, f"counts/f{i}.tsv", count_file([("A", i)]))
    put(scratch, "counts/unlisted.tsv", "this is no count file\n")
    files = ingest.list_files(listing(spark, 8), "P", "Transcriptome Profiling", "TSV")
    with pytest.warns(UserWarning, match="2 listed files"):
        path = ingest.ingest_rna_seq(spark, scratch, files, f"{scratch}/counts", ingestion_date="2024-01-01")
    assert layers.scan_layer(spark, path).select("file_id").distinct().count() == 6
    with pytest.warns(UserWarning), pytest.raises(ValueError, match="at least 7"):
        ingest.ingest_rna_seq(spark, scratch, files, f"{scratch}/counts", minimum=7, ingestion_date="2024-01-02")
    assert layers.slice_dates(spark, path) == ["2024-01-01"]


def test_count_rows_are_written_once(spark, scratch, monkeypatch):
    """The slice is the only table of parsed rows; a value that does not fit leaves the table as it was."""
    labels, kept = [], ingest.materialize
    monkeypatch.setattr(ingest, "materialize", lambda df, label="step": (labels.append(label), kept(df, label))[1])
    for i in range(6):
        put(scratch, f"counts/f{i}.tsv", count_file([("A", i), ('"B"', 7)]))
    files = ingest.list_files(listing(spark, 6), "P", "Transcriptome Profiling", "TSV")
    path = ingest.ingest_rna_seq(spark, scratch, files, f"{scratch}/counts", ingestion_date="2024-01-01")
    assert "staged" not in labels
    rows = layers.scan_layer(spark, path)
    names = {r[0] for r in rows.select("gene_name").distinct().collect()}
    assert rows.select("file_id").distinct().count() == 6 and {"A", "B"} <= names
    before = rows.count()
    good = open(f"{scratch}/counts/f3.tsv").read()
    put(scratch, "counts/f3.tsv", good.replace("\t3\t", "\tmany\t"))
    for root in (scratch, f"{scratch}/new"):
        with pytest.raises(Exception, match="many"):
            ingest.ingest_rna_seq(spark, root, files, f"{scratch}/counts", ingestion_date="2024-01-02")
    assert layers.slice_dates(spark, path) == ["2024-01-01"] and layers.scan_layer(spark, path).count() == before
    assert not layers.table_exists(spark, path.replace(scratch, f"{scratch}/new"))


def test_layouts_from_a_file(spark, scratch):
    path = put(scratch, "x.txt", "ab 12\n")
    layout = [{"name": "letters", "start": 1, "end": 2}, ("digits", 4, 5)]
    assert delimited.scan_fixed_width(spark, path, layout).first().asDict() == {"letters": "ab", "digits": "12"}


def test_all_columns_of_the_records_are_kept(spark, scratch):
    put(scratch, "m/1.json", [{"sampleId": "s", "patientId": "p", "gene": {"hugoGeneSymbol": "TP53", "entrezGeneId": 1}, "chr": "17", "startPosition": 5}])
    row = records.scan_mutation_records(spark, f"{scratch}/m").first()
    assert (row.gene, row.chr, row.startPosition, row.proteinChange) == ("TP53", "17", "5", None)
    put(scratch, "pm/1.json", {"Header": [{"status": "Success"}], "Data": [{"state_code": "06", "poc": 1, "date_local": "2024-01-01", "arithmetic_mean": 3.5}]})
    row = records.scan_json_envelope(spark, f"{scratch}/pm", ingest.PM25_RECORD, keep_all=True).first()
    assert (row.state_code, row.county_code, row.poc, row.arithmetic_mean) == ("06", None, "1", "3.5")


def test_a_failed_contract_leaves_the_slice(spark, scratch):
    good = '{"sampleId": "s", "patientId": "p", "gene": "TP53"}\n'
    put(scratch, "m/1.json", good)
    path = ingest.ingest_cbioportal_mutations(spark, scratch, f"{scratch}/m", "2024-01-01", multi_line=False)
    put(scratch, "m/1.json", good.replace("\"s\"", "null").replace("\"TP53\"", "null"))
    with pytest.raises(contracts.ContractViolation):
        ingest.ingest_cbioportal_mutations(spark, scratch, f"{scratch}/m", "2024-01-01", multi_line=False)
    assert [r.patientId for r in layers.scan_layer(spark, path).collect()] == ["p"]


def test_steps_leave_no_scratch(spark, scratch):
    shared = runtime.shared_dir(spark).removeprefix("file:")
    slices(spark, scratch)
    before = set(os.listdir(shared))
    clean.clean_environmental(spark, scratch)
    assert set(os.listdir(shared)) == before
    with pytest.raises(ValueError):
        with runtime.scratch_scope(spark):
            inside = runtime.materialize(spark.range(3), "inside")
            assert inside.count() == 3 and set(os.listdir(shared)) != before
            raise ValueError
    assert set(os.listdir(shared)) == before


class Cluster:
    """A session on a cluster, as far as the shared folder asks."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getConf():
            return {}

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:  # noqa: N801
        @staticmethod
        def get(name, default):
            return default


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="share"):
        runtime.shared_dir(Cluster)


def test_contracts_and_profiles_without_rows(spark):
    empty = spark.createDataFrame([], "a long, b string")
    for check in (contracts.contract_check_ge, contracts.contract_check_isin):
        assert check(spark.createDataFrame([("p",)], "patientId string"), contracts.CLINICAL).count() == 0
    got = {r.column: (r.type, r.rows, r.nulls, r.distinct_values) for r in inspect.table_profile(empty).collect()}
    assert got == {"a": ("bigint", 0, 0, 0), "b": ("string", 0, 0, 0)}
    assert inspect.distinct_count(empty, ["a", "b"]).count() == 2


def test_unlisted_pathways_count_as_unmapped(spark):
    calls = spark.createDataFrame([("p", "A"), ("p", "B"), ("p", "C")], "patient_key string, gene string")
    genes = spark.createDataFrame([("A", "x"), ("B", "y")], "gene string, pathway string")
    for pathways in (["x", "unmapped"], ["x"]):
        row = genomic.aggregate_mutation_burden(calls, genes, pathways=pathways).first()
        assert (row.x, row.unmapped) == (1, 2)


def test_vectors_fill_missing_attributes(spark):
    rows = [("p", "b", 2.0), ("p", "d", 4.0), ("q", "a", 1.0), ("q", "b", 2.0), ("q", "c", 3.0), ("q", "d", 4.0)]
    df = spark.createDataFrame(rows, "id string, gene string, v double")
    got = {r.id: list(r.vector) for r in reshape.long_to_vector(df, "id", "gene", "v", ["a", "b", "c", "d"], output_col="vector").collect()}
    assert got == {"p": [0.0, 2.0, 0.0, 4.0], "q": [1.0, 2.0, 3.0, 4.0]}


def test_components_point_one_way(spark):
    rows = [(i, float(i), -2.0 * i + (i % 3), float(i % 5)) for i in range(30)]
    df = spark.createDataFrame(rows, "patient_key long, a double, b double, c double")
    flipped = df.select("patient_key", *[(-F.col(c)).alias(c) for c in "abc"])
    one, two = (genomic.reduce_expression_pca(x, ["a", "b", "c"], k=2).orderBy("patient_key").toPandas() for x in (df, flipped))
    assert abs(one["expression_pca_0"] + two["expression_pca_0"]).max() < 1e-9


def test_a_repeated_batch_keeps_its_first_date(spark, scratch):
    landing, table, state = (f"{scratch}/{n}" for n in ("landing", "table", "state"))
    put(landing, "1.json", '{"file_id": "a"}\n')
    ingest_new_files(spark, landing, "file_id string", table, state, "2024-01-01")
    for commit in glob.glob(f"{state}/commits/*") + glob.glob(f"{state}/commits/.*crc"):
        os.remove(commit)
    ingest_new_files(spark, landing, "file_id string", table, state, "2024-01-02")
    assert [(r.file_id, r.ingestion_date) for r in layers.scan_layer(spark, table).collect()] == [("a", "2024-01-01")]


def test_a_hot_date_lies_in_many_buckets(spark, monkeypatch):
    sizes = []
    real = missing.cut_ranges

    def spy(df, keys, rows):
        ranges = real(df, keys, rows)
        sizes.append(ranges.assign(df).groupBy(missing.BUCKET).count().agg(F.max("count")).first()[0])
        return ranges

    monkeypatch.setattr(missing, "cut_ranges", spy)
    df = spark.range(4000).select(F.lit("x").alias("place"), F.lit("2024-01-01").alias("day"), F.when(F.col("id") % 7 == 0, F.col("id").cast("double")).alias("v"))
    out = missing.fill_environmental_nearest(df, "v", "place", "day", rows_per_bucket=100)
    assert out.filter("v is null").count() == 0 and out.count() == 4000 and out.columns == df.columns
    assert sizes[0] <= 200


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for d in folders for p in glob.glob(f"{d.getPath()}/*/shuffle_*")}


@pytest.mark.parametrize("write", ["scratch", "slice", "layer"])
def test_written_tables_leave_no_shuffle_files(spark, scratch, write):
    before = shuffle_files(spark)
    df = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("n")).repartition(3, "n")
    if write == "scratch":
        made = runtime.materialize(df, "sums")
    elif write == "slice":
        made = layers.scan_layer(spark, layers.write_bronze_slice(df, f"{scratch}/sums", "2024-01-01"))
    else:
        made = layers.scan_layer(spark, layers.overwrite_table(df, f"{scratch}/sums"))
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    # the frame is planned anew when it is used again, and other uses of the session keep their files
    assert made.count() == df.count() == 700 and df.agg(F.sum("n")).first()[0] == sum(range(5000))
    assert spark.conf.get(runtime._SHUFFLE_CLEANUP) == "false"


def test_layers_hold_digests_in_half_their_letters(spark, scratch):
    df = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("patient_key"))
    for path in (layers.overwrite_table(df, f"{scratch}/gold"), layers.write_bronze_slice(df, f"{scratch}/bronze", "2024-01-01")):
        assert sum(os.path.getsize(p) for p in glob.glob(f"{path}/**/*.parquet", recursive=True)) < 20_000 * 64 * 0.7


def test_the_fused_table_alone_is_left_of_a_querys_lake(spark):
    root = composed.patient_lake(spark, "/root/testdata/sf0.01")
    assert {layer: runtime.folder_entries(spark, f"{root}/{layer}") for layer in layers.LAYERS} == {
        "bronze": set(), "silver": set(), "gold": {"patient_features_tcga"}
    }
    assert layers.scan_layer(spark, layers.layer_path(root, "gold", "patient_features_tcga")).count() == 15_000
