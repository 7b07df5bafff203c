"""Sources, sinks and the composed plans over files written by the tests."""

import datetime as dt
import json
import os

import pytest

from cohortloom import defaults
from cohortloom.operators import contracts
from cohortloom.plans import clean, features, ingest, training
from cohortloom.sources import delimited, layers, lookups, records
from cohortloom.streaming.landing import ingest_new_files


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text if isinstance(text, str) else json.dumps(text))
    return path


def test_slices_replace_and_stay(spark, scratch):
    path = layers.layer_path(scratch, "bronze", "t")
    day1, day2 = spark.createDataFrame([(1,), (2,)], "a int"), spark.createDataFrame([(3,)], "a int")
    for _ in range(2):
        layers.write_bronze_slice(day1, path, "2024-01-01")
    layers.write_bronze_slice(day2, path, "2024-01-02")
    assert layers.scan_layer(spark, path).count() == 3
    assert layers.scan_layer(spark, path).schema["ingestion_date"].dataType.simpleString() == "string"
    assert [r["a"] for r in layers.scan_layer(spark, path, slices="latest").collect()] == [3]
    assert layers.scan_layer(spark, path, slices="2024-01-01").count() == 2
    with pytest.raises(ValueError):
        layers.write_bronze_slice(day1.limit(0), path, "2024-01-02")
    assert layers.scan_layer(spark, path).count() == 3
    plan = layers.scan_layer(spark, path, slices="latest")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_empty_first_slice_leaves_nothing(spark, scratch):
    path = layers.layer_path(scratch, "bronze", "none")
    with pytest.raises(ValueError):
        layers.write_bronze_slice(spark.createDataFrame([], "a int"), path)
    assert not layers.table_exists(spark, path)
    with pytest.raises(ValueError):
        layers.layer_path(scratch, "platinum", "t")


def test_overwrite_replaces_the_schema(spark, scratch):
    path = layers.layer_path(scratch, "gold", "t")
    layers.overwrite_table(spark.createDataFrame([(1, "x")], "a int, b string"), path, ["b"])
    layers.overwrite_table(spark.createDataFrame([(2.5,)], "c double"), path)
    assert [tuple(r) for r in layers.scan_layer(spark, path).collect()] == [(2.5,)]


def test_clinical_pages(spark, scratch):
    put(scratch, "s/1.json", [{"patientId": "p", "sampleId": "s1", "clinicalAttributeId": "X", "value": "1", "more": 2}])
    put(scratch, "s/2.json", [{"patientId": "p", "sampleId": "s2", "clinicalAttributeId": "X", "value": None}])
    put(scratch, "p/1.json", [{"patientId": "p", "clinicalAttributeId": "AGE", "value": "50"},
                              {"patientId": "nobody", "clinicalAttributeId": "AGE", "value": "1"}])
    df = records.scan_eav_clinical(spark, f"{scratch}/s", f"{scratch}/p")
    assert sorted((r["sampleId"], r["clinicalAttributeId"], r["value"]) for r in df.collect() if r["value"]) == [
        ("s1", "AGE", "50"), ("s1", "X", "1"), ("s2", "AGE", "50"),
    ]
    assert records.scan_eav_clinical(spark, f"{scratch}/s").count() == 2
    put(scratch, "empty/1.json", [])
    with pytest.raises(ValueError):
        records.scan_eav_clinical(spark, f"{scratch}/empty")


def test_envelopes(spark, scratch):
    good = {"Header": [{"status": "Success", "rows": 2}], "Data": [{"a": 1}, {"a": None}]}
    put(scratch, "good/1.json", good)
    put(scratch, "good/2.json", {"Header": [], "Data": [{"a": 3}]})
    assert records.scan_json_envelope(spark, f"{scratch}/good", "a int").count() == 3
    put(scratch, "bad/1.json", {"Header": [{"status": "Failed"}], "Data": [{"a": 1}]})
    with pytest.raises(RuntimeError):
        records.scan_json_envelope(spark, f"{scratch}/bad", "a int")
    put(scratch, "none/1.json", {"Header": [{"status": "Success"}], "Data": []})
    with pytest.raises(ValueError):
        records.scan_json_envelope(spark, f"{scratch}/none", "a int")


def test_nested_lists(spark):
    df = spark.createDataFrame(
        [("f", [("c1", "s1"), ("c2", "s2")]), ("g", []), ("h", None)], "file_id string, cases array<struct<case_id:string,submitter_id:string>>"
    )
    out = records.json_explode_nested(df, "cases", ["file_id"], prefix="cases.")
    assert out.columns == ["file_id", "cases.case_id", "cases.submitter_id"] and out.count() == 2
    firsts = df.select(records.json_first_element("cases", "case_id").alias("c")).collect()
    assert [r["c"] for r in firsts] == ["c1", None, None]


def test_fixed_width_lines(spark, scratch):
    whole = "00000001" + " " * 15 + "1" + "095" + "2019" + " " * 10 + "C500" + "037" + " " * 6 + "8500"
    whole = (whole.ljust(99) + "IIA ").ljust(199) + "0012" + "1"
    put(scratch, "x.txt", whole + "\n\n" + "00000002" + " " * 15 + "9NA\n")
    rows = delimited.scan_fixed_width(spark, f"{scratch}/x.txt", na_values=["NA"]).orderBy("patient_id_number").collect()
    assert rows[0]["age_at_diagnosis"] == "095" and rows[0]["stage_tnm_combined"] == "IIA" and rows[0]["vital_status"] == "1"
    assert rows[1]["sex"] == "9" and rows[1]["age_at_diagnosis"] is None and rows[1]["vital_status"] is None
    assert len(rows) == 2


def count_file(genes):
    head = "# gene-model: test\n" + "\t".join(c.split()[0] for c in delimited.COUNT_SCHEMA.split(", ")) + "\n"
    lines = [f"N_unmapped\t\t\t{5}\t5\t5\t\t"] + [f"id{g}\t{g}\tcoding\t{n}\t1\t1\t0.5\t0.1" for g, n in genes]
    return head + "\n".join(lines) + "\n"


def test_count_files_with_a_drifted_header_fail(spark, scratch):
    put(scratch, "c/a.tsv", count_file([("G", 1)]).replace("gene_type", "kind"))
    with pytest.raises(Exception):
        delimited.scan_count_tsv(spark, f"{scratch}/c").collect()


def test_whole_lake(spark, scratch):
    """Landed files of every source through bronze, silver and gold to a training split."""
    day = "2024-03-01"
    patients = [f"P{i}" for i in range(24)]
    put(scratch, "s/1.json", [
        {"patientId": p, "sampleId": f"{p}-1", "clinicalAttributeId": a, "value": v}
        for i, p in enumerate(patients) for a, v in (("CANCER_TYPE", "Breast"), ("MUTATION_COUNT", str(i) if i else "bad"))
    ])
    put(scratch, "p/1.json", [
        {"patientId": p, "clinicalAttributeId": a, "value": v}
        for i, p in enumerate(patients)
        for a, v in (("AGE", str(40 + 3 * i)), ("OS_MONTHS", str(i + 1)), ("OS_STATUS", "1:DECEASED" if i % 2 else "0:LIVING"),
                     ("AJCC_PATHOLOGIC_TUMOR_STAGE", "STAGE IIA"))
    ])
    ingest.ingest_cbioportal_clinical(spark, scratch, f"{scratch}/s", f"{scratch}/p", day)
    put(scratch, "m/1.json", [
        {"sampleId": f"{p}-1", "patientId": p, "gene": {"hugoGeneSymbol": g, "entrezGeneId": 1} if g != "TTN" else "TTN",
         "proteinChange": "p.X", "mutationType": None}
        for p in patients[:20] for g in ("TP53", "TTN")
    ])
    ingest.ingest_cbioportal_mutations(spark, scratch, f"{scratch}/m", day)

    hits = spark.createDataFrame(
        [(f"f{i}", f"f{i}.tsv", "x", "TSV", "Transcriptome Profiling", "TCGA-BRCA", "open", [(f"C{i}", patients[i])]) for i in range(8)],
        ingest.FILE_HIT,
    )
    for i in range(8):
        put(scratch, f"counts/f{i}.tsv", count_file([("A.1", i), ("B-2", i * i), ("C", 3)]))
    files = ingest.list_files(hits, "TCGA-BRCA", "Transcriptome Profiling", "tsv")
    ingest.ingest_rna_seq(spark, scratch, files, f"{scratch}/counts", limit=7, ingestion_date=day)
    with pytest.raises(ValueError):
        ingest.ingest_rna_seq(spark, scratch, files, f"{scratch}/counts", limit=4, ingestion_date="2024-03-02")
    ingest.ingest_gdc_metadata(scratch, hits, "TCGA-BRCA", "Transcriptome Profiling", "TSV", day)

    put(scratch, "pm/1.json", {"Header": [{"status": "Success"}], "Data": [
        {"state_code": "06", "county_code": "037", "date_local": f"2019-01-0{d}", "arithmetic_mean": m}
        for d, m in ((1, None), (2, "8.5"), (3, None), (4, "9.5"))
    ]})
    ingest.ingest_environmental(spark, scratch, f"{scratch}/pm", dt.date(2019, 1, 30), ingestion_date=day)
    line = "00000001" + " " * 15 + "1" + "095" + "2019" + " " * 10 + "C500" + "037"
    put(scratch, "seer.txt", line + "\n")
    ingest.ingest_seer(spark, scratch, f"{scratch}/seer.txt", day)

    salt = "s"
    assert clean.clean_mutations(spark, f"{scratch}/nowhere", salt) is None
    for step in (clean.clean_clinical, clean.clean_mutations, clean.clean_rna_seq, clean.clean_seer):
        assert step(spark, scratch, salt)
    clean.clean_environmental(spark, scratch)
    clinical = layers.scan_layer(spark, layers.layer_path(scratch, "silver", "clinical"))
    assert clinical.count() == 24 and "patientId" not in clinical.columns
    assert clinical.agg({"AGE": "max"}).first()[0] == 90.0 and clinical.filter("MUTATION_COUNT is null").count() == 0

    features.clinical_features(spark, scratch)
    features.mutation_burden_features(spark, scratch)
    features.expression_features(spark, scratch)
    fused = layers.scan_layer(spark, features.patient_features_tcga(spark, scratch))
    assert fused.count() == 24 and fused.filter("has_genomic_expression_data").count() == 7
    assert fused.filter("has_genomic_mutation_burden_data").count() == 20
    assert fused.filter("p53_signaling = 1 and unmapped = 1").count() == 20
    joined = layers.scan_layer(spark, features.patient_features_seer_environmental(spark, scratch))
    # the first gap stays, the third day takes the second's reading: (8.5 + 8.5 + 9.5) / 3
    assert joined.first()["pm25_annual_mean"] == pytest.approx(26.5 / 3)

    found = training.prepare_train_test_split(spark, scratch, f"{scratch}/split")
    assert "expression_pca_0" in found and set(defaults.PATHWAY_FEATURES) <= set(found)
    split = spark.read.parquet(f"{scratch}/split")
    assert split.filter("split = 'test'").count() == 4 and split.count() == 24


def test_yaml_lookup(spark, scratch):
    path = put(scratch, "map.yaml", "mappings:\n  - {gene: TP53, pathway: p53}\n")
    assert [tuple(r) for r in lookups.scan_yaml_lookup(spark, path, "mappings", "gene string, pathway string").collect()] == [("TP53", "p53")]
    assert lookups.gene_pathways(spark).count() == 12


def test_new_files_are_ingested_once(spark, scratch):
    landing, table, state = (f"{scratch}/{n}" for n in ("landing", "table", "state"))
    put(landing, "1.json", '{"file_id": "a", "file_name": "a.tsv", "data_type": "x"}\n')
    schema = "file_id string, file_name string, data_type string"

    def run(day):
        ingest_new_files(spark, landing, schema, table, state, day, contracts.FILE_METADATA)

    run("2024-01-01")
    run("2024-01-01")
    put(landing, "2.json", '{"file_id": "b", "file_name": "b.tsv"}\n')
    run("2024-01-01")
    rows = layers.scan_layer(spark, table).collect()
    assert sorted(r["file_id"] for r in rows) == ["a", "b"] and {r["ingestion_date"] for r in rows} == {"2024-01-01"}
