"""Queries over the composed plans: landed files to bronze, silver and gold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortloom import defaults
from cohortloom.plans import clean, features, ingest
from cohortloom.runtime import materialize, remove_path, scratch_path
from cohortloom.sources.layers import layer_path, scan_layer, write_bronze_slice
from cohortloom.streaming.newest import follow_slices, newest_rows
from suite import frames, scans
from suite.registry import query, table
from suite.relational import BURDEN_COLUMNS_SQL, _PATHWAY_OF

DAY = "2024-02-01"
SALT = frames.SALT


def _doubles(df, names):
    """Columns that may be null as doubles, whose nulls read alike everywhere."""
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def lake(spark) -> str:
    return scratch_path(spark, "lake")


def bronze(spark, root, domain):
    return scan_layer(spark, layer_path(root, "bronze", domain))


def _dated(sql: str) -> str:
    return f"select *, '{DAY}' as ingestion_date from ({sql}) as landed"


# --- ingest


@query("ingest_cbioportal_clinical", _dated(frames.EAV_SQL))
def ingest_cbioportal_clinical(spark, sf):
    root = lake(spark)
    ingest.ingest_cbioportal_clinical(spark, root, *scans.landed_clinical(spark, sf), ingestion_date=DAY)
    return bronze(spark, root, "cbioportal_clinical")


@query("ingest_cbioportal_mutations", _dated(frames.MUTATIONS_SQL))
def ingest_cbioportal_mutations(spark, sf):
    root = lake(spark)
    ingest.ingest_cbioportal_mutations(spark, root, scans.landed_mutations(spark, sf), DAY)
    return bronze(spark, root, "cbioportal_mutations")


@query(
    "ingest_gdc_metadata",
    f"""
    select file_id, file_name, data_type, data_format, case_id, submitter_id, '{DAY}' as ingestion_date
    from ({frames.LISTING_SQL}) as l
    """,
)
def ingest_gdc_metadata(spark, sf):
    root = lake(spark)
    hits = frames.file_listing(spark, sf)
    ingest.ingest_gdc_metadata(root, hits, "TCGA-BRCA", "Transcriptome Profiling", "TSV", DAY)
    written = bronze(spark, root, "gdc_mutation_file_metadata")
    return written.withColumnsRenamed({"cases.case_id": "case_id", "cases.submitter_id": "submitter_id"})


def listed(spark, sf):
    return ingest.list_files(frames.file_listing(spark, sf), "TCGA-BRCA", "Transcriptome Profiling", "TSV", limit=None)


def with_absent_file(files):
    """A listing with one more file, which never landed."""
    more = files.limit(1).withColumn("file_id", F.lit("never-landed"))
    return files.unionByName(more)


TAGGED_SQL = f"""
    with counts as ({frames.COUNT_SQL}), listing as ({frames.LISTING_SQL})
    select counts.*, case_id, submitter_id from counts join listing using (file_id)
"""


@query("ingest_rna_seq", _dated(TAGGED_SQL))
def ingest_rna_seq(spark, sf):
    root = lake(spark)
    ingest.ingest_rna_seq(
        spark, root, with_absent_file(listed(spark, sf)), frames.land_count_files(spark, sf), ingestion_date=DAY,
        naming=frames.COUNT_FOLDER, file_id=frames.COUNT_FILE_ID,
    )
    return bronze(spark, root, "gdc_rna_seq_counts")


@query(
    "ingest_methylation",
    f"""
    with betas as (select 'f' || cast(floor(l_orderkey / {frames.ORDERS_PER_FILE}) as bigint) as file_id,
                          'cg' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as probe_id,
                          case when l_discount = 0 then null else l_discount end as beta_value from lineitem),
         listing as ({frames.LISTING_SQL})
    select probe_id, beta_value, file_id, case_id, submitter_id, file_name, '{DAY}' as ingestion_date
    from betas join listing using (file_id)
    """,
)
def ingest_methylation(spark, sf):
    beta = F.when(F.col("l_discount") == 0, "NA").otherwise(F.col("l_discount").cast("string"))
    probe = F.concat(F.lit("cg"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    folder = scratch_path(spark, "betas")
    (
        table(spark, sf, "lineitem")
        .select(frames.file_of(F.col("l_orderkey")).alias("file_id"), F.concat_ws("\t", probe, beta).alias("value"))
        .hint("rebalance", "file_id").write.partitionBy("file_id").text(folder)
    )
    root = lake(spark)
    ingest.ingest_methylation(
        spark, root, listed(spark, sf), folder, ingestion_date=DAY,
        naming=frames.COUNT_FOLDER, file_id=frames.COUNT_FILE_ID,
    )
    return bronze(spark, root, "gdc_methylation_beta_values")


@query(
    "ingest_environmental",
    f"""
    select event_id, state_code, county_code, date_local, arithmetic_mean, '{DAY}' as ingestion_date
    from ({frames.READINGS_SQL}) as r
    where date_local between '2024-01-01' and '2024-01-31'
      and (state_code, county_code) in (select ('01', '001') union all select ('08', '008'))
    """,
)
def ingest_environmental(spark, sf):
    path = frames.land_json_pages(frames.as_json(frames.readings(spark, sf)), "readings", frames.ENVELOPE)
    places = spark.createDataFrame([("01", "001"), ("08", "008")], "state_code string, county_code string")
    root = lake(spark)
    ingest.ingest_environmental(spark, root, path, dt.date(2024, 1, 31), places, ingestion_date=DAY)
    return bronze(spark, root, "environmental_pm25").withColumn("event_id", F.col("event_id").cast("long"))


@query("ingest_seer", _dated(frames.REGISTRY_SQL))
def ingest_seer(spark, sf):
    root = lake(spark)
    ingest.ingest_seer(spark, root, frames.land_registry_extract(spark, sf), DAY)
    return bronze(spark, root, "seer_extract")


# --- clean


def clinical_bronze(spark, sf) -> str:
    root = lake(spark)
    write_bronze_slice(frames.eav(spark, sf), layer_path(root, "bronze", "cbioportal_clinical"), DAY)
    return root


CLEAN_CLINICAL_SQL = f"""
    with wide as ({frames.WIDE_CLINICAL_SQL}),
    typed as (select * replace (try_cast("AGE" as double) as "AGE", try_cast("MUTATION_COUNT" as double) as "MUTATION_COUNT")
              from wide),
    medians as (select "CANCER_TYPE" as s, quantile_disc("AGE", 0.5) as a, quantile_disc("MUTATION_COUNT", 0.5) as m
                from typed group by 1),
    filled as (select typed.* replace (coalesce("AGE", a) as "AGE", coalesce("MUTATION_COUNT", m) as "MUTATION_COUNT")
               from typed join medians on "CANCER_TYPE" is not distinct from s),
    fences as (select "CANCER_TYPE" as s, quantile_disc("AGE", 0.25) as a1, quantile_disc("AGE", 0.75) as a3,
                      quantile_disc("MUTATION_COUNT", 0.25) as m1, quantile_disc("MUTATION_COUNT", 0.75) as m3
               from filled group by 1),
    capped as (select filled.* replace (
                      greatest(least("AGE", a3 + 1.5 * (a3 - a1)), a1 - 1.5 * (a3 - a1)) as "AGE",
                      greatest(least("MUTATION_COUNT", m3 + 1.5 * (m3 - m1)), m1 - 1.5 * (m3 - m1)) as "MUTATION_COUNT")
               from filled join fences on "CANCER_TYPE" is not distinct from s)
    select "sampleId", coalesce("CANCER_TYPE", 'Unknown') as "CANCER_TYPE", "MUTATION_COUNT",
           case when "AGE" > 89 then 90 else "AGE" end as "AGE", coalesce("SEX", 'Unknown') as "SEX",
           coalesce("AJCC_PATHOLOGIC_TUMOR_STAGE", 'Unknown') as "AJCC_PATHOLOGIC_TUMOR_STAGE",
           "OS_MONTHS", "OS_STATUS", sha256("patientId" || '{SALT}') as patient_key
    from capped
"""


def cleaned_clinical(spark, sf) -> str:
    root = clinical_bronze(spark, sf)
    clean.clean_clinical(spark, root, SALT, attributes=frames.CLINICAL_ATTRIBUTES, method="exact")
    return root


@query("clean_clinical", CLEAN_CLINICAL_SQL)
def clean_clinical(spark, sf):
    return scan_layer(spark, layer_path(cleaned_clinical(spark, sf), "silver", "clinical"))


CLEAN_MUTATIONS_SQL = f"""
    select "sampleId", gene, "proteinChange", coalesce("mutationType", 'not_tested') as "mutationType",
           sha256("patientId" || '{SALT}') as patient_key
    from ({frames.MUTATIONS_SQL}) as m
"""


def cleaned_mutations(spark, sf, root: str) -> str:
    write_bronze_slice(frames.mutation_calls(spark, sf), layer_path(root, "bronze", "cbioportal_mutations"), DAY)
    return clean.clean_mutations(spark, root, SALT)


@query("clean_mutations", _dated(CLEAN_MUTATIONS_SQL))
def clean_mutations(spark, sf):
    return scan_layer(spark, cleaned_mutations(spark, sf, lake(spark)))


_NUMERIC = ["unstranded", "stranded_first", "stranded_second", "tpm_unstranded", "fpkm_unstranded"]


def _medians(columns: list[str], source: str) -> str:
    return ", ".join(f"(select quantile_disc({c}, 0.5) from {source}) as m_{c}" for c in columns)


CLEAN_RNA_SQL = f"""
    with counts as ({TAGGED_SQL}), med as (select {_medians(_NUMERIC, 'counts')}),
    dev as (select {", ".join(f"quantile_disc(abs({c} - m_{c}), 0.5) as d_{c}" for c in _NUMERIC)} from counts, med)
    select file_id, gene_id, gene_name, {", ".join(_NUMERIC)}, case_id, sha256(submitter_id || '{SALT}') as patient_key,
           {", ".join(f"cast(abs({c} - m_{c}) / (1.4826 * coalesce(nullif(d_{c}, 0), 1e-9)) > 3.5 as double) as {c}_is_outlier"
                      for c in _NUMERIC)}
    from counts, med, dev
"""


def tagged_counts(spark, sf):
    """Count rows with their cases, without the detour over landed files."""
    rows = frames.count_rows(spark, sf).unionByName(frames.summary_rows(spark, sf), allowMissingColumns=True)
    listing = listed(spark, sf).withColumnsRenamed({"cases.case_id": "case_id", "cases.submitter_id": "submitter_id"})
    return rows.join(materialize(listing.select("file_id", "case_id", "submitter_id"), "listing"), "file_id")


def cleaned_rna_seq(spark, sf, root: str) -> str:
    write_bronze_slice(tagged_counts(spark, sf), layer_path(root, "bronze", "gdc_rna_seq_counts"), DAY)
    return clean.clean_rna_seq(spark, root, SALT, method="exact")


@query("clean_rna_seq", CLEAN_RNA_SQL)
def clean_rna_seq(spark, sf):
    cleaned = scan_layer(spark, cleaned_rna_seq(spark, sf, lake(spark))).drop("ingestion_date", "gene_type")
    return _doubles(cleaned, [f"{c}_is_outlier" for c in _NUMERIC])


OLD_DAY, NEW_FROM = "2024-01-20", "2024-01-10"
# a reading is as its newest slice has it
SLICED_SQL = f"""
    select event_id, state_code, county_code, date_local,
           case when date_local < '{NEW_FROM}' then arithmetic_mean * 2 else arithmetic_mean end as arithmetic_mean,
           case when date_local < '{NEW_FROM}' then '{OLD_DAY}' else '{DAY}' end as ingestion_date
    from ({frames.READINGS_SQL}) as readings
"""
CLEAN_PM25_SQL = f"""
    select ingestion_date, event_id, state_code, county_code, date_local, coalesce(arithmetic_mean,
           last_value(arithmetic_mean ignore nulls) over (partition by state_code, county_code order by date_local, event_id
           rows between unbounded preceding and current row)) as arithmetic_mean
    from ({SLICED_SQL}) as r
"""


def cleaned_environmental(spark, sf, root: str) -> str:
    """Two slices that overlap: the older one holds the first twenty days with other values."""
    readings, path = frames.readings(spark, sf), layer_path(root, "bronze", "environmental_pm25")
    older = readings.filter(F.col("date_local") <= OLD_DAY)
    doubled = (F.col("arithmetic_mean").cast("double") * 2).cast("string")
    write_bronze_slice(older.withColumn("arithmetic_mean", doubled), path, OLD_DAY)
    write_bronze_slice(readings.filter(F.col("date_local") >= NEW_FROM), path, DAY)
    return clean.clean_environmental(
        spark, root, place_cols=("state_code", "county_code"), tie_cols=("event_id",)
    )


@query("clean_environmental", CLEAN_PM25_SQL)
def clean_environmental(spark, sf):
    return scan_layer(spark, cleaned_environmental(spark, sf, lake(spark)))


@query("stream_newest_readings", CLEAN_PM25_SQL)
def stream_newest_readings(spark, sf):
    """The same readings by a stream that runs after each slice and keeps the newest per key as state."""
    readings, root = frames.readings(spark, sf), lake(spark)
    bronze, newest, state = (layer_path(root, "bronze", "environmental_pm25"), *[scratch_path(spark, n) for n in ("newest", "state")])
    key = [c for c in clean.READING_KEY if c in readings.columns]
    older = readings.filter(F.col("date_local") <= OLD_DAY)
    doubled = (F.col("arithmetic_mean").cast("double") * 2).cast("string")
    write_bronze_slice(older.withColumn("arithmetic_mean", doubled), bronze, OLD_DAY)
    follow_slices(spark, bronze, newest, state, key)
    write_bronze_slice(readings.filter(F.col("date_local") >= NEW_FROM), bronze, DAY)
    follow_slices(spark, bronze, newest, state, key)
    rows = newest_rows(spark, bronze, newest)
    return clean.clean_environmental_frame(rows, place_cols=("state_code", "county_code"), tie_cols=("event_id",))


CLEAN_SEER_SQL = f"""
    select * exclude (patient_id_number) replace (
               case when cast(age_at_diagnosis as double) > 89 then 90 else cast(age_at_diagnosis as double) end
               as age_at_diagnosis),
           sha256(patient_id_number || '{SALT}') as patient_key
    from ({frames.REGISTRY_SQL}) as r
"""


def cleaned_seer(spark, sf, root: str) -> str:
    ingest.ingest_seer(spark, root, frames.land_registry_extract(spark, sf), DAY)
    return clean.clean_seer(spark, root, SALT)


@query("clean_seer", _dated(CLEAN_SEER_SQL))
def clean_seer(spark, sf):
    return _doubles(scan_layer(spark, cleaned_seer(spark, sf, lake(spark))), ["age_at_diagnosis"])


# --- gold

_STAGE_CASE = " ".join(f"when '{s}' then {i}" for i, s in enumerate(defaults.STAGE_ORDER))
STAGED_SQL = f"""
    select *, case upper(trim(regexp_replace("AJCC_PATHOLOGIC_TUMOR_STAGE", '^\\s*[Ss][Tt][Aa][Gg][Ee]\\s+', '')))
              {_STAGE_CASE} end::double as stage_rank
    from ({CLEAN_CLINICAL_SQL}) as c
"""


@query("clinical_features", STAGED_SQL)
def clinical_features(spark, sf):
    return _doubles(scan_layer(spark, features.clinical_features(spark, cleaned_clinical(spark, sf))), ["stage_rank"])


def _expression_sql(values: str) -> str:
    """Squared length of the standardised values of every patient; a gene without a value counts as 0."""
    return f"""
        with cells as ({values}),
             wide as (select p.patient_key, g.gene, coalesce(c.v, 0) as v
                      from (select distinct patient_key from cells) as p cross join (select distinct gene from cells) as g
                           left join cells as c using (patient_key, gene)),
             scales as (select gene, avg(v) as m, stddev_samp(v) as s from wide group by gene)
        select patient_key, round(sum(case when s > 0 then ((v - m) / s) ** 2 else 0 end), 4) as squared_length
        from wide join scales using (gene) group by patient_key
    """


def _squared_length(components):
    """All components together keep the length of a row, however they are turned."""
    names = [c for c in components.columns if c.startswith("expression_pca_")]
    squares = sum((F.col(c) ** 2 for c in names), F.lit(0.0))
    return components.select("patient_key", F.round(squares, 4).alias("squared_length"))


@query(
    "expression_features",
    _expression_sql(
        f"""
        select patient_key, gene_name as gene, coalesce(arg_min(unstranded, (gene_id, file_id)), 0) as v
        from ({CLEAN_RNA_SQL}) as c where gene_name is not null group by 1, 2
        """
    ),
)
def expression_features(spark, sf):
    root = lake(spark)
    cleaned_rna_seq(spark, sf, root)
    made = features.expression_features(spark, root, order_by=["gene_id", "file_id"], components=10_000)
    return _squared_length(scan_layer(spark, made))


@query(
    "expression_components",
    _expression_sql(
        """
        select 'P' || (l_suppkey % 120) as patient_key, 'G' || (l_partkey % 300) as gene,
               arg_min(l_quantity, (l_orderkey, l_linenumber)) as v
        from lineitem group by 1, 2
        """
    ),
)
def expression_components(spark, sf):
    """The reduction of many patients' genes in one piece, from the long table to the components."""
    lines = table(spark, sf, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_suppkey") % 120).alias("patient_key"),
        F.concat(F.lit("G"), F.col("l_partkey") % 300).alias("gene_name"),
        F.col("l_quantity").alias("unstranded"),
        "l_orderkey",
        "l_linenumber",
    )
    return _squared_length(features.expression_features_frame(lines, components=10_000, order_by=["l_orderkey", "l_linenumber"]))


BURDEN_SQL = f"""
    select patient_key, {BURDEN_COLUMNS_SQL}
    from (select patient_key, case gene {_PATHWAY_OF} else 'unmapped' end as pathway from ({CLEAN_MUTATIONS_SQL}) as m) as p
    group by 1
"""


@query("mutation_burden_features", BURDEN_SQL)
def mutation_burden_features(spark, sf):
    root = lake(spark)
    cleaned_mutations(spark, sf, root)
    return scan_layer(spark, features.mutation_burden_features(spark, root))


def used_up(spark, root: str, *tables: str) -> None:
    """Remove tables of a lake, named by layer and domain, that no later step reads."""
    for name in tables:
        remove_path(spark, layer_path(root, *name.split("/")))


def patient_lake(spark, sf) -> str:
    """All three modalities up to the fused gold table. A table goes when the step that reads it last has written its own."""
    root = cleaned_clinical(spark, sf)
    features.clinical_features(spark, root)
    used_up(spark, root, "bronze/cbioportal_clinical", "silver/clinical")
    cleaned_mutations(spark, sf, root)
    features.mutation_burden_features(spark, root)
    used_up(spark, root, "bronze/cbioportal_mutations", "silver/mutations")
    cleaned_rna_seq(spark, sf, root)
    used_up(spark, root, "bronze/gdc_rna_seq_counts")
    features.expression_features(spark, root, order_by=["gene_id", "file_id"])
    used_up(spark, root, "silver/rna_seq")
    features.patient_features_tcga(spark, root)
    used_up(spark, root, "gold/clinical_features", "gold/mutation_burden_features", "gold/expression_features")
    return root


@query(
    "patient_features_tcga",
    f"""
    with clinical as ({STAGED_SQL}), burden as ({BURDEN_SQL}),
         expression as (select distinct sha256(submitter_id || '{SALT}') as patient_key from ({frames.LISTING_SQL}) as l)
    select patient_key, "sampleId", "AGE", "OS_MONTHS", stage_rank, {", ".join(defaults.PATHWAY_FEATURES)},
           "sampleId" is not null as has_clinical_data, e.patient_key is not null as has_genomic_expression_data,
           unmapped is not null as has_genomic_mutation_burden_data
    from clinical full outer join (select patient_key, patient_key as pk from expression) as x using (patient_key)
         full outer join burden using (patient_key) left join expression as e using (patient_key)
    """,
)
def patient_features_tcga(spark, sf):
    fused = scan_layer(spark, layer_path(patient_lake(spark, sf), "gold", "patient_features_tcga"))
    return _doubles(fused, ["stage_rank"]).select(
        "patient_key", "sampleId", "AGE", "OS_MONTHS", "stage_rank", *defaults.PATHWAY_FEATURES,
        "has_clinical_data", "has_genomic_expression_data", "has_genomic_mutation_burden_data",
    )


@query(
    "patient_features_seer_environmental",
    f"""
    with yearly as (select county_code, substr(date_local, 1, 4) as year, avg(arithmetic_mean) as pm25
                    from ({CLEAN_PM25_SQL}) as r group by 1, 2)
    select s.* exclude (county_of_residence), county_of_residence as county_code, year_of_diagnosis as year,
           round(pm25, 6) as pm25_annual_mean, '{DAY}' as ingestion_date
    from ({CLEAN_SEER_SQL}) as s left join yearly on county_of_residence = county_code and year_of_diagnosis = year
    """,
)
def patient_features_seer_environmental(spark, sf):
    root = lake(spark)
    cleaned_seer(spark, sf, root)
    cleaned_environmental(spark, sf, root)
    gold = scan_layer(spark, features.patient_features_seer_environmental(spark, root))
    return _doubles(gold, ["age_at_diagnosis"]).withColumn("pm25_annual_mean", F.round("pm25_annual_mean", 6))
