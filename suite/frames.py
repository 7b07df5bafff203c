"""Health-record shaped inputs derived from the given tables, as Spark frames and as
the SQL that describes the same rows, and writers that land them as source files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import defaults
from cohortloom.runtime import scratch_path
from suite.registry import table

SALT = "suite-salt"
PAGE_ROWS = 5000
ORDERS_PER_FILE = 2000

GENES = [gene for gene, _ in defaults.GENE_PATHWAYS] + ["TTN", "GATA3"]
STAGES = ["Stage 0", "STAGE I", "stage ia", "IB", "Stage II", "STAGE IIA", " stage IIB", "III", "STAGE IIIA",
          "Stage IIIB", "STAGE IIIC", "Stage IV", "STAGE X", "STAGEIV"]


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


# --- long clinical attributes: an order is a sample, its customer the patient


def sample_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    cancer_type = F.when((F.col("o_orderpriority") == "5-LOW") & (key % 7 == 0), None).otherwise(F.col("o_orderpriority"))
    count = F.when(key % 23 == 0, "NA").otherwise(F.floor(price / 1000).cast("string"))
    pairs = F.array(
        F.struct(F.lit("CANCER_TYPE").alias("clinicalAttributeId"), cancer_type.alias("value")),
        F.struct(F.lit("MUTATION_COUNT").alias("clinicalAttributeId"), count.alias("value")),
    )
    return orders.select(
        F.concat(F.lit("P"), F.col("o_custkey")).alias("patientId"),
        F.concat(F.lit("S"), key).alias("sampleId"),
        F.inline(pairs),
    )


def patient_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    age = F.when(F.col("c_acctbal") < 0, None).when(key % 17 == 0, "unknown").otherwise((key % 110).cast("string"))
    values = {
        "AGE": age,
        "SEX": F.when(key % 3 == 0, "Male").when(key % 3 == 1, "Female"),
        "AJCC_PATHOLOGIC_TUMOR_STAGE": pick(STAGES, key % len(STAGES)),
        "OS_MONTHS": F.when(key % 29 == 0, "[Not Available]").otherwise((key * 7 % 240).cast("string")),
        "OS_STATUS": F.when(F.col("c_mktsegment") == "MACHINERY", "1:DECEASED").otherwise("0:LIVING"),
    }
    pairs = F.array(
        *[F.struct(F.lit(k).alias("clinicalAttributeId"), v.cast("string").alias("value")) for k, v in values.items()]
    )
    return customer.select(F.concat(F.lit("P"), key).alias("patientId"), F.inline(pairs))


CLINICAL_ATTRIBUTES = [
    "CANCER_TYPE", "MUTATION_COUNT", "AGE", "SEX", "AJCC_PATHOLOGIC_TUMOR_STAGE", "OS_MONTHS", "OS_STATUS",
]

# one row per sample with the same attributes as text
WIDE_CLINICAL_SQL = f"""
    select 'P' || o_custkey as "patientId", 'S' || o_orderkey as "sampleId",
           case when o_orderpriority = '5-LOW' and o_orderkey % 7 = 0 then null else o_orderpriority end as "CANCER_TYPE",
           case when o_orderkey % 23 = 0 then 'NA'
                else cast(cast(floor(o_totalprice / 1000) as bigint) as varchar) end as "MUTATION_COUNT",
           case when c_acctbal < 0 then null when c_custkey % 17 = 0 then 'unknown'
                else cast(c_custkey % 110 as varchar) end as "AGE",
           case c_custkey % 3 when 0 then 'Male' when 1 then 'Female' end as "SEX",
           ({sql_list(STAGES)})[c_custkey % {len(STAGES)} + 1] as "AJCC_PATHOLOGIC_TUMOR_STAGE",
           case when c_custkey % 29 = 0 then '[Not Available]' else cast(c_custkey * 7 % 240 as varchar) end as "OS_MONTHS",
           case when c_mktsegment = 'MACHINERY' then '1:DECEASED' else '0:LIVING' end as "OS_STATUS"
    from orders join customer on o_custkey = c_custkey
"""

EAV_SQL = f"""
    with wide as ({WIDE_CLINICAL_SQL})
    {" union all ".join(f'''select "patientId", "sampleId", '{a}' as "clinicalAttributeId", "{a}" as "value" from wide'''
                        for a in CLINICAL_ATTRIBUTES)}
"""


def eav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long table without the detour over landed files."""
    from cohortloom.operators.joins import join_broadcast_attributes

    samples, patients = sample_attributes(spark, sf_dir), patient_attributes(spark, sf_dir)
    spread = join_broadcast_attributes(samples, patients, "patientId", "sampleId")
    return samples.unionByName(spread)


# --- mutation calls: one per order


def mutation_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), key).alias("sampleId"),
        F.concat(F.lit("P"), F.col("o_custkey")).alias("patientId"),
        pick(GENES, key % len(GENES)).alias("gene"),
        F.concat(F.lit("p."), F.col("o_orderpriority")).alias("proteinChange"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("mutationType"),
    )


MUTATIONS_SQL = f"""
    select 'S' || o_orderkey as "sampleId", 'P' || o_custkey as "patientId",
           ({sql_list(GENES)})[o_orderkey % {len(GENES)} + 1] as gene,
           'p.' || o_orderpriority as "proteinChange",
           case when o_orderstatus <> 'P' then o_orderstatus end as "mutationType"
    from orders
"""


# --- expression counts: one file per block of orders, one gene row per line item


def file_number(order_key: Column) -> Column:
    return F.floor(order_key / ORDERS_PER_FILE)


def file_name(number: Column) -> Column:
    return F.concat(F.lit("f"), number.cast("string"))


def file_of(order_key: Column) -> Column:
    return file_name(file_number(order_key))


def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        file_of(F.col("l_orderkey")).alias("file_id"),
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.floor(F.col("l_extendedprice") * 100 + 0.5),
        ).alias("gene_id"),
        F.concat(F.lit("G"), F.col("l_partkey") % 300).alias("gene_name"),
        F.col("l_returnflag").alias("gene_type"),
        F.col("l_quantity").cast("long").alias("unstranded"),
        F.col("l_suppkey").alias("stranded_first"),
        F.col("l_linenumber").cast("long").alias("stranded_second"),
        F.col("l_extendedprice").alias("tpm_unstranded"),
        F.col("l_discount").alias("fpkm_unstranded"),
    )


def summary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four rows a count file starts with: totals without a gene name."""
    per_file = table(spark, sf_dir, "lineitem").groupBy(file_number(F.col("l_orderkey")).alias("number")).agg(
        F.count(F.lit(1)).alias("N_unmapped"),
        F.count_if(F.col("l_returnflag") == "R").alias("N_multimapping"),
        F.count_if(F.col("l_returnflag") == "A").alias("N_noFeature"),
        F.count_if(F.col("l_discount") == 0).alias("N_ambiguous"),
    )
    names = ["N_unmapped", "N_multimapping", "N_noFeature", "N_ambiguous"]
    pairs = F.array(*[F.struct(
        F.lit(n).alias("gene_id"),
        *[F.col(n).alias(c) for c in ("unstranded", "stranded_first", "stranded_second")],
    ) for n in names])
    return per_file.select(file_name(F.col("number")).alias("file_id"), F.inline(pairs))


COUNT_SQL = f"""
    select 'f' || cast(floor(l_orderkey / {ORDERS_PER_FILE}) as bigint) as file_id,
           l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
               || cast(floor(l_extendedprice * 100 + 0.5) as bigint) as gene_id,
           'G' || (l_partkey % 300) as gene_name, l_returnflag as gene_type,
           cast(l_quantity as bigint) as unstranded, l_suppkey as stranded_first,
           cast(l_linenumber as bigint) as stranded_second, l_extendedprice as tpm_unstranded,
           l_discount as fpkm_unstranded
    from lineitem
    union all
    select file_id, unnest(['N_unmapped', 'N_multimapping', 'N_noFeature', 'N_ambiguous']), null, null,
           unnest([n, r, a, z]), unnest([n, r, a, z]), unnest([n, r, a, z]), null, null
    from (select 'f' || cast(floor(l_orderkey / {ORDERS_PER_FILE}) as bigint) as file_id, count(*) as n,
                 count(*) filter (l_returnflag = 'R') as r, count(*) filter (l_returnflag = 'A') as a,
                 count(*) filter (l_discount = 0) as z
          from lineitem group by 1) as per_file
"""


def land_count_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the count files, each with a header, a comment line and its rows.

    A file that is too large for one task is written as several, each with a header.
    """
    totals = summary_rows(spark, sf_dir)
    comments = totals.select("file_id").distinct().withColumn("gene_id", F.lit("# gene-model: suite"))
    rows = count_rows(spark, sf_dir)
    for part in (totals, comments):
        rows = rows.unionByName(part, allowMissingColumns=True)
    path = scratch_path(spark, "counts")
    writer = rows.hint("rebalance", "file_id").write.partitionBy("file_id")
    # the writer quotes a leading comment sign, so give it another one
    writer.option("comment", "~").csv(path, sep="\t", header=True)
    return path


COUNT_FILE_ID = r"file_id=([^/]+)/"
COUNT_FOLDER = "file_id={file_id}"


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed file metadata with its cases as a list; every fourth file has two."""
    number = F.col("number")
    # numbers first: what is asked of the listing is then asked of them, and no row of the table becomes text
    files = table(spark, sf_dir, "lineitem").select(file_number(F.col("l_orderkey")).alias("number")).distinct()
    files = files.withColumn("file_id", file_name(number))

    def case(suffix: str) -> Column:
        return F.struct(
            F.concat(F.lit("C"), number, F.lit(suffix)).alias("case_id"),
            F.concat(F.lit("P"), number).alias("submitter_id"),
        )

    return files.select(
        "file_id",
        F.concat("file_id", F.lit(".counts.tsv")).alias("file_name"),
        F.lit("Gene Expression Quantification").alias("data_type"),
        F.when(number % 2 == 0, "TSV").otherwise("tsv").alias("data_format"),
        F.lit("Transcriptome Profiling").alias("data_category"),
        F.lit("TCGA-BRCA").alias("project_id"),
        F.lit("open").alias("access"),
        F.when(number % 4 == 3, F.array(case("a"), case("b"))).otherwise(F.array(case("a"))).alias("cases"),
    )


LISTING_SQL = f"""
    select file_id, 'C' || n || c as case_id, 'P' || n as submitter_id, file_id || '.counts.tsv' as file_name,
           'Gene Expression Quantification' as data_type, case when n % 2 = 0 then 'TSV' else 'tsv' end as data_format
    from (select file_id, n, unnest(case when n % 4 = 3 then ['a', 'b'] else ['a'] end) as c
          from (select distinct 'f' || cast(floor(l_orderkey / {ORDERS_PER_FILE}) as bigint) as file_id,
                       cast(floor(l_orderkey / {ORDERS_PER_FILE}) as bigint) as n from lineitem) as files) as cases
"""


# --- daily readings: an event is a monitor reading, its type's gaps are lost readings


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.lpad((F.col("user_id") % 56).cast("string"), 2, "0").alias("state_code"),
        F.lpad((F.col("user_id") % 100).cast("string"), 3, "0").alias("county_code"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_local"),
        F.when(F.col("event_type") != "error", F.col("value").cast("string")).alias("arithmetic_mean"),
    )


READINGS_SQL = """
    select event_id, lpad(cast(user_id % 56 as varchar), 2, '0') as state_code,
           lpad(cast(user_id % 100 as varchar), 3, '0') as county_code, strftime(ts, '%Y-%m-%d') as date_local,
           case when event_type <> 'error' then value end as arithmetic_mean
    from events
"""


# --- registry extract: a customer is a case


def registry_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key,
        F.lpad(key.cast("string"), 8, "0").alias("patient_id_number"),
        F.when(key % 13 == 0, "").otherwise((key % 2 + 1).cast("string")).alias("sex"),
        F.when(key % 19 == 0, "").otherwise(F.lpad((key % 110).cast("string"), 3, "0")).alias("age_at_diagnosis"),
        F.lit("2024").alias("year_of_diagnosis"),
        F.concat(F.lit("C"), F.lpad((key % 800).cast("string"), 3, "0")).alias("primary_site"),
        F.lpad((key % 120).cast("string"), 3, "0").alias("county_of_residence"),
        F.lpad((F.lit(8000) + F.col("c_nationkey")).cast("string"), 4, "0").alias("histology_icd_o3"),
        pick(["I", "IIA", "IIIB", "IV"], key % 4).alias("stage_tnm_combined"),
        F.lpad((key % 240).cast("string"), 4, "0").alias("survival_months"),
        pick(["0", "1", "4"], key % 3).alias("vital_status"),
    )


REGISTRY_SQL = """
    select lpad(cast(c_custkey as varchar), 8, '0') as patient_id_number,
           case when c_custkey % 13 = 0 then null else cast(c_custkey % 2 + 1 as varchar) end as sex,
           case when c_custkey % 19 = 0 then null else lpad(cast(c_custkey % 110 as varchar), 3, '0') end as age_at_diagnosis,
           '2024' as year_of_diagnosis, 'C' || lpad(cast(c_custkey % 800 as varchar), 3, '0') as primary_site,
           lpad(cast(c_custkey % 120 as varchar), 3, '0') as county_of_residence,
           lpad(cast(8000 + c_nationkey as varchar), 4, '0') as histology_icd_o3,
           (['I', 'IIA', 'IIIB', 'IV'])[c_custkey % 4 + 1] as stage_tnm_combined,
           case when c_custkey % 11 = 0 then null else lpad(cast(c_custkey % 240 as varchar), 4, '0') end as survival_months,
           case when c_custkey % 11 = 0 then null else (['0', '1', '4'])[c_custkey % 3 + 1] end as vital_status
    from customer
"""


def land_registry_extract(spark: SparkSession, sf_dir: str) -> str:
    """Fixed-width lines; some lines end after the stage."""
    fields, parts, at = registry_fields(spark, sf_dir), [], 1
    for name, start, end in defaults.REGISTRY_LAYOUT:
        parts += [F.lit(" " * (start - at)), F.rpad(name, end - start + 1, " ")]
        at = end + 1
    whole = F.concat(*parts)
    cut = defaults.REGISTRY_LAYOUT[-3][2]
    line = F.when(F.col("c_custkey") % 11 == 0, F.rtrim(F.substring(whole, 1, cut))).otherwise(whole)
    path = scratch_path(spark, "registry")
    fields.select(line.alias("value")).write.text(path)
    return path


# --- landing JSON


def land_json_pages(records: DataFrame, label: str, envelope: str | None = None) -> str:
    """Write a one-column frame of JSON records as files that hold one array each.

    Rows are numbered within their input partition, so a page never has more than
    ``PAGE_ROWS`` records. ``envelope`` wraps the array, which it calls ``%s``.
    """
    name = records.columns[0]
    path = scratch_path(records.sparkSession, label)
    pages = (
        records.withColumn("page", F.floor(F.monotonically_increasing_id() / PAGE_ROWS))
        .groupBy("page")
        .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(name)), F.lit("]")).alias("value"))
    )
    if envelope:
        before, after = envelope.split("%s")
        pages = pages.withColumn("value", F.concat(F.lit(before), "value", F.lit(after)))
    pages.write.partitionBy("page").text(path)
    return path


ENVELOPE = '{"Header": [{"status": "Success"}], "Data": %s}'


def as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def mutation_json(calls: DataFrame) -> DataFrame:
    """Most genes as objects, those called TTN as plain text."""
    rest = ["sampleId", "patientId", "proteinChange", "mutationType"]
    gene = F.struct(F.col("gene").alias("hugoGeneSymbol"), F.length("gene").alias("entrezGeneId")).alias("gene")
    text = F.when(F.col("gene") == "TTN", F.to_json(F.struct(*rest, "gene"))).otherwise(F.to_json(F.struct(*rest, gene)))
    return calls.select(text.alias("json"))
