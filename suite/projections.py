"""Queries over column-wise operators, guards and contracts."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortloom.functions import columns, deident, encode
from cohortloom.operators import contracts, inspect, linkage
from cohortloom.runtime import materialize
from suite import frames
from suite.registry import query, table


@query("select_keep", "select c_custkey, c_mktsegment from customer")
def select_keep(spark, sf):
    return columns.select_keep(table(spark, sf, "customer"), ["c_custkey", "c_mktsegment"])


@query(
    "drop_direct_identifiers",
    "select c_custkey, c_mktsegment from customer",
)
def drop_direct_identifiers(spark, sf):
    personal = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", F.col("c_name").alias("patient_name"),
        F.concat(F.lit("mrn"), "c_custkey").alias("mrn"), F.lit("10.0.0.1").alias("ip_address"),
    )
    return deident.drop_direct_identifiers(personal)


@query("rename_column", "select c_custkey, c_nationkey as county_code from customer")
def rename_column(spark, sf):
    return columns.rename_column(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", "county_code")


@query(
    "sanitize_columns",
    'select c_custkey as c_key, c_name as "AC011503_1", c_nationkey as "HLA_DRB1", c_acctbal as "HLA_DRB1_2" from customer',
)
def sanitize_columns(spark, sf):
    named = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("c-key"), F.col("c_name").alias("AC011503.1"),
        F.col("c_nationkey").alias("HLA-DRB1"), F.col("c_acctbal").alias("HLA.DRB1"),
    )
    return columns.sanitize_columns(named)


@query(
    "cast_columns",
    """
    select c_custkey, case when c_custkey % 7 = 0 then null else c_acctbal end as balance,
           case when c_custkey % 5 = 0 then null else cast(c_custkey as double) end as number,
           cast(c_nationkey as varchar) as nation
    from customer
    """,
)
def cast_columns(spark, sf):
    key = F.col("c_custkey")
    texts = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(key % 7 == 0, "[Not Available]").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(key % 5 == 0, "12 years").otherwise(F.concat(F.lit(" "), key.cast("string"))).alias("number"),
        F.col("c_nationkey").alias("nation"),
    )
    cast = columns.cast_columns(texts, {"balance": "double", "number": "int", "nation": "string"})
    return cast.withColumn("number", F.col("number").cast("double"))


def with_gaps(spark, sf):
    """Customers without negative balances and without the name of one segment."""
    return table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )


GAPS_SQL = """
    select c_custkey, c_nationkey, case when c_acctbal >= 0 then c_acctbal end as balance,
           case when c_mktsegment <> 'BUILDING' then c_mktsegment end as segment
    from customer
"""


@query(
    "add_missing_indicators",
    f"select *, balance is null as balance_was_missing, segment is null as segment_was_missing from ({GAPS_SQL}) as g",
)
def add_missing_indicators(spark, sf):
    return columns.add_missing_indicators(with_gaps(spark, sf), ["balance", "segment"])


@query(
    "fill_categorical_unknown",
    f"select c_custkey, coalesce(segment, 'Unknown') as segment from ({GAPS_SQL}) as g",
)
def fill_categorical_unknown(spark, sf):
    return columns.fill_categorical_unknown(with_gaps(spark, sf).select("c_custkey", "segment"), ["segment"])


@query(
    "flag_genomic_not_tested",
    f"select c_custkey, coalesce(segment, 'not_tested') as segment from ({GAPS_SQL}) as g",
)
def flag_genomic_not_tested(spark, sf):
    return columns.flag_genomic_not_tested(with_gaps(spark, sf).select("c_custkey", "segment"), "segment")


@query("fill_zero", f"select c_custkey, coalesce(balance, 0) as balance, segment from ({GAPS_SQL}) as g")
def fill_zero(spark, sf):
    return columns.fill_zero(with_gaps(spark, sf).select("c_custkey", "balance", "segment"), ["balance"])


@query(
    "filter_not_null",
    f"select c_custkey, balance, segment from ({GAPS_SQL}) as g where balance is not null and segment is not null",
)
def filter_not_null(spark, sf):
    return columns.filter_not_null(with_gaps(spark, sf).select("c_custkey", "balance", "segment"), ["balance", "segment"])


STATUS_SQL = "case o_orderstatus when 'F' then '1:DECEASED' when 'O' then '0:LIVING' end"


@query("derive_event", f"select o_orderkey, case when {STATUS_SQL} like '1%' then 1 else 0 end as event from orders")
def derive_event(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "1:DECEASED").when(F.col("o_orderstatus") == "O", "0:LIVING")
    orders = table(spark, sf, "orders").select("o_orderkey", status.alias("OS_STATUS"))
    return columns.derive_event(orders, "OS_STATUS").select("o_orderkey", "event")


# --- contracts


def pm25_like(spark, sf):
    segment = F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        F.when(segment != "BUILDING", segment).alias("state_code"),
        F.col("c_nationkey").cast("string").alias("county_code"),
        F.lit("2024-01-01").alias("date_local"),
        F.col("c_acctbal").alias("arithmetic_mean"),
    )


def registry_like(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") > 0, key.cast("string")).alias("patient_id_number"),
        frames.pick(["1", "2", "9"], key % 3).alias("sex"),
        (key % 110).cast("int").alias("age_at_diagnosis"),
        F.when(key % 4 > 0, frames.pick(["0", "1", "2", "4"], key % 4)).alias("vital_status"),
    )


def _report_sql(lines: list[tuple[str, str, str]]) -> str:
    return " union all ".join(
        f'''select '{c}' as "column", '{k}' as "check", cast({n} as bigint) as failures, count(*) as "rows" from customer'''
        for c, k, n in lines
    )


_PM25_STATIC = [(c, k, "0") for c in ("state_code", "county_code", "date_local", "arithmetic_mean") for k in ("exists", "type")]
_PM25_NULL = [
    ("state_code", "not_null", "count(*) filter (c_mktsegment = 'BUILDING')"),
    ("county_code", "not_null", "0"),
    ("date_local", "not_null", "0"),
]
_PM25_GE = [("arithmetic_mean", "ge", "count(*) filter (c_acctbal < 0)")]
_REGISTRY_COLUMNS = [
    (c, k, "1" if (c, k) == ("age_at_diagnosis", "type") else "0")
    for c in ("patient_id_number", "sex", "age_at_diagnosis", "vital_status")
    for k in ("exists", "type")
]
_REGISTRY_ISIN = [
    ("sex", "isin", "count(*) filter (c_custkey % 3 = 2)"),
    ("vital_status", "isin", "count(*) filter (c_custkey % 4 = 2)"),
]


@query("contract_columns", _report_sql(_REGISTRY_COLUMNS))
def contract_columns(spark, sf):
    return contracts.contract_columns(registry_like(spark, sf), contracts.REGISTRY)


@query("contract_not_null", _report_sql(_PM25_NULL))
def contract_not_null(spark, sf):
    return contracts.contract_not_null(pm25_like(spark, sf), contracts.PM25)


@query("contract_check_ge", _report_sql(_PM25_GE))
def contract_check_ge(spark, sf):
    return contracts.contract_check_ge(pm25_like(spark, sf), contracts.PM25)


@query("contract_check_isin", _report_sql(_REGISTRY_ISIN))
def contract_check_isin(spark, sf):
    return contracts.contract_check_isin(registry_like(spark, sf), contracts.REGISTRY)


@query("validate", _report_sql(_PM25_STATIC + _PM25_NULL + _PM25_GE))
def validate(spark, sf):
    return contracts.validate(pm25_like(spark, sf), contracts.PM25, raise_on_fail=False)


@query(
    "quarantine",
    """
    select case when c_mktsegment <> 'BUILDING' then c_mktsegment end as state_code, cast(c_nationkey as varchar) as county_code,
           '2024-01-01' as date_local, c_acctbal as arithmetic_mean,
           not (c_mktsegment = 'BUILDING' or c_acctbal < 0) as passed
    from customer
    """,
)
def quarantine(spark, sf):
    good, bad = contracts.quarantine(pm25_like(spark, sf), contracts.PM25)
    return good.withColumn("passed", F.lit(True)).unionByName(bad.withColumn("passed", F.lit(False)))


@query("sample_rows", "select least(count(*), 50) as rows, true as distinct_rows, true as from_the_table from orders")
def sample_rows(spark, sf):
    """The sample's size is its feature: so many rows, each another one of the table."""
    orders = table(spark, sf, "orders")
    sample = materialize(inspect.sample_rows(orders, 50), "sample")
    held = sample.join(orders, orders.columns, "left_semi").agg(F.count(F.lit(1)).alias("held"), F.count_distinct("o_orderkey").alias("keys"))
    counted = sample.agg(F.count(F.lit(1)).alias("rows")).join(held)
    return counted.select("rows", (F.col("keys") == F.col("rows")).alias("distinct_rows"), (F.col("held") == F.col("rows")).alias("from_the_table"))


# --- de-identification


@query(
    "pseudonymize_patient_id",
    f"select sha256(c_custkey || '{frames.SALT}') as patient_key, c_mktsegment from customer",
)
def pseudonymize_patient_id(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return deident.pseudonymize_patient_id(customer, "c_custkey", frames.SALT)


@query(
    "shift_dates",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, true as one_offset, true as in_range,
           cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as bigint) as gap
    from lineitem join orders on l_orderkey = o_orderkey
    """,
)
def shift_dates(spark, sf):
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    dated = lines.withColumns({"was_ordered": F.to_date("o_orderdate"), "was_shipped": F.to_date("l_shipdate")})
    moved = deident.shift_dates(dated, ["o_orderdate", "l_shipdate"], "o_custkey")
    by_order = F.datediff("o_orderdate", "was_ordered")
    return moved.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        (by_order == F.datediff("l_shipdate", "was_shipped")).alias("one_offset"),
        by_order.between(-365, 364).alias("in_range"),
        F.datediff("l_shipdate", "o_orderdate").cast("long").alias("gap"),
    )


_ZIP = "lpad(cast(c_custkey * 37 % 100000 as varchar), 5, '0')"
_RESTRICTED = "('036','059','063','102','203','556','692','790','821','823','830','831','878','879','884','890','893')"


@query(
    "generalize_zip_to_safe_harbor",
    f"""
    select c_custkey, case when substr({_ZIP}, 1, 3) in {_RESTRICTED} then '000' else substr({_ZIP}, 1, 3) end as zip_code
    from customer
    """,
)
def generalize_zip_to_safe_harbor(spark, sf):
    zips = table(spark, sf, "customer").select(
        "c_custkey", F.lpad((F.col("c_custkey") * 37 % 100000).cast("string"), 5, "0").alias("zip_code")
    )
    return deident.generalize_zip_to_safe_harbor(zips, "zip_code")


@query(
    "truncate_age_over_90",
    "select c_custkey, case when c_custkey % 110 > 89 then 90 else c_custkey % 110 end as age from customer",
)
def truncate_age_over_90(spark, sf):
    ages = table(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") % 110).alias("age"))
    return deident.truncate_age_over_90(ages, "age")


# --- linkage


def _source(spark, sf, name: str):
    letter = name[0]
    key = F.col(f"{letter}_{'custkey' if name == 'customer' else 'suppkey'}")
    return table(spark, sf, name).select(
        F.concat(F.lit(letter), key).alias("_source_patient_id"),
        frames.pick(["M", "F", None], key % 3).alias("sex"),
        (1940 + key % 60).cast("int").alias("birth_year"),
        F.lpad((key * 37 % 100000).cast("string"), 5, "0").alias("zip"),
    )


def _source_sql(name: str) -> str:
    key = {"customer": "c_custkey", "supplier": "s_suppkey"}[name]
    sex = f"case {key} % 3 when 0 then 'M' when 1 then 'F' end"
    return f"""
        select '{name}' as _source_name, '{name[0]}' || {key} as _source_patient_id,
               coalesce({sex} || '|', '') || (1940 + {key} % 60) || '|'
                   || substr(lpad(cast({key} * 37 % 100000 as varchar), 5, '0'), 1, 3) as _blocking_key
        from {name}
    """


@query("build_blocking_key", f"select _source_patient_id, _blocking_key from ({_source_sql('customer')}) as c")
def build_blocking_key(spark, sf):
    keyed = linkage.build_blocking_key(_source(spark, sf, "customer"), "sex", "birth_year", "zip")
    return keyed.select("_source_patient_id", "_blocking_key")


@query(
    "assign_master_patient_id",
    f"""
    select *, sha256(_blocking_key || '{frames.SALT}') as master_patient_id
    from ({_source_sql('customer')} union all {_source_sql('supplier')}) as s
    """,
)
def assign_master_patient_id(spark, sf):
    sources = [
        (linkage.build_blocking_key(_source(spark, sf, n), "sex", "birth_year", "zip"), n) for n in ("customer", "supplier")
    ]
    return linkage.assign_master_patient_id(*sources, salt=frames.SALT)


# orders of a customer share its number, orders of one day and clerk a second key; every third lacks that
_LINKED_SQL = """
    select 'orders' as _source_name, cast(o_orderkey as varchar) as id,
           case when o_orderkey % 5 <> 0 then cast(o_custkey as varchar) || '/' || cast(o_orderkey % 200 as varchar) end as k0,
           case when o_orderkey % 3 <> 0 then cast(cast(floor(o_totalprice / 20) as bigint) as varchar) end as k1 from orders
    union all
    select 'customer', cast(c_custkey as varchar), cast(c_custkey as varchar) || '/7', null from customer
"""


@query(
    "link_by_any_key",
    f"""
    with recursive records as ({_LINKED_SQL}),
    held as (
        select _source_name || '/' || id as record, 'key000' || chr(31) || k0 as k from records where k0 is not null
        union all
        select _source_name || '/' || id, 'key001' || chr(31) || k1 from records where k1 is not null),
    pairs as (select distinct a.k as a, b.k as b from held as a join held as b using (record)),
    reached as (select distinct k as node, k as root from held union select p.b, r.root from reached as r join pairs as p on p.a = r.node),
    least as (select node, min(root) as root from reached group by node)
    select _source_name, id as _source_patient_id,
           sha256(coalesce((select min(root) from held join least on node = k where record = _source_name || '/' || id),
                           'record' || chr(31) || _source_name || chr(31) || id) || '{frames.SALT}') as master_patient_id
    from records
    """,
)
def link_by_any_key(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("_source_patient_id"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat_ws("/", "o_custkey", F.col("o_orderkey") % 200)).alias("k0"),
        F.when(F.col("o_orderkey") % 3 != 0, F.floor(F.col("o_totalprice") / 20).cast("string")).alias("k1"),
    )
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("_source_patient_id"),
        F.concat(F.col("c_custkey"), F.lit("/7")).alias("k0"),
        F.lit(None).cast("string").alias("k1"),
    )
    return linkage.link_by_any_key((orders, "orders"), (customers, "customer"), keys=["k0", "k1"], salt=frames.SALT)


# --- encoders

_RANKS = "map(['0','I','IA','IB','II','IIA','IIB','III','IIIA','IIIB','IIIC','IV'], [0,1,2,3,4,5,6,7,8,9,10,11])"


@query(
    "encode_tnm_stage_ordinal",
    f"""
    with staged as (select p_partkey, case when p_size % 15 = 14 then null
                           else ({frames.sql_list(frames.STAGES)})[p_size % 15 + 1] end as stage from part)
    select p_partkey, stage, cast({_RANKS}[upper(trim(regexp_replace(stage, '^\\s*[Ss][Tt][Aa][Gg][Ee]\\s+', '')))] as double)
           as stage_rank
    from staged
    """,
)
def encode_tnm_stage_ordinal(spark, sf):
    staged = table(spark, sf, "part").select("p_partkey", frames.pick(frames.STAGES, F.col("p_size") % 15).alias("stage"))
    return encode.encode_tnm_stage_ordinal(staged, "stage").withColumn("stage_rank", F.col("stage_rank").cast("double"))


@query(
    "encode_icd10_category",
    """
    with coded as (select p_partkey, case when p_size % 10 = 0 then null
                          else 'C' || lpad(cast(p_size % 13 as varchar), 2, '0') || '.' || p_size end as icd from part),
         ranked as (select substr(icd, 1, 3) as category, row_number() over (order by count(*) desc, substr(icd, 1, 3)) - 1 as i
                    from coded where icd is not null group by 1)
    select p_partkey, icd, substr(icd, 1, 3) as icd_category,
           cast(coalesce(i, (select count(*) from ranked)) as double) as icd_category_idx,
           cast(coalesce(i + 1, 0) as bigint) as hot_position, (select count(*) from ranked) as vector_size
    from coded left join ranked on substr(icd, 1, 3) = category
    """,
)
def encode_icd10_category(spark, sf):
    size = F.col("p_size")
    code = F.concat(F.lit("C"), F.lpad((size % 13).cast("string"), 2, "0"), F.lit("."), size.cast("string"))
    coded = table(spark, sf, "part").select("p_partkey", F.when(size % 10 != 0, code).alias("icd"))
    hot = vector_to_array("icd_category_vec")
    return encode.encode_icd10_category(coded, "icd").select(
        "p_partkey", "icd", "icd_category", "icd_category_idx",
        F.array_position(hot, F.lit(1.0)).alias("hot_position"), F.size(hot).cast("long").alias("vector_size"),
    )


@query(
    "encode_days_since_treatment",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as bigint) as days
    from lineitem join orders on l_orderkey = o_orderkey
    """,
)
def encode_days_since_treatment(spark, sf):
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return encode.encode_days_since_treatment(lines, "o_orderdate", "l_shipdate", "days").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("days").cast("long").alias("days")
    )


@query("substring_year", "select o_orderkey, strftime(o_orderdate, '%Y') as year from orders")
def substring_year(spark, sf):
    dated = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    return dated.select("o_orderkey", encode.substring_year("d").alias("year"))
