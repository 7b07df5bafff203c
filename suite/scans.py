"""Queries over sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortloom.operators.guards import guard_min_groups, guard_not_empty
from cohortloom.operators.split import assign_split
from cohortloom.runtime import scratch_path
from cohortloom.sources import delimited, records
from cohortloom.sources.layers import layer_path, overwrite_table, scan_layer, write_bronze_slice, write_split
from suite import frames
from suite.registry import query, table


@query("scan_layer", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def scan_layer_(spark, sf):
    return scan_layer(spark, f"{sf}/customer.parquet")


@query("scan_json_records", "select conv_id, turn, role, text from conversations")
def scan_json_records(spark, sf):
    path = frames.land_json_pages(frames.as_json(table(spark, sf, "conversations")), "conversations")
    return records.scan_json_records(spark, path, "conv_id long, turn long, role string, text string")


@query("scan_json_envelope", "select event_id, user_id, event_type, value from events")
def scan_json_envelope(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    path = frames.land_json_pages(frames.as_json(events), "envelope", frames.ENVELOPE)
    return records.scan_json_envelope(
        spark, path, "event_id long, user_id long, event_type string, value double"
    )


def _with_charges(spark, sf):
    """Line items with their charges as a list that may be empty."""
    charges = F.array(
        F.struct(F.lit("discount").alias("kind"), F.col("l_discount").alias("rate")),
        F.struct(F.lit("tax").alias("kind"), F.col("l_tax").alias("rate")),
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.filter(charges, lambda c: c["rate"] > 0).alias("charges"),
    )


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(
    "json_explode_nested",
    f"""
    select {_LINE}, 'discount' as charge_kind, l_discount as charge_rate from lineitem where l_discount > 0
    union all
    select {_LINE}, 'tax', l_tax from lineitem where l_tax > 0
    """,
)
def json_explode_nested(spark, sf):
    return records.json_explode_nested(_with_charges(spark, sf), "charges", _LINE.split(", "), prefix="charge_")


@query(
    "json_first_element",
    f"""
    select {_LINE}, case when l_discount > 0 then 'discount' when l_tax > 0 then 'tax' end as first_kind,
           case when l_discount > 0 then l_discount when l_tax > 0 then l_tax end as first_rate
    from lineitem
    """,
)
def json_first_element(spark, sf):
    return _with_charges(spark, sf).select(
        *_LINE.split(", "),
        records.json_first_element("charges", "kind").alias("first_kind"),
        records.json_first_element("charges", "rate").alias("first_rate"),
    )


@query(
    "struct_field_or_self",
    """
    select event_id, case when event_type = 'error' then 'plain-' || event_id
                          else regexp_extract(props, '([0-9]+)', 1) end as k
    from events
    """,
)
def struct_field_or_self(spark, sf):
    plain = F.concat(F.lit("plain-"), "event_id")
    mixed = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", plain).otherwise(F.col("props")).alias("props")
    )
    return mixed.select("event_id", records.struct_field_or_self("props", "k").alias("k"))


def landed_mutations(spark, sf) -> str:
    return frames.land_json_pages(frames.mutation_json(frames.mutation_calls(spark, sf)), "mutations")


@query("scan_mutation_records", frames.MUTATIONS_SQL)
def scan_mutation_records(spark, sf):
    return records.scan_mutation_records(spark, landed_mutations(spark, sf))


def landed_clinical(spark, sf) -> tuple[str, str]:
    return (
        frames.land_json_pages(frames.as_json(frames.sample_attributes(spark, sf)), "samples"),
        frames.land_json_pages(frames.as_json(frames.patient_attributes(spark, sf)), "patients"),
    )


@query("scan_eav_clinical", frames.EAV_SQL)
def scan_eav_clinical(spark, sf):
    return records.scan_eav_clinical(spark, *landed_clinical(spark, sf))


def scanned_counts(spark, sf):
    return delimited.scan_count_tsv(spark, frames.land_count_files(spark, sf), file_id=frames.COUNT_FILE_ID)


@query("scan_count_tsv", frames.COUNT_SQL)
def scan_count_tsv(spark, sf):
    return scanned_counts(spark, sf)


@query(
    "scan_beta_tsv",
    """
    select 'cg' || p_partkey as probe_id, case when p_size % 10 = 0 then null else p_retailprice end as beta_value
    from part
    """,
)
def scan_beta_tsv(spark, sf):
    beta = F.when(F.col("p_size") % 10 == 0, "NA").otherwise(F.col("p_retailprice").cast("string"))
    lines = table(spark, sf, "part").select(
        F.concat_ws("\t", F.concat(F.lit("cg"), "p_partkey"), beta).alias("value")
    )
    path = scratch_path(spark, "beta")
    spark.createDataFrame([("# probes of the suite",)], "value string").unionByName(lines).write.text(path)
    return delimited.scan_beta_tsv(spark, path).select("probe_id", "beta_value")


@query(
    "tag_file_lineage",
    f"""
    with counts as ({frames.COUNT_SQL}), listing as ({frames.LISTING_SQL})
    select file_id, gene_id, unstranded, case_id, submitter_id, file_name from counts join listing using (file_id)
    """,
)
def tag_file_lineage(spark, sf):
    listing = records.json_explode_nested(
        frames.file_listing(spark, sf), "cases", ["file_id", "file_name"], prefix=""
    )
    tagged = delimited.tag_file_lineage(scanned_counts(spark, sf), listing, ["case_id", "submitter_id", "file_name"])
    return tagged.select("file_id", "gene_id", "unstranded", "case_id", "submitter_id", "file_name")


@query("limit_files", f"select file_id, file_name from (select distinct file_id, file_name from ({frames.LISTING_SQL}) as l) as f order by file_id limit 5")
def limit_files(spark, sf):
    return delimited.limit_files(frames.file_listing(spark, sf).select("file_id", "file_name"), 5)


@query("guard_min_groups", f'select file_id, count(*) as "rows" from ({frames.COUNT_SQL}) as c group by 1')
def guard_min_groups_(spark, sf):
    counts = scanned_counts(spark, sf)
    return guard_min_groups(counts, "file_id", 5).groupBy("file_id").agg(F.count(F.lit(1)).alias("rows"))


@query("guard_not_empty", "select o_orderkey, o_orderstatus from orders")
def guard_not_empty_(spark, sf):
    return guard_not_empty(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"))


@query("scan_fixed_width", frames.REGISTRY_SQL)
def scan_fixed_width(spark, sf):
    return delimited.scan_fixed_width(spark, frames.land_registry_extract(spark, sf))


@query(
    "file_metadata_filter",
    """
    select 'f' || o_orderkey as file_id, o_orderstatus as project_id, o_orderpriority as data_category
    from orders
    where o_orderstatus = 'F' and o_orderpriority = '2-HIGH' and o_orderkey % 3 <> 2 and o_totalprice < 400000
    """,
)
def file_metadata_filter(spark, sf):
    key = F.col("o_orderkey")
    listing = table(spark, sf, "orders").select(
        F.concat(F.lit("f"), key).alias("file_id"),
        F.col("o_orderstatus").alias("project_id"),
        F.col("o_orderpriority").alias("data_category"),
        F.when(key % 3 == 0, "tsv").when(key % 3 == 1, "TSV").otherwise("bam").alias("data_format"),
        F.when(F.col("o_totalprice") < 400000, "open").otherwise("controlled").alias("access"),
    )
    chosen = delimited.file_metadata_filter(listing, "F", "2-HIGH", "Tsv", size=None)
    return chosen.select("file_id", "project_id", "data_category")


@query(
    "date_lookback_range",
    """
    select o_orderkey, o_orderstatus, o_orderpriority from orders
    where o_orderdate >= timestamp '1998-05-31' and o_orderdate < timestamp '1998-07-01'
      and ((o_orderstatus = 'F' and o_orderpriority = '2-HIGH') or (o_orderstatus = 'O' and o_orderpriority = '1-URGENT'))
    """,
)
def date_lookback_range(spark, sf):
    places = spark.createDataFrame([("F", "2-HIGH"), ("O", "1-URGENT")], "o_orderstatus string, o_orderpriority string")
    recent = delimited.date_lookback_range(
        table(spark, sf, "orders"), "o_orderdate", dt.date(1998, 6, 30), 30, places, places.columns
    )
    return recent.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "write_bronze_slice",
    """
    select event_id, value, '2024-01-01' as ingestion_date from events where event_type <> 'click'
    union all
    select event_id, value, '2024-01-02' from events
    """,
)
def write_bronze_slice_(spark, sf):
    events = table(spark, sf, "events")
    path = layer_path(scratch_path(spark, "lake"), "bronze", "events")
    write_bronze_slice(events.filter("event_type = 'click'"), path, "2024-01-01")
    write_bronze_slice(events, path, "2024-01-02")
    write_bronze_slice(events.filter("event_type <> 'click'"), path, "2024-01-01")
    return scan_layer(spark, path).select("event_id", "value", "ingestion_date")


@query("overwrite_table", "select c_custkey, c_mktsegment, c_acctbal * 2 as doubled from customer")
def overwrite_table_(spark, sf):
    path = layer_path(scratch_path(spark, "lake"), "silver", "replaced")
    overwrite_table(table(spark, sf, "nation"), path)
    customer = table(spark, sf, "customer")
    overwrite_table(
        customer.select("c_custkey", "c_mktsegment", (F.col("c_acctbal") * 2).alias("doubled")), path, ["c_mktsegment"]
    )
    return scan_layer(spark, path)


SPLIT_SQL = """
    select c_custkey, c_mktsegment,
           case when row_number() over (partition by c_mktsegment order by md5(c_custkey || '|42'))
                     <= round(0.2 * count(*) over (partition by c_mktsegment)) then 'test' else 'train' end as split
    from customer
"""


@query("write_split", f"select c_custkey, split from ({SPLIT_SQL}) as s")
def write_split_(spark, sf):
    split = assign_split(table(spark, sf, "customer"), "c_custkey", "c_mktsegment")
    path = write_split(split, scratch_path(spark, "split"))
    return spark.read.parquet(path).select("c_custkey", "split")


@query("patient_level_split", SPLIT_SQL)
def patient_level_split(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return assign_split(customer, "c_custkey", "c_mktsegment")
