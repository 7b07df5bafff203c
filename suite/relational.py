"""Queries over joins, aggregates, windows and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom import defaults
from cohortloom.operators import genomic, joins, missing, ordered, outliers, quantiles, reshape, slice_quantiles
from cohortloom.operators import inspect as inspection
from cohortloom.operators.fuse import bucket_modalities, fuse_bucketed, fuse_modalities
from cohortloom.runtime import scratch_path
from cohortloom.sources.lookups import gene_pathways
from suite import frames
from suite.projections import GAPS_SQL, with_gaps
from suite.registry import query, table

# --- joins


@query(
    "join_broadcast_attributes",
    """
    select o_custkey as patient, o_orderkey as sample, c_mktsegment, c_acctbal
    from (select distinct o_custkey, o_orderkey from orders) as s join customer on o_custkey = c_custkey
    """,
)
def join_broadcast_attributes(spark, sf):
    samples = table(spark, sf, "orders").select(F.col("o_custkey").alias("patient"), F.col("o_orderkey").alias("sample"))
    patients = table(spark, sf, "customer").select(F.col("c_custkey").alias("patient"), "c_mktsegment", "c_acctbal")
    return joins.join_broadcast_attributes(samples, patients, "patient", "sample")


PRIORITY_GROUPS = [("1-URGENT", "fast"), ("2-HIGH", "fast"), ("5-LOW", "slow")]
PRIORITY_SQL = """
    case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'fast' when o_orderpriority = '5-LOW' then 'slow'
         else 'unmapped' end
"""


@query("join_left_lookup", f"select o_orderkey, o_orderpriority, {PRIORITY_SQL} as pathway from orders")
def join_left_lookup(spark, sf):
    lookup = spark.createDataFrame(PRIORITY_GROUPS, "o_orderpriority string, pathway string")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return joins.join_left_lookup(orders, lookup, "o_orderpriority", "pathway", "unmapped")


def order_readings(spark, sf):
    """Order totals as readings of the customer's nation."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").cast("string").alias("county_code"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_local"),
        F.col("o_totalprice").alias("arithmetic_mean"),
    )


_YEARLY = """
    select cast(c_nationkey as varchar) as county_code, strftime(o_orderdate, '%Y') as year,
           avg(o_totalprice) as pm25_annual_mean
    from orders join customer on o_custkey = c_custkey group by 1, 2
"""


@query(
    "join_left_composite",
    f"""
    select c.c_custkey, c.county_code, c.year, round(pm25_annual_mean, 6) as pm25_annual_mean
    from (select c_custkey, cast(c_nationkey as varchar) as county_code, '199' || (c_custkey % 9) as year from customer) as c
    left join ({_YEARLY}) as y on c.county_code = y.county_code and c.year = y.year
    """,
)
def join_left_composite(spark, sf):
    people = table(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_nationkey").cast("string").alias("county_code"),
        F.concat(F.lit("199"), F.col("c_custkey") % 9).alias("year"),
    )
    exposure = joins.county_exposure(order_readings(spark, sf))
    joined = joins.with_county_exposure(people, exposure)
    return joined.withColumn("pm25_annual_mean", F.round("pm25_annual_mean", 6))


def _modalities(spark, sf):
    spending = (
        table(spark, sf, "orders")
        .filter("o_orderstatus = 'F' and o_totalprice > 300000")
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("largest"))
    )
    account = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"), "c_acctbal")
    activity = (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("peak"))
    )
    return spending, account, activity


_SPENDING = """
    (select o_custkey as id, count(*) as n, max(o_totalprice) as largest, true as has from orders
     where o_orderstatus = 'F' and o_totalprice > 300000 group by 1)
"""
_ACCOUNT = "(select c_custkey as id, c_acctbal, true as has from customer where c_acctbal > 0)"
_ACTIVITY = "(select user_id as id, count(*) as n, max(value) as peak, true as has from events group by 1)"


@query(
    "join_full_outer_nway",
    f"""
    select id, c_acctbal, peak, coalesce(a.has, false) as has_account_data, coalesce(v.has, false) as has_activity_data
    from {_ACCOUNT} as a full outer join {_ACTIVITY} as v using (id)
    """,
)
def join_full_outer_nway(spark, sf):
    _, account, activity = _modalities(spark, sf)
    return fuse_modalities({"account": account, "activity": activity.select("id", "peak")}, "id")


@query(
    "fuse_modalities",
    f"""
    select id, cast(s.n as double) as spending_n, largest, c_acctbal, cast(v.n as double) as activity_n, peak, coalesce(s.has, false) as has_spending_data,
           coalesce(a.has, false) as has_account_data, coalesce(v.has, false) as has_activity_data
    from {_SPENDING} as s full outer join {_ACCOUNT} as a using (id) full outer join {_ACTIVITY} as v using (id)
    """,
)
def fuse(spark, sf):
    fused = fuse_modalities(dict(zip(("spending", "account", "activity"), _modalities(spark, sf))), "id")
    return fused.withColumns({c: F.col(c).cast("double") for c in ("spending_n", "activity_n")})


@query(
    "fuse_bucketed",
    f"""
    select id, cast(s.n as double) as spending_n, largest, c_acctbal, cast(v.n as double) as activity_n, peak, coalesce(s.has, false) as has_spending_data,
           coalesce(a.has, false) as has_account_data, coalesce(v.has, false) as has_activity_data
    from {_SPENDING} as s full outer join {_ACCOUNT} as a using (id) full outer join {_ACTIVITY} as v using (id)
    """,
)
def fuse_bucketed_(spark, sf):
    blocks = bucket_modalities(dict(zip(("spending", "account", "activity"), _modalities(spark, sf))), "id")
    fused = fuse_bucketed(blocks, "id")
    return fused.withColumns({c: F.col(c).cast("double") for c in ("spending_n", "activity_n")})


@query(
    "semi_join_isin",
    """
    select c_custkey, c_mktsegment from customer
    where c_custkey in (select o_custkey from orders where o_totalprice > 400000)
    """,
)
def semi_join_isin(spark, sf):
    big = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi_join_isin(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), big, "c_custkey")


def _keyed(spark, sf):
    return {
        "customers": table(spark, sf, "customer").select(F.col("c_custkey").alias("k")),
        "orders": table(spark, sf, "orders").select(F.col("o_custkey").alias("k")),
        "events": table(spark, sf, "events").select(F.col("user_id").alias("k")),
    }


@query(
    "key_overlap",
    """
    with c as (select distinct c_custkey as k from customer), o as (select distinct o_custkey as k from orders),
         e as (select distinct user_id as k from events)
    select 'rows:customers' as measure, count(*) as n from customer union all
    select 'rows:orders', count(*) from orders union all
    select 'rows:events', count(*) from events union all
    select 'keys:customers', count(*) from c union all
    select 'keys:orders', count(*) from o union all
    select 'keys:events', count(*) from e union all
    select 'overlap:customers&orders', count(*) from c join o using (k) union all
    select 'overlap:customers&events', count(*) from c join e using (k) union all
    select 'overlap:orders&events', count(*) from o join e using (k) union all
    select 'overlap:customers&orders&events', count(*) from c join o using (k) join e using (k)
    """,
)
def key_overlap(spark, sf):
    return joins.key_overlap(_keyed(spark, sf), "k")


@query("intersect_keys", "select user_id as k from events intersect select o_custkey from orders")
def intersect_keys(spark, sf):
    keyed = _keyed(spark, sf)
    return joins.intersect_keys(keyed["events"], keyed["orders"])


# --- aggregates


@query(
    "pivot_long_to_wide",
    """
    select user_id, arg_min(value, (ts, event_id)) filter (event_type = 'click') as click,
           arg_min(value, (ts, event_id)) filter (event_type = 'error') as error,
           arg_min(value, (ts, event_id)) filter (event_type = 'purchase') as purchase,
           arg_min(value, (ts, event_id)) filter (event_type = 'signup') as signup,
           arg_min(value, (ts, event_id)) filter (event_type = 'view') as view
    from events group by 1
    """,
)
def pivot_long_to_wide(spark, sf):
    return reshape.pivot_long_to_wide(
        table(spark, sf, "events"), ["user_id"], "event_type", "value",
        ["click", "error", "purchase", "signup", "view"], ["ts", "event_id"],
    )


_PATHWAY_OF = " ".join(f"when '{g}' then '{p}'" for g, p in defaults.GENE_PATHWAYS)
BURDEN_COLUMNS_SQL = ", ".join(f"count(*) filter (pathway = '{p}') as {p}" for p in defaults.PATHWAY_FEATURES)


@query(
    "mutation_burden",
    f"""
    select "patientId", {BURDEN_COLUMNS_SQL}
    from (select "patientId", case gene {_PATHWAY_OF} else 'unmapped' end as pathway from ({frames.MUTATIONS_SQL}) as m) as p
    group by 1
    """,
)
def mutation_burden(spark, sf):
    return genomic.aggregate_mutation_burden(
        frames.mutation_calls(spark, sf), gene_pathways(spark), "patientId", defaults.PATHWAY_FEATURES
    )


@query(
    "group_avg_by_year",
    """
    select o_orderstatus, strftime(o_orderdate, '%Y') as year, round(avg(o_totalprice), 6) as mean
    from orders group by 1, 2
    """,
)
def group_avg_by_year(spark, sf):
    orders = table(spark, sf, "orders").withColumn("date_local", F.date_format("o_orderdate", "yyyy-MM-dd"))
    yearly = joins.county_exposure(orders, "o_orderstatus", "date_local", "o_totalprice", "mean")
    return yearly.withColumn("mean", F.round("mean", 6))


_VARIANCES = """
    select l_partkey, var_samp(l_extendedprice) as variance from lineitem group by 1
    order by variance desc nulls last, l_partkey limit 50
"""


@query(
    "group_variance_rank",
    f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem
    where l_partkey in (select l_partkey from ({_VARIANCES}) as v)
    """,
)
def group_variance_rank(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return genomic.top_variable_genes(lines, "l_partkey", "l_extendedprice", 50)


@query("top_k_by_variance", f"select l_partkey, round(variance, 2) as variance from ({_VARIANCES}) as v")
def top_k_by_variance(spark, sf):
    top = genomic.top_k_by_variance(table(spark, sf, "lineitem"), "l_partkey", "l_extendedprice", 50)
    return top.withColumn("variance", F.round("variance", 2))


@query(
    "quantiles_grouped",
    """
    select event_type, quantile_disc(value, 0.25) as q1, quantile_disc(value, 0.5) as median,
           quantile_disc(value, 0.75) as q3
    from events group by 1
    """,
)
def quantiles_grouped(spark, sf):
    return quantiles.quantiles_grouped(table(spark, sf, "events"), "value", ["event_type"])


@query(
    "quantiles_grouped_approx",
    """
    select event_type, p, true as within
    from (select distinct event_type from events) cross join (values (0.25), (0.5), (0.75)) as v(p)
    """,
)
def quantiles_grouped_approx(spark, sf):
    """The sketch path: the rank of every value it gives lies within the sketch's bound of the wanted one."""
    events = table(spark, sf, "events").select("event_type", "value")
    probs, names = [0.25, 0.5, 0.75], ["q1", "median", "q3"]
    found = quantiles.quantiles_grouped(events, "value", ["event_type"], probs, names, method="approx")
    long = found.select("event_type", F.explode(F.arrays_zip(F.array(*map(F.lit, probs)).alias("p"), F.array(*names).alias("q"))).alias("x"))
    ranks = events.filter("value is not null").join(long, "event_type").groupBy("event_type", "x.p").agg(
        F.avg((F.col("value") < F.col("x.q")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("x.q")).cast("double")).alias("upto")
    )
    bound = 2.0 / quantiles.SKETCH_ACCURACY
    within = (F.col("below") <= F.col("p") + bound) & (F.col("upto") >= F.col("p") - bound)
    return ranks.select("event_type", F.col("p").cast("double").alias("p"), within.alias("within"))


@query(
    "quantiles_of_slices",
    """
    select event_type, quantile_disc(value, 0.25) as q1, quantile_disc(value, 0.5) as median,
           quantile_disc(value, 0.75) as q3
    from events group by 1
    """,
)
def quantiles_of_slices(spark, sf):
    """The same quantiles from what four slices left behind as they came, the first of them twice."""
    path, days = scratch_path(spark, "ranks"), F.pmod(F.dayofyear("ts"), F.lit(4))
    for part in (0, 1, 2, 3, 0):
        some = table(spark, sf, "events").filter(days == part)
        slice_quantiles.write_rank_slice(some, "value", ["event_type"], path, str(part))
    tables = (spark.read.parquet(f"{path}/{name}") for name in ("sketches", "ranks"))
    return slice_quantiles.quantiles_of_slices(*tables, ["event_type"], [0.25, 0.5, 0.75], ["q1", "median", "q3"])


_SKETCH_BOUND = 2.0 / 10_000


@query(
    "cap_iqr_approx",
    "select l_returnflag, count(*) as rows, true as within from lineitem group by 1",
)
def cap_iqr_approx(spark, sf):
    """Caps by sketched fences: every capped value lies between the fences that exact quantiles at the bound's ends give."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("v"), F.col("l_extendedprice").alias("given"))
    capped = outliers.cap_iqr(lines, ["v"], ["l_returnflag"], method="approx")
    ends = [p + side * _SKETCH_BOUND for p in (0.25, 0.75) for side in (-1, 1)]
    exact = quantiles.quantiles_grouped(lines, "given", ["l_returnflag"], ends, ["a0", "a1", "b0", "b1"], method="exact")
    both = capped.join(exact, "l_returnflag")
    low = F.col("a0") - 1.5 * (F.col("b1") - F.col("a0"))
    high = F.col("b1") + 1.5 * (F.col("b1") - F.col("a0"))
    inner_low, inner_high = F.col("a1") - 1.5 * (F.col("b0") - F.col("a1")), F.col("b0") + 1.5 * (F.col("b0") - F.col("a1"))
    # inside the narrowest fences nothing moves, outside the widest nothing stays
    kept = ~F.col("given").between(inner_low, inner_high) | (F.col("v") == F.col("given"))
    fits = kept & F.col("v").between(low - 1e-6, high + 1e-6)
    return both.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"), F.every(fits).alias("within"))


@query(
    "quantiles_global",
    """
    select 'l_extendedprice' as "column", quantile_disc(l_extendedprice, 0.25) as q1,
           quantile_disc(l_extendedprice, 0.5) as median, quantile_disc(l_extendedprice, 0.75) as q3 from lineitem
    union all
    select 'l_quantity', quantile_disc(l_quantity, 0.25), quantile_disc(l_quantity, 0.5), quantile_disc(l_quantity, 0.75)
    from lineitem
    """,
)
def quantiles_global(spark, sf):
    return quantiles.quantiles_global(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])


_MAD = """
    select '{c}' as "column", (select quantile_disc({c}, 0.5) from {t}) as median,
           quantile_disc(abs({c} - (select quantile_disc({c}, 0.5) from {t})), 0.5) as mad from {t}
"""


@query("mad_global", " union all ".join(_MAD.format(c=c, t="lineitem") for c in ("l_extendedprice", "l_quantity")))
def mad_global(spark, sf):
    return quantiles.mad_global(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])


@query("distinct_pairs", "select distinct user_id, event_type from events")
def distinct_pairs(spark, sf):
    return joins.distinct_pairs(table(spark, sf, "events"), ["user_id", "event_type"])


@query(
    "dedupe_by_key",
    """
    select o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey,
           arg_min(o_orderstatus, (o_orderdate, o_orderkey)) as o_orderstatus
    from orders group by 1
    """,
)
def dedupe_by_key(spark, sf):
    return reshape.dedupe_by_key(
        table(spark, sf, "orders"), "o_custkey", ["o_orderkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"]
    )


@query("row_count", 'select count(*) as "rows" from lineitem')
def row_count(spark, sf):
    return inspection.row_count(table(spark, sf, "lineitem"))


def _profile_sql(name: str, columns: dict[str, str], full: bool) -> str:
    extra = """, '{kind}' as "type", count(*) as "rows", count(*) - count({c}) as nulls""" if full else ""
    return " union all ".join(
        f'select \'{c}\' as "column", count(distinct {c}) as distinct_values{extra.format(kind=k, c=c)} from {name}'
        for c, k in columns.items()
    )


_CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}


@query("distinct_count", _profile_sql("lineitem", {"l_partkey": "", "l_suppkey": "", "l_returnflag": ""}, False))
def distinct_count(spark, sf):
    return inspection.distinct_count(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey", "l_returnflag"])


def sketched(spark, sf, name, columns, slices):
    """A table's sketches, written slice by slice; the first slice is written twice."""
    path = scratch_path(spark, "sketches")
    rows = table(spark, sf, name)
    for part in [*range(slices), 0]:
        some = rows.filter(F.pmod(F.xxhash64(columns[0]), F.lit(slices)) == part)
        inspection.write_key_sketches(some, columns, path, str(part))
    return spark.read.parquet(path)


@query(
    "distinct_from_sketches",
    """
    select unnest(['l_partkey', 'l_suppkey', 'l_orderkey']) as column, count(*) as rows,
           unnest([count(distinct l_partkey), count(distinct l_suppkey), count(distinct l_orderkey)]) as distinct_values,
           true as within from lineitem
    """,
)
def distinct_from_sketches(spark, sf):
    """Distinct values from sketches of four slices, each within five standard errors of the exact number."""
    columns = ["l_partkey", "l_suppkey", "l_orderkey"]
    found = inspection.distinct_from_sketches(sketched(spark, sf, "lineitem", columns, 4))
    exact = inspection.distinct_count(table(spark, sf, "lineitem"), columns)
    near = F.abs(F.col("s.distinct_values") - F.col("e.distinct_values")) <= 0.08 * F.col("e.distinct_values")
    both = found.alias("s").join(exact.alias("e"), "column")
    return both.select("column", "rows", F.col("e.distinct_values").alias("distinct_values"), near.alias("within"))


@query(
    "overlap_from_sketches",
    """
    with k as (select distinct l_suppkey * 7 as k from lineitem), o as (select distinct o_custkey as k from orders)
    select (select count(*) from k) as left_keys, (select count(*) from o) as right_keys,
           (select count(*) from k join o using (k)) as both, true as within
    """,
)
def overlap_from_sketches(spark, sf):
    """Keys of two tables, and those of both, from their sketches; each is near the exact number."""
    path = scratch_path(spark, "sketches")
    supplied = table(spark, sf, "lineitem").select((F.col("l_suppkey") * 7).alias("k"))
    ordered = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    left = spark.read.parquet(inspection.write_key_sketches(supplied, ["k"], f"{path}/left", "all"))
    right = spark.read.parquet(inspection.write_key_sketches(ordered, ["k"], f"{path}/right", "all"))
    found = inspection.overlap_from_sketches(left, right, "k", "k")
    one, two = supplied.distinct(), ordered.distinct()
    exact = one.agg(F.count("k").alias("l")).join(two.agg(F.count("k").alias("r"))).join(one.join(two, "k").agg(F.count("k").alias("b")))
    near = (
        (F.abs(F.col("left_keys") - F.col("l")) <= 0.02 * F.col("l"))
        & (F.abs(F.col("right_keys") - F.col("r")) <= 0.02 * F.col("r"))
        & (F.abs(F.col("both") - F.col("b")) <= 0.02 * (F.col("l") + F.col("r")))
    )
    return found.join(exact).select(F.col("l").alias("left_keys"), F.col("r").alias("right_keys"), F.col("b").alias("both"), near.alias("within"))


@query("table_profile", _profile_sql("customer", _CUSTOMER, True))
def table_profile(spark, sf):
    return inspection.table_profile(table(spark, sf, "customer"))


# --- windows and fences


def with_lost_stratum(spark, sf):
    """Gaps as before; one segment has no balance at all."""
    gaps = with_gaps(spark, sf)
    return gaps.withColumn("balance", F.when(F.coalesce(F.col("segment"), F.lit("")) != "MACHINERY", F.col("balance")))


_LOST = f"select c_custkey, segment, case when coalesce(segment, '') <> 'MACHINERY' then balance end as balance from ({GAPS_SQL}) as g"


@query(
    "impute_numeric_stratified",
    f"""
    with g as ({_LOST}), m as (select segment, quantile_disc(balance, 0.5) as median from g group by 1)
    select c_custkey, g.segment, coalesce(balance, median) as balance
    from g join m on g.segment is not distinct from m.segment
    """,
)
def impute_numeric_stratified(spark, sf):
    gaps = with_lost_stratum(spark, sf).select("c_custkey", "segment", "balance")
    return missing.impute_numeric_stratified(gaps, ["balance"], ["segment"], method="exact")


@query(
    "cap_iqr",
    """
    with f as (select event_type, quantile_disc(value, 0.25) as a, quantile_disc(value, 0.75) as b from events group by 1)
    select event_id, e.event_type, greatest(least(value, b + 1.5 * (b - a)), a - 1.5 * (b - a)) as value
    from events as e join f on e.event_type = f.event_type
    """,
)
def cap_iqr(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return outliers.cap_iqr(events, ["value"], ["event_type"], method="exact")


@query(
    "cap_iqr_global",
    """
    with f as (select quantile_disc(value, 0.25) as a, quantile_disc(value, 0.75) as b from events)
    select event_id, greatest(least(value, b + 1.5 * (b - a)), a - 1.5 * (b - a)) as value from events, f
    """,
)
def cap_iqr_global(spark, sf):
    return outliers.cap_iqr(table(spark, sf, "events").select("event_id", "value"), ["value"], method="exact")


def lost_values(spark, sf):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf, "events").select("event_id", "user_id", "ts", value.alias("value"))


_LOST_VALUES = "select event_id, user_id, ts, case when event_type <> 'error' then value end as value from events"


@query(
    "fill_environmental_nearest",
    f"""
    select event_id, user_id, coalesce(value, last_value(value ignore nulls) over
           (partition by user_id order by ts, event_id rows between unbounded preceding and current row)) as value
    from ({_LOST_VALUES}) as e
    """,
)
def fill_environmental_nearest(spark, sf):
    filled = missing.fill_environmental_nearest(lost_values(spark, sf), "value", "user_id", "ts", ["event_id"])
    return filled.select("event_id", "user_id", "value")


@query(
    "fill_environmental_both_sides",
    f"""
    with e as ({_LOST_VALUES}),
    s as (select *, last_value(value ignore nulls) over before as pv,
                 last_value(case when value is not null then ts end ignore nulls) over before as pt,
                 first_value(value ignore nulls) over after as nv,
                 first_value(case when value is not null then ts end ignore nulls) over after as nt
          from e
          window before as (partition by user_id order by ts, event_id rows between unbounded preceding and current row),
                 after as (partition by user_id order by ts, event_id rows between current row and unbounded following))
    select event_id, user_id,
           case when value is not null then value when pt is null then nv when nt is null then pv
                when date_diff('microsecond', pt, ts) <= date_diff('microsecond', ts, nt) then pv else nv end as value
    from s
    """,
)
def fill_environmental_both_sides(spark, sf):
    filled = missing.fill_environmental_nearest(
        lost_values(spark, sf), "value", "user_id", "ts", ["event_id"], method="nearest"
    )
    return filled.select("event_id", "user_id", "value")


_ROBUST = """
    with m as (select quantile_disc({c}, 0.5) as med from {t}),
         d as (select quantile_disc(abs({c} - med), 0.5) as mad from {t}, m)
"""


@query(
    "flag_robust_zscore_outliers",
    _ROBUST.format(c="value", t="events")
    + " select event_id, value, abs(value - med) / (1.4826 * mad) > 3.5 as value_is_outlier from events, m, d",
)
def flag_robust_zscore_outliers(spark, sf):
    return outliers.flag_robust_zscore_outliers(
        table(spark, sf, "events").select("event_id", "value"), ["value"], method="exact"
    )


@query(
    "flag_robust_zscore_by_group",
    """
    with m as (select event_type, quantile_disc(value, 0.5) as med from events group by 1),
         d as (select event_type, quantile_disc(abs(value - med), 0.5) as mad
               from events join m using (event_type) group by 1)
    select event_id, abs(value - med) / (1.4826 * mad) > 3.5 as value_is_outlier
    from events join m using (event_type) join d using (event_type)
    """,
)
def flag_robust_zscore_by_group(spark, sf):
    return outliers.flag_robust_zscore_outliers(
        table(spark, sf, "events").select("event_id", "event_type", "value"), ["value"],
        group_cols=["event_type"], method="exact",
    ).select("event_id", "value_is_outlier")


# --- unions and running totals


@query(
    "union_by_name",
    """
    select c_custkey as id, c_acctbal as balance, 'customer' as source from customer
    union all select s_suppkey, s_acctbal, 'supplier' from supplier
    """,
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return reshape.union_by_name([(customers, "customer"), (suppliers, "supplier")])


@query(
    "concat_frames",
    """
    select c_custkey as id, c_mktsegment as segment, cast(null as double) as balance from customer
    union all select s_suppkey, null, s_acctbal from supplier
    """,
)
def concat_frames(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return reshape.concat_frames([customers, suppliers])


@query(
    "ordered_prefix_sum",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           cast(sum(cast(l_quantity as bigint)) over (order by l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey
                rows between unbounded preceding and current row) as bigint) as prefix_sum
    from lineitem
    """,
)
def ordered_prefix_sum(spark, sf):
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem").select(*order, F.col("l_quantity").cast("long").alias("quantity"))
    return ordered.ordered_prefix_sum(lines, order, "quantity").select(*order, "prefix_sum")
