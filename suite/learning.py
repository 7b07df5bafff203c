"""Queries over reduction, training and evaluation."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortloom.operators import cox, genomic, metrics, models
from cohortloom.operators.split import assign_split
from cohortloom.plans import training
from cohortloom.runtime import materialize
from suite.registry import query, table

FEATURES = ["n_orders", "mean_price", "n_urgent", "c_acctbal", "c_nationkey"]


def patients(spark, sf):
    """Customers with orders: order history as features, its length as duration, and
    whether the last order is finished as event."""
    order_at = F.struct("o_orderdate", "o_orderkey")
    history = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n_orders"),
            F.avg("o_totalprice").alias("mean_price"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("n_urgent"),
            F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).cast("double").alias("duration"),
            F.max_by("o_orderstatus", order_at).alias("last_status"),
        )
    )
    joined = history.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "c_custkey", *FEATURES, "duration", F.when(F.col("last_status") == "F", 1).otherwise(0).alias("event")
    )


def split_patients(spark, sf):
    return materialize(assign_split(patients(spark, sf), "c_custkey", "event"), "patients")


@query(
    "reduce_expression_pca",
    """
    with genes as (select vec_id, unnest(range(64)) as gene, unnest(embedding) as v from embeddings),
         scales as (select gene, avg(v) as m, stddev_samp(v) as s from genes group by 1)
    select vec_id as patient_key, round(sum(((v - m) / s) ** 2), 4) as squared_length
    from genes join scales using (gene) group by 1
    """,
)
def reduce_expression_pca(spark, sf):
    """All components together keep the length of every standardised row."""
    embeddings = table(spark, sf, "embeddings")
    genes = [f"gene_{i}" for i in range(64)]
    wide = embeddings.select(
        F.col("vec_id").alias("patient_key"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(g) for i, g in enumerate(genes)],
    )
    reduced = genomic.reduce_expression_pca(wide, genes, k=len(genes))
    squares = sum((F.col(f"expression_pca_{i}") ** 2 for i in range(len(genes))), F.lit(0.0))
    return reduced.select("patient_key", F.round(squares, 4).alias("squared_length"))


def _correlation_sql(columns):
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return ", ".join(f"corr({a}, {b}) as r{k}" for k, (a, b) in enumerate(pairs))


PCA_COLUMNS = ["l_quantity", "l_extendedprice", "l_tax"]


@query(
    "pca_variances",
    f"""
    with r as (select {_correlation_sql(PCA_COLUMNS)} from lineitem),
         p as (select *, sqrt((r0 * r0 + r1 * r1 + r2 * r2) / 3) as p from r),
         a as (select p, acos(greatest(-1, least(1, r0 * r1 * r2 / p ** 3))) / 3 as a from p),
         e as (select 1 + 2 * p * cos(a) as e0, 1 + 2 * p * cos(a + 2 * pi() / 3) as e2 from a)
    select unnest([0, 1, 2]) as component, unnest([round(e0, 8), round(3 - e0 - e2, 8), round(e2, 8)]) as variance from e
    """,
)
def pca_variances(spark, sf):
    """Variance of every component of three columns: the roots of the cubic of their correlations."""
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("patient_key"), *[F.col(c).cast("double").alias(c) for c in PCA_COLUMNS]
    )
    reduced = genomic.reduce_expression_pca(lines, PCA_COLUMNS, k=3)
    spread = F.array(*[F.var_samp(f"expression_pca_{i}") for i in range(3)])
    found = reduced.agg(spread.alias("v")).select(F.posexplode("v").alias("component", "variance"))
    return found.select("component", F.round("variance", 8).alias("variance"))


@query(
    "pca_moments",
    """
    with genes as (select vec_id, unnest(range(64)) as gene, unnest(embedding)::double as v from embeddings),
         pairs as (select corr(a.v, b.v) as r, a.gene as g, b.gene as h from genes as a join genes as b using (vec_id) group by all)
    select round(sum(r) filter (g = h), 6) as total, round(sum(r * r), 6) as squares from pairs
    """,
)
def pca_moments(spark, sf):
    """Sum of the variances of all components, and of their squares: those of the correlations."""
    reduced = genomic.reduce_vector_pca(
        table(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v")), "v", 64, "vec_id"
    )
    spread = F.array(*[F.var_samp(f"expression_pca_{i}") for i in range(64)])
    moments = reduced.agg(spread.alias("v")).select(F.explode("v").alias("x"))
    return moments.agg(F.round(F.sum("x"), 6).alias("total"), F.round(F.sum(F.col("x") * F.col("x")), 6).alias("squares"))


@query(
    "prepare_training_table",
    """
    select 'P' || o_orderkey as patient_key, o_totalprice as "OS_MONTHS",
           case when o_orderstatus = 'F' then 1 else 0 end as event,
           case when o_orderstatus = 'F' then '1:DECEASED' when o_orderstatus = 'O' then '0:LIVING' end as "OS_STATUS",
           case when o_orderpriority = '5-LOW' then 0.0 else cast(o_custkey as double) end as stage_rank,
           cast(o_orderkey % 7 as double) as unmapped
    from orders where o_orderpriority <> '3-MEDIUM'
    """,
)
def prepare_training_table(spark, sf):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    raw = table(spark, sf, "orders").select(
        F.concat(F.lit("P"), "o_orderkey").alias("patient_key"),
        F.when(priority == "3-MEDIUM", "[Not Available]").otherwise(F.col("o_totalprice").cast("string")).alias("OS_MONTHS"),
        F.when(status == "F", "1:DECEASED").when(status == "O", "0:LIVING").alias("OS_STATUS"),
        F.when(priority != "5-LOW", F.col("o_custkey")).alias("stage_rank"),
        (F.col("o_orderkey") % 7).cast("string").alias("unmapped"),
    )
    return training.prepare_training_table(raw)


@query(
    "sort_importances",
    """
    select feature, importance, row_number() over (order by importance desc, feature) as place
    from (select c_mktsegment as feature, round(sum(c_acctbal), 2) as importance from customer group by 1)
    """,
)
def sort_importances(spark, sf):
    weights = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("feature"))
    ordered = models.sort_importances(weights.agg(F.round(F.sum("c_acctbal"), 2).alias("importance")))
    # ids follow the order of the rows: the place is where the operator put them
    return materialize(ordered.coalesce(1), "ordered").select(
        "*", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("long").alias("place")
    )


def _scored_documents(spark, sf):
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
    return joined.select(F.round(F.col("n_chars") / 1000).alias("score"), F.col("quality").alias("label"))


_SCORED = """
    select score, sum(label) as pos, count(*) - sum(label) as neg
    from (select round(n_chars / 1000.0) as score, quality as label from labels join documents using (doc_id)) as s
    group by 1
"""


@query(
    "roc_auc",
    f"""
    with c as ({_SCORED}), r as (select *, sum(neg) over (order by score rows between unbounded preceding and current row) - neg as below from c)
    select round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 9) as roc_auc from r
    """,
)
def roc_auc(spark, sf):
    return metrics.roc_auc(_scored_documents(spark, sf), "score", "label").withColumn("roc_auc", F.round("roc_auc", 9))


@query(
    "average_precision",
    f"""
    with c as ({_SCORED}), r as (select *, sum(pos) over w as tp, sum(pos + neg) over w as n from c
                                 window w as (order by score desc rows between unbounded preceding and current row))
    select round(sum(pos * tp / n) / sum(pos), 9) as average_precision from r
    """,
)
def average_precision(spark, sf):
    found = metrics.average_precision(_scored_documents(spark, sf), "score", "label")
    return found.withColumn("average_precision", F.round("average_precision", 9))


_PATIENTS = """
    select c_custkey, date_diff('day', cast(min(o_orderdate) as date), cast(max(o_orderdate) as date)) as t,
           case when arg_max(o_orderstatus, (o_orderdate, o_orderkey)) = 'F' then 1 else 0 end as e,
           floor(any_value(c_acctbal) / 500) as r
    from orders join customer on o_custkey = c_custkey group by 1
"""


@query(
    "concordance_index",
    f"""
    with p as ({_PATIENTS}), cells as (select t, e, r, count(*) as w from p group by 1, 2, 3),
    pairs as (select a.w * b.w as n, case when a.r > b.r then 1.0 when a.r = b.r then 0.5 else 0.0 end as s
              from cells as a join cells as b on a.e = 1 and (a.t < b.t or (a.t = b.t and b.e = 0)))
    select round(sum(n * s) / sum(n), 9) as concordance, cast(sum(n) as bigint) as comparable,
           cast(sum(n * s) as double) as concordant from pairs
    """,
)
def concordance_index(spark, sf):
    risky = patients(spark, sf).withColumn("risk", F.floor(F.col("c_acctbal") / 500))
    found = metrics.concordance_index(risky, "duration", "event", "risk")
    return found.withColumn("concordance", F.round("concordance", 9))


PATIENTS_SQL = """
    select c_custkey, n_orders, c_acctbal, duration, case when last_status = 'F' then 1 else 0 end as event
    from customer join (
        select o_custkey, cast(count(*) as double) as n_orders,
               cast(date_diff('day', cast(min(o_orderdate) as date), cast(max(o_orderdate) as date)) as double) as duration,
               first(o_orderstatus order by o_orderdate desc, o_orderkey desc) as last_status
        from orders group by 1) on o_custkey = c_custkey
"""
COX_COVARIATES = ["n_orders", "c_acctbal"]
NEWTON_STEPS = 8


def _cox_sql(select: str) -> str:
    """Newton steps for two standardised covariates, one chain of tables per step.

    Per event time the risk set is a running sum from the latest time, and its d deaths leave it in shares (Efron).
    """
    (x, y), pen = COX_COVARIATES, cox.PENALIZER
    sums = {"": "1", "1": "z1", "2": "z2", "11": "z1 * z1", "12": "z1 * z2", "22": "z2 * z2"}
    parts = [
        f"patients as materialized ({PATIENTS_SQL})",
        f"scale as (select count(*) as n, avg({x}) as m1, avg({y}) as m2, stddev_samp({x}) as s1, stddev_samp({y}) as s2 from patients)",
        f"z as materialized (select c_custkey, duration as t, event as e, ({x} - m1) / s1 as z1, ({y} - m2) / s2 as z2 from patients, scale)",
        "b0 as (select cast(0 as double) as b1, cast(0 as double) as b2, cast(null as double) as v1, cast(null as double) as v2)",
    ]
    for k in range(NEWTON_STEPS):
        per_time = ", ".join(f"sum(w * {v}) as r{c}, sum(e * w * {v}) as q{c}" for c, v in sums.items())
        cumulated = ", ".join(f"sum(r{c}) over (order by t desc) as c{c}, q{c}" for c in sums)
        shares = ", ".join(f"c{c} - l / d * q{c} as a{c}" for c in sums)
        parts += [
            f"w{k} as materialized (select z.*, exp(b1 * z1 + b2 * z2) as w from z, b{k})",
            f"t{k} as materialized (select t, sum(e) as d, {per_time} from w{k} group by t)",
            f"c{k} as materialized (select d, {cumulated} from t{k})",
            f"a{k} as materialized (select {shares} from (select *, unnest(range(cast(d as bigint))) as l from c{k} where d > 0))",
            f"""g{k} as materialized (
                select (e1 - sum(a1 / a)) / n - {pen} * b1 as g1, (e2 - sum(a2 / a)) / n - {pen} * b2 as g2,
                       sum(a11 / a - a1 / a * a1 / a) / n + {pen} as h11, sum(a12 / a - a1 / a * a2 / a) / n as h12,
                       sum(a22 / a - a2 / a * a2 / a) / n + {pen} as h22, b1, b2, n
                from a{k}, b{k}, scale, (select sum(e * z1) as e1, sum(e * z2) as e2 from z) group by b1, b2, n, e1, e2)""",
            f"""b{k + 1} as materialized (
                select b1 + (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12) as b1,
                       b2 + (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12) as b2,
                       h22 / (h11 * h22 - h12 * h12) / n as v1, h11 / (h11 * h22 - h12 * h12) / n as v2 from g{k})""",
        ]
    return f"with {', '.join(parts)}, fitted as (select * from b{NEWTON_STEPS}) {select}"


def fitted_cox(spark, sf):
    df = patients(spark, sf)
    return df, cox.train_coxph(df, "duration", "event", COX_COVARIATES)


@query(
    "train_coxph",
    _cox_sql(
        f"""
        select '{COX_COVARIATES[0]}' as covariate, round(b1 / s1, 8) as coef, round(exp(b1 / s1), 8) as hazard_ratio,
               round(sqrt(v1) / s1, 8) as se from fitted, scale
        union all
        select '{COX_COVARIATES[1]}', round(b2 / s2, 8), round(exp(b2 / s2), 8), round(sqrt(v2) / s2, 8) from fitted, scale
        """
    ),
)
def train_coxph(spark, sf):
    df, model = fitted_cox(spark, sf)
    return model.summary(spark).select("covariate", *[F.round(c, 8).alias(c) for c in ("coef", "hazard_ratio", "se")])


@query(
    "partial_hazard",
    _cox_sql("select c_custkey, round(exp(b1 * z1 + b2 * z2), 6) as partial_hazard from z, fitted"),
)
def partial_hazard(spark, sf):
    df, model = fitted_cox(spark, sf)
    return cox.partial_hazard(model, df).select("c_custkey", F.round("partial_hazard", 6).alias("partial_hazard"))


def two_valued(spark, sf):
    """Patients with two features of two values, and a side of the split that SQL can name."""
    return materialize(
        patients(spark, sf).select(
            "c_custkey", "duration", "event",
            F.when(F.col("n_orders") > 10, 1.0).otherwise(0.0).alias("many"),
            F.when(F.col("c_acctbal") > 5000, 1.0).otherwise(0.0).alias("rich"),
            F.when(F.col("c_custkey") % 4 == 0, "test").otherwise("train").alias("split"),
        ),
        "two_valued",
    )


ETA, ROUNDS = models.BOOSTING["eta"], models.BOOSTING["n_estimators"]
TWO_VALUED_SQL = f"""
    patients as (select *, n_orders > 10 as many, c_acctbal > 5000 as rich,
                        case when c_custkey % 4 = 0 then 'test' else 'train' end as split from ({PATIENTS_SQL}))
"""


def _boosted_sql(features: str, rounds: int, select: str, where: str = "true") -> str:
    """Rounds of second-order boosting over the four cells of two two-valued features, a row per round.

    Every tree is the better one of two splits; with one feature it is that one's. ``f`` are the scores of the cells
    (neither, rich, many, both), ``s_many`` and ``s_rich`` the sums of the gains.
    """
    sides = {"many": ("01", "23"), "rich": ("02", "13")}
    cells = {"0": "not many and not rich", "1": "not many and rich", "2": "many and not rich", "3": "many and rich"}
    total = lambda x, side: "(" + " + ".join(f"{x}{c}" for c in side) + ")"
    term = lambda side: f"{total('g', side)} ^ 2 / ({total('h', side)} + 1)"
    gains = []
    for name, (left, right) in sides.items():
        fits = f"least({total('h', left)}, {total('h', right)}) >= 1" if name in features.split() else "false"
        gains.append(f"case when {fits} then {term(left)} + {term(right)} - {term('0123')} else 0 end as gain_{name}")

    def moved(c: str) -> str:
        step = lambda side: f"{total('g', side)} / ({total('h', side)} + 1)"
        own = {name: next(side for side in both if c in side) for name, both in sides.items()}
        return f"f{c} - {ETA} * case best when 'many' then {step(own['many'])} when 'rich' then {step(own['rich'])} else {step('0123')} end"

    keep = ", ".join(f"n{c}, y{c}" for c in cells)
    counts = ", ".join(f"cast(count(*) filter ({w}) as double) as n{c}, cast(count(*) filter ({w} and event = 1) as double) as y{c}" for c, w in cells.items())
    start = f"4 * {total('y', '0123')} / {total('n', '0123')} - 2"
    return f"""
    with recursive {TWO_VALUED_SQL},
    counts as (select {counts} from patients where {where}),
    rounds as (
        select 0 as k, {", ".join(f"{start} as f{c}" for c in cells)}, {keep}, cast(0 as double) as s_many, 0 as t_many,
               cast(0 as double) as s_rich, 0 as t_rich from counts
        union all
        select k + 1, {", ".join(moved(c) for c in cells)}, {keep},
               s_many + if(best = 'many', gain_many, 0), t_many + if(best = 'many', 1, 0),
               s_rich + if(best = 'rich', gain_rich, 0), t_rich + if(best = 'rich', 1, 0)
        from (select *, case when greatest(gain_many, gain_rich) <= 1e-6 then 'none'
                             when gain_rich > gain_many * (1 + 1e-10) then 'rich' else 'many' end as best
              from (select *, {", ".join(gains)}
                    from (select *, {", ".join(f"n{c} / (1 + exp(-f{c})) - y{c} as g{c}, n{c} / (1 + exp(-f{c})) / (1 + exp(f{c})) as h{c}" for c in cells)}
                          from rounds where k < {rounds})))),
    fitted as (select *, s_many / greatest(t_many, 1) as m_many, s_rich / greatest(t_rich, 1) as m_rich from rounds where k = {rounds}),
    scored as (select *, 1 / (1 + exp(-case when many then if(rich, f3, f2) else if(rich, f1, f0) end)) as score from patients, fitted)
    {select}
    """


@query(
    "train_boosted_classifier",
    _boosted_sql("many", ROUNDS, "select c_custkey, event, round(score, 6) as score from scored"),
)
def train_boosted_classifier(spark, sf):
    df = two_valued(spark, sf)
    scored = models.score_classifier(models.train_boosted_classifier(df, ["many"]), df)
    return scored.select("c_custkey", "event", F.round("score", 6).alias("score"))


@query(
    "train_boosted_by_levels",
    _boosted_sql("many rich", 12, "select c_custkey, event, round(score, 6) as score from scored"),
)
def train_boosted_by_levels(spark, sf):
    """The same trees with a job for each level, as tables need that are too large for one task."""
    df, shape = two_valued(spark, sf), {"max_depth": 1, "n_estimators": 12}
    model = models.train_boosted_classifier(df, ["many", "rich"], params=shape, task_cells=0)
    return models.score_classifier(model, df).select("c_custkey", "event", F.round("score", 6).alias("score"))


@query(
    "feature_importance",
    _boosted_sql(
        "many rich", ROUNDS,
        """
        select 'many' as feature, round(m_many / (m_many + m_rich), 6) as importance from fitted
        union all select 'rich', round(m_rich / (m_many + m_rich), 6) from fitted
        """,
    ),
)
def feature_importance(spark, sf):
    model = models.train_boosted_classifier(two_valued(spark, sf), ["many", "rich"], params={"max_depth": 1})
    shares = models.feature_importance(spark, model)
    return shares.select("feature", F.round("importance", 6).alias("importance"))


BOOSTED_FEATURES = ["n_orders", "mean_price", "urgent_price", "c_acctbal", "c_nationkey"]


def patients_with_gaps(spark, sf):
    """Patients whose mean price of urgent orders is missing where they have none, on the sides of a split."""
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey"))
    prices = urgent.agg(F.avg("o_totalprice").alias("urgent_price"))
    return materialize(split_patients(spark, sf).join(prices, "c_custkey", "left"), "patients")


@query("train_boosted_features")
def train_boosted_features(spark, sf):
    """Five features, one with missing values, at full depth and rounds, scored on rows not trained on."""
    train, test = training.sides(patients_with_gaps(spark, sf))
    model = models.train_boosted_classifier(train, BOOSTED_FEATURES)
    return models.score_classifier(model, test).select("c_custkey", "event", "score")


@query("classification_importances")
def classification_importances(spark, sf):
    """Importances as the run returns them, most important first."""
    return training.classification_run(patients_with_gaps(spark, sf), BOOSTED_FEATURES).importances


@query(
    "train_survival_forest",
    f"""
    with {TWO_VALUED_SQL},
    grid as (select distinct duration as t from patients where event = 1),
    sides as (select *, case when least(count(*) filter (many) over (), count(*) filter (not many) over ()) >= 10 then many end as side from patients),
    steps as (select side, t, sum(event) filter (duration = t) as d, count(*) filter (duration >= t) as y,
                     (select count(*) from grid as later where later.t >= grid.t) as left_over
              from sides, grid group by side, t),
    leaves as (select side, sum(d / y * left_over) as risk from steps where d > 0 group by side)
    select c_custkey, duration, event, round(coalesce(risk, 0), 6) as risk
    from sides left join leaves on sides.side is not distinct from leaves.side
    """,
)
def train_survival_forest(spark, sf):
    """One tree without draws: a log-rank split of a two-valued covariate, and the hazards of its leaves."""
    df = two_valued(spark, sf)
    forest = models.train_survival_forest(df, "duration", "event", ["many"], n_estimators=1, bootstrap=False)
    return forest.risk(df).select("c_custkey", "duration", "event", F.round("risk", 6).alias("risk"))


@query("survival_forest_features")
def survival_forest_features(spark, sf):
    train, test = training.sides(split_patients(spark, sf))
    forest = models.train_survival_forest(train, "duration", "event", FEATURES)
    return forest.risk(test).select("c_custkey", "duration", "event", "risk")


@query(
    "classification_run",
    f"""
    with {TWO_VALUED_SQL},
    rates as (select many, avg(event) as rate from patients where split = 'train' group by many),
    tested as (select rate, sum(event) as pos, sum(1 - event) as neg from patients join rates using (many)
               where split = 'test' group by rate),
    ordered as (select *, sum(neg) over (order by rate) - neg as below, sum(pos) over (order by rate desc) as tp,
                       sum(pos + neg) over (order by rate desc) as n from tested)
    select 'test_roc_auc' as metric, round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) as value from ordered
    union all
    select 'test_pr_auc', round(sum(pos * tp / n) / sum(pos), 9) from ordered
    """,
)
def classification_run(spark, sf):
    """With one two-valued feature the scores follow its event rates, whatever the trees."""
    found = training.classification_run(two_valued(spark, sf), ["many"]).metrics
    return found.select("metric", F.round("value", 9).alias("value"))


@query(
    "survival_run",
    f"""
    with {TWO_VALUED_SQL},
    train as (select * from patients where split = 'train'),
    steps as (select t, count(*) filter (duration >= t) as y, count(*) filter (duration >= t and many) as y1,
                     sum(event) filter (duration = t) as d, coalesce(sum(event) filter (duration = t and many), 0) as d1
              from train, (select distinct duration as t from train where event = 1) group by t),
    excess as (select sign(sum(d1 - y1 * d / y)) as s from steps),
    cells as (select duration as t, event as e, if(many, s, 0) as r, count(*) as w from patients, excess where split = 'test' group by all),
    pairs as (select a.w * b.w as n, case when a.r > b.r then 1.0 when a.r = b.r then 0.5 else 0.0 end as c
              from cells as a join cells as b on a.e = 1 and (a.t < b.t or (a.t = b.t and b.e = 0)))
    select unnest(['coxph_test_concordance_index', 'survival_forest_test_concordance_index']) as metric,
           round(sum(n * c) / sum(n), 9) as value from pairs
    """,
)
def survival_run(spark, sf):
    """With one two-valued covariate both models order the patients by the side with more deaths than expected."""
    found = training.survival_run(two_valued(spark, sf), ["many"], "duration", n_estimators=60).metrics
    return found.select("metric", F.round("value", 9).alias("value"))


@query("survival_run_features")
def survival_run_features(spark, sf):
    return training.survival_run(split_patients(spark, sf), FEATURES, "duration").metrics
