"""Gold to models: prepare, split by patient, train and score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import defaults
from cohortloom.functions.columns import cast_columns, derive_event, fill_zero, filter_not_null
from cohortloom.operators import cox, metrics, models
from cohortloom.operators.split import assign_split
from cohortloom.runtime import materialize, present
from cohortloom.sources.layers import layer_path, scan_layer, write_split


def available_features(df: DataFrame, expected: Sequence[str] = tuple(defaults.MODEL_FEATURES)) -> list[str]:
    found = present(df, expected)
    if not found:
        raise ValueError("the table has none of the expected feature columns")
    return found


def prepare_training_table(
    df: DataFrame,
    expected: Sequence[str] = tuple(defaults.MODEL_FEATURES),
    duration_col: str = "OS_MONTHS",
    status_col: str = "OS_STATUS",
    id_col: str = "patient_key",
) -> DataFrame:
    """Numeric duration, 0/1 event, complete keys, features as doubles without nulls."""
    features = available_features(df, expected)
    ready = derive_event(cast_columns(df, {duration_col: "double"}), status_col)
    ready = filter_not_null(ready, [duration_col, id_col])
    return fill_zero(cast_columns(ready, dict.fromkeys(features, "double")), features)


def prepare_train_test_split(spark: SparkSession, root: str, path: str, **options) -> list[str]:
    """Write the split training table and return the feature columns it has."""
    table = prepare_training_table(scan_layer(spark, layer_path(root, "gold", "patient_features_tcga")), **options)
    order = present(table, ["sampleId"])
    write_split(assign_split(table, "patient_key", "event", order_by=[*order, "event"]), path)
    return available_features(table)


def sides(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")


@dataclass(frozen=True)
class ClassificationResult:
    model: models.BoostedTrees
    metrics: DataFrame  # (metric, value)
    importances: DataFrame  # (feature, importance), most important first


def classification_run(
    split: DataFrame, features: Sequence[str], target_col: str = "event", params: dict | None = None
) -> ClassificationResult:
    train, test = sides(split)
    spark = split.sparkSession
    model = models.train_boosted_classifier(train, features, target_col, params)
    scored = materialize(models.score_classifier(model, test, features).select("score", target_col), "scored")
    found = [
        ("test_roc_auc", metrics.roc_auc(scored, "score", target_col).first()[0]),
        ("test_pr_auc", metrics.average_precision(scored, "score", target_col).first()[0]),
    ]
    return ClassificationResult(
        model,
        spark.createDataFrame(found, "metric string, value double"),
        models.sort_importances(models.feature_importance(spark, model, features)),
    )


@dataclass(frozen=True)
class SurvivalResult:
    cox_model: cox.CoxModel
    forest: models.SurvivalForest
    metrics: DataFrame  # (metric, value)




def survival_run(
    split: DataFrame,
    features: Sequence[str],
    duration_col: str = "OS_MONTHS",
    event_col: str = "event",
    n_estimators: int = models.FOREST_TREES,
) -> SurvivalResult:
    train, test = sides(split)
    hazards = cox.train_coxph(train, duration_col, event_col, features)
    forest = models.train_survival_forest(train, duration_col, event_col, features, n_estimators)
    by_cox = cox.partial_hazard(hazards, test, "risk")
    by_forest = forest.risk(test, "risk")
    found = []
    for name, scored in (("coxph", by_cox), ("survival_forest", by_forest)):
        row = metrics.concordance_index(scored, duration_col, event_col, "risk").first()
        found.append((f"{name}_test_concordance_index", row["concordance"]))
    return SurvivalResult(hazards, forest, split.sparkSession.createDataFrame(found, "metric string, value double"))
