"""What the runs ask of their models: training, scores, importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.boosting import BOOSTING, BoostedTrees, train_boosted_classifier
from cohortloom.operators.survival_forest import FOREST_MIN_LEAF, FOREST_TREES, SEED, SurvivalForest, train_survival_forest

__all__ = [
    "BOOSTING", "BoostedTrees", "FOREST_MIN_LEAF", "FOREST_TREES", "SEED", "SurvivalForest", "feature_importance",
    "score_classifier", "sort_importances", "train_boosted_classifier", "train_survival_forest",
]


def score_classifier(
    model: BoostedTrees, df: DataFrame, feature_cols: Sequence[str] | None = None, output_col: str = "score"
) -> DataFrame:
    """Add the probability of the outcome."""
    return df.withColumn(output_col, model.probability(feature_cols))


def feature_importance(spark: SparkSession, model: BoostedTrees, feature_cols: Sequence[str] | None = None) -> DataFrame:
    """(feature, importance), one row per feature: its share of the mean gains of the splits."""
    named = zip(feature_cols or model.features, model.importances())
    return spark.createDataFrame([(c, float(w)) for c, w in named], "feature string, importance double")


def sort_importances(importances: DataFrame) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), "feature")
