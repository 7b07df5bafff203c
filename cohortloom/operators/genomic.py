"""Reduction of expression data and of mutation calls to a few columns per patient."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom import defaults
from cohortloom.operators.guards import guard_min_columns
from cohortloom.operators.joins import join_left_lookup, semi_join_isin
from cohortloom.operators.reduction import standard_axes
from cohortloom.runtime import materialize


def gene_variance(long_df: DataFrame, gene_col: str, value_col: str) -> DataFrame:
    """Sample variance per gene; a gene with one value has none."""
    return (
        long_df.filter(F.col(gene_col).isNotNull())
        .groupBy(gene_col)
        .agg(F.var_samp(F.col(value_col).try_cast("double")).alias("variance"))
    )


def top_k_by_variance(long_df: DataFrame, gene_col: str, value_col: str, n: int = defaults.TOP_GENES) -> DataFrame:
    """The ``n`` most variable genes, equal variances by name."""
    ranked = gene_variance(long_df, gene_col, value_col)
    return ranked.orderBy(F.col("variance").desc_nulls_last(), gene_col).limit(n)


def top_variable_genes(long_df: DataFrame, gene_col: str, value_col: str, n: int = defaults.TOP_GENES) -> DataFrame:
    """The rows of the ``n`` most variable genes."""
    # written, so that the join broadcasts the names by their size or not at all
    keep = materialize(top_k_by_variance(long_df, gene_col, value_col, n).select(gene_col), "genes")
    return semi_join_isin(long_df, keep, gene_col)


def pca_rank(columns: int, rows: int, limit: int = defaults.MAX_COMPONENTS) -> int:
    """Components that the data can support."""
    return max(1, min(limit, columns - 1, rows - 1))


def reduce_expression_pca(
    df: DataFrame, gene_columns: Sequence[str], k: int = defaults.MAX_COMPONENTS, id_col: str = "patient_key"
) -> DataFrame:
    """Standardised principal components of a wide table as flat columns."""
    guard_min_columns(gene_columns, 2, "the expression table")
    assembled = VectorAssembler(inputCols=list(gene_columns), outputCol="__genes").transform(df)
    return reduce_vector_pca(assembled.select(id_col, "__genes"), "__genes", k, id_col)


def reduce_vector_pca(df: DataFrame, vector_col: str, k: int, id_col: str = "patient_key") -> DataFrame:
    """The same from one vector per id; no wide table is ever built. The largest loading of a component is positive."""
    rows = df.select(id_col, vector_col)
    reduced = standard_axes(rows, vector_col, k).project(rows, vector_col, "__components")
    return reduced.select(id_col, *[F.get("__components", F.lit(i)).alias(f"expression_pca_{i}") for i in range(k)])


def aggregate_mutation_burden(
    mutations: DataFrame,
    gene_pathways: DataFrame,
    id_col: str = "patient_key",
    pathways: Sequence[str] | None = None,
) -> DataFrame:
    """Mutations per id and pathway, one column per pathway, 0 where there are none.

    ``pathways`` fixes the columns and saves the pass that finds them; genes of no
    listed pathway count as unmapped.
    """
    mapped = join_left_lookup(mutations, gene_pathways, "gene", "pathway", defaults.UNMAPPED_PATHWAY)
    if not pathways:
        return mapped.groupBy(id_col).pivot("pathway").agg(F.count(F.lit(1))).na.fill(0)
    # every call counts somewhere: those of other pathways as unmapped
    wanted = list(dict.fromkeys([*pathways, defaults.UNMAPPED_PATHWAY]))
    known = F.col("pathway").isin(wanted)
    placed = mapped.withColumn("pathway", F.when(known, F.col("pathway")).otherwise(F.lit(defaults.UNMAPPED_PATHWAY)))
    return placed.groupBy(id_col).pivot("pathway", wanted).agg(F.count(F.lit(1))).na.fill(0)
