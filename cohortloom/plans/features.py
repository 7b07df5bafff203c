"""Silver to gold: encode, reduce and fuse into model-ready tables.

Two gold tables come out, since the sources do not share a cohort: one per patient
with clinical, expression and mutation blocks, and one that joins registry records
to yearly exposure by county. They are never joined to each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import defaults
from cohortloom.functions.columns import rename_column
from cohortloom.functions.encode import encode_tnm_stage_ordinal
from cohortloom.operators import genomic
from cohortloom.operators.fuse import fuse_modalities
from cohortloom.operators.guards import guard_min_columns
from cohortloom.operators.joins import county_exposure, with_county_exposure
from cohortloom.operators.reshape import long_to_vector
from cohortloom.runtime import cleans_up, materialize
from cohortloom.sources.layers import layer_path, overwrite_table, scan_layer, table_exists
from cohortloom.sources.lookups import gene_pathways

STAGE = "AJCC_PATHOLOGIC_TUMOR_STAGE"


def clinical_features_frame(clinical: DataFrame) -> DataFrame:
    return encode_tnm_stage_ordinal(clinical, STAGE, "stage_rank") if STAGE in clinical.columns else clinical


def expression_features_frame(
    rna_seq: DataFrame,
    id_col: str = "patient_key",
    gene_col: str = "gene_name",
    value_col: str = "unstranded",
    top_genes: int = defaults.TOP_GENES,
    components: int = defaults.MAX_COMPONENTS,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Principal components of the most variable genes, one row per patient.

    The long table goes straight to one vector per patient: no table with a column
    per gene, and no column names to repair.
    """
    kept = materialize(genomic.top_k_by_variance(rna_seq, gene_col, value_col, top_genes), "genes")
    genes = [row[gene_col] for row in kept.select(gene_col).orderBy(gene_col).collect()]  # at most ``top_genes``
    guard_min_columns(genes, 2, "the expression table")
    vectors = materialize(long_to_vector(rna_seq, id_col, gene_col, value_col, genes, "genes", order_by=order_by), "vectors")
    k = genomic.pca_rank(len(genes), vectors.count(), components)
    return genomic.reduce_vector_pca(vectors, "genes", k, id_col)


def mutation_burden_frame(
    mutations: DataFrame, pathways: DataFrame | None = None, names: Sequence[str] | None = None
) -> DataFrame:
    """Burden per pathway; with the built-in map the pathway columns are known in advance."""
    if pathways is None:
        pathways = gene_pathways(mutations.sparkSession)
        names = names or defaults.PATHWAY_FEATURES
    return genomic.aggregate_mutation_burden(mutations, pathways, "patient_key", names)


def seer_environmental_frame(seer: DataFrame, pm25: DataFrame) -> DataFrame:
    people = rename_column(seer, "county_of_residence", "county_code")
    if "year_of_diagnosis" in people.columns:
        people = people.withColumn("year", F.col("year_of_diagnosis").cast("string"))
    return with_county_exposure(people, county_exposure(pm25))


def _silver(spark: SparkSession, root: str, domain: str) -> DataFrame:
    return scan_layer(spark, layer_path(root, "silver", domain))


@cleans_up
def clinical_features(spark: SparkSession, root: str) -> str:
    gold = clinical_features_frame(_silver(spark, root, "clinical"))
    return overwrite_table(gold, layer_path(root, "gold", "clinical_features"))


@cleans_up
def expression_features(spark: SparkSession, root: str, **options) -> str:
    gold = expression_features_frame(_silver(spark, root, "rna_seq"), **options)
    return overwrite_table(gold, layer_path(root, "gold", "expression_features"))


@cleans_up
def mutation_burden_features(spark: SparkSession, root: str, pathways: DataFrame | None = None) -> str:
    gold = mutation_burden_frame(_silver(spark, root, "mutations"), pathways)
    return overwrite_table(gold, layer_path(root, "gold", "mutation_burden_features"))


@cleans_up
def patient_features_tcga(spark: SparkSession, root: str) -> str:
    """Fuse the three blocks; clinical rows are per sample, the others per patient."""
    blocks = {
        "clinical": "clinical_features",
        "genomic_expression": "expression_features",
        "genomic_mutation_burden": "mutation_burden_features",
    }
    frames = {name: scan_layer(spark, layer_path(root, "gold", table)) for name, table in blocks.items()}
    fused = fuse_modalities(frames, "patient_key", repeated="clinical")
    return overwrite_table(fused, layer_path(root, "gold", "patient_features_tcga"))


@cleans_up
def patient_features_seer_environmental(spark: SparkSession, root: str) -> str | None:
    domains = ("seer_extract", "environmental_pm25")
    if not all(table_exists(spark, layer_path(root, "silver", d)) for d in domains):
        return None
    gold = seer_environmental_frame(*[_silver(spark, root, d) for d in domains])
    return overwrite_table(gold, layer_path(root, "gold", "patient_features_seer_environmental"))
