"""Landed JSON responses: pages of records, status envelopes, nested lists."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators.guards import guard_not_empty
from cohortloom.operators.joins import join_broadcast_attributes
from cohortloom.runtime import materialize

EAV_COLUMNS = ["patientId", "sampleId", "clinicalAttributeId", "value"]
SAMPLE_SCHEMA = "patientId string, sampleId string, clinicalAttributeId string, value string"
PATIENT_SCHEMA = "patientId string, clinicalAttributeId string, value string"
MUTATION_SCHEMA = (
    "sampleId string, patientId string, gene string, proteinChange string, mutationType string"
)


_FAILFAST = {"mode": "FAILFAST"}


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _texts(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """A row per file, or per line; names of folders are no columns of the records."""
    rows = spark.read.option("recursiveFileLookup", True).option("wholetext", multi_line).text(path)
    return rows.select(F.trim("value").alias("value")).filter("value != ''")


def record_variants(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``record``: the records of all page files under ``path``, each a variant.

    A page is one JSON array of records, or a single one. With ``multi_line=False`` a line is a page, and files are
    splittable. A page that is no JSON fails the read.
    """
    page = F.when(F.col("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
    rows = _texts(spark, path, multi_line).select(F.explode(F.from_json(page, "array<variant>", _FAILFAST)).alias("record"))
    return rows.filter(~F.is_variant_null("record"))


def _field(name: str, kind: T.DataType) -> Column:
    """A field of the record. Text takes plain values as they read, and objects and lists as their JSON."""
    place = f'$["{name}"]'
    if not isinstance(kind, T.StringType):
        return F.variant_get("record", place, kind.simpleString()).alias(name)
    value = F.variant_get("record", place, "variant")
    read = F.coalesce(F.try_variant_get("record", place, "string"), F.to_json(value))
    return F.when(~F.is_variant_null(value), read).alias(name)


def _text_leaves(kind: T.DataType) -> T.DataType:
    """A type with text in place of plain values; as a whole text where values of several kinds meet."""
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, _text_leaves(f.dataType)) for f in kind.fields]
        return T.StringType() if any(isinstance(f.dataType, T.VariantType) for f in kind.fields) else T.StructType(fields)
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.VariantType):
        return T.ArrayType(_text_leaves(kind.elementType))
    return T.StringType()


def found_schema(staged: DataFrame, required: str | T.StructType) -> T.StructType:
    """The required columns as given and every other field of the records of a written table, plain values as text."""
    wanted = _struct(required)
    row = staged.agg(F.schema_of_variant_agg("record")).first()
    described = T.StructType.fromDDL("record " + re.sub(r"\bOBJECT<", "struct<", row[0])) if row and row[0] else None
    seen = described["record"].dataType if described else None
    if not isinstance(seen, T.StructType):
        return wanted
    more = [T.StructField(f.name, _text_leaves(f.dataType)) for f in seen.fields if f.name not in wanted.names]
    return T.StructType([*wanted.fields, *more])


def _columns(schema: T.StructType) -> list[Column]:
    return [_field(f.name, f.dataType) for f in schema.fields]


def scan_json_records(
    spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = True
) -> DataFrame:
    """Rows of all page files under ``path``; a page is one JSON array of records.

    With ``multi_line=False`` a file holds one record per line and is splittable.
    """
    return record_variants(spark, path, multi_line).select(*_columns(_struct(schema)))


def scan_json_envelope(
    spark: SparkSession, path: str, record_schema: str | T.StructType, keep_all: bool = False
) -> DataFrame:
    """Records of payloads shaped ``{"Header": [{"status"}], "Data": [records]}``.

    ``keep_all`` adds whatever else the records hold, as text. Any payload whose status is given and is not ``Success`` fails the read, and
    so does a read without any record. The payloads are parsed once, into a table of variants in the shared folder,
    and counted while that is written; columns are found and taken there.
    """
    envelope = "struct<Header: array<struct<status: string>>, Data: array<variant>>"
    payloads = _texts(spark, path, True).select(F.from_json("value", envelope, _FAILFAST).alias("p")).select("p.*")
    status = F.get("Header", F.lit(0))["status"]
    seen = Observation()
    # a missing or empty status is no failure
    counted = payloads.observe(
        seen,
        F.count_if(F.coalesce(status, F.lit("")).isin("", "Success") == F.lit(False)).alias("failed"),
        F.sum(F.when(F.col("Data").isNotNull(), F.size("Data")).otherwise(0)).alias("records"),
    )
    staged = materialize(counted.select(F.explode("Data").alias("record")), "records")
    if seen.get["failed"]:
        raise RuntimeError(f"{seen.get['failed']} payloads under {path} report a failed request")
    if not seen.get["records"]:
        raise ValueError(f"the payloads under {path} hold no records")
    return staged.select(*_columns(found_schema(staged, record_schema) if keep_all else _struct(record_schema)))


def json_explode_nested(
    df: DataFrame, record_col: str, meta: Sequence[str], prefix: str | None = None
) -> DataFrame:
    """One row per element of a list of objects; an empty or null list gives none."""
    prefix = f"{record_col}_" if prefix is None else prefix
    fields = df.schema[record_col].dataType.elementType.names
    exploded = df.select(*meta, F.explode(record_col).alias("__element"))
    return exploded.select(*meta, *[F.col("__element")[f].alias(f"{prefix}{f}") for f in fields])


def json_first_element(column: str, field: str) -> Column:
    """A field of the first list element; null for an empty or missing list."""
    return F.get(column, F.lit(0))[field]


def struct_field_or_self(column: str, field: str) -> Column:
    """A field of a JSON object, or the text itself when it is not an object."""
    text = F.col(column)
    is_object = F.ltrim(text).startswith("{")
    return F.when(is_object, F.get_json_object(text, f"$.{field}")).otherwise(text)


def scan_mutation_records(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """Mutation calls with the gene given by symbol; no calls at all is an error.

    Without a schema the records keep all their columns. Pages are parsed once, into a table of variants in the shared
    folder, where the columns are found. A ``gene`` object is read as its JSON text, so objects and plain symbols may mix.
    """
    staged = materialize(record_variants(spark, path, multi_line), "records")
    guard_not_empty(staged, f"mutation records under {path}")
    wanted = found_schema(staged, MUTATION_SCHEMA) if schema is None else _struct(schema)
    return staged.select(*_columns(wanted)).withColumn("gene", struct_field_or_self("gene", "hugoGeneSymbol"))


def scan_eav_clinical(
    spark: SparkSession, sample_path: str, patient_path: str | None = None, multi_line: bool = True
) -> DataFrame:
    """Sample attributes plus each patient attribute repeated on every sample.

    The samples are needed twice and parsed once: they are written to the shared folder first.
    """
    samples = materialize(scan_json_records(spark, sample_path, SAMPLE_SCHEMA, multi_line), "samples")
    guard_not_empty(samples, f"clinical records under {sample_path}")
    if patient_path is None:
        return samples
    patients = scan_json_records(spark, patient_path, PATIENT_SCHEMA, multi_line)
    spread = join_broadcast_attributes(samples, patients, "patientId", "sampleId")
    return samples.unionByName(spread.select(*EAV_COLUMNS))
