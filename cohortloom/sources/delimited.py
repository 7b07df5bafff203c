"""Tab-separated and fixed-width files, and which file a row came from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import defaults
from cohortloom.operators.guards import guard_not_empty
from cohortloom.runtime import materialize

# what a count file must have; further columns are kept
COUNT_SCHEMA = (
    "gene_id string, gene_name string, gene_type string, unstranded long, stranded_first long, "
    "stranded_second long, tpm_unstranded double, fpkm_unstranded double"
)
BETA_SCHEMA = "probe_id string, beta_value double"
FILE_STEM = r"([^/]+?)(?:\.[^/]*)?$"
FILE_FOLDER = r"([^/]+)/[^/]+$"


def file_id_of(pattern: str = FILE_STEM) -> Column:
    """Id of the file a row was read from: its name up to the first dot by default."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def scan_count_tsv(
    spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType = COUNT_SCHEMA, file_id: str = FILE_STEM
) -> DataFrame:
    """Expression count files: comment line, header line, summary rows, gene rows.

    Every file is read by its own header, so columns may stand in any order. The columns of ``schema`` must be there;
    what else some file has is kept, measures (``tpm_*``, ``fpkm_*``) as numbers and the rest as text. All rows are
    kept, and a value that does not fit its type fails the read. The lines are read once, into a table in the shared
    folder, where headers are found: the lines that begin with the schema's first column. The places of the columns are
    looked up once per file; the driver learns the names of the columns only.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = (
        spark.read.option("recursiveFileLookup", True)
        .text(path if isinstance(path, str) else list(path))
        .select("value", F.col("_metadata.file_path").alias("__file"), file_id_of(file_id).alias("file_id"))
    )
    is_header = F.col("value").startswith(f"{wanted.names[0]}\t")
    # sorted by nothing: lines stay in the order of their files, whose names compress to nearly nothing
    lines = materialize(raw.filter((F.trim("value") != "") & ~F.col("value").startswith("#")), "lines")
    first = lines.filter(is_header).groupBy("__file").agg(F.first("value").alias("header"))
    headers = materialize(first.select("__file", F.split("header", "\t", -1).alias("names")), "headers")
    lacking = headers.select(F.array_except(F.lit(wanted.names), "names").alias("lacking")).filter(F.size("lacking") > 0).first()
    if lacking:
        raise ValueError(f"count files lack the columns {lacking['lacking']}")
    rows = lines.filter(~is_header)
    if not lines.select("__file").distinct().join(headers, "__file", "left_anti").isEmpty():
        raise ValueError("count files without the header they must have")
    seen = {r["name"] for r in headers.select(F.explode("names").alias("name")).distinct().collect()}
    measure = ("tpm_", "fpkm_")
    kinds = [(f.name, f.dataType) for f in wanted]
    kinds += [(n, T.DoubleType() if n.startswith(measure) else T.StringType()) for n in sorted(seen - set(wanted.names))]
    # the places of all columns in a file's rows, behind the last where it lacks one
    absent = F.lit(1 << 20)
    at = [F.coalesce(F.nullif(F.array_position("names", n).cast("int"), F.lit(0)) - 1, absent) for n, _ in kinds]
    places = materialize(headers.select("__file", F.array(*at).alias("__at")), "places")

    def field(i: int, name: str, kind: T.DataType) -> Column:
        text = F.get("__held", F.get("__at", F.lit(i)))
        # few fields are quoted, and only those need the expression
        bare = F.when(text.startswith('"'), F.regexp_replace(text, '^"(.*)"$', "$1")).otherwise(text)
        return F.nullif(bare, F.lit("")).cast(kind).alias(name)

    held = rows.select("file_id", "__file", F.split("value", "\t", -1).alias("__held")).join(places, "__file")
    return held.select(*[field(i, n, k) for i, (n, k) in enumerate(kinds)], "file_id")


def scan_beta_tsv(
    spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType = BETA_SCHEMA, file_id: str = FILE_STEM
) -> DataFrame:
    """Headerless two-column files of probe and beta value; ``NA`` is a missing value."""
    rows = spark.read.csv(
        path if isinstance(path, str) else list(path),
        schema=schema, sep="\t", comment="#", nullValue="NA",
        recursiveFileLookup=True,
    )
    return rows.select("*", file_id_of(file_id).alias("file_id"))


def tag_file_lineage(rows: DataFrame, metadata: DataFrame, columns: Sequence[str], file_id_col: str = "file_id") -> DataFrame:
    """Add the given metadata columns to the rows of each listed file.

    A file listed once per case gives its rows once per case; files that are not
    listed are dropped.
    """
    listing = metadata.select(file_id_col, *[c for c in columns if c != file_id_col])
    return rows.join(materialize(listing, "listing"), file_id_col, "inner")


def file_metadata_filter(
    metadata: DataFrame,
    project_id: str,
    data_category: str,
    data_format: str | None = None,
    access: str | None = "open",
    size: int | None = None,
    extra: Column | None = None,
    file_id_col: str = "file_id",
) -> DataFrame:
    """Files of a project and category; all of them, or the first ``size`` entries."""
    keep = (F.col("project_id") == project_id) & (F.col("data_category") == data_category)
    if data_format:
        keep = keep & F.col("data_format").isin(data_format.upper(), data_format.lower())
    if access:
        keep = keep & (F.col("access") == access)
    if extra is not None:
        keep = keep & extra
    chosen = metadata.filter(keep)
    return chosen if size is None else limit_files(chosen, size, file_id_col)


def limit_files(metadata: DataFrame, n: int, file_id_col: str = "file_id") -> DataFrame:
    """The first ``n`` entries of a file listing by id, the entries of one file by the rest."""
    rest = [f.name for f in metadata.schema.fields if f.name != file_id_col and not isinstance(f.dataType, T.MapType)]
    return metadata.orderBy(file_id_col, *[F.col(f"`{c}`") for c in rest]).limit(n)


def date_lookback_range(
    df: DataFrame,
    date_col: str,
    end: dt.date,
    days: int = defaults.LOOKBACK_DAYS,
    places: DataFrame | None = None,
    place_cols: Sequence[str] = ("state_code", "county_code"),
) -> DataFrame:
    """Rows dated from ``days`` before ``end`` up to ``end``, of the listed places."""
    begin = end - dt.timedelta(days=days)
    kind = df.schema[date_col].dataType
    if isinstance(kind, T.StringType):
        inside = F.col(date_col).between(begin.isoformat(), end.isoformat())
    elif isinstance(kind, T.DateType):
        inside = F.col(date_col).between(F.lit(begin), F.lit(end))
    else:
        after = end + dt.timedelta(days=1)
        inside = (F.col(date_col) >= F.lit(begin)) & (F.col(date_col) < F.lit(after))
    chosen = df.filter(inside)
    return chosen if places is None else chosen.join(
        materialize(places.select(*place_cols), "places"), list(place_cols), "left_semi"
    )


def fixed_width_columns(
    layout: Sequence[tuple[str, int, int] | Mapping], line_col: str = "value", na_values: Sequence[str] = ()
) -> list[Column]:
    """Text fields cut from a line by 1-based inclusive positions; blank is null.

    A field is (name, start, end), or a mapping with these keys as a layout file gives it.
    """
    fields = []
    for entry in layout:
        name, start, end = (entry[k] for k in ("name", "start", "end")) if isinstance(entry, Mapping) else entry
        text = F.nullif(F.trim(F.substring(line_col, start, end - start + 1), F.lit(" \t")), F.lit(""))
        if na_values:
            text = F.when(~text.isin(list(na_values)), text)
        fields.append(text.alias(name))
    return fields


def scan_fixed_width(
    spark: SparkSession,
    path: str,
    layout: Sequence[tuple[str, int, int] | Mapping] = tuple(defaults.REGISTRY_LAYOUT),
    na_values: Sequence[str] = (),
) -> DataFrame:
    """A fixed-width extract as string columns; blank lines are skipped."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    guard_not_empty(lines, f"the extract {path}")
    return lines.select(*fixed_width_columns(layout, "value", na_values))
