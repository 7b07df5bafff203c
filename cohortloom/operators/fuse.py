"""Fusion of per-patient blocks with a flag for each block that a patient has."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.runtime import any_of, bucketed


def has_flag(name: str) -> str:
    return f"has_{name}_data"


def fuse_modalities(
    modalities: dict[str, DataFrame],
    id_col: str = "patient_key",
    check_unique: bool = True,
    repeated: str | None = None,
) -> DataFrame:
    """Full outer join of all modalities on one id, plus ``has_<name>_data`` flags.

    A patient of any modality appears; columns of a modality they lack are null. A
    flag is true when any column of that modality is not null. A column name used by
    two modalities is prefixed by the modality's name. Null ids match nothing.

    Every modality has one row per id; only ``repeated`` may hold several, and the
    other modalities are then repeated on each of its rows. A modality is read more
    than once, so it should be a stored table.
    """
    if not modalities:
        raise ValueError("no modalities given")
    blocks = _blocks(modalities, id_col)
    if check_unique:
        _check_unique(blocks, id_col, repeated)
    known = {name: block.filter(F.col(id_col).isNotNull()) for name, block in blocks.items()}
    if check_unique and repeated is None:
        joined = _grouped(known, id_col)
    else:
        joined = _joined(known, id_col, repeated or next(iter(blocks)))
    for block in blocks.values():
        joined = joined.unionByName(block.filter(F.col(id_col).isNull()), allowMissingColumns=True)

    flags = {has_flag(n): F.coalesce(F.col(has_flag(n)), F.lit(False)) for n in blocks}
    columns = [c for block in blocks.values() for c in block.columns if c != id_col and c not in flags]
    return joined.withColumns(flags).select(id_col, *columns, *flags)


def bucket_modalities(modalities: dict[str, DataFrame], id_col: str = "patient_key", buckets: int | None = None) -> dict[str, DataFrame]:
    """The modalities, written once in equal hash buckets of the id, to be fused any number of times without a shuffle.

    ``buckets`` is the session's number of shuffle partitions unless given; choose it by the size of the largest block.
    """
    some = next(iter(modalities.values())).sparkSession
    n = buckets or int(some.conf.get("spark.sql.shuffle.partitions"))
    return {name: bucketed(df, [id_col], n, "modality") for name, df in modalities.items()}


def fuse_bucketed(modalities: dict[str, DataFrame], id_col: str = "patient_key", buckets: int | None = None) -> DataFrame:
    """:func:`fuse_modalities` of modalities from :func:`bucket_modalities`, with the same rows.

    The ids of all are written in buckets, too; every modality is then a left join of tables in equal buckets, which no
    exchange precedes. A modality may hold several rows of an id; its rows are then combined with those of the others.
    """
    if not modalities:
        raise ValueError("no modalities given")
    blocks = _blocks(modalities, id_col)
    known = [block.select(id_col).filter(F.col(id_col).isNotNull()) for block in blocks.values()]
    some = known[0].sparkSession
    n = buckets or int(some.conf.get("spark.sql.shuffle.partitions"))
    joined = bucketed(functools.reduce(DataFrame.union, known).distinct(), [id_col], n, "ids")
    for block in blocks.values():
        joined = joined.join(block.hint("merge"), id_col, "left")
    for block in blocks.values():
        joined = joined.unionByName(block.filter(F.col(id_col).isNull()), allowMissingColumns=True)
    flags = {has_flag(name): F.coalesce(F.col(has_flag(name)), F.lit(False)) for name in blocks}
    columns = [c for block in blocks.values() for c in block.columns if c != id_col and c not in flags]
    return joined.withColumns(flags).select(id_col, *columns, *flags)


def _grouped(known: dict[str, DataFrame], id_col: str) -> DataFrame:
    """With one row per id and modality the join is a union grouped by id: one shuffle."""
    stacked = None
    for block in known.values():
        stacked = block if stacked is None else stacked.unionByName(block, allowMissingColumns=True)
    values = [F.first(c, ignorenulls=True).alias(c) for c in stacked.columns if c != id_col]
    return stacked.groupBy(id_col).agg(*values)


def _joined(known: dict[str, DataFrame], id_col: str, lead: str) -> DataFrame:
    """Left joins from the rows of ``lead`` and the ids it lacks. A left join keeps the
    partitioning of its left side, so no joined result is shuffled again."""
    ids = None
    for name, block in known.items():
        if name != lead:
            part = block.select(id_col)
            ids = part if ids is None else ids.union(part)
    joined = known[lead]
    if ids is not None:
        missing = ids.distinct().join(known[lead].select(id_col), id_col, "left_anti")
        joined = joined.unionByName(missing, allowMissingColumns=True)
    for name, block in known.items():
        if name != lead:
            joined = joined.join(block, id_col, "left")
    return joined


def _blocks(modalities: dict[str, DataFrame], id_col: str) -> dict[str, DataFrame]:
    uses: dict[str, int] = {}
    for df in modalities.values():
        for c in df.columns:
            uses[c] = uses.get(c, 0) + 1
    blocks = {}
    for name, df in modalities.items():
        data = [c for c in df.columns if c != id_col]
        if not data:
            raise ValueError(f"modality {name!r} has no column besides {id_col!r}")
        flag = any_of([F.col(c).isNotNull() for c in data]).alias(has_flag(name))
        named = [F.col(c).alias(f"{name}_{c}" if uses[c] > 1 else c) for c in data]
        blocks[name] = df.select(id_col, *named, flag)
    return blocks


def _check_unique(blocks: dict[str, DataFrame], id_col: str, repeated: str | None) -> None:
    """Refuse a modality with several rows for one id: one grouped pass over ids."""
    tagged = None
    for name, block in blocks.items():
        if name != repeated:
            part = block.select(id_col, F.lit(name).alias("__name"))
            tagged = part if tagged is None else tagged.union(part)
    if tagged is None:
        return
    several = (
        tagged.filter(F.col(id_col).isNotNull())
        .groupBy("__name", id_col)
        .count()
        .filter("count > 1")
        .groupBy("__name")
        .count()
    )
    bad = {row["__name"]: row["count"] for row in several.collect()}  # one row per modality
    if bad:
        raise ValueError(f"several rows for one {id_col}: {bad}")


join_full_outer_nway = fuse_modalities
