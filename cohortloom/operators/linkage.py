"""Deterministic linkage of the same person across sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.deident import salted_key
from cohortloom.operators.connected import connected_components
from cohortloom.operators.reshape import union_by_name
from cohortloom.runtime import any_of, materialize

KEY = "_blocking_key"


def build_blocking_key(
    df: DataFrame,
    sex_col: str,
    birth_year_col: str,
    zip_col: str,
    extra_cols: Sequence[str] = (),
    null_policy: str = "skip",
) -> DataFrame:
    """Add ``sex|birth year|zip3``, followed by any extra parts.

    ``null_policy="skip"`` leaves absent parts out; ``"null"`` gives no key at all
    when a part is absent, so that incomplete records never link.
    """
    parts = [F.col(sex_col), F.col(birth_year_col).cast("string"), F.substring(zip_col, 1, 3)]
    parts += [F.col(c).cast("string") for c in extra_cols]
    if null_policy == "skip":
        key = F.concat_ws("|", *parts)
    elif null_policy == "null":
        key = F.concat(*[x for i, p in enumerate(parts) for x in ((F.lit("|"), p) if i else (p,))])
    else:
        raise ValueError(f"unknown null policy {null_policy!r}")
    return df.withColumn(KEY, key)


def assign_master_patient_id(
    *sources: tuple[DataFrame, str], salt: str, dedupe: bool = False
) -> DataFrame:
    """Lookup of (source, id in the source) to a master id shared by equal keys.

    The master id is a salted hash of the key: a rerun gives the same ids.
    """
    records = union_by_name([(df.select(KEY, "_source_patient_id"), name) for df, name in sources], "_source_name")
    linked = records.withColumn("master_patient_id", salted_key(KEY, salt)).select(
        "_source_name", "_source_patient_id", "master_patient_id", KEY
    )
    return linked.distinct() if dedupe else linked


def link_by_any_key(*sources: tuple[DataFrame, str], keys: Sequence[str], salt: str) -> DataFrame:
    """Lookup of (source, id in the source) to a master id shared by all records that some chain of equal keys joins.

    Every source has ``_source_patient_id`` and the columns ``keys``, one per kind of key; a null key links nothing, and
    keys of different kinds never meet. Keys form a graph in which a record links its least key to its others, so a key
    that a great many records hold makes no pairs. The master id is a salted hash of the least key of the component (of
    the record itself where it has none): it is the same on every rerun and does not depend on the order of the sources.
    """
    ids = ["_source_name", "_source_patient_id"]
    tagged = union_by_name([(df.select("_source_patient_id", *keys), name) for df, name in sources], "_source_name")
    named = {f"__{i}": F.concat(F.lit(f"key{i:03d}\x1f"), F.col(k).cast("string")) for i, k in enumerate(keys)}
    held = materialize(tagged.select(*ids, *[key.alias(c) for c, key in named.items()]), "held")
    # a record may have several rows: all its keys are linked, those between the least and the last of a kind further down
    ends = held.groupBy(*ids).agg(*[f(c).alias(f"{c}{f.__name__}") for c in named for f in (F.min, F.max)])
    of_kind = [(F.col(f"{c}min"), F.col(f"{c}max")) for c in named]
    several = F.coalesce(any_of([low != high for low, high in of_kind]), F.lit(False))
    keys_held = F.array_distinct(F.array_compact(F.array(*[end for both in of_kind for end in both])))
    records = materialize(ends.select(*ids, keys_held.alias("held"), several.alias("several")), "records")
    least = F.get("held", F.lit(0))
    own = F.concat_ws("\x1f", F.lit("record"), *[F.col(c).cast("string") for c in ids])
    links = records.select(least.alias("a"), F.explode(F.slice("held", 2, F.greatest(F.size("held"), F.lit(1)))).alias("b"))
    many = records.filter("several").select(own.alias("record"), least.alias("a"))
    if not many.isEmpty():
        rows = held.select(own.alias("record"), F.explode(F.array_compact(F.array(*named))).alias("b"))
        links = links.unionByName(rows.join(materialize(many, "several"), "record").select("a", "b"))
    roots = connected_components(links)
    # kinds of keys sort before records, so a component's root is a key
    joined = records.select(*ids, F.coalesce(least, own).alias("node")).join(roots, "node", "left")
    return joined.withColumn("__root", F.coalesce("root", "node")).select(*ids, salted_key("__root", salt).alias("master_patient_id"))
