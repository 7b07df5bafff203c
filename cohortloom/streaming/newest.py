"""The recurring re-ingest with state: slices look back and overlap, and of each reading the newest slice counts.

A run reads only the slices that came since the last one. What a key was last seen with is held as state, and given up
once the watermark says that no look-back reaches it any more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cohortloom import defaults
from cohortloom.sources.layers import SLICE, scan_layer

BATCH = "stream_batch"
KEEP_DAYS = 2 * defaults.LOOKBACK_DAYS
_DAY_MS = 86_400_000


def follow_slices(
    spark: SparkSession,
    bronze_path: str,
    newest_path: str,
    state_path: str,
    key: Sequence[str],
    date_col: str = "date_local",
    keep_days: int = KEEP_DAYS,
) -> None:
    """Bring the table of newest readings up to date with the slices that a bronze table got since the last run.

    ``key`` names a reading and holds ``date_col``. A key whose rows come in a newer slice than before, or in the same
    one, gets them written anew, whole; rows of an older slice change nothing. Each micro-batch owns a folder of the
    table and replaces only that, so a repeated batch leaves one copy. State is kept for ``keep_days`` behind the newest
    date seen, and readings older than that are dropped as too late. A slice must not be written twice.
    """
    schema = scan_layer(spark, bronze_path).schema
    keys = [c for c in key if c in schema.names]
    if date_col not in keys:
        raise ValueError(f"the key must hold {date_col!r}")
    names = [f"__k{i}" for i in range(len(keys))]
    rows = (
        spark.readStream.schema(schema).parquet(bronze_path)
        .select(
            *[F.col(c).cast("string").alias(n) for c, n in zip(keys, names)],
            F.to_timestamp(date_col).alias("__at"),
            F.col(SLICE).alias("__slice"),
            F.to_json(F.struct(*[c for c in schema.names if c != SLICE]), {"ignoreNullFields": "true"}).alias("__row"),
        )
        .withWatermark("__at", f"{keep_days} days")
    )

    def newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held, seen = state.get if state.exists else ("", [])
        seen, date, changed = list(seen), 0, False
        for frame in frames:
            date = max(date, int(frame["__at"].max().timestamp() * 1000))
            for part, row in zip(frame["__slice"], frame["__row"]):
                if part > held:
                    held, seen = part, []
                if part == held:
                    seen.append(row)
                    changed = True
        state.update((held, seen))
        state.setTimeoutTimestamp(max(date + keep_days * _DAY_MS, state.getCurrentWatermarkMs() + 1))
        if changed:
            yield pd.DataFrame({**{n: [k] * len(seen) for n, k in zip(names, key)}, "__slice": held, "__row": seen})

    out = ", ".join([*[f"{n} string" for n in names], "__slice string", "__row string"])
    changes = rows.groupBy(*names).applyInPandasWithState(
        newest, out, "slice string, rows array<string>", "update", GroupStateTimeout.EventTimeTimeout
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn(BATCH, F.lit(batch_id)).write.partitionBy(BATCH).mode("overwrite")
        placed.option("partitionOverwriteMode", "dynamic").parquet(newest_path)

    (
        changes.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", state_path)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def newest_rows(spark: SparkSession, bronze_path: str, newest_path: str) -> DataFrame:
    """The rows of a bronze table as their newest slices have them, from what :func:`follow_slices` wrote."""
    schema = scan_layer(spark, bronze_path).schema
    table = spark.read.parquet(newest_path)
    names = [c for c in table.columns if c.startswith("__k")]
    rows = F.collect_list(F.struct("__slice", "__row"))
    per_batch = table.groupBy(*names, BATCH).agg(rows.alias("rows"))
    last = per_batch.groupBy(*names).agg(F.max_by("rows", BATCH).alias("rows")).select(F.inline("rows"))
    kept = T.StructType([f for f in schema.fields if f.name != SLICE])
    parsed = last.select(F.from_json("__row", kept).alias("r"), F.col("__slice").alias(SLICE))
    return parsed.select("r.*", SLICE).select(*schema.names)
