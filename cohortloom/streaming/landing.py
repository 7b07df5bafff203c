"""The recurring ingest as a stream that stops when all landed files are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators import contracts
from cohortloom.runtime import folder_entries
from cohortloom.sources.layers import SLICE, slice_dates

BATCH = "landing_batch"


def ingest_new_files(
    spark: SparkSession,
    landing_path: str,
    schema: str | T.StructType,
    table_path: str,
    state_path: str,
    ingestion_date: str,
    contract: contracts.Contract | None = None,
    file_format: str = "json",
) -> None:
    """Append the files that landed since the last run to the slice of one date.

    Spark's file source remembers in ``state_path`` which files it has read. Each
    micro-batch owns one folder of the slice and replaces only that, so a batch that
    is repeated after a failure leaves one copy: it keeps the date it had at first.
    """

    def date_of(batch_id: int) -> str:
        for day in slice_dates(spark, table_path):
            if f"{BATCH}={batch_id}" in folder_entries(spark, f"{table_path}/{SLICE}={day}"):
                return day
        return ingestion_date

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if contract is not None:
            contracts.validate(batch, contract)
        (
            batch.withColumns({SLICE: F.lit(date_of(batch_id)), BATCH: F.lit(batch_id)})
            .write.partitionBy(SLICE, BATCH)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(table_path)
        )

    stream = spark.readStream.format(file_format).schema(schema).load(landing_path)
    (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", state_path)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
