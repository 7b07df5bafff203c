"""Token counts of documents in flat token files that have no index.

A token file is a run of fixed-width ids; a document ends with the end-of-document id. Tasks read fixed blocks of the
files and find the ends by one vectorised comparison. A prefix scan over the blocks (documents before, last end before)
then stitches the documents that cross block boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.files import attempt_name, new_folder, open_input, open_output
from cohortloom.llm.text import bounded_batches
from cohortloom.llm.tokens import tokenizer
from cohortloom.runtime import materialize

BLOCK_BYTES = 4 << 20
FILE_BYTES = 256 << 20
BLOCKS_A_SPAN = 1024
SCAN_TASKS = 100_000


def write_token_files(
    df: DataFrame,
    tokenizer_path: str,
    end_id: int,
    text_col: str = "text",
    carry: Sequence[str] = ("doc_id",),
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Tokenise documents into flat files of 16-bit little-endian ids, ``end_id`` after each document.

    Returns the written table of contents: ``path``, ``ordinal`` (place of the document in its file, from 0) and the
    carried columns. Every attempt of a task writes files of its own, and only those in the table count. Texts cannot
    hold ``end_id``: the strings of special tokens are ordinary text here. A null or empty text is an empty document.
    """
    bounded_batches(df.sparkSession)
    folder = new_folder(df.sparkSession, "tokens")
    base = df.select(*dict.fromkeys([*[f"`{c}`" for c in carry], f"`{text_col}`"]))
    names, carried = base.columns, list(carry)
    kinds = base.select(*[f"`{c}`" for c in carried]).schema.fields
    end = np.array([end_id], "<u2").tobytes()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path, special_as_text=True).ids
        out, path, size, ordinal = None, "", 0, 0
        for batch in batches:
            paths, ordinals = [], []
            for text in batch.column(names.index(text_col)).to_pylist():
                if out is None or size >= file_bytes:
                    if out is not None:
                        out.close()
                    path = attempt_name(folder, "tokens", ".u16")
                    out, size, ordinal = open_output(path), 0, 0
                wide = np.frombuffer(encode(text or ""), "<u4")
                if wide.size and int(wide.max()) > 0xFFFF:
                    raise ValueError("the vocabulary does not fit 16-bit ids")
                size += out.write(wide.astype("<u2").tobytes() + end)
                paths.append(path)
                ordinals.append(ordinal)
                ordinal += 1
            kept = [batch.column(names.index(c)) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(ordinals, pa.int64()), *kept], ["path", "ordinal", *carried]
            )
        if out is not None:
            out.close()

    schema = T.StructType([*T._parse_datatype_string("path string, ordinal long").fields, *kinds])
    return materialize(base.mapInArrow(written, schema), "contents")


def token_blocks(spark: SparkSession, paths: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(``path``, ``block``, ``begin``, ``length``) of every block of the files in the column ``path``."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            sizes = []
            for path in found:
                with open_input(path) as f:
                    sizes.append(f.size())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes"])

    files = paths.select("path").distinct().mapInArrow(sized, "path string, bytes long")
    # an empty file has no block
    starts = F.when(F.col("bytes") > 0, F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(block_bytes)))
    return (
        files.select("path", "bytes", F.posexplode(starts).alias("block", "begin"))
        .withColumn("length", F.least(F.lit(block_bytes), F.col("bytes") - F.col("begin")))
        .select("path", "block", "begin", "length")
    )


def scan_ends(blocks: DataFrame, end_id: int, dtype: str) -> DataFrame:
    """Per block the positions (in ids, within the file) of the end-of-document id, and its number of ids."""
    width = np.dtype(dtype).itemsize

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block, begin, length in zip(*[c.to_pylist() for c in batch.columns]):
                if length % width:
                    raise ValueError(f"{path} does not hold whole ids")
                with open_input(path) as f:
                    f.seek(begin)
                    ids = np.frombuffer(f.read(length), dtype)
                if len(ids) * width != length:
                    raise ValueError(f"{path} ended early")
                ends = np.flatnonzero(ids == end_id) + begin // width
                row = [[path], [block], [begin // width + len(ids)], [ends]]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(row, kinds)], ["path", "block", "stop", "ends"]
                )

    return blocks.mapInArrow(scanned, "path string, block long, stop long, ends array<long>")


def count_tokens(
    spark: SparkSession,
    paths: DataFrame,
    end_id: int,
    dtype: str = "<u2",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document of the flat token files named in ``paths.path``.

    ``path``, ``ordinal`` (place in the file, from 0), ``first`` (where it begins, in ids), ``n_tokens`` (without the
    separator) and ``terminated``; ids behind the last separator of a file are one more document, not terminated. Two
    separators in a row hold an empty document; an empty file holds none. ``block_bytes`` must be a multiple of the
    width of an id. A task holds one block. The scan over blocks runs within spans of 1,024 blocks and then over the
    spans, so that one huge file does not become one task's window.
    """
    if block_bytes % np.dtype(dtype).itemsize:
        raise ValueError("a block must hold whole ids")
    blocks = materialize(token_blocks(spark, paths, block_bytes), "blocks")
    tasks = max(1, min(SCAN_TASKS, blocks.count()))
    found = materialize(scan_ends(blocks.repartition(tasks), end_id, dtype), "ends")
    sums = found.select(
        "path",
        "block",
        F.floor(F.col("block") / BLOCKS_A_SPAN).alias("span"),
        F.size("ends").cast("long").alias("n"),
        F.get("ends", F.size("ends") - 1).alias("last"),
    )
    inside = Window.partitionBy("path", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("path").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        sums.groupBy("path", "span")
        .agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        .select(
            "path",
            "span",
            F.coalesce(F.sum("n").over(across), F.lit(0)).alias("span_n"),
            F.max("last").over(across).alias("span_last"),
        )
    )
    before = (
        sums.withColumn("docs_before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .withColumn("last_before", F.max("last").over(inside))
        .join(spans, ["path", "span"])
        .select(
            "path",
            "block",
            (F.col("docs_before") + F.col("span_n")).alias("docs_before"),
            F.coalesce("last_before", "span_last", F.lit(-1)).alias("last_before"),
        )
    )
    stitched = found.join(before, ["path", "block"])
    begins = F.transform(
        F.concat(F.array("last_before"), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0)))), lambda p: p + 1
    )
    docs = (
        stitched.filter(F.size("ends") > 0)
        .select("path", "docs_before", F.posexplode(F.arrays_zip(begins.alias("b"), F.col("ends").alias("e"))))
        .select(
            "path",
            (F.col("docs_before") + F.col("pos")).alias("ordinal"),
            F.col("col.b").alias("first"),
            (F.col("col.e") - F.col("col.b")).alias("n_tokens"),
            F.lit(True).alias("terminated"),
        )
    )
    tails = (
        found.groupBy("path")
        .agg(
            F.sum(F.size("ends")).cast("long").alias("ordinal"),
            (F.coalesce(F.max(F.get("ends", F.size("ends") - 1)), F.lit(-1)) + 1).alias("first"),
            F.max("stop").alias("stop"),
        )
        .filter(F.col("stop") > F.col("first"))
        .select("path", "ordinal", "first", (F.col("stop") - F.col("first")).alias("n_tokens"), F.lit(False).alias("terminated"))
    )
    return docs.unionByName(tails)
