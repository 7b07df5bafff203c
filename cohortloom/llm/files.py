"""Binary files in the shared folder, opened inside tasks by any address that names a store."""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from cohortloom.runtime import scratch_path


def _located(address: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path in it. Hadoop writes local addresses with one slash."""
    address = re.sub(r"\Afile:/+", "/", address)
    return pafs.FileSystem.from_uri(address)


def open_input(address: str) -> pafs.FileSystem:
    store, path = _located(address)
    return store.open_input_file(path)


def open_output(address: str):
    store, path = _located(address)
    return store.open_output_stream(path, compression=None)


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared space; it exists when this returns."""
    address = scratch_path(spark, label)
    store, path = _located(address)
    store.create_dir(path, recursive=True)
    return address


def attempt_name(folder: str, label: str, suffix: str) -> str:
    """A name no other attempt of any task uses, so a repeated task never writes into a file that counts."""
    return f"{folder}/{label}-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"
