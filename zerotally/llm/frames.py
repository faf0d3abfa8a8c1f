"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def fold_of(c: Column) -> Column:
    """crc32 of the id as text, mod 5; 0 is the held-out fold. A null id counts as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5


def binary_text(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of every value, one at a time; null gives the empty text."""
    for value in batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()):
        yield value.as_py() or b""
