"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition sorts its digests into a run and folds equal neighbours, so that a run holds a digest once, with
its count and the identifier to keep; a text that fills a third of the table is one row per run from the first level on.
Runs are cut by digest range. In every round the runs whose numbers agree but for the last binary digits that the round
covers, `FAN_IN` of them, exchange their rows and are merged in digest order as a stream: strides are 1, FAN_IN,
FAN_IN ** 2, ..., the rounds of a binomial tree taken `log2(FAN_IN)` at a time, until one run per range is left. No range
ever meets another. At each level rows that are merged must agree in byte length and in a second hash, or the job stops.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zerotally.workspace import materialise

FAN_IN = 8
RANGE_DIGITS = 3  # hex digits of the digest that name its range: 4,096 ranges
#: A run's rows: its range and number, the digest, the identifier to keep and whether there is one, count and checks.
_RUN = "range int, run int, digest binary, keep_id long, known boolean, group_size long, n_bytes long, check long"


def _words(column: pa.Array) -> np.ndarray:
    """Digests as four 64-bit words each."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 4)


def merged(largest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Fold equal neighbours of sorted rows; a digest that goes on in the next batch is held back."""
    pick, none = (np.maximum, -(1 << 63)) if largest else (np.minimum, (1 << 63) - 1)

    def fold(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = _words(batch.column(2))
        where = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        same = (words[1:] == words[:-1]).all(axis=1) & (where[0][1:] == where[0][:-1]) & (where[1][1:] == where[1][:-1])
        at = np.r_[0, 1 + np.flatnonzero(~same)]
        for name in ("n_bytes", "check"):
            x = batch.column(batch.schema.get_field_index(name)).to_numpy()
            if (same & (x[1:] != x[:-1])).any():
                raise ValueError(f"equal digests differ in {name}")
        ids = np.where(batch.column(4).to_numpy(zero_copy_only=False), batch.column(3).fill_null(none).to_numpy(), none)
        first = batch.take(pa.array(at))
        known = np.logical_or.reduceat(batch.column(4).to_numpy(zero_copy_only=False), at)
        columns = [*first.columns[:3], pa.array(pick.reduceat(ids, at)), pa.array(known),
                   pa.array(np.add.reduceat(batch.column(5).to_numpy(), at)), *first.columns[6:]]
        return pa.RecordBatch.from_arrays(columns, schema=first.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [held.cast(batch.schema), batch]).combine_chunks().to_batches()[0]
            folded = fold(rows)
            held = folded.slice(folded.num_rows - 1)
            if folded.num_rows > 1:
                yield folded.slice(0, folded.num_rows - 1)
        if held is not None:
            yield held
    return run


def document_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per document: doc_id, digest (32 bytes), n_bytes, check, run. Null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
            .select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"),
                    F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("text").alias("check"),
                    F.spark_partition_id().alias("run")))


def merge_runs(digests: DataFrame, keep: str = "largest", fan_in: int = FAN_IN) -> DataFrame:
    """One row per digest: digest, keep_id, group_size, n_bytes, check."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    last = digests.agg(F.max("run")).first()[0] or 0
    part = F.conv(F.substring(F.hex("digest"), 1, RANGE_DIGITS), 16, 10).cast("int")
    rows = digests.select(part.alias("range"), F.col("run").cast("int").alias("run"), "digest", F.col("doc_id").alias("keep_id"),
                          F.col("doc_id").isNotNull().alias("known"), F.lit(1).cast("long").alias("group_size"), "n_bytes", "check")
    fold = merged(keep == "largest")
    runs = rows.sortWithinPartitions("run", "range", "digest").mapInArrow(fold, _RUN)
    while True:
        last //= fan_in
        runs = (runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                .repartition("range", "run").sortWithinPartitions("range", "run", "digest").mapInArrow(fold, _RUN))
        if last == 0:
            return runs.select("digest", F.when(F.col("known"), F.col("keep_id")).alias("keep_id"), "group_size", "n_bytes", "check")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                 normalise: Callable[[Column], Column] | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Nulls and empty texts are one text. Rows without an id are counted in their group and stay only if the whole group
    has none. Rows that repeat the kept id are all kept, as nothing tells them apart. An empty table gives no rows.
    Other columns of `docs`, whatever their names, are not looked at.
    """
    digests = materialise(document_digests(docs, id_col, text_col, normalise), "digests")
    groups = merge_runs(digests, keep, fan_in).select("digest", "keep_id", "group_size")
    return (digests.select("doc_id", "digest").join(groups, "digest")
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))
