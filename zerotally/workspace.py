"""Shared scratch space: written tables that cut lineage and outlive executors, and scopes that remove them."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

_DIR_KEY = "spark.checkpoint.dir"
#: Paths made in the innermost open scope; None outside of any.
_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("zerotally_scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one only in local mode with none set."""
    named = spark.conf.get(_DIR_KEY, None) or spark.sparkContext.getConf().get(_DIR_KEY)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_DIR_KEY} to a folder all executors share")
    made = getattr(spark.sparkContext, "_zerotally_dir", None)
    if made is None:
        made = tempfile.mkdtemp(prefix="zerotally-")
        spark.sparkContext._zerotally_dir = made
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    held = _SCOPE.get()
    if held is not None:
        held.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside when the block ends or fails, those of `together`'s threads too.

    A DataFrame that reads them must be used up inside. Scopes nest; each removes its own tables.
    """
    held: list[str] = []
    token = _SCOPE.set(held)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in held:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write once as Parquet and read back: computed a single time, pruned on every reuse."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *tasks: Callable[[], Any]) -> list[Any]:
    """Run independent chains of Spark jobs from several driver threads; results in order."""
    wrap = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(contextvars.copy_context().run, wrap(t)) for t in tasks]]
