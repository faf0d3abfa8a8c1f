"""Named tables: create or replace, load, expose to SQL, list and drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zerotally import fixed
from zerotally.operators.ranking import with_row_id


def save_table(df: DataFrame, name: str, add_id: bool = False, order: list[str] | None = None,
               path: str | None = None) -> None:
    """Create or replace a table, in the warehouse or at `path`.

    `add_id` appends a 0-based `row_id` in the given order.
    """
    if add_id:
        df = with_row_id(df, order or [fixed.ID])
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def load_table(spark: SparkSession, name: str, exclude: list[str] | None = None) -> DataFrame:
    """The table without the excluded columns; rows carry no order until a sink asks for one."""
    return spark.table(name).drop(*(exclude or []))


def register(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def unregister(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
