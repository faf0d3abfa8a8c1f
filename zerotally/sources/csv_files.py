"""CSV in with many NULL tokens, strict types, and sorted CSV out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerotally import fixed


def read_policies_csv(spark: SparkSession, path: str, null_tokens=fixed.NULL_TOKENS) -> DataFrame:
    """All columns as text, named by the header, every NULL token turned into NULL."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[
        F.when(~F.col(c).isin(list(null_tokens)), F.col(c)).alias(c) for c in raw.columns])


def cast_policies(df: DataFrame, has_target: bool) -> DataFrame:
    """Fixed schema by explicit casts; text that does not parse raises."""
    types = dict(fixed.POLICY_COLUMNS, **({fixed.TARGET: "int"} if has_target else {}))

    def typed(name, kind):
        c = F.col(name)
        if kind in ("int", "bigint"):
            # plain digits first, so that wide ids keep every digit; "3.0" goes by way of double
            return F.coalesce(c.try_cast(kind), F.rint(c.cast("double")).cast(kind))
        return c.cast(kind)

    return df.select(*[typed(n, k).alias(n) for n, k in types.items()])


def write_predictions(df: DataFrame, path: str, value: str = fixed.TARGET) -> None:
    """`id,value` ordered by id across the part files."""
    df.select(fixed.ID, value).orderBy(fixed.ID).write.csv(path, header=True)


def read_predictions(spark: SparkSession, path: str, value: str = fixed.TARGET) -> DataFrame:
    return spark.read.schema(f"{fixed.ID} bigint, {value} double").option("header", True).csv(path)
