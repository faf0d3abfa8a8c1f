"""Row filters: segments, positives, rows with a known or a missing flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from zerotally import fixed
from zerotally.functions.scalars import known_flag
from zerotally.workspace import scratch_path


def segment_condition(name: str) -> Column:
    group, telematics = F.col("bi_limit_group"), F.col("telematics_ind")
    if name == "auto":
        return (group != fixed.NOT_AUTO) & (telematics != fixed.NO_TELEMATICS)
    return (group == fixed.NOT_AUTO) & (telematics == fixed.NO_TELEMATICS)


def segment(df: DataFrame, name: str) -> DataFrame:
    """One segment without the columns that say nothing there."""
    return df.where(segment_condition(name)).drop(*fixed.SEGMENT_DROPS[name])


def segment_label() -> Column:
    """'Auto', 'NonAuto', or NULL where the two markers disagree or one is NULL."""
    return F.when(segment_condition("auto"), "Auto").when(segment_condition("nonauto"), "NonAuto")


def both_segments(df: DataFrame) -> DataFrame:
    """The rows of both segments with all columns and a `segment` label; rows that fit neither are left out."""
    return df.withColumn("segment", segment_label()).where(F.col("segment").isNotNull())


def segment_counts(df: DataFrame) -> DataFrame:
    """Rows per segment and rows that fit neither, because the two markers disagree or are NULL."""
    return df.groupBy(F.coalesce(segment_label(), F.lit("Neither")).alias("segment")).agg(F.count(F.lit(1)).alias("n"))


def segment_tables(df: DataFrame) -> dict[str, DataFrame]:
    """Both segments from one write of the table, in a folder each; a segment is then read without the other's rows."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "segments")
    label = F.when(segment_condition("auto"), "auto").when(segment_condition("nonauto"), "nonauto")
    df.withColumn("_segment", label).where(F.col("_segment").isNotNull()).write.partitionBy("_segment").parquet(path)
    read = spark.read.schema(StructType([*df.schema.fields, StructField("_segment", StringType())])).parquet(path)
    return {s: read.where(F.col("_segment") == s).drop("_segment", *fixed.SEGMENT_DROPS[s]) for s in fixed.SEGMENTS}


def positives(df: DataFrame, y: str = fixed.TARGET) -> DataFrame:
    return df.where(F.col(y) > 0)


def labelled(df: DataFrame, column: str = fixed.IMPUTED) -> DataFrame:
    return df.where(known_flag(column).isNotNull())


def unlabelled(df: DataFrame, column: str = fixed.IMPUTED) -> DataFrame:
    return df.where(known_flag(column).isNull())


def union_samples(train: DataFrame, val: DataFrame) -> DataFrame:
    """All rows of both with a `Sample` column saying where each came from."""
    return (train.withColumn("Sample", F.lit("Train"))
            .unionByName(val.withColumn("Sample", F.lit("Val"))))
