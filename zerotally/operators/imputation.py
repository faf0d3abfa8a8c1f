"""Filling the e-delivery flag from its nearest labelled neighbours."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.functions.scalars import indicator, known_flag
from zerotally.operators.encoder import scaling
from zerotally.operators.neighbours import TILE_ROWS, TileIndex, build_index, majority_label
from zerotally.operators.segments import labelled, unlabelled

GEO_DUMMIES = {level: f"geo_{level}" for level in fixed.GEO_LEVELS}
DISCRETE = [*fixed.KNN_FLAGS, *GEO_DUMMIES.values()]


def geo_dummies() -> list[Column]:
    """One 0/1 column per fixed geo level; none is dropped."""
    return [indicator(F.col("geo_group") == level).alias(name) for level, name in GEO_DUMMIES.items()]


def knn_features(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    """Id, known flag, four standardised numerics, two raw flags and the geo dummies."""
    numeric = [((F.col(c) - F.lit(scales[c][0])) / F.lit(scales[c][1])).alias(c) for c in fixed.KNN_NUMERIC]
    return df.select(fixed.ID, known_flag().alias("label"), *numeric, *fixed.KNN_FLAGS, *geo_dummies())


def fill_from(df: DataFrame, imputed: DataFrame) -> DataFrame:
    """Replace the sentinel by the imputed value, in `pol_edeliv_ind_filled`.

    Only the sentinel rows are joined; all others pass straight through without a shuffle.
    """
    flag = F.col(fixed.IMPUTED)
    missing = flag == fixed.SENTINEL
    through = df.where(~missing | flag.isNull()).withColumn(fixed.FILLED, flag).drop(fixed.IMPUTED)
    filled = (df.where(missing).join(imputed.select(fixed.ID, F.col("imputed").alias(fixed.FILLED)),
                                     fixed.ID, "left").drop(fixed.IMPUTED))
    return through.unionByName(filled)


@dataclass(frozen=True)
class Imputer:
    """Index of the labelled training rows and their scaling; both stay as they were at fit."""
    index: TileIndex
    scales: dict[str, tuple[float, float]]

    def neighbours(self, df: DataFrame) -> DataFrame:
        return self.index.search(knn_features(unlabelled(df), self.scales), fixed.ID)

    def predict(self, df: DataFrame) -> DataFrame:
        """`id, imputed` for the rows without a known flag."""
        return majority_label(self.neighbours(df), fixed.ID, "imputed")

    def apply(self, df: DataFrame) -> DataFrame:
        return fill_from(df, self.predict(df))

    def save(self, spark: SparkSession, path: str) -> None:
        self.index.save(spark, f"{path}/neighbours")
        rows = [(c, mean, sd) for c, (mean, sd) in self.scales.items()]
        spark.createDataFrame(rows, "feature string, mean double, sd double").coalesce(1).write.mode("overwrite").parquet(f"{path}/scales")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Imputer":
        scales = {r["feature"]: (r["mean"], r["sd"]) for r in spark.read.parquet(f"{path}/scales").collect()}
        return Imputer(TileIndex.load(spark, f"{path}/neighbours"), scales)


def fit_imputer(train: DataFrame, k: int = fixed.NEIGHBOURS, tile_rows: int = TILE_ROWS) -> Imputer:
    """Scaling comes from the labelled training rows only."""
    reference = labelled(train)
    scales = scaling(reference, fixed.KNN_NUMERIC)
    index = build_index(knn_features(reference, scales), fixed.KNN_NUMERIC, DISCRETE, k, fixed.ID, "label", tile_rows)
    return Imputer(index, scales)


def fit_impute(train: DataFrame, k: int = fixed.NEIGHBOURS) -> tuple[DataFrame, Imputer]:
    imputer = fit_imputer(train, k)
    return imputer.apply(train), imputer
