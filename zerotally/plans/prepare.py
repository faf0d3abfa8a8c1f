"""From the policy table to imputed, split segments and encoded model frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.operators.encoder import Encoder, fit_encoder
from zerotally.operators.imputation import Imputer, fill_from, fit_imputer
from zerotally.operators.ranking import with_sample
from zerotally.operators.segments import positives, segment, segment_tables
from zerotally.operators.views import feature_view
from zerotally.workspace import materialise, scratch_path, together


@dataclass(frozen=True)
class Prepared:
    """One segment, imputed, with `Sample` fixed once per id for every later stage."""
    name: str
    rows: DataFrame
    imputer: Imputer

    def sample(self, which: str) -> DataFrame:
        return self.rows.where(F.col("Sample") == which)

    def impute(self, unseen: DataFrame) -> DataFrame:
        """The same segment of another policy table, filled from the training neighbours."""
        return imputed(materialise(segment(unseen, self.name), "unseen"), self.imputer)

    def save(self, spark: SparkSession, path: str) -> None:
        self.rows.write.mode("overwrite").parquet(f"{path}/rows")
        self.imputer.save(spark, f"{path}/imputer")

    @staticmethod
    def load(spark: SparkSession, path: str, name: str) -> "Prepared":
        return Prepared(name, spark.read.parquet(f"{path}/rows"), Imputer.load(spark, f"{path}/imputer"))


def imputed(rows: DataFrame, imputer: Imputer) -> DataFrame:
    """A table's rows with the flag filled. Only the found ids and values are written; they are joined on every read."""
    return fill_from(rows, materialise(imputer.predict(rows), "imputed"))


def prepare_all(train: DataFrame) -> list[Prepared]:
    """All segments, prepared side by side from one write of the policy table."""
    tables = segment_tables(train)
    return together(train.sparkSession, *[lambda s=s, t=t: prepare_segment(t, s) for s, t in tables.items()])


def prepare(train: DataFrame, seg: str) -> Prepared:
    return prepare_segment(materialise(segment(train, seg), "segment"), seg)


def prepare_segment(table: DataFrame, seg: str) -> Prepared:
    """Split and imputation of a written segment table."""
    rows = with_sample(table)
    imputer = fit_imputer(rows.where(F.col("Sample") == "Train"))
    filled = imputed(rows, imputer)
    # written, as every stage reads the rows several times: the hash of the split and the join are worked out once; in a
    # folder for each sample, so that reading one does not touch the other's rows
    spark, path = table.sparkSession, scratch_path(table.sparkSession, "prepared")
    folders = {s: f"{path}/{s}" for s in ("Train", "Val")}
    together(spark, *[lambda s=s, f=f: filled.where(F.col("Sample") == s).write.parquet(f) for s, f in folders.items()])
    return Prepared(seg, spark.read.schema(filled.schema).parquet(*folders.values()), imputer)


@dataclass(frozen=True)
class Encoded:
    """Encoded rows of one stage: id, Sample, target and features in frozen order."""
    stage: str
    target: str
    encoder: Encoder
    rows: DataFrame

    def sample(self, which: str | None) -> DataFrame:
        return self.rows if which is None else self.rows.where(F.col("Sample") == which)


def stage_target(stage: str) -> str:
    return fixed.NONZERO if stage == "binary" else fixed.TARGET


def encode_stage(data: Prepared, stage: str, nominal: list[str] | None = None,
                 numeric: list[str] | None = None) -> Encoded:
    """Fit the stage's encoder on its training rows and apply it to training and validation.

    The count stage sees positive rows only. Naming `nominal` or `numeric` narrows the
    features to those.
    """
    seg, y = data.name, stage_target(stage)
    rows = positives(data.rows) if stage == "count" else data.rows
    view = feature_view(rows, stage, seg, keep=["Sample"])
    if nominal is None and numeric is None:
        nominal, numeric = fixed.NOMINAL[seg], fixed.NUMERIC[stage, seg]
    else:
        nominal, numeric = nominal or [], numeric or []
        view = view.select(fixed.ID, *numeric, *nominal, y, "Sample")
    encoder = fit_encoder(view.where(F.col("Sample") == "Train"), nominal, numeric, exclude=[y, "Sample"])
    return Encoded(stage, y, encoder, encoder.apply(view, [fixed.ID, "Sample", y]))
