"""Frozen one-hot and standardising encoder, fitted once and applied as a projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.workspace import together

_SPEC_SCHEMA = ("pos int, feature string, kind string, source string, level string, "
                "mean double, sd double")
MAX_LEVELS = 10_000


@dataclass(frozen=True)
class Feature:
    """One output column: passed through, standardised, or a 0/1 dummy of a level."""
    name: str
    kind: str
    source: str
    level: str | None = None
    mean: float | None = None
    sd: float | None = None

    def column(self, prefix: str = "") -> Column:
        """The output value; `prefix` names the struct that holds the source, as in 'b.'."""
        c = F.col(f"{prefix}`{self.source}`")
        if self.kind == "dummy":
            # NULL and levels unseen at fit give 0
            return F.when(c.cast("string") == self.level, 1).otherwise(0).cast("tinyint")
        if self.kind == "scaled":
            return (c - F.lit(self.mean)) / F.lit(self.sd)
        return c


@dataclass(frozen=True)
class Encoder:
    features: list[Feature] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.features]

    def columns(self, available: list[str] | None = None) -> list[Column]:
        """Output columns in frozen order; a source the frame lacks counts as 0 before scaling."""
        out = []
        for f in self.features:
            c = f.column()
            if available is not None and f.source not in available:
                c = F.lit(-f.mean / f.sd) if f.kind == "scaled" else F.lit(0)
            out.append(c.alias(f.name))
        return out

    def apply(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        kept = [fixed.ID] if keep is None else keep
        return df.select(*kept, *self.columns(df.columns))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, f.name, f.kind, f.source, f.level, f.mean, f.sd) for i, f in enumerate(self.features)]
        return spark.createDataFrame(rows, _SPEC_SCHEMA)

    @staticmethod
    def from_frame(spec: DataFrame) -> "Encoder":
        rows = sorted(spec.collect(), key=lambda r: r["pos"])
        return Encoder([Feature(r["feature"], r["kind"], r["source"], r["level"], r["mean"], r["sd"])
                        for r in rows])

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Encoder":
        return Encoder.from_frame(spark.read.parquet(path))


def training_levels(df: DataFrame, nominal: list[str]) -> DataFrame:
    """Distinct non-NULL levels of all nominal columns in one scan (`Variable`, `Level`)."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in nominal])
    return (texts.unpivot([], nominal, "Variable", "Level").where(F.col("Level").isNotNull())
            .groupBy("Variable", "Level").agg(F.count(F.lit(1)).alias("n")))


def scaling(df: DataFrame, numeric: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population sd per column; a constant column keeps its scale."""
    if not numeric:
        return {}
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(numeric)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(numeric)]).first()
    out = {}
    for i, c in enumerate(numeric):
        mean, sd = row[f"m{i}"], row[f"s{i}"]
        flat = sd is None or sd <= 1e-13 * max(1.0, abs(mean))
        out[c] = (0.0 if mean is None else mean, 1.0 if flat else sd)
    return out


def fit_encoder(df: DataFrame, nominal: list[str], numeric: list[str], drop_first: bool = True,
                exclude: list[str] | None = None, max_levels: int = MAX_LEVELS) -> Encoder:
    """Freeze levels, column order and scaling on the training rows.

    Every level becomes a column, so more than `max_levels` in all are an error that names the columns.

    Order: the columns that are not nominal, as they come, then a block of dummies per
    nominal column. With `drop_first` the lowest training level is the base.
    """
    skip = {fixed.ID, *(exclude or [])}
    whole = {n for n, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint")}
    found: dict[str, list[str]] = {c: [] for c in nominal}
    rows, scales = together(
        df.sparkSession,
        lambda: training_levels(df, nominal).limit(max_levels + 1).collect() if nominal else [],
        lambda: scaling(df, numeric))
    if len(rows) > max_levels:
        sizes = df.agg(*[F.approx_count_distinct(F.col(c).cast("string")).alias(c) for c in nominal]).first().asDict()
        raise ValueError(f"more than {max_levels} levels to encode: " + ", ".join(f"{c} about {n}" for c, n in sizes.items()))
    for r in rows:
        found[r["Variable"]].append(r["Level"])
    features = []
    for c in df.columns:
        if c in skip or c in nominal:
            continue
        if c in scales:
            features.append(Feature(c, "scaled", c, None, *scales[c]))
        else:
            features.append(Feature(c, "plain", c))
    for c in nominal:
        levels = sorted(found[c], key=int) if c in whole else sorted(found[c])
        features += [Feature(f"{c}_{v}", "dummy", c, v) for v in levels[1 if drop_first else 0:]]
    return Encoder(features)
