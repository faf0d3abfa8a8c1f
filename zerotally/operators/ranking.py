"""Exact ranks, running totals, quantiles and hold-out splits without a one-task sort.

Rows are put in total order by a range exchange on the whole sort key, which ends in a
unique column, so a value shared by many rows still spreads over partitions. Inside a
partition the position comes from `monotonically_increasing_id`; only one short row per
partition is ever brought together to turn local positions into global ones.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, LongType, StructField, StructType

from zerotally import fixed
from zerotally.workspace import materialise

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above these bits
PREFIX_DIGITS = 4  # hash digits counted per step of the split, 16 ** 4 counts at most
SMALL_BUCKET = 10_000  # keys ordered directly once the cut lies in a bucket this small
GRID = 200  # steps at which a quantile sketch is read
SKETCH_ACCURACY = 1000  # ranks are right to one part in this many
SMALL_BRACKET = 100_000  # rows that may be ordered for one quantile
MAX_NARROWINGS = 8


def range_sorted(df: DataFrame, *order: Column) -> DataFrame:
    """Total order with `_part` (partition) and `_pos` (0-based place inside it)."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return (ordered.withColumn("_mark", F.monotonically_increasing_id())
            .withColumn("_part", F.shiftright("_mark", _LOCAL_BITS))
            .withColumn("_pos", F.col("_mark").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
            .drop("_mark"))


def before(totals: DataFrame, value: str, out: str, by: list[str] | None = None) -> DataFrame:
    """Running total of `value` over earlier partitions; `totals` has a row per partition."""
    w = Window.partitionBy(*(by or [])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def with_row_id(df: DataFrame, order: list[str], out: str = "row_id") -> DataFrame:
    """Append the 0-based place of every row in the given (unique) order."""
    parts = materialise(range_sorted(df, *[F.col(c) for c in order]), "sorted")
    starts = before(parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "_n", "_start")
    return (parts.join(F.broadcast(starts.select("_part", "_start")), "_part")
            .withColumn(out, F.col("_start") + F.col("_pos"))
            .drop("_part", "_pos", "_start"))


def prefix_scan(df: DataFrame, order: list[Column], values: dict[str, str]) -> DataFrame:
    """Rows in total order with `_part`, `_pos` and, for each name of `values`, the total of its column in this partition
    up to and with the row.

    The totals are carried along the sorted rows of the range exchange, so no row is shuffled again. Whole numbers stay
    whole (a total beyond 64 bits raises), other numbers are added as doubles; NULL adds nothing, and a total is NULL
    until the partition has shown a value.
    """
    ordered = range_sorted(df, *order)
    whole = {o: isinstance(df.schema[v].dataType, IntegralType) for o, v in values.items()}
    inputs = [F.col(v).cast("long" if whole[o] else "double").alias(f"_in_{o}") for o, v in values.items()]
    ordered = ordered.select("*", *inputs)
    keep = [c for c in ordered.columns if not c.startswith("_in_") or c in df.columns]
    schema = StructType([*(ordered.schema[c] for c in keep),
                         *(StructField(o, LongType() if whole[o] else DoubleType()) for o in values)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int | float | None] = dict.fromkeys(values)
        for batch in batches:
            columns = [batch.column(i) for i in range(len(keep))]
            for k, out in enumerate(values):
                x = batch.column(len(keep) + k)
                known = np.asarray(x.is_valid())
                filled = x.fill_null(0).to_numpy(zero_copy_only=False)
                if whole[out] and sum(map(abs, (int(filled.max(initial=0)), int(filled.min(initial=0))))) * len(filled) + abs(total[out] or 0) >= 1 << 63:
                    run_ = np.array(list(itertools.accumulate(map(int, filled), initial=total[out] or 0))[1:], dtype=object)
                else:
                    run_ = np.cumsum(filled) + (total[out] or 0)
                shown = known.cumsum() > 0 if total[out] is None else np.ones(len(filled), bool)
                columns.append(pa.array(run_, mask=~shown, type=pa.int64() if whole[out] else pa.float64()))
                if len(filled) and shown[-1]:
                    total[out] = run_[-1].item() if hasattr(run_[-1], "item") else run_[-1]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *values])

    return ordered.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`_in_{o}`") for o in values]).mapInArrow(run, schema)


def with_running_sum(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Append the running total of `value` in the given (unique) order; one range exchange, then an offset per partition."""
    parts = materialise(prefix_scan(df, [F.col(c) for c in order], {"_run": value}), "sorted")
    last = F.max_by("_run", F.when(F.col("_run").isNotNull(), F.col("_pos")))
    starts = before(parts.groupBy("_part").agg(last.alias("_s")), "_s", "_start")
    known = before(parts.groupBy("_part").agg(F.count("_run").alias("_k")), "_k", "_known")
    starts = starts.join(known.select("_part", "_known"), "_part")
    total = F.col("_start") + F.coalesce("_run", F.lit(0))
    return (parts.join(F.broadcast(starts.select("_part", "_start", "_known")), "_part")
            .withColumn(out, F.when(F.col("_run").isNotNull() | (F.col("_known") > 0), total))
            .drop("_part", "_pos", "_run", "_start", "_known"))


def tied_products(df: DataFrame, key: Column, a: Column, b: Column) -> DataFrame:
    """One row: total `a`, total `b` and `cross`, the sum over distinct keys, in rising order, of
    a * (b of all smaller keys + b / 2).

    Equal keys are added up within Arrow batches before the only exchange, a range exchange on the key and the number of
    the task, over which a key that a third of the rows share still spreads. Every partition leaves one row: its sums and
    what it holds of its first and last key, from which a key that lies over several partitions is put right.
    NULL keys come first, NaN last.
    """
    tallied = df.select(key.isNotNull().alias("known"), F.coalesce(key.cast("double"), F.lit(0.0)).alias("key"),
                        a.cast("double").alias("a"), b.cast("double").alias("b"))
    ordered = (tallied.mapInArrow(_tally, "known boolean, key double, a double, b double")
               .withColumn("_task", F.spark_partition_id())
               .repartitionByRange("known", "key", "_task").sortWithinPartitions("known", "key"))
    end = "struct<known: boolean, key: double, a: double, b: double>"
    parts = (ordered.select(F.spark_partition_id().alias("part"), "known", "key", "a", "b")
             .mapInArrow(_tied_part, f"part int, a double, b double, u double, first {end}, last {end}"))
    total = parts.repartition(1).sortWithinPartitions("part").mapInArrow(_tied_total, "a double, b double, cross double")
    return total.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("a", "b", "cross")])  # a row even without partitions


def _groups(known: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where runs of one key begin; NaN equals NaN."""
    same = (known[1:] == known[:-1]) & ((key[1:] == key[:-1]) | np.isnan(key[1:]) & np.isnan(key[:-1]))
    return np.r_[0, 1 + np.flatnonzero(~same)]


def _columns(batch: pa.RecordBatch, names: tuple[str, ...]) -> list[np.ndarray]:
    found = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return [c.fill_null(False if n == "known" else 0).to_numpy(zero_copy_only=False) for n, c in zip(names, found)]


_TIED = ("known", "key", "a", "b")


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            known, key, a, b = _columns(batch, _TIED)
            order = np.lexsort((key, known))
            known, key, a, b = known[order], key[order] + 0.0, a[order], b[order]
            at = _groups(known, key)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (known[at], key[at], np.add.reduceat(a, at), np.add.reduceat(b, at))],
                                             names=list(_TIED))


def _same(x: dict, y: dict) -> bool:
    return x["known"] == y["known"] and (x["key"] == y["key"] or x["key"] != x["key"] and y["key"] != y["key"])


def _tied_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, first, open_, sum_a, sum_b, u = None, None, None, 0.0, 0.0, 0.0
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(0)[0].as_py()
        known, key, a, b = _columns(batch, _TIED)
        at = _groups(known, key)
        a, b = np.add.reduceat(a, at), np.add.reduceat(b, at)
        head = {"known": bool(known[0]), "key": float(key[0]), "a": 0.0, "b": 0.0}
        if open_ is not None and _same(open_, head):
            a[0] += open_["a"]
            b[0] += open_["b"]
        elif open_ is not None:
            first = first or open_
            u += open_["a"] * (sum_b + open_["b"] / 2)
            sum_a, sum_b = sum_a + open_["a"], sum_b + open_["b"]
        if len(at) > 1:
            first = first or {**head, "a": float(a[0]), "b": float(b[0])}
            ahead = sum_b + np.r_[0.0, np.cumsum(b[:-1])]
            u += float((a[:-1] * (ahead[:-1] + b[:-1] / 2)).sum())
            sum_a, sum_b = sum_a + float(a[:-1].sum()), float(ahead[-1])
        open_ = {"known": bool(known[at[-1]]), "key": float(key[at[-1]]), "a": float(a[-1]), "b": float(b[-1])}
    if open_ is not None:
        u += open_["a"] * (sum_b + open_["b"] / 2)
        yield pa.RecordBatch.from_pylist([{"part": part, "a": sum_a + open_["a"], "b": sum_b + open_["b"], "u": u,
                                           "first": first or open_, "last": open_}], schema=_TIED_PART)


_TIED_END = pa.struct([("known", pa.bool_()), ("key", pa.float64()), ("a", pa.float64()), ("b", pa.float64())])
_TIED_PART = pa.schema([("part", pa.int32()), ("a", pa.float64()), ("b", pa.float64()), ("u", pa.float64()),
                        ("first", _TIED_END), ("last", _TIED_END)])


def _tied_total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sum_a, sum_b, u, open_ = 0.0, 0.0, 0.0, None
    for batch in batches:
        for p in batch.to_pylist():
            first, last = p["first"], p["last"]
            u += p["u"] + p["a"] * sum_b
            if open_ is not None and _same(open_, first):  # pieces of one key: each pair shares its product evenly
                u += (open_["a"] * first["b"] - first["a"] * open_["b"]) / 2
                if _same(first, last):
                    last = {**last, "a": open_["a"] + last["a"], "b": open_["b"] + last["b"]}
            open_ = last
            sum_a, sum_b = sum_a + p["a"], sum_b + p["b"]
    yield pa.RecordBatch.from_pydict({"a": [sum_a], "b": [sum_b], "cross": [u]})


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: list[float]) -> DataFrame:
    """Linear-interpolation quantiles: one row per group and probability (`by`, prob, quantile).

    A mergeable sketch per group says between which two values a wanted rank must lie; values are counted exactly below
    and inside that bracket, and only those inside are put in order. While a bracket holds too many rows, a sketch of what
    is inside narrows it. A rank that a bracket misses, as a sketch is only probable, is looked for again in all values.
    `df` is scanned two times or more, so it should be a table.
    """
    v = F.col("_v")
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    sketch = lambda c: F.percentile_approx(c, grid, SKETCH_ACCURACY)
    base = materialise(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
                                             sketch(v).alias("_g")), "sketches")
    at = (F.col("_n") - 1) * F.col("prob")
    wanted = base.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs]))).select(
        *by, "prob", "_min", "_max", at.alias("_at"), F.floor(at).alias("_low"), F.ceil(at).alias("_high"),
        *_narrowed(F.lit(0), F.col("_n"), F.floor(at), F.ceil(at), F.col("_g"), F.col("_min"), F.col("_max")))
    held = wanted.agg(F.max("_held")).first()[0] or 0
    for _ in range(MAX_NARROWINGS):
        if held <= SMALL_BRACKET:
            break
        wanted = materialise(wanted, "brackets")
        inside = v.between(F.col("_lo"), F.col("_hi"))
        found = (_bracketed(rows, wanted, by).groupBy(*by, "prob")
                 .agg(F.count(F.when(v < F.col("_lo"), 1)).alias("_below"), F.count(F.when(inside, 1)).alias("_inside"),
                      sketch(F.when(inside, v)).alias("_g")))
        narrow = _narrowed(F.col("_below"), F.col("_inside"), F.col("_low"), F.col("_high"), F.col("_g"), F.col("_lo"), F.col("_hi"))
        wanted = wanted.drop("_held").join(found, [*by, "prob"]).select(*by, "prob", "_min", "_max", "_at", "_low", "_high", *narrow)
        now = wanted.agg(F.max("_held")).first()[0] or 0
        if now >= held:
            break
        held = now
    wanted = materialise(wanted, "brackets")
    found = materialise(_ranked(rows, wanted, by), "quantiles")
    if found.where(~F.col("_hit")).limit(1).count():
        missed = found.where(~F.col("_hit")).select(*by, "prob", F.lit(True).alias("_missed"))
        again = wanted.join(missed, [*by, "prob"]).withColumn("_lo", F.col("_min")).withColumn("_hi", F.col("_max"))
        found = found.where("_hit").unionByName(_ranked(rows, materialise(again.drop("_missed"), "brackets"), by))
    return found.select(*by, "prob", "quantile")


def _narrowed(below: Column, n: Column, low: Column, high: Column, grid: Column, lo: Column, hi: Column) -> list[Column]:
    """Bracket around the ranks low .. high (0-based, among all) from the sketch of `n` rows that follow `below` others."""
    slack = 1 + math.ceil(2 * GRID / SKETCH_ACCURACY)
    i = F.floor((low - below) * GRID / n).cast("int") - slack
    j = F.ceil((high + 1 - below) * GRID / n).cast("int") + slack
    missed = (low < below) | (high >= below + n) | (n == 0)
    start = F.when(missed | (i < 0), lo).otherwise(F.get(grid, i))
    end = F.when(missed | (j > GRID), hi).otherwise(F.get(grid, j))
    share = F.least(n, F.ceil((j - i + 2 * slack) * n / GRID))
    return [start.alias("_lo"), end.alias("_hi"), F.when(missed, n).when(start == end, 0).otherwise(share).alias("_held")]


def _bracketed(rows: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """Every row once for each probability of its group whose bracket does not lie below it."""
    brackets = wanted.groupBy(*by).agg(F.collect_list(F.struct("prob", "_lo", "_hi")).alias("_b"))
    brackets = materialise(brackets, "brackets")
    if not by:
        brackets = F.broadcast(brackets)  # a single row
    met = rows.crossJoin(brackets) if not by else rows.join(brackets, by)
    return met.select(*by, "_v", F.explode(F.filter("_b", lambda b: F.col("_v") <= b["_hi"])).alias("_b")).select(*by, "_v", "_b.*")


def _ranked(rows: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """(by, prob, quantile, _hit) from exact counts below and inside the brackets."""
    place = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))  # NULL stands for all that is below
    counted = (_bracketed(rows, wanted, by).groupBy(*by, "prob", place.alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    run = Window.partitionBy(*by, "prob").orderBy(F.col("_v").asc_nulls_first())
    upto = counted.withColumn("_upto", F.sum("_c").over(run)).where("_v IS NOT NULL")
    share = F.col("_at") - F.col("_low")
    holds = lambda r: (F.col(r) < F.col("_upto")) & (F.col(r) >= F.col("_upto") - F.col("_c"))
    hit = upto.join(wanted.select(*by, "prob", "_at", "_low", "_high"), [*by, "prob"])
    found = hit.groupBy(*by, "prob").agg(F.max(F.when(holds("_low"), F.col("_v"))).alias("_x"), F.max(F.when(holds("_high"), F.col("_v"))).alias("_y"),
                                         F.first(share).alias("_share"))
    quantile = F.when(F.col("_share") == 0, F.col("_x")).otherwise(F.col("_x") * (1 - F.col("_share")) + F.col("_y") * F.col("_share"))
    every = wanted.select(*by, "prob").join(found, [*by, "prob"], "left")
    return every.select(*by, "prob", quantile.alias("quantile"), (F.col("_x").isNotNull() & F.col("_y").isNotNull()).alias("_hit"))


def split_key(seed: int = fixed.SEED, id_col: str = fixed.ID) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def holdout_cutoff(df: DataFrame, frac: float = fixed.HOLDOUT, seed: int = fixed.SEED,
                   id_col: str = fixed.ID) -> str:
    """Largest split key that belongs to the ceil(frac * n) held-out rows; '' when none.

    The key is a uniform hash, so counting 4-digit prefixes finds the bucket of the cut, and
    a second count inside that bucket leaves a handful of keys to order. Nothing is sorted
    or shuffled but at most 65,536 counts per step.
    """
    keyed = df.select(split_key(seed, id_col).alias("k"))
    prefix, need, bucket = "", None, None
    while True:
        width = len(prefix) + PREFIX_DIGITS
        counts = (keyed.where(F.col("k").startswith(prefix))
                  .groupBy(F.substring("k", 1, width).alias("p")).count().collect())
        if need is None:
            need = math.ceil(frac * sum(r["count"] for r in counts))
            if need == 0:
                return ""
        for row in sorted(counts, key=lambda r: r["p"]):
            if row["count"] >= need:
                prefix, bucket = row["p"], row["count"]
                break
            need -= row["count"]
        if bucket <= SMALL_BUCKET or width >= 32:
            break
    ordered = keyed.where(F.col("k").startswith(prefix)).orderBy("k").limit(need)
    return ordered.agg(F.max("k")).first()[0]


def with_sample(df: DataFrame, frac: float = fixed.HOLDOUT, seed: int = fixed.SEED,
                id_col: str = fixed.ID, cutoff: str | None = None) -> DataFrame:
    """Add `Sample` ('Train' or 'Val'): a plain comparison per row once the cutoff is known.

    Finding the cutoff scans the ids a few times, so `df` should be a table, not a long plan.
    """
    cutoff = holdout_cutoff(df, frac, seed, id_col) if cutoff is None else cutoff
    held = split_key(seed, id_col) <= F.lit(cutoff)
    return df.withColumn("Sample", F.when(held, F.lit("Val")).otherwise(F.lit("Train")))
