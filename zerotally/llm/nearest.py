"""Approximate nearest neighbours by largest inner product over shifted space-filling curves.

Vectors are lifted onto a sphere (one more component makes all lengths equal, so the largest inner product is the
nearest point), turned at random, and a few turned components give a Hilbert key. Each of several curves has a turn
and a shift of its own. Spark range-partitions the rows by curve and key and packs neighbours into cells; the queries of
a cell meet the cells of a window around it on the same curve, and what the windows of all curves find is merged and
ranked by inner products of the original vectors.

Equal vectors are one point with its least identifiers, so that a vector that fills a third of the table is one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zerotally.workspace import materialise

QUERY_STEP = 20
NEIGHBOURS = 20
SALTS = 64


@dataclass(frozen=True)
class Curves:
    """`curves` orderings of `dims` turned components of `bits` bits; windows hold `share` of a curve's cells, and
    `least` on either side at least, of `cell` points each."""

    curves: int = 6
    dims: int = 6
    bits: int = 10
    share: float = 0.3
    least: int = 1
    cell: int = 4096
    seed: int = 11


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of grid coordinates (0 .. 2 ** bits - 1)."""
    x = grid.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):  # undo the turns that coarser squares have made, from the coarsest on
        low = (1 << level) - 1
        for axis in range(dims):
            high = (x[axis] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(high, low, swap)
            if axis:
                x[axis] ^= swap
    for axis in range(1, dims):  # Gray code across the axes
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(dims):
            key = key << 1 | x[axis] >> level & 1
    return key


def _keys(vectors: np.ndarray, length: float, as_query: bool, c: Curves, curve: int) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1)
    if as_query:
        lifted = np.column_stack([vectors * (length / norm)[:, None], np.zeros(len(vectors))])
    else:
        lifted = np.column_stack([vectors, np.sqrt(np.maximum(0.0, length * length - norm * norm))])
    width = lifted.shape[1]
    rng = np.random.default_rng([c.seed, curve, width])
    turn = np.linalg.qr(rng.standard_normal((width, width)))[0][:, :c.dims]
    at = lifted @ turn * (math.sqrt(width) / length)  # about normal where directions are
    even = 1 / (1 + np.exp(-1.702 * at)) + rng.uniform(-0.1, 0.1, turn.shape[1])
    return hilbert_keys(np.clip((even * 0.8 + 0.1) * (1 << c.bits), 0, (1 << c.bits) - 1).astype(np.int64), c.bits)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float)


def distinct_points(vectors: DataFrame, id_col: str, vector_col: str, keep: int) -> DataFrame:
    """point (least id), vec (doubles), ids (its `keep` least ids), asked (whether a query is among all its ids). Vectors
    that are null, zero, empty or hold null or non-finite components are left out, as are rows without an id."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0))
    v = v.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    asked = F.max(F.pmod("id", F.lit(QUERY_STEP)) == 0)
    first = (v.groupBy("vec", "salt").agg(asked.alias("asked"), F.min("id").alias("least")))
    first = first.groupBy("vec").agg(F.max("asked").alias("asked"), F.min("least").alias("point"))
    salted, whole = Window.partitionBy("vec", "salt").orderBy("id"), Window.partitionBy("vec").orderBy("id")
    ids = (v.distinct().withColumn("at", F.row_number().over(salted)).where(F.col("at") <= keep)
           .withColumn("at", F.row_number().over(whole)).where(F.col("at") <= keep)
           .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    return first.join(ids, "vec").select("point", "vec", "ids", "asked")


def curve_cells(points: DataFrame, length: float, c: Curves, partitions: int) -> DataFrame:
    """Runs of neighbours along each curve: curve, low (key), cell ids, data (points, vec), queries (points, vec)."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            point, vec = batch.column(0), batch.column(1)
            asked = np.array(batch.column(2).to_pylist(), bool)
            x = _matrix(vec)
            if not len(x):
                continue
            picked = pa.array(np.flatnonzero(asked))
            for curve in range(c.curves):
                for query in (False, True):
                    p, v = (point.take(picked), vec.take(picked)) if query else (point, vec)
                    key = _keys(x[asked] if query else x, length, query, c, curve)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), curve, "i4")), pa.array(key), pa.array(np.full(len(key), query)), p, v],
                        names=["curve", "key", "query", "point", "vec"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            sides = []
            for query in (False, True):
                rows = [r for r in held if r[2] == query]
                sides += [np.array([r[3] for r in rows], "<i8").tobytes(), np.array([r[4] for r in rows], "<f8").tobytes()]
            made = pa.RecordBatch.from_pydict(
                {"curve": [held[0][0]], "low": [held[0][1]], "first": [held[0][3]], "points": [sides[0]], "vecs": [sides[1]],
                 "q_points": [sides[2]], "q_vecs": [sides[3]]},
                schema=pa.schema([("curve", pa.int32()), ("low", pa.int64()), ("first", pa.int64()), ("points", pa.binary()),
                                  ("vecs", pa.binary()), ("q_points", pa.binary()), ("q_vecs", pa.binary())]))
            held.clear()
            return made

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and (held[0][0] != row[0] or len(held) >= c.cell):
                    yield out()
                held.append(row)
        if held:
            yield out()

    keys = points.select("point", "vec", "asked").mapInArrow(
        keyed, "curve int, key long, query boolean, point long, vec array<double>")
    return (keys.repartitionByRange(partitions, "curve", "key", "point").sortWithinPartitions("curve", "key", "point", "query")
            .mapInArrow(packed, "curve int, low long, first long, points binary, vecs binary, q_points binary, q_vecs binary"))


def _best(keep: int):
    """The `keep` best points of a cell for each query of another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for points, vecs, q_points, q_vecs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ids, asks = np.frombuffer(points, "<i8"), np.frombuffer(q_points, "<i8")
                x, q = (np.frombuffer(v, "<f8").reshape(len(n), -1) for v, n in ((vecs, ids), (q_vecs, asks)))
                if not len(ids) or not len(asks):
                    continue
                found, n = q @ x.T, min(keep, len(ids))
                # all that may be among the best, with whatever ties at the last place; one sum then ranks them all
                slack = 4 * x.shape[1] * np.finfo(float).eps * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
                row, at = np.nonzero(found >= (np.partition(found, len(ids) - n, axis=1)[:, len(ids) - n] - slack)[:, None])
                score = (x[at] * q[row]).sum(1)
                order = np.lexsort((ids[at], -score, row))
                row, at, score = row[order], at[order], score[order]
                best = np.arange(len(row)) - np.searchsorted(row, row) < n
                yield pa.RecordBatch.from_arrays([pa.array(asks[row[best]]), pa.array(ids[at[best]]), pa.array(score[best])],
                                                 names=["query", "point", "score"])
    return run


def search(vectors: DataFrame, k: int = NEIGHBOURS, curves: Curves = Curves(), id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """For every row whose id is divisible by `QUERY_STEP`: query_id, rank (from 1), vec_id, score of its `k` nearest
    other rows that were found, nearest first, ties to the smaller id.

    Nearest is the largest inner product, in double precision. Null, empty and zero vectors, vectors with null or
    non-finite components and rows without an id take no part. All vectors must have one length; equal ids count
    once. With fewer than k others all are given.
    """
    spark = vectors.sparkSession
    points = materialise(distinct_points(vectors, id_col, vector_col, k + 1), "points")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    seen = points.agg(F.count("*").alias("n"), F.max(norm).alias("length"), F.min(F.size("vec")).alias("low"), F.max(F.size("vec")).alias("high")).first()
    if seen["low"] != seen["high"]:
        raise ValueError("vectors differ in length")
    empty = "query_id long, rank int, vec_id long, score double"
    if not seen["n"]:
        return spark.createDataFrame([], empty)
    parts = max(1, math.ceil(seen["n"] * curves.curves / (8 * curves.cell)))
    cells = materialise(curve_cells(points, seen["length"], curves, parts), "cells")
    number = F.row_number().over(Window.partitionBy("curve").orderBy("low", "first")) - 1
    order = materialise(cells.select("curve", "low", "first", F.octet_length("q_points").alias("asks")).withColumn("at", number)
                        .withColumn("n", F.count("*").over(Window.partitionBy("curve"))), "order")
    side = F.greatest(F.lit(curves.least), F.ceil(F.col("n") * curves.share / 2)).cast("int")
    start = F.greatest(F.lit(0), F.least(F.col("at") - side, F.col("n") - 1 - 2 * side))
    visits = (order.where("asks > 0").select("curve", "low", "first", F.explode(F.sequence(
        start, F.least(start + 2 * side, F.col("n") - 1))).alias("at")))
    key = ["curve", "low", "first"]
    asking = cells.select(*key, "q_points", "q_vecs").join(visits, key).select("curve", "at", "q_points", "q_vecs")
    asked = cells.select(*key, "points", "vecs").join(order.select(*key, "at"), key).where(F.octet_length("points") > 0)
    found = (asking.join(asked.select("curve", "at", "points", "vecs"), ["curve", "at"]).select("points", "vecs", "q_points", "q_vecs")
             .mapInArrow(_best(k + 1), "query long, point long, score double"))
    near_points, near_ids = (Window.partitionBy("query").orderBy(F.desc("score"), c) for c in ("point", "vec_id"))
    found = (found.withColumn("at", F.dense_rank().over(near_points)).where(F.col("at") <= k + 1)
             .select("query", "point", "score").distinct())  # a point found on several curves has one rank
    near = (found.join(points.select("point", F.explode("ids").alias("vec_id")), "point")
            .withColumn("at", F.row_number().over(near_ids)).where(F.col("at") <= k + 1)
            .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("at", "vec_id", "score"))).alias("near")))
    ids = vectors.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    ids = (ids.where(F.pmod("query_id", F.lit(QUERY_STEP)) == 0).distinct()
           .join(points.where("asked").select("vec", F.col("point").alias("query")), "vec"))
    own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (ids.join(near, "query").select("query_id", F.posexplode(own).alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")))
