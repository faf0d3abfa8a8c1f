"""Exact k-nearest-neighbour join.

Reference points are tiled: first by their discrete coordinates, then, where a tile holds
too many points, level by level at quantiles of the coordinate that cuts it best. Every tile keeps
its bounding box. A query searches one nearby tile, which gives an upper bound on its k-th
distance, and then only those tiles whose box comes that close. Both descents are equi-joins
on the parent tile. Distances are computed per tile in bounded blocks and only k rows per
query and tile leave a task.

The tiles and points are written once as an index that can be kept, and a search reads only the
folders of the tiles it visits.

Copies of one point could never give more than k neighbours, so all but the k lowest ids are
set aside first; copies of one query are answered once. Neither can pile up in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zerotally.workspace import materialise, scratch_path

MAX_LEVELS = 10  # tile numbers stay within 64 bits
FANOUT = 32          # children per tile and split, a power of two
TILE_ROWS = 20_000   # a tile above this is split further
QUERY_ROWS = 4_000   # queries searched against one copy of a tile
BLOCK_CELLS = 128_000  # distances worked on at once: few enough to stay in a core's cache
BOUND_GROUPS = 16    # groups of distances per neighbour, see _bound
MAX_DISCRETE = 4096
MAX_SHARDS = 2048    # folders of an index; a folder is what a search reads at once

_FOUND = "qid long, nid long, d2 double, label int"


def _min_distance(dims: list[str]) -> str:
    """SQL for the squared distance from the query's coordinates to the box of a tile `c`."""
    gaps = [f"greatest(c.lo{i} - `{d}`, `{d}` - c.hi{i}, 0D)" for i, d in enumerate(dims)]
    return " + ".join(f"{g} * {g}" for g in gaps)


def _tile_by_discrete(points: DataFrame, discrete: list[str]) -> DataFrame | None:
    """Number the distinct combinations of the discrete coordinates; None if there are too many for a tile each."""
    combos = points.select(*discrete).distinct().limit(MAX_DISCRETE + 1).collect()
    if len(combos) > MAX_DISCRETE:
        return None
    listed = sorted(tuple(float(v) for v in row) for row in combos)
    names = [*discrete, "tile"]
    types = [pa.float64()] * len(discrete) + [pa.int64()]
    values = list(zip(*[(*c, i) for i, c in enumerate(listed)])) or [()] * len(names)
    # from Arrow, so that the rows are part of the plan and no Python task runs wherever it is used
    numbered = points.sparkSession.createDataFrame(pa.table([pa.array(v, t) for v, t in zip(values, types)], names=names))
    return points.join(F.broadcast(numbered), discrete)


def _with_cuts(seen: DataFrame, numeric: list[str], tile_rows: int) -> DataFrame:
    """Per tile `_at<i>`, the values at which coordinate i is cut, from its count `_n` and the coordinates' ranges and quantiles.

    A tile of 2^p times the wanted size is cut into 2^p parts (32 at most) by all coordinates at once: halvings are dealt out
    to the coordinates with most different quantiles first. A coordinate whose quantiles say nothing is cut at its mean.
    """
    grid = [F.col(f"_d{i}") for i in range(len(numeric))]
    power = F.least(F.ceil(F.log2(F.col("_n") / tile_rows)), F.lit(int(np.log2(FANOUT)))).cast("int")
    different = lambda d: F.size(F.array_distinct(F.filter(d["q"], lambda v: v > d["lo"])))
    # coordinates that can be cut, the one with most quantiles first
    order = F.array_sort(F.filter(F.array(*[F.struct((-different(d)).alias("n"), F.lit(i).alias("i"), (d["hi"] > d["lo"]).alias("cut"))
                                            for i, d in enumerate(grid)]), lambda r: r["cut"]))
    ranked = seen.withColumn("_power", power).withColumn("_order", F.transform(order, lambda r: r["i"]))
    usable = F.greatest(F.size("_order"), F.lit(1))
    share = []
    for i in range(len(numeric)):
        place = F.array_position("_order", F.lit(i)).cast("int")  # 0 where it cannot be cut
        share.append(F.when(place > 0, F.floor(F.col("_power") / usable).cast("int") + F.when(place <= F.col("_power") % usable, 1).otherwise(0))
                     .otherwise(0).alias(f"_p{i}"))
    dealt = ranked.select("tile", *[f"_d{i}" for i in range(len(numeric))], *share)
    out = []
    for i, d in enumerate(grid):
        step = F.lit(FANOUT) / F.pow(F.lit(2.0), F.col(f"_p{i}"))
        at = F.array_distinct(F.filter(d["q"], lambda v, j: ((j + 1) % step == 0) & (v > d["lo"])))
        mean = F.array(F.greatest(d["mid"], d["hi"] / 2 + d["lo"] / 2))
        out.append(F.when(F.col(f"_p{i}") == 0, F.array().cast("array<double>")).when(F.size(at) > 0, at).otherwise(mean).alias(f"_at{i}"))
    return dealt.select("tile", *out)


def _split_tiles(points: DataFrame, numeric: list[str], tile_rows: int) -> tuple[DataFrame, int]:
    """Give every point the number of its final tile; also the number of split levels.

    On every level a tile that is too large is cut at quantiles of its coordinates, or at the mean where one value holds
    nearly all of it, so that only copies of a single point can stay together.
    """
    depth = 0
    grid = [j / FANOUT for j in range(1, FANOUT)]
    while depth < MAX_LEVELS:
        sizes = materialise(points.groupBy("tile").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > tile_rows), "sizes")
        if sizes.isEmpty():
            break
        seen = points.join(sizes, "tile").groupBy("tile").agg(F.first("_n").alias("_n"), *[
            F.struct(F.min(d).alias("lo"), F.max(d).alias("hi"), F.avg(d).alias("mid"),
                     F.percentile_approx(d, grid, 1000).alias("q")).alias(f"_d{i}") for i, d in enumerate(numeric)])
        at = [f"_at{i}" for i in range(len(numeric))]
        cut = reduce(lambda a, b: a | b, [F.size(c) > 0 for c in at])
        cuts = materialise(_with_cuts(seen, numeric, tile_rows).where(cut), "cuts")
        if cuts.isEmpty():
            break
        child = F.lit(0).cast("long")
        for c, d in zip(at, numeric):
            child = child * (F.size(c) + 1) + F.size(F.filter(F.col(c), lambda v: v <= F.col(d).cast("double")))
        # written, so that no later level works out the places on the earlier ones again
        points = materialise(points.join(cuts, "tile", "left")
                             .withColumn("tile", F.col("tile") * FANOUT + F.coalesce(child, F.lit(0))).drop(*at), "tiled")
        depth += 1
    return points, depth


def _tile_tree(level: DataFrame, depth: int) -> list[DataFrame]:
    """Per level, top first: parent tile and the array of its children with count and box. `level` has the final tiles."""
    edges = [c for c in level.columns if c != "tile"]
    up = [(F.min(c) if c.startswith("lo") else F.max(c)).alias(c) for c in edges if c != "cnt"]
    levels = []
    for step in range(depth + 1):
        parent = F.lit(0).cast("long") if step == depth else F.floor(F.col("tile") / FANOUT)
        tagged = level.withColumn("parent", parent)
        levels.append(tagged.groupBy("parent").agg(
            F.collect_list(F.struct("tile", *edges)).alias("children")))
        if step < depth:
            level = (tagged.groupBy("parent").agg(F.sum("cnt").alias("cnt"), *up)
                     .withColumnRenamed("parent", "tile"))
    return levels[::-1]


def _home_tiles(queries: DataFrame, tree: list[DataFrame], dims: list[str], k: int) -> DataFrame:
    """Walk down to the nearest tile that can hold k points, one child per level."""
    best = F.expr(f"array_min(transform(children, c -> struct(c.cnt < {k} AS few, "
                  f"{_min_distance(dims)} AS d, c.tile AS tile))).tile")
    at = queries.withColumn("parent", F.lit(0).cast("long"))
    for level in tree:
        at = at.join(level, "parent").withColumn("parent", best).drop("children")
    return at.withColumnRenamed("parent", "tile")


def _near_tiles(queries: DataFrame, tree: list[DataFrame], dims: list[str]) -> DataFrame:
    """All tiles but the home one whose box is within the bound `r2`; slack covers rounding."""
    near = F.expr("explode(transform(filter(children, c -> "
                  f"{_min_distance(dims)} <= r2 * (1 + 1e-9D) + 1e-12D), c -> c.tile))")
    at = queries.withColumn("parent", F.lit(0).cast("long"))
    for level in tree:
        at = at.join(level, "parent").withColumn("parent", near).drop("children")
    return at.withColumnRenamed("parent", "tile").where(F.col("tile") != F.col("home"))


def _bound(d2: np.ndarray, take: int) -> np.ndarray:
    """Per row a value that at least `take` distances do not exceed, and few more: of the least distances of many groups
    the one at place `take`, which is cheaper than that of all."""
    groups = BOUND_GROUPS * take
    width = d2.shape[1] // groups
    if width > 1:
        least = d2[:, :groups * width].reshape(len(d2), groups, width).min(axis=2)
        if not np.isnan(least).any():
            d2 = least
    return np.partition(d2, take - 1, axis=1)[:, take - 1:take]


def _search_block(dims: list[str], k: int):
    """The k nearest points of one tile for each of its queries, ties by point id."""
    def nearest(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or points.empty:
            return pd.DataFrame({"qid": [], "nid": [], "d2": [], "label": []})
        points = points.sort_values("nid", kind="stable")
        p, q = points[dims].to_numpy(float), queries[dims].to_numpy(float)
        qid, nid, label = (queries["qid"].to_numpy(), points["nid"].to_numpy(),
                           points["label"].to_numpy())
        take = min(k, len(p))
        # a coordinate in which all points and queries agree adds exactly 0
        met = [j for j in range(len(dims)) if p[0, j] != q[0, j] or np.ptp(p[:, j]) or np.ptp(q[:, j])]
        if len(met) < len(dims):
            p, q = p[:, met], q[:, met]
        out: list[tuple[np.ndarray, ...]] = []
        width = max(1, BLOCK_CELLS // len(p))
        for start in range(0, len(q), width):
            part = q[start:start + width]
            d2 = np.zeros((len(part), len(p)))
            gap = np.empty_like(d2)
            for j in range(p.shape[1]):
                np.subtract(part[:, j, None], p[None, :, j], out=gap)
                d2 += np.square(gap, out=gap)
            row, col = np.nonzero(d2 <= _bound(d2, take))
            dist = d2[row, col]
            order = np.lexsort((col, dist, row))
            row, col, dist = row[order], col[order], dist[order]
            place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
            keep = place < take
            out.append((qid[start + row[keep]], nid[col[keep]], dist[keep], label[col[keep]]))
        return pd.DataFrame(dict(zip(("qid", "nid", "d2", "label"), map(np.concatenate, zip(*out)))))
    return nearest


def _search(queries: DataFrame, points: DataFrame, dims: list[str], k: int) -> DataFrame:
    """Search each query in its tile; a tile with many queries is copied for parts of them.

    Few bytes stand for much work here, so the exchange has a fixed number of partitions, which are not joined by size.
    """
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = queries.groupBy("tile").agg(
        F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("_copies"))
    dealt = (queries.join(copies, "tile")
             .withColumn("_copy", F.pmod(F.xxhash64("qid"), F.col("_copies")).cast("int"))
             .select("qid", "tile", "_copy", *dims))
    spread = (points.join(copies, "tile")
              .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
              .select("nid", "label", "tile", "_copy", *dims))
    dealt, spread = (df.repartition(tasks, "tile", "_copy") for df in (dealt, spread))
    return (dealt.groupBy("tile", "_copy").cogroup(spread.groupBy("tile", "_copy"))
            .applyInPandas(_search_block(dims, k), _FOUND))


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy("d2", "nid")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _coordinates(df: DataFrame, names: list[str]) -> list[Column]:
    """Own names for the coordinates, so that no caller's column can be taken for another."""
    refuse = F.raise_error(F.lit("NULL coordinate in a neighbour search")).cast("double")
    return [F.coalesce(F.col(f"`{c}`").cast("double"), refuse).alias(x) for c, x in zip(names, _dims(names))]


def _dims(names: list[str]) -> list[str]:
    return [f"_x{i}" for i in range(len(names))]


@dataclass(frozen=True)
class TileIndex:
    """Reference points in tiles, written once: `points` by folder (`shard`) of one tile or a few, `tiles` with count and
    box. Searches read the folders of the tiles that they visit, in any session."""
    points: DataFrame
    tiles: DataFrame
    names: list[str]  # of the coordinates, in order
    k: int            # copies of a point beyond this many are not held
    depth: int

    def save(self, spark: SparkSession, path: str) -> None:
        _write_points(self.points, path)
        _write_tiles(self.tiles, path)
        _write_state(spark, self.names, self.k, self.depth, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TileIndex":
        r = spark.read.parquet(f"{path}/index").first()
        dims = _dims(r["names"])
        return TileIndex(spark.read.schema(_point_schema(dims)).parquet(f"{path}/points"),
                         spark.read.schema(_tile_schema(dims)).parquet(f"{path}/tiles"), list(r["names"]), r["k"], r["depth"])

    def at(self, asked: DataFrame) -> DataFrame:
        """The points in the folders of the tiles that `asked` names."""
        met = asked.select("tile").distinct().join(self.tiles.select("tile", "shard"), "tile").select("shard").distinct()
        return self.points.where(F.col("shard").isin([r["shard"] for r in met.collect()]))

    def search(self, queries: DataFrame, query_id: str, k: int | None = None) -> DataFrame:
        """`query_id`, `nid`, squared distance `d2`, `label` and `place` 1..k for every query row."""
        k = self.k if k is None else k
        if k > self.k:
            raise ValueError(f"the index holds {self.k} copies of a point at most, so k cannot be {k}")
        dims = _dims(self.names)
        asked = materialise(queries.select(F.col(query_id).alias(query_id), *_coordinates(queries, self.names)), "queries")
        # a query meets many boxes on its way down: dealt out by number, not by their few bytes
        tasks = queries.sparkSession.sparkContext.defaultParallelism
        queries = asked.groupBy(*dims).agg(F.min(query_id).cast("long").alias("qid")).repartition(tasks)
        tree = _tile_tree(self.tiles.drop("shard"), self.depth)
        home = materialise(_home_tiles(queries, tree, dims, k), "home")
        first = materialise(_search(home, self.at(home), dims, k), "first")
        bound = first.groupBy("qid").agg(
            F.when(F.count(F.lit(1)) >= k, F.max("d2")).otherwise(F.lit(float("inf"))).alias("r2"))
        bounded = home.withColumnRenamed("tile", "home").join(bound, "qid", "left").na.fill(float("inf"), ["r2"])
        near = materialise(_near_tiles(bounded.repartition(tasks), tree, dims), "near")
        best = _top(first.unionByName(_search(near, self.at(near), dims, k)), k)
        answers = home.join(best, "qid").select(*dims, "nid", "d2", "label", "place")
        return asked.join(answers, dims).select(query_id, "nid", "d2", "label", "place")


def _point_schema(dims: list[str]) -> str:
    return ", ".join(["nid long, label int", *(f"{d} double" for d in dims), "tile long", "shard int"])


def _tile_schema(dims: list[str]) -> str:
    return ", ".join(["tile long, cnt long", *(f"lo{i} double, hi{i} double" for i in range(len(dims))), "shard int"])


def _write_points(points: DataFrame, path: str) -> None:
    points.repartition("tile").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/points")


def _write_tiles(tiles: DataFrame, path: str) -> None:
    tiles.write.mode("overwrite").parquet(f"{path}/tiles")


def _write_state(spark: SparkSession, names: list[str], k: int, depth: int, path: str) -> None:
    row = pa.table({"names": pa.array([names], pa.list_(pa.string())), "k": pa.array([k], pa.int32()), "depth": pa.array([depth], pa.int32())})
    spark.createDataFrame(row).coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def build_index(points: DataFrame, numeric: list[str], discrete: list[str], k: int, point_id: str, label: str,
                tile_rows: int = TILE_ROWS, path: str | None = None) -> TileIndex:
    """Tile the points and write the index, to `path` or to scratch space. A NULL coordinate raises."""
    if tile_rows < FANOUT * k:
        raise ValueError(f"tile_rows must be at least {FANOUT * k}")
    spark, names = points.sparkSession, [*numeric, *discrete]
    dims = _dims(names)
    # the hash goes first, so that the sorts compare whole coordinates only where it agrees
    copies = Window.partitionBy("_hash", *dims).orderBy("nid")
    points = (points.select(F.col(point_id).cast("long").alias("nid"), F.col(label).cast("int").alias("label"), *_coordinates(points, names))
              .withColumn("_hash", F.xxhash64(*dims))
              .withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k).drop("_copy", "_hash"))
    points = materialise(points, "points")
    by_discrete = _tile_by_discrete(points, dims[len(numeric):])
    if by_discrete is None:  # then they are cut like the others
        tiled, depth = _split_tiles(points.withColumn("tile", F.lit(0).cast("long")), dims, tile_rows)
    else:
        tiled, depth = _split_tiles(by_discrete, dims[:len(numeric)], tile_rows)
    if not depth:
        tiled = materialise(tiled, "tiled")
    box = [f(F.col(d)).alias(f"{n}{i}") for i, d in enumerate(dims) for n, f in (("lo", F.min), ("hi", F.max))]
    place = F.row_number().over(Window.orderBy("tile")) - 1  # a row per tile
    tiles = tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("cnt"), *box)
    many = F.count(F.lit(1)).over(Window.partitionBy())
    path = path or scratch_path(spark, "index")
    _write_tiles(tiles.withColumn("shard", F.floor(place / F.ceil(many / MAX_SHARDS)).cast("int")), path)
    tiles = spark.read.schema(_tile_schema(dims)).parquet(f"{path}/tiles")
    _write_points(tiled.join(tiles.select("tile", "shard"), "tile").select("nid", "label", *dims, "tile", "shard"), path)
    _write_state(spark, names, k, depth, path)
    return TileIndex(spark.read.schema(_point_schema(dims)).parquet(f"{path}/points"), tiles, names, k, depth)


def nearest_neighbours(queries: DataFrame, points: DataFrame, numeric: list[str], discrete: list[str],
                       k: int, query_id: str, point_id: str, label: str,
                       tile_rows: int = TILE_ROWS) -> DataFrame:
    """`query_id`, `nid`, squared distance `d2`, `label` and `place` 1..k for every query row.

    Euclidean over all coordinates, ties by lowest point id. Fewer than k points give fewer
    rows. A NULL coordinate raises.
    """
    return build_index(points, numeric, discrete, k, point_id, label, tile_rows).search(queries, query_id)


def majority_label(neighbours: DataFrame, query_id: str, out: str) -> DataFrame:
    """Most frequent label per query, ties to the smallest label."""
    votes = neighbours.groupBy(query_id, "label").agg(F.count(F.lit(1)).alias("_n"))
    return votes.groupBy(query_id).agg(
        F.max_by("label", F.struct(F.col("_n"), -F.col("label"))).alias(out))
