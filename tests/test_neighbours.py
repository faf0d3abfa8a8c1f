import numpy as np
import pytest
from pyspark.sql import functions as F

import zerotally.operators.neighbours as N
from zerotally import fixed
from zerotally.operators.imputation import fill_from, fit_impute, fit_imputer
from zerotally.operators.neighbours import majority_label, nearest_neighbours


def _brute(q, p, k):
    out = {}
    for qid, *x in q:
        d = sorted((sum((a - b) ** 2 for a, b in zip(x, pt[2:])), pt[0]) for pt in p)[:k]
        out[qid] = [nid for _, nid in d]
    return out


def _join(spark, q, p, k, tile_rows, discrete=("c",)):
    dims = "a double, b double, " + ", ".join(f"{c} int" for c in discrete)
    qdf = spark.createDataFrame(q, "id long, " + dims).repartition(3)
    pdf = spark.createDataFrame(p, "id long, label int, " + dims).repartition(3)
    got = nearest_neighbours(qdf, pdf, ["a", "b"], list(discrete), k, "id", "id", "label", tile_rows)
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r["id"], r["place"])):
        out.setdefault(r["id"], []).append(r["nid"])
    return out


def _points(rng, n, start=0):
    """Clustered, with many exact copies of one point and integers that tie."""
    a = np.where(rng.random(n) < 0.33, 1.0, rng.integers(0, 12, n).astype(float))
    b = np.where(a == 1.0, 2.0, rng.normal(size=n) * 3)
    c = (rng.random(n) < 0.1).astype(int)
    return [(start + i, float(a[i]), float(b[i]), int(c[i])) for i in range(n)]


@pytest.mark.parametrize("tile_rows", [100, 20_000])
def test_matches_brute_force_with_copies_and_ties(spark, tile_rows):
    rng = np.random.default_rng(5)
    p = [(r[0], r[0] % 3, *r[1:]) for r in _points(rng, 3000)]
    q = _points(rng, 60, 10_000) + [(20_000, 500.0, 500.0, 1), (20_001, 1.0, 2.0, 0)]
    assert _join(spark, q, p, 3, tile_rows) == _brute(q, p, 3)


def test_many_combinations_of_discrete_coordinates(spark, monkeypatch):
    monkeypatch.setattr(N, "MAX_DISCRETE", 1)
    rng = np.random.default_rng(15)
    p = [(r[0], r[0] % 3, *r[1:]) for r in _points(rng, 1500)]
    q = _points(rng, 40, 10_000)
    assert _join(spark, q, p, 3, 100) == _brute(q, p, 3)


def test_many_queries_in_one_tile_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(N, "QUERY_ROWS", 7)
    rng = np.random.default_rng(6)
    p = [(r[0], 0, *r[1:]) for r in _points(rng, 300)]
    q = [(1000 + i, float(rng.normal()), float(rng.normal()), 0) for i in range(80)]
    assert _join(spark, q, p, 5, 20_000) == _brute(q, p, 5)


def test_neighbours_across_cells_and_fewer_points_than_k(spark):
    # the query's own cell has one point, all others lie in the next cell
    p = [(1, 0, 9.0, 0.0, 0), (2, 1, 0.1, 0.0, 1), (3, 1, 0.2, 0.0, 1)]
    assert _join(spark, [(7, 0.0, 0.0, 0)], p, 2, 20_000) == {7: [2, 3]}
    assert _join(spark, [(7, 0.0, 0.0, 0)], p, 5, 20_000) == {7: [2, 3, 1]}


def test_null_coordinates_raise(spark):
    with pytest.raises(Exception, match="NULL coordinate"):
        _join(spark, [(7, None, 0.0, 0)], [(1, 0, 1.0, 1.0, 0)], 1, 20_000)


def test_majority_ties_go_to_the_smallest_label(spark):
    rows = [(1, 1), (1, 1), (1, 0), (1, 0), (1, -1), (2, -1), (2, 1), (3, 1), (3, 1), (3, 0)]
    votes = majority_label(spark.createDataFrame(rows, "id long, label int"), "id", "v")
    assert {r["id"]: r["v"] for r in votes.collect()} == {1: 0, 2: -1, 3: 1}


def _people(spark, n=200, missing=(3, 50)):
    rng = np.random.default_rng(8)
    rows = [(i, int(rng.integers(0, 9)), float(rng.random() * 900), int(rng.integers(1, 5)), int(rng.integers(0, 400)),
             int(rng.integers(0, 2)), int(rng.integers(0, 2)), fixed.GEO_LEVELS[i % 3],
             -2 if i in missing else int(rng.integers(0, 2))) for i in range(n)]
    cols = ("id long, 12m_call_history int, ann_prm_amt double, household_policy_counts int, tenure_at_snapshot int, "
            "digital_contact_ind int, has_prior_carrier int, geo_group string, pol_edeliv_ind int")
    return spark.createDataFrame(rows, cols)


def test_imputation_fills_only_the_sentinel(spark):
    df = _people(spark)
    filled, imputer = fit_impute(df)
    got = {r["id"]: r[fixed.FILLED] for r in filled.collect()}
    before = {r["id"]: r["pol_edeliv_ind"] for r in df.collect()}
    assert set(got) == set(before) and got[3] in (0, 1) and got[50] in (0, 1)
    assert all(got[i] == before[i] for i in before if i not in (3, 50))
    nothing = imputer.apply(df.where("pol_edeliv_ind != -2"))
    assert nothing.count() == 198 and fixed.FILLED in nothing.columns


def test_unknown_codes_are_predicted_but_not_written_back(spark):
    df = _people(spark).withColumn("pol_edeliv_ind", F.when(F.col("id") == 9, 7).when(F.col("id") == 10, F.lit(None))
                                   .otherwise(F.col("pol_edeliv_ind")).cast("int"))
    imputer = fit_imputer(df)
    assert {r["id"] for r in imputer.predict(df).collect()} == {3, 9, 10, 50}
    got = {r["id"]: r[fixed.FILLED] for r in imputer.apply(df).collect()}
    assert got[9] == 7 and got[10] is None and len(got) == 200


def test_fill_from_leaves_unmatched_sentinels_null(spark):
    df = spark.createDataFrame([(1, -2), (2, -2), (3, 1)], "id long, pol_edeliv_ind int")
    imputed = spark.createDataFrame([(1, 0)], "id long, imputed int")
    got = {r["id"]: r[fixed.FILLED] for r in fill_from(df, imputed).collect()}
    assert got == {1: 0, 2: None, 3: 1}


def test_tiles_are_bounded_but_for_copies_of_one_point(spark):
    rng = np.random.default_rng(12)
    n = 20_000
    rows = [(0, float(c), 0.0 if z else float(v), float(w), 1.0) for c, z, v, w in zip(
        rng.integers(0, 4, n), rng.random(n) < 0.6, rng.gamma(2, 50, n), rng.normal(size=n))]
    rows += [(0, 0.0, 0.0, 9.0, 1.0)] * 700
    points = spark.createDataFrame(rows, "tile long, count double, zero double, wide double, flat double").repartition(4)
    tiled, depth = N._split_tiles(points, ["count", "zero", "wide", "flat"], 200)
    sizes = tiled.groupBy("tile").agg(F.count("*").alias("n"), F.countDistinct("count", "zero", "wide").alias("d")).collect()
    assert depth > 1 and max(r["n"] for r in sizes if r["d"] > 1) <= 200
    assert sum(r["n"] for r in sizes) == n + 700
    skewed = [(0, 0.0, 0.0, 0.0, 1.0)] * 900 + [(0, float(i), 0.0, 0.0, 1.0) for i in range(1, 30)]
    tiled, _ = N._split_tiles(spark.createDataFrame(skewed, points.schema), ["count", "zero", "wide", "flat"], 100)
    sizes = tiled.groupBy("tile").agg(F.count("*").alias("n"), F.countDistinct("count").alias("d")).collect()
    assert max([r["n"] for r in sizes if r["d"] > 1], default=0) <= 100


def test_tiled_points_are_a_written_table(spark):
    rng = np.random.default_rng(5)
    points = spark.createDataFrame([(0, *map(float, r)) for r in rng.normal(size=(3000, 2))], "tile long, a double, b double")
    tiled, depth = N._split_tiles(points, ["a", "b"], 200)
    plan = tiled._jdf.queryExecution().optimizedPlan().toString()
    assert depth >= 1 and "Relation" in plan and "Join" not in plan  # places on earlier levels are not worked out again


def test_a_bound_from_groups_keeps_the_nearest():
    rng = np.random.default_rng(6)
    for n, take in ((5000, 5), (161, 5), (40, 5), (5, 5)):
        d2 = np.round(rng.random((7, n)), 2)
        exact = np.sort(d2, axis=1)[:, take - 1:take]
        bound = N._bound(d2, take)
        assert (bound >= exact).all() and ((d2 <= bound).sum(1) >= take).all()
        if n == 5000:
            assert (d2 <= bound).sum() < d2.size / 4
    d2[0] = np.nan
    assert np.isnan(N._bound(d2, 5)[0]).all()


def test_a_saved_index_reads_only_the_folders_it_visits(spark, tmp_path):
    rng = np.random.default_rng(21)
    p = [(i, i % 3, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(rng.random(4000) * 100, rng.random(4000) * 100, rng.integers(0, 3, 4000)))]
    points = spark.createDataFrame(p, "id long, label int, a double, b double, c int")
    N.build_index(points, ["a", "b"], ["c"], 3, "id", "label", 100, str(tmp_path / "index"))
    index = N.TileIndex.load(spark.newSession(), str(tmp_path / "index"))
    q = [(i, float(a), 10.0, 1) for i, a in enumerate(rng.random(20) * 10)]
    asked = spark.createDataFrame(q, "id long, a double, b double, c int")
    got = {}
    for r in index.search(asked, "id", 2).collect():
        got.setdefault(r["id"], {})[r["place"]] = r["nid"]
    assert {i: [v[1], v[2]] for i, v in got.items()} == _brute(q, p, 2)
    tiles = index.tiles.select("tile", "shard").collect()
    read = index.at(spark.createDataFrame([(tiles[0]["tile"],)], "tile long"))
    assert len({r["shard"] for r in tiles}) == len(tiles) > 20
    assert {r["tile"] for r in read.select("tile").distinct().collect()} == {tiles[0]["tile"]}
    assert f"PartitionFilters: [isnotnull(shard" in read._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="at most"):
        index.search(asked, "id", 4)


def test_a_saved_imputer_fills_as_the_fitted_one(spark, tmp_path):
    from zerotally.operators.imputation import Imputer

    df = _people(spark)
    filled, imputer = fit_impute(df)
    imputer.save(spark, str(tmp_path / "imputer"))
    again = Imputer.load(spark, str(tmp_path / "imputer"))
    assert again.scales == imputer.scales
    assert sorted(map(tuple, again.apply(df).collect())) == sorted(map(tuple, filled.collect()))


def test_searches_without_queries_or_points(spark):
    points = spark.createDataFrame([], "id long, label int, a double, b double, c int")
    asked = spark.createDataFrame([(1, 0.0, 0.0, 0)], "id long, a double, b double, c int")
    assert nearest_neighbours(asked, points, ["a", "b"], ["c"], 2, "id", "id", "label").count() == 0
    one = spark.createDataFrame([(5, 1, 0.0, 0.0, 0)], points.schema)
    assert nearest_neighbours(asked.limit(0), one, ["a", "b"], ["c"], 2, "id", "id", "label").count() == 0


def test_a_tile_is_cut_by_all_its_coordinates_at_once(spark):
    rng = np.random.default_rng(31)
    rows = [(0, *map(float, v)) for v in rng.random((6000, 4))]
    tiled, depth = N._split_tiles(spark.createDataFrame(rows, "tile long, a double, b double, c double, d double"), list("abcd"), 460)
    sizes = [r["count"] for r in tiled.groupBy("tile").count().collect()]
    assert depth == 1 and len(sizes) == 16 and max(sizes) <= 460


def test_queries_and_searches_are_dealt_to_all_cores(spark):
    rng = np.random.default_rng(32)
    p = [(i, i % 3, float(a), float(b), i % 7) for i, (a, b) in enumerate(rng.random((2000, 2)))]
    points = spark.createDataFrame(p, "id long, label int, a double, b double, c int")
    index = N.build_index(points, ["a", "b"], ["c"], 3, "id", "label")
    q = spark.createDataFrame([(i, float(a), 0.5, i % 7) for i, a in enumerate(rng.random(400))], "id long, a double, b double, c int")
    dims = N._dims(index.names)
    home = q.select(F.col("id").alias("qid"), *N._coordinates(q, index.names)).join(index.tiles.select("tile", "lo2"), F.col("_x2") == F.col("lo2")).drop("lo2")
    found = N._search(home, index.at(home), dims, 3)
    # a handful of bytes, but no fewer tasks than the session's partitions
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "LocalTableScan" in N._tile_by_discrete(points.select(F.col("c").cast("double").alias("_x2"), "id"), ["_x2"])._jdf.queryExecution().toString()
