"""Near copies and nearest neighbours against brute force."""

import math
import random

import numpy as np
import pytest

from zerotally.llm import near_dedup, nearest
from zerotally.llm.components import components


def _shingles(text, n):
    w = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", w)]
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n):
    sets = [(i, _shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [(i, len(s), root(i) if i is not None else None, i is None or root(i) == i) for i, s in sets]


def _rows(seed):
    rng = random.Random(seed)
    text = lambda n: [f"W{rng.randint(0, 3000)}" for _ in range(n)]
    common = text(30)
    rows = []
    for group in range(14):
        words = text(rng.randint(3, 120))
        if group % 3 == 0:
            words = common + words
        for _ in range(rng.choice([1, 1, 2, 6, 25])):
            rows.append(list(words))
            words = list(words) if rng.random() < 0.5 else words  # half of the copies drift on from their predecessor
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 3000)}"
    rows += [text(2), ["one"], ["One"], common, common + ["x"]]
    ids = rng.sample(range(10_000), len(rows))
    return [(i, " ".join(w)) for i, w in zip(ids, rows)]


@pytest.mark.parametrize("seed,words,k", [(1, 4, 32), (2, 5, 32), (3, 4, 24)])
def test_groups_match_all_pairs(spark, seed, words, k):
    rows = _rows(seed) + [(20_001, None), (20_002, ""), (20_003, " \n"), (None, "a b c d e"), (None, "a b c d e"), (20_004, "a B c\td e"), (20_005, "A b c d e"),
                          (20_006, "long " * 60_000), (20_007, "long " * 60_001)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rep long, value string").repartition(5)
    got = near_dedup.near_groups(docs, words=words, k=k).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows, words)))


def test_rows_with_one_id_and_no_rows(spark):
    same = [(1, "a b c d e f"), (1, "g h i j k l"), (2, "A b c d e f"), (3, "g h i j k l")]
    docs = spark.createDataFrame(same, "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in near_dedup.near_groups(docs).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert near_dedup.near_groups(docs.limit(0)).count() == 0


def test_values_in_common_are_those_of_the_whole_matrix():
    rng = np.random.default_rng(3)
    values = [rng.choice(400, rng.integers(0, 48), replace=False).astype(np.int64) - 200 for _ in range(301)]
    dense = np.zeros((301, 400))
    for row, of in enumerate(values):
        dense[row, of + 200] = 1
    for some in (values, values[:1], [v[:0] for v in values]):
        counts, whole = near_dedup.in_common(some), dense[:len(some)] * (sum(map(len, some)) > 0)
        strips = [counts(low) for low in range(0, len(some), near_dedup._ROWS)]
        assert max(len(s) for s in strips) <= near_dedup._ROWS
        assert (np.concatenate(strips) == whole @ whole.T).all()


def test_least_overlap_leaves_out_less_than_the_miss():
    need = near_dedup.least_overlap(32, 8)
    tail = lambda n: sum(math.comb(32, i) * 0.8 ** i * 0.2 ** (32 - i) for i in range(n))
    assert tail(need) <= near_dedup.MISS < tail(need + 1)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 400)] + [(399, 500), (500, 3), (9, 9), (None, 1)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(101, 141)} == {100}
    assert {got[i] for i in [*range(200, 400), 500, 7]} == {3}
    assert not {3, 9, 100, 1} & set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.array([v for _, v in good])
    out = []
    for q, v in good:
        if q % 20 == 0:
            best = sorted((-float((v * y).sum()), i) for i, y in good if i != q)[:k]
            out += [(q, r + 1, i, round(-s, 9)) for r, (s, i) in enumerate(best)]
    return out


def test_neighbours_of_few_rows_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=8).astype(float).tolist()) for i in range(130)]
    rows += [(i, [1.0] * 8) for i in range(200, 261)] + [(500, None), (520, [0.0] * 8), (540, []), (560, [1.0, None] + [0.0] * 6),
                                                        (580, [float("nan")] * 8), (600, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (620, [30.0] + [0.0] * 7)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<double>, point int").repartition(4)
    got = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in nearest.search(df).collect()]
    assert sorted(got) == sorted(_nearest(rows, 20))
    few = df.where("vec_id in (0, 1, 2)")
    assert nearest.search(few).count() == 2
    assert nearest.search(df.limit(0)).count() == 0
    assert nearest.search(df.where("vec_id = 520")).count() == 0


def test_recall_of_windows(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 24)) * rng.uniform(0.5, 2, (4000, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {(r["query_id"], r["vec_id"]) for r in nearest.search(df, curves=nearest.Curves(cell=100)).collect()}
    score = x[::20] @ x.T
    score[np.arange(200), np.arange(0, 4000, 20)] = -np.inf
    true = {(int(q) * 20, int(j)) for q, row in enumerate(score) for j in np.argpartition(-row, 20)[:20]}
    assert len(found & true) >= 0.9 * len(true)


@pytest.mark.parametrize("dims,bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_hilbert_keys_walk_to_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = nearest.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(1 << bits * dims))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("cell", [16, 4096])
def test_ties_of_different_vectors_go_to_the_smaller_ids(spark, cell):
    # vectors that agree in what the query sees and differ in the rest
    rows = [(0, [1.0, 0.0, 0.0])] + [(i, [0.5, float(i), float(-i)]) for i in range(1, 101)]
    curves = nearest.Curves(cell=cell, share=1.0)
    got = [(r["vec_id"], r["score"]) for r in nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), curves=curves)
           .where("query_id = 0").orderBy("rank").collect()]
    assert got == [(i, 0.5) for i in range(1, 21)]
