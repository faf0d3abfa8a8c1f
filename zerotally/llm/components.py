"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zerotally.workspace import materialise

MAX_ROUNDS = 200


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    turned = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge that is not the least of its component, which is `component`.

    Edges shrink to a star per component; every round is written, and the rounds end when one changes nothing. A node
    with very many neighbours only meets the least of them, so that no neighbour list is ever gathered. Edges with
    a null end and loops are left out.
    """
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = materialise(e, "edges")
    mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        e = materialise(_small_star(_large_star(e)), "edges")
        before, mark = mark, e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
    else:
        raise RuntimeError("the components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
