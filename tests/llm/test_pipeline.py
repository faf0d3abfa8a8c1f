"""The pipeline's stages, each on what the one before it kept, and the SQL of the registered queries."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from zerotally.workspace import materialise

corpus_pipeline = pytest.importorskip("corpus_pipeline")
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def stages(spark):
    docs, made = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        made.append((docs, materialise(stage(spark, docs, FOLDER), "t")))
        docs = made[-1][1]
    return made


def test_stages_keep_the_columns_of_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    for docs, made in stages[:-1]:
        assert made.schema.simpleString() == docs.schema.simpleString() and made.count() > 0


def test_filters_keep_rows_as_they_are(stages):
    for docs, made in stages[:3]:
        assert {tuple(r) for r in made.collect()} <= {tuple(r) for r in docs.collect()}


def test_exact_stage_leaves_each_text_once(stages):
    docs, made = stages[1]
    last = {}
    for r in docs.collect():
        last[r["text"] or ""] = max(r["doc_id"], last.get(r["text"] or "", -1))
    assert sorted((r["text"] or "", r["doc_id"]) for r in made.collect()) == sorted(last.items())


def test_near_stage_leaves_the_least_of_each_group(stages):
    from tests.llm.test_near import brute

    docs, made = stages[2]
    want = {i for i, _, _, kept in brute([(r["doc_id"], r["text"]) for r in docs.collect()], 5) if kept}
    assert sorted(r["doc_id"] for r in made.collect()) == sorted(want)


def test_exact_stage_with_repeated_rows_and_nulls(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (2, "a", "y"), (2, "a", "y"), (3, None, "z"), (None, "", None), (None, "n", None), (4, "n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(corpus_pipeline.without_exact_copies(spark, docs, FOLDER).collect(), key=repr)
    assert [(r["doc_id"], r["text"]) for r in got] == [(2, "a"), (3, None), (4, "n")]


def test_columns_with_names_of_the_stages_own_stay_as_they_are(spark):
    extra = ["_id", "_sha", "_n", "_row", "row", "key", "n", "_key", "_size", "_text", "label", "place"]
    docs = (spark.read.parquet(f"{FOLDER}/documents.parquet").select("*", *[F.concat(F.lit(c), F.lit(":"), F.col("doc_id")).alias(c) for c in extra]))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = materialise(stage(spark, docs, FOLDER), "t")
        assert made.columns == docs.columns and made.count() > 0
        assert all(r[c] == f"{c}:{r['doc_id']}" for r in made.collect() for c in extra)
        docs = made
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() > 0


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


@pytest.mark.parametrize("name", ["op9_exact_dedup", "op10_near_dedup"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    result = con.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    got = entry_points.queries()[name](spark, FOLDER).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(result.fetchall())


def test_all_queries_are_registered():
    names = set(entry_points.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names


@pytest.mark.parametrize("name", ["op1_licence_scan", "op2_url_filter", "op3_remove_repeats", "op6_nearest", "op7_mix_sources", "op8_pack", "pipeline"])
def test_registered_query_covers_its_table(spark, name):
    rows = entry_points.queries()[name](spark, FOLDER).collect()
    table, key = {"op2_url_filter": ("pages", "page_id"), "op6_nearest": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    ids = {r[0] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect()}
    if name == "op6_nearest":
        assert {r["query_id"] for r in rows} == {i for i in ids if i % 20 == 0}
    elif name == "pipeline":
        assert rows and {r["doc_id"] for r in rows} <= ids
    else:
        assert {r[key] for r in rows} == ids
