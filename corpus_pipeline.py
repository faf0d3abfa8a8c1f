"""From raw documents to packed sequences: quality, exact copies, near copies, source mix, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last give back the
columns of `documents`; the last gives the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zerotally.llm import exact_dedup, mixing, near_dedup, packing, quality
from zerotally.llm.queries import quality_model, vocabulary
from zerotally.workspace import materialise


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the learning folds of `labels`, does not reject.

    Null counts as the empty text and is judged like it. Whole texts are read, however long; repeated rows are judged
    each, and all their columns stay as they are; an empty table gives no rows.
    """
    return quality.keep_good(docs, quality_model(spark, docs, sf_dir))


def _boxed(docs: DataFrame) -> DataFrame:
    """Rows as one struct `row`, so that no column that they bring, whatever its name, meets the stage's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def _unboxed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _id(c: Column) -> Column:
    """An id as text that tells a null from all others."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id; of rows that repeat that id too, one.

    Null counts as the empty text; such a group keeps a row with a text before one without. Rows without an id stay only if
    their whole group has none. Texts go whole, through one exchange; an empty table gives no rows.
    """
    key = lambda id_, sha: F.concat(_id(id_), F.lit(":"), sha)
    kept = exact_dedup.exact_groups(docs).where("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias("key")).distinct()
    rows = _boxed(docs).withColumn("key", key(F.col("row.doc_id"), F.sha2(F.coalesce("row.text", F.lit("")), 256)))
    one = Window.partitionBy("key").orderBy(F.col("row.text").isNull())
    return _unboxed(rows.join(kept, "key", "left_semi").withColumn("n", F.row_number().over(one)).where("n = 1"), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by five-word shingles at a similarity of 0.8 or more: the one with the least id.

    Null and empty texts are linked with nothing and stay. Rows that repeat a kept id stay; one without an id is a group
    of its own. Very long texts take part whole; an empty table gives no rows.
    """
    kept = near_dedup.near_groups(docs, words=5, tenths=8).where("kept").select(_id(F.col("doc_id")).alias("key")).distinct()
    return _unboxed(_boxed(docs).withColumn("key", _id(F.col("row.doc_id"))).join(kept, "key", "left_semi"), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole and part copies of documents so that sources come near their target weights.

    Null is a source of its own. Documents without words, null texts among them, are never taken. Texts may be very long;
    rows that repeat an id are documents of their own; an empty table gives no rows.
    """
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens.

    A null text is the empty one, a piece of one token. Longer texts are cut; repeated rows are packed each; an empty table
    gives no rows; of the columns only doc_id and text are read.
    """
    return packing.pack(docs, vocabulary())


STAGES = [("quality classifier", good_quality), ("exact dedup", without_exact_copies),
          ("MinHash near-dedup", without_near_copies), ("mixing sources to target weights", mixed),
          ("best-fit packing", packed)]

#: Compression and tokenising have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
