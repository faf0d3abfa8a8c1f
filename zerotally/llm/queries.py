"""The registered queries of the subpackage and the SQL that some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from zerotally.llm import (conversations, exact_dedup, html_text, language_id, licence_scan, mixing, near_dedup, nearest, packing,
                           quality, repeats, url_filter, whitening)
from zerotally.llm.frames import fold_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/")]


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return keep


@query("op1_licence_scan")
def op1_licence_scan(spark, folder):
    return licence_scan.scan_licences(table(spark, folder, "documents"))


@query("op2_url_filter")
def op2_url_filter(spark, folder):
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)


@query("op3_remove_repeats")
def op3_remove_repeats(spark, folder):
    return repeats.remove_repeats(table(spark, folder, "documents"))


@query("op4_language_id")
def op4_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = fold_of(F.col("doc_id")) == 0
    return language_id.identify(docs, language_id.train(docs.where(~held_out)), held_out=held_out)


def quality_model(spark, docs, folder):
    """Trained on labels of the learning folds."""
    return quality.train(table(spark, folder, "labels").where(fold_of(F.col("doc_id")) != 0), docs)


@query("op5_quality")
def op5_quality(spark, folder):
    docs = table(spark, folder, "documents")
    return quality.score_quality(docs, quality_model(spark, docs, folder), held_out=fold_of(F.col("doc_id")) == 0)


@query("op6_nearest")
def op6_nearest(spark, folder):
    return nearest.search(table(spark, folder, "embeddings"))


@query("op7_mix_sources")
def op7_mix_sources(spark, folder):
    return mixing.mix(table(spark, folder, "documents"))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op8_pack")
def op8_pack(spark, folder):
    return packing.pack(table(spark, folder, "documents"), vocabulary())


@query("op9_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""")
def op9_exact_dedup(spark, folder):
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@query("op10_near_dedup", r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
whole AS (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS h FROM s GROUP BY doc_id),
rep AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS r FROM whole),
u AS (SELECT s.doc_id, s.g FROM s JOIN rep USING (doc_id) WHERE doc_id = r),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM u x JOIN u y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n m ON m.doc_id = a JOIN n k ON k.doc_id = b WHERE 100 * c >= 80 * (m.n + k.n - c)
      UNION ALL SELECT r, doc_id FROM rep WHERE r <> doc_id),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, e2.b FROM reach r JOIN e2 ON e2.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, t.doc_id) AS component_id,
       coalesce(c.component_id, t.doc_id) = t.doc_id AS kept
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
""")
def op10_near_dedup(spark, folder):
    return near_dedup.near_groups(table(spark, folder, "documents"), words=4, tenths=8)


@query("op11_html_text")
def op11_html_text(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


@query("op12_repair_conversations")
def op12_repair_conversations(spark, folder):
    return conversations.repair(conversations.damage(table(spark, folder, "conversations")))


@query("op13_whiten")
def op13_whiten(spark, folder):
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))
