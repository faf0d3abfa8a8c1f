"""URL verdicts: host and path rules first, a model over hashed character n-grams for the rest.

The model is a logistic regression that Spark ML trains on a small labelled table of URLs. Features are counts of the
character n-grams of host and path, hashed to `FEATURES` buckets. All of it runs in the JVM: string functions,
higher-order functions and Spark ML.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zerotally.llm.frames import ascii_lower

FEATURES = 1 << 14
GRAMS = (2, 3, 4)
#: Labelled URLs that the model may train on, for each label.
TRAINING_URLS = 2000

Rule = tuple[str, str]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: what follows the first `://` up to / ? # or the end (A-Z lower-cased), then up to ? # or the end.
    Both are empty for null and for text without `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; nulls where none fits. `rules` holds (verdict, host/path) pairs."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # later, so longer, rules are asked first
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{tail}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column, sizes: Sequence[int] = GRAMS) -> Column:
    """Array of character n-grams, marked h or p for the part they come from; ^ and $ mark a part's ends."""
    def of(mark: str, part: Column, n: int) -> Column:
        starts = F.when(F.length(part) >= n, F.sequence(F.lit(1), F.length(part) - n + 1))
        pieces = F.transform(starts, lambda i: F.concat(F.lit(mark), part.substr(i, F.lit(n))))
        return F.coalesce(pieces, F.array().cast("array<string>"))

    ends = [(mark, F.concat(F.lit("^"), part, F.lit("$"))) for mark, part in (("h", host), ("p", path))]
    parts = [of(mark, part, n) for mark, part in ends for n in sizes]
    return F.concat(*parts)


def _hashed(df: DataFrame) -> DataFrame:
    tf = HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="features")
    return tf.transform(df.withColumn("grams", grams(F.col("host"), F.col("path")))).drop("grams")


def labelled_urls(parsed: DataFrame, per_label: int = TRAINING_URLS) -> DataFrame:
    """A small labelled table: for each verdict of the rules, the `per_label` different URLs with the lowest hash."""
    seen = parsed.where("verdict is not null").select("host", "path", "verdict").distinct()
    pick = lambda v: (seen.where(F.col("verdict") == v).orderBy(F.xxhash64("host", "path"), "host", "path")
                      .limit(per_label))
    return pick("allow").unionByName(pick("block"))


def train(labelled: DataFrame, max_iter: int = 40, reg: float = 0.01) -> LogisticRegressionModel | None:
    """Model from (host, path, verdict) rows; None if there is no labelled row."""
    data = _hashed(labelled).select("features", (F.col("verdict") == "block").cast("double").alias("label"))
    data = data.coalesce(1).persist()
    try:
        if data.isEmpty():
            return None
        return LogisticRegression(maxIter=max_iter, regParam=reg).fit(data)
    finally:
        data.unpersist()


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
               labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, p_block.

    A rule fits its host and all subdomains if the path starts with the rule's path; the longest fitting rule decides.
    Other URLs are blocked if the model gives at least `threshold`. The model learns from `labelled` (host, path,
    verdict), or else from `labelled_urls` of these pages. Without any labelled row p_block is null and pages that no
    rule decides are allowed. Null URLs and URLs without `://` have empty host and path. Repeated rows are judged each.
    """
    host, path = split_url(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": rule, "verdict": verdict})
    model = train(labelled if labelled is not None else labelled_urls(parsed))
    if model is None:
        return parsed.withColumns({"verdict": F.coalesce("verdict", F.lit("allow")),
                                   "p_block": F.lit(None).cast("double")})
    scored = (model.transform(_hashed(parsed))
              .withColumn("p_block", vector_to_array("probability")[1]))
    said = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", said).alias("verdict"), "p_block")
