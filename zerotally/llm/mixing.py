"""Mixing sources to target weights with Sainte-Lague apportionment of equal blocks.

Sources share a number of words by weight, capped at a multiple of what they hold. Blocks of `BLOCK` words are seats:
the seats of the whole mix go to sources by the highest quotients target / (2 s + 1), and the seats of a source go to
its shards in the same way by shard size. A shard lays its documents end to end in seeded order, cuts that line
into blocks and takes whole rounds of all blocks plus a seeded choice of the rest. All of it is DataFrame arithmetic;
the text is read once, to count its words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zerotally.workspace import materialise

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 32
SHARD_DOCS = 10_000
SEED = 7
STRIDE = 982_451_653  # a prime, larger than any shard's number of blocks


def word_sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size in words (null text: 0), `at`, the row's place in this reading of `docs`, and columns to keep."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.monotonically_increasing_id().alias("at"), *keep)


def seeded_keys(sizes: DataFrame, seed: int = SEED) -> DataFrame:
    """`sizes` with a seeded `key` per row: of id, source, size and a number among the rows that agree in all three.

    So rows that repeat an id spread like others, and the keys do not depend on how the rows lie. Rows are counted by
    partition of the reading and numbered inside of it: no group is larger than one of its partitions.
    """
    known = lambda c: F.when(F.col(c).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(c).cast("string")))
    same = F.md5(F.concat_ws(":", F.col("size").cast("string"), known("doc_id"), known("source"), F.lit(str(seed))))
    rows = sizes.withColumn("same", same).withColumn("part", F.shiftright("at", 33))  # the id holds its partition above bit 33
    earlier = Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("same", "part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(earlier))
              .where("before > 0").select("same", "part", "before"))
    nth = F.row_number().over(Window.partitionBy("same", "part").orderBy("at")) + F.coalesce("before", F.lit(0))
    return (rows.join(starts, ["same", "part"], "left")
            .withColumn("key", F.md5(F.concat_ws(":", "same", nth.cast("string")))).drop("same", "part", "before"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """rk, source, n_docs, source_size, target. Sources by code point, null last, take the weights in turn. A target
    stops at `cap` times its source's size and the excess goes to the others by weight: in rising order of
    cap / weight, all before the first source that the common rate leaves below its cap are full."""
    sources = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    each = F.array(*[F.lit(w) for w in weights])
    s = (sources.withColumn("rk", F.row_number().over(by_name) - 1)
         .withColumn("w", each[F.col("rk") % len(weights)])
         .withColumn("most", F.col("source_size") * cap))
    order = Window.orderBy(F.col("most") / F.col("w"), "rk").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    zero = F.lit(0).cast("long")
    s = (s.withColumn("full", F.coalesce(F.sum("most").over(order), zero))
         .withColumn("used", F.coalesce(F.sum("w").over(order), zero))
         .withColumn("rate", (F.sum("source_size").over(every) * F.lit(float(share)) - F.col("full"))
                     / (F.sum("w").over(every) - F.col("used")))
         .withColumn("fits", F.col("rate") * F.col("w") <= F.col("most")))
    s = s.withColumn("first", F.min(F.when(F.col("fits"), F.col("used"))).over(every))
    s = s.withColumn("level", F.min(F.when(F.col("used") == F.col("first"), F.col("rate"))).over(every))
    target = F.when(F.col("used") >= F.col("first"), F.col("level") * F.col("w")).otherwise(F.col("most").cast("double"))
    return s.select("rk", "source", "n_docs", "source_size", F.least(target, F.col("most").cast("double")).alias("target"))


def apportion(votes: DataFrame, group: Sequence[str], item: str, vote: str, seats: str) -> DataFrame:
    """`votes` with column `won`: the `seats` of each group given out by the highest quotients vote / (2 s + 1), ties
    to the lower item.

    With k items and V votes, no item has fewer than vote * (seats - k / 2) / V seats, rounded, and those seats leave at most k
    over. Only the next few quotients of each item compete for these, so the work does not grow with the seats.
    """
    of = Window.partitionBy(*group)
    v = (votes.withColumn("_all", F.sum(F.col(vote).cast("double")).over(of))
         .withColumn("_k", F.sum(F.when(F.col(vote) > 0, 1).otherwise(0)).over(of)))
    share = F.col(vote) * F.greatest(F.col(seats) - F.col("_k") / 2, F.lit(0.0)) / F.col("_all")
    v = v.withColumn("_base", F.when(F.col(vote) > 0, F.greatest(F.ceil(share - 0.5), F.lit(0))).otherwise(0).cast("long"))
    v = v.withColumn("_left", F.col(seats) - F.sum("_base").over(of))
    more = F.when((F.col(vote) > 0) & (F.col("_left") > 0),
                  F.sequence(F.lit(0), (F.floor(F.col(vote) * F.col("_k") / F.col("_all")) + 2).cast("int")))
    tries = v.select(*group, item, "_left", F.col("_base"), F.col(vote).alias("_v"), F.explode(more).alias("_s"))
    best = Window.partitionBy(*group).orderBy(F.desc(F.col("_v") / (2 * (F.col("_base") + F.col("_s")) + 1)), item, "_s")
    extra = (tries.withColumn("_n", F.row_number().over(best)).where("_n <= _left")
             .groupBy(*group, item).agg(F.count("*").alias("_extra")))
    return (v.join(extra, [*group, item], "left")
            .withColumn("won", F.col("_base") + F.coalesce("_extra", F.lit(0)))
            .drop("_all", "_k", "_base", "_left", "_extra"))


def _chosen(j: Column) -> Column:
    """Whether block j is among the shard's extra ones: a seeded rotation at a stride prime to the number of blocks."""
    return F.pmod(j * STRIDE + F.col("turn"), F.col("n_blocks")) < F.col("odd")


def plan_mix(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: int = 2,
             block: int = BLOCK, shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """`sizes` rows with source_size, target, and where the document lies: start (in its shard's line of words),
    rounds (how often every block is taken), odd, turn and n_blocks (which blocks are taken once more). `sizes` is read
    several times and must be a written table."""
    whole = lambda c: F.conv(F.substring(c, 1, 8), 16, 10).cast("long")
    sources = source_targets(sizes, weights, share, cap)
    seats = apportion(sources.withColumn("_one", F.lit(1)).withColumn(
        "seats", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")),
        ["_one"], "rk", "target", "seats")
    seats = seats.select("rk", F.col("source").alias("_source"), "n_docs", "source_size", "target", F.col("won").alias("seats"))
    seats = materialise(seats, "mix-sources")
    docs = (seeded_keys(sizes, seed).join(seats, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("shard", (whole(F.col("key")) % F.ceil(F.col("n_docs") / shard_docs)).cast("long")))
    docs = materialise(docs, "mix-keys")
    shards = (docs.groupBy("rk", "shard").agg(F.sum("size").alias("shard_size"), F.first("seats").alias("seats")))
    blocks = F.ceil(F.col("shard_size") / block)
    taken = F.least(F.col("won"), cap * blocks)
    shards = (apportion(shards, ["rk"], "shard", "shard_size", "seats").withColumn("n_blocks", F.greatest(blocks, F.lit(1)))
              .select("rk", "shard", "n_blocks", F.floor(taken / F.col("n_blocks")).alias("rounds"),
                      (taken % F.col("n_blocks")).alias("odd"),
                      whole(F.md5(F.concat_ws(":", F.col("rk").cast("string"), F.col("shard").cast("string"), F.lit(str(seed))))).alias("turn")))
    line = Window.partitionBy("rk", "shard").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return (docs.join(shards, ["rk", "shard"])
            .withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0))))


def _blocks(block: int) -> Column:
    """Numbers of the blocks that a document touches; null for one without words."""
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    return F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), last))


def _within(j: Column, block: int) -> tuple[Column, Column]:
    """First word and number of words of block j inside the document."""
    low = F.greatest(F.col("start"), j * block)
    return low - F.col("start"), F.least(F.col("start") + F.col("size"), (j + 1) * block) - low


def mix(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    Null and empty texts have size 0 and are taken 0 times; null is a source of its own, after the others. Rows that
    repeat an id are documents of their own. An empty table gives no rows. Reruns give the same rows.
    """
    sizes = materialise(word_sizes(docs, id_col, source_col, text_col), "mix-sizes")
    plan = plan_mix(sizes, block=block, **options)
    odd = F.aggregate(_blocks(block), F.lit(0).cast("long"),
                      lambda n, j: n + F.when(_chosen(j), _within(j, block)[1]).otherwise(F.lit(0)).cast("long"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("rounds") * F.col("size") + F.coalesce(odd, F.lit(0))).alias("taken"))


def mixed_documents(docs: DataFrame, block: int = BLOCK, seed: int = SEED, **options) -> DataFrame:
    """The mix itself, with the columns of `docs`: a row for every whole round that takes a document, with its text as
    it is, and one row for the words of its blocks that are taken once more, each with the white space before it. The
    columns doc_id, source and text are read; n_chars, if there is one, is set to the length of the new text. Documents
    without words are never taken. Rows that agree in id, source and size take these documents' places in any order.

    The rows are written once, so that a row's place names it in the plan and with its text; texts move once, by place.
    """
    columns = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    rows = materialise(word_sizes(boxed, "row.doc_id", "row.source", "row.text", keep=["row"]), "mix-rows")
    plan = plan_mix(rows.drop("row"), block=block, seed=seed, **options).where("size > 0").select(
        "at", "start", "size", "n_blocks", "rounds", "odd", "turn")
    picked = F.coalesce(F.filter(_blocks(block), _chosen), F.array().cast("array<bigint>"))
    some = F.aggregate(picked, F.lit(0).cast("long"), lambda n, j: n + _within(j, block)[1])
    plan = plan.withColumn("some", some).where("rounds > 0 or some > 0")
    text = F.col("row.text")
    words_of = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = lambda j: F.slice(F.col("words"), (_within(j, block)[0] + 1).cast("int"), _within(j, block)[1].cast("int"))
    part = F.when(F.col("some") == F.col("size"), text).otherwise(F.array_join(F.flatten(F.transform(picked, cut)), ""))
    texts = F.concat(F.array_repeat(text, F.col("rounds").cast("int")),
                     F.when(F.col("some") > 0, F.array(part)).otherwise(F.array().cast("array<string>")))
    taken = (rows.select("at", "row").join(plan, "at")
             .withColumn("words", F.when((F.col("some") > 0) & (F.col("some") < F.col("size")), words_of))
             .select("row", F.explode(texts).alias("new_text")))
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return taken.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])
