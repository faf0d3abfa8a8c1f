"""Near duplicates by bottom-k sketches from one hash function.

Each document's shingles are hashed once; the k least values are its sketch. Documents with the same whole set are one
class from then on. Inverted lists of the retained values give candidates:

- Two sets as similar as asked share at least `need` of their k least values, but for a chance of `MISS`. So each class
  only enters the lists of its k - need + 1 rarest values, and common shingles (a passage that a third of the table
  carries) are left to those that have nothing rarer.
- The least class of a list is paired with all others of it. The pairs pass the size bound, the union-sketch estimate and the exact
  Jaccard test on full sets, and give components. A large group of near copies so costs a pair per member and list.
- Lists that still hold several components are looked through block against block: sketch overlaps of a block are one
  matrix product, a pair is only looked at in the first list it shares and while it is not connected, and what
  passes is tested on full sets there. Only confirmed links that connect something leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zerotally.llm.components import components
from zerotally.llm.frames import binary_text
from zerotally.workspace import materialise

SKETCH = 48
#: Classes of a list that meet in one task at most, on either side.
BLOCK = 2048
#: Classes compared at once with all that meet in a task.
_ROWS = 64
MISS = 1e-9
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `words` words; A-Z count as a-z. A shorter text is one shingle."""
    tokens = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not tokens:
        return np.empty(0, np.uint64)
    of = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    h = np.full(len(of) - width + 1, width, np.uint64)
    for i in range(width):
        h = _scramble(h * _MIX[0] + of[i:len(of) - width + 1 + i])
    return np.unique(h)


def least_overlap(k: int, tenths: int) -> int:
    """The most values that two sketches of k share in all but a `MISS` part of pairs with a Jaccard of `tenths` / 10."""
    p, chance = tenths / 10, 0.0
    for n in range(k + 1):
        chance += math.comb(k, n) * p ** n * (1 - p) ** (k - n)
        if chance > MISS:
            return max(1, n)
    return k


def sketches(docs: DataFrame, words: int, k: int = SKETCH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, whole (hash of the whole set), sketch (the k least hashes, in order)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, whole, least = [], [], []
            for text in binary_text(batch):
                found = shingle_set(text, words)
                n.append(len(found))
                whole.append(xxhash.xxh3_128_digest(found.tobytes()))
                least.append(found[:k].view(np.int64))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_shingles": n, "whole": whole, "sketch": least}, schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("whole", pa.binary()), ("sketch", pa.list_(pa.int64()))])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n_shingles long, whole binary, sketch array<bigint>"))


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and its shingle hashes as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "shingles": [shingle_set(t, words).tobytes() for t in binary_text(batch)]},
                schema=pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())]))
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles binary")


def inverted_lists(classes: DataFrame, k: int, need: int, tenths: int) -> DataFrame:
    """(value, rep, n): the lists of at least two classes, with each class under its rarest values only."""
    each = classes.select("rep", "n", F.explode("sketch").alias("value"))
    often = each.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    by_class = Window.partitionBy("rep", "n")
    m, have = F.least("n", F.lit(k)), F.count("*").over(by_class)
    overlap = F.least(F.lit(need), F.ceil(m * tenths / 10))
    # values of this class alone are its rarest and need no list
    room = F.when(have > m, have).otherwise(m - overlap + 1 - (m - have))  # more than m: two sets of one size under one id
    return (each.join(often, "value").withColumn("at", F.row_number().over(by_class.orderBy("df", "value")))
            .withColumn("room", room).where("at <= room").select("value", "rep", "n"))


def _fits(tenths: int):
    return F.least("n_a", "n_b") * 10 >= F.greatest("n_a", "n_b") * tenths


def likely_pairs(pairs: DataFrame, classes: DataFrame, k: int, tenths: int) -> DataFrame:
    """Pairs whose union sketch does not rule them out: of its k least values at least `need` are in both, or, where the
    sketches hold the whole sets, as many as asked."""
    need = least_overlap(k, tenths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            keep = []
            for p, q in zip(x, y):
                p, q = p.values.to_numpy().view(np.uint64), q.values.to_numpy().view(np.uint64)
                union = np.union1d(p, q)[:k]
                both = np.isin(union, p).astype(int) + np.isin(union, q) == 2
                whole = len(p) < k and len(q) < k
                keep.append(both.sum() * 10 >= tenths * len(union) if whole and len(np.union1d(p, q)) <= k else both.sum() >= min(need, math.ceil(len(union) * tenths / 10)))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda name: classes.select(F.col("rep").alias(name), F.col("sketch").alias(f"sketch_{name}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sketch_a", "sketch_b")
            .mapInArrow(run, "a long, b long"))


def verified_pairs(pairs: DataFrame, sets: DataFrame, tenths: int) -> DataFrame:
    """Pairs whose full sets have 10 * intersection >= tenths * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(s.as_buffer(), np.uint64) for s in (p, q))
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(10 * both >= tenths * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda name: sets.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"shingles_{name}"))
    return (pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "shingles_a", "shingles_b")
            .mapInArrow(run, "a long, b long"))


def near_groups(docs: DataFrame, words: int = 5, tenths: int = 8, k: int = SKETCH, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of `words`-word shingles have a Jaccard similarity of at least `tenths` / 10;
    component_id is the least doc_id that links reach, and kept says that it is the document's own. Null text and text
    without words have an empty set and no links. Rows that share an id are one document with several texts: what links
    to one of them links to all. Rows without an id have no links and no component, and are kept.
    """
    need = least_overlap(k, tenths)
    sk = materialise(sketches(docs, words, k, id_col, text_col), "sketches")
    linked = sk.where("n_shingles > 0 and doc_id is not null")
    classes = materialise(linked.groupBy("whole", F.col("n_shingles").alias("n"))
                          .agg(F.min("doc_id").alias("rep"), F.min_by("sketch", "doc_id").alias("sketch")), "classes")
    lists = materialise(inverted_lists(classes, k, need, tenths), "lists")
    members = lists.groupBy("value").agg(F.count("*").alias("size"), F.min("rep").alias("pivot")).where("size > 1")
    star = (lists.join(members, "value").where("rep <> pivot")
            .select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct())
    sizes = classes.select("rep", "n")
    star = (star.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b").where(_fits(tenths)).select("a", "b"))
    likely = materialise(likely_pairs(star, classes, k, tenths).distinct(), "pairs")

    wanted = lists.join(members.select("value"), "value", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = materialise(full_sets(texts.join(wanted, "doc_id", "left_semi"), words), "sets")
    first = components(verified_pairs(likely, sets, tenths).unionByName(_same_set(linked, classes)))

    placed = lists.join(members.select("value"), "value", "left_semi").join(
        first.select(F.col("node").alias("rep"), "component"), "rep", "left")
    placed = materialise(placed.select("value", "rep", "n", F.coalesce("component", "rep").alias("part")), "placed")
    more = materialise(links_across(placed, lists, classes, sets, k, tenths), "links")
    final = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    return (sk.select("doc_id", "n_shingles").join(final.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                    F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept")))


def in_common(values: list[np.ndarray]):
    """A function that counts, for a strip of rows, the values which each of them shares with each row.

    Only values that the strip holds become columns, so its matrices have at most `_ROWS` rows' values across.
    """
    row = np.repeat(np.arange(len(values)), [len(v) for v in values])
    flat = np.concatenate(values) if values else np.empty(0, np.int64)

    def counts(low: int) -> np.ndarray:
        high = min(low + _ROWS, len(values))
        held = np.unique(flat[(row >= low) & (row < high)])
        at = np.minimum(np.searchsorted(held, flat), max(0, len(held) - 1))
        hit = held[at] == flat if len(held) else np.zeros(len(flat), bool)
        out = np.zeros((len(values), len(held)), np.float32)
        out[row[hit], at[hit]] = 1
        return out[low:high] @ out.T

    return counts


def links_across(placed: DataFrame, lists: DataFrame, classes: DataFrame, sets: DataFrame, k: int, tenths: int) -> DataFrame:
    """Confirmed links (a, b) between components that meet in a list; enough of them to connect all that are linked."""
    split = (placed.groupBy("value").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("size"))
             .where("low < high").select("value", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    rows = placed.join(split, "value").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("value", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "rep", "n", "part")
    about = (lists.groupBy("rep", "n").agg(F.collect_list("value").alias("prefix"))  # at most k values
             .join(classes.select("rep", "n", "sketch"), ["rep", "n"]))
    need = least_overlap(k, tenths)
    key = ["value", "i", "j"]

    def likely(value: int, i: int, j: int, table: pa.Table):
        """Pairs of rows that may be similar, a strip of rows at a time."""
        rep, n, part, block = (table.column(c).to_numpy() for c in ("rep", "n", "part", "block"))
        prefix = [np.asarray(p, np.int64) for p in table.column("prefix").to_pylist()]
        sketch = [np.asarray(v, np.int64) for v in table.column("sketch").to_pylist()]
        seen, shared = in_common([p[p < value] for p in prefix]), in_common(sketch)
        least = np.minimum(need, np.ceil(np.array([len(v) for v in sketch]) * tenths / 10))
        for low in range(0, len(rep), _ROWS):
            at = slice(low, low + _ROWS)
            ok = shared(low) >= np.minimum(least[at, None], least)
            ok &= (seen(low) == 0) & (part[at, None] != part) & (rep[at, None] < rep)
            ok &= np.minimum(n[at, None], n) * 10 >= np.maximum(n[at, None], n) * tenths
            if i != j:
                ok &= block[at, None] != block
            x, y = np.nonzero(ok)
            yield x + low, y

    def promising(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = np.zeros(table.num_rows, bool)
        for x, y in likely(*(v.as_py() for v in key), table):
            found[x] = found[y] = True
        return table.filter(pa.array(found))

    def links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rep, part = table.column("rep").to_pylist(), table.column("part").to_pylist()
        shingles = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        parent = {p: p for p in part}

        def root(p: int) -> int:
            while parent[p] != p:
                parent[p] = parent[parent[p]]
                p = parent[p]
            return p

        found = []
        for xs, ys in likely(*(v.as_py() for v in key), table):
            for x, y in zip(xs.tolist(), ys.tolist()):
                a, b = root(part[x]), root(part[y])
                if a != b:
                    p, q = shingles[x], shingles[y]
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    if 10 * both >= tenths * (len(p) + len(q) - both):
                        parent[a] = b
                        found.append((rep[x], rep[y]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    full = rows.join(about, ["rep", "n"])
    left = materialise(full.groupBy(*key).applyInArrow(promising, full.schema), "promising")
    with_sets = left.join(sets.select(F.col("doc_id").alias("rep"), (F.octet_length("shingles") / 8).cast(dict(left.dtypes)["n"]).alias("n"), "shingles"), ["rep", "n"])
    return with_sets.groupBy(*key).applyInArrow(links, "a long, b long")


def _same_set(linked: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges from the least document of a class to its others."""
    return (linked.select("doc_id", "whole", F.col("n_shingles").alias("n")).join(classes.select("whole", "n", "rep"), ["whole", "n"])
            .where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
