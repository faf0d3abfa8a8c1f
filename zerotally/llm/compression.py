"""Compressed sizes under zstandard raw-content dictionaries, and the bounded samples these are built from.

A text is compressed in blocks, each on its own against the dictionary, so that a long text is told apart by all of its
bytes and not only before it has become its own dictionary. The size of an empty block is taken off each.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zerotally.workspace import materialise

DICTIONARY_BYTES = 112_000
BLOCK_BYTES = 1024
LEVEL = 3
#: Characters that a sampled text lends to a dictionary, from a place within it that a hash chooses.
DICTIONARY_PART = 2000


class Sizer:
    """Bytes that a text takes under one dictionary."""

    def __init__(self, dictionary: bytes, level: int = LEVEL, block: int = BLOCK_BYTES):
        if len(dictionary) >= 8:
            data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            self._packer = zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_dict_id=False)
        else:
            self._packer = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self._block, self._empty = block, len(self._packer.compress(b""))

    def size(self, text: bytes) -> int:
        step, pack = self._block, self._packer.compress
        view = memoryview(text)
        return sum(len(pack(view[i:i + step])) - self._empty for i in range(0, len(text), step))


def build_dictionary(parts: Iterable[str], size: int = DICTIONARY_BYTES) -> tuple[bytes, int]:
    """Raw content from the first parts that fill `size` bytes, and how many parts that took."""
    content, used = b"", 0
    for part in parts:
        if len(content) >= size:
            break
        content += part.encode("utf-8", "replace") + b"\n"
        used += 1
    return content[:size], used


def labelled_sample(rows: DataFrame, id_col: str, text_col: str, label: Column, per_label: int,
                    texts: DataFrame | None = None) -> tuple[DataFrame, dict[str, int]]:
    """For each label up to `per_label` different texts, whole, in the order of a hash, as a written table (label, place,
    same, text), and the number of labelled rows. Rows without a text or label are left out. The texts are a column of
    `rows`, or else of `texts`, which shares the id; a label that a row repeats for an id then counts once.

    Labels are counted over all rows; the hash bound that lets about twice the wanted number through follows from the
    counts. Where many rows share what is hashed, an order of their hashes ends each label at `per_label` texts.
    """
    text = [] if texts is not None else [F.col(text_col).alias("text")]
    labelled = rows.select(F.col(id_col).alias("_id"), label.cast("string").alias("label"), *text)
    labelled = labelled.dropna(subset=["label", *(["text"] if text else [])])
    labelled = labelled if text else labelled.distinct()
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    bound = F.lit(0).cast("long")
    for name, n in counts.items():
        bound = F.when(F.col("label") == name, min(1 << 30, int(2 * per_label / n * (1 << 30)) + 1)).otherwise(bound)
    hashed = F.xxhash64(F.lit("sample"), "_id", *(["text"] if text else []))
    near = labelled.withColumn("place", F.pmod(hashed, F.lit(1 << 30))).where(F.col("place") < bound)
    if texts is not None:
        near = materialise(near, "picked")  # a few rows of known size, which Spark's own check then lets it broadcast
        near = texts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where("text IS NOT NULL").join(near, "_id")
    near = materialise(near.select("label", "place", F.xxhash64("text").alias("same"), "text"), "sample")
    keys, last = near.select("label", F.struct("place", "same").alias("key")).distinct(), F.lit(False)
    for name in counts:
        end = keys.where(F.col("label") == name).orderBy("key").limit(per_label).agg(F.max("key")).first()[0]
        if end is not None:
            within = (F.col("place") < end["place"]) | (F.col("place") == end["place"]) & (F.col("same") <= end["same"])
            last = F.when(F.col("label") == name, within).otherwise(last)
    return near.where(last).groupBy("label", "place", "same").agg(F.any_value("text").alias("text")), counts


def sampled_parts(sample: DataFrame, part: int = DICTIONARY_PART) -> dict[str, list[tuple[tuple[int, int], str]]]:
    """Per label the key and `part` characters of every text, in order, from a place that a hash of the text chooses."""
    start = 1 + F.pmod(F.xxhash64(F.lit("part"), "text"), F.greatest(F.lit(1), F.length("text") - part + 1)).cast("int")
    rows = sample.select("label", "place", "same", F.substring("text", start, F.lit(part)).alias("part")).collect()
    found: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["label"], r["place"], r["same"])):
        found.setdefault(r["label"], []).append(((r["place"], r["same"]), r["part"]))
    return found


def sizers(dictionaries: Sequence[bytes]) -> list[Sizer]:
    return [Sizer(d) for d in dictionaries]
