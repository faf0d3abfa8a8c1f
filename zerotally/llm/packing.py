"""Best-fit packing of tokenised documents: minimum bin slack over lengths.

Texts are tokenised where they lie, ended by id 0 and cut into pieces of at most the capacity. How pieces are combined
depends on their lengths alone, and there are no more lengths than the capacity, so the plan is made from the histogram
of lengths, whatever the number of documents: a bitset of the sums that the available lengths can reach, taken largest
length first, gives the fullest feasible bin; that combination is repeated as long as its lengths last, then
the next one is sought. The k-th piece of a length then reads its sequence and offset off the plan.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zerotally.llm.frames import binary_text
from zerotally.workspace import materialise

CAPACITY = 2048
END = np.zeros(1, "<u4").tobytes()
# Fixed value: how byte-level BPE splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Chunks of documents within which pieces are numbered.
CHUNK_DOCS = 20_000


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, by a vocabulary file of `tokenizers`.

    A byte-level BPE's ids are fixed by its vocabulary and merge order, so where the file is one whose ids are in merge
    order, tiktoken works them out from the same file several times as fast. Texts with a special token's string, and any
    that tiktoken refuses, go to `tokenizers`.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self._fast = _by_ranks(json.load(file))

    def encode(self, text: str) -> bytes:
        """Ids of `text` and the end id."""
        if self._fast and "<|" not in text:
            try:
                return self._fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes() + END
            except BaseException as error:  # its Rust side reports exhausted stacks as a panic, which is no Exception
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + END


def _by_ranks(file: dict):
    """The tiktoken encoding of a byte-level BPE file, or None if it is not one whose ids follow the merges."""
    import tiktoken

    model, before = file["model"], file.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    if model.get("type") != "BPE" or not plain or file.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
        return None
    # visible stand-ins for bytes: a byte's own character where it is printable, the next free ones from 256 on elsewhere
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in file.get("added_tokens", ())}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocabulary.get(m) for m in merges]
    if None in ids or ids != sorted(set(ids)) or len(vocabulary) != 256 + len(set(merges)):
        return None
    ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; it lasts from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full, but for the first."""
    first = n_ids % capacity or min(n_ids, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n_ids, capacity))]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                 text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece (and ids, if kept). Null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            rows, ids_of = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), binary_text(batch)):
                ids = encode(text.decode("utf-8", "replace"))
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(part)))
                    if keep_ids:
                        ids_of.append(np.frombuffer(part, "<u4").astype("i4"))
            columns = list(zip(*rows)) or [()] * 5
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, out)]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(ids_of, pa.list_(pa.int32()))] if keep_ids else []), schema=out)

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    out = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if keep_ids else []))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long"
                        + (", ids array<int>" if keep_ids else "")))


def fullest(counts: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(length, how often) of a combination that fills a bin best; lengths left in `counts`, each as often as it is there.

    Lengths join from the largest down, a copy at a time in binary portions; `reach` has bit s if sum s can be made. It
    stops at the first length with which the bin can be full. Going back over the steps gives the combination, which
    prefers the lengths that joined first.
    """
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in np.flatnonzero(counts)[::-1].tolist():
        left, portion = min(int(counts[length]), capacity // length), 1
        while left:
            take = min(portion, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, portion = left - take, portion * 2
        if reach >> capacity:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return sorted(used.items(), reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first, last, sequence, per_bin, offset): pieces first .. last - 1 of a length go `per_bin` to a
    sequence, from `sequence` on and from `offset` on. Each combination found is used until a length of it runs out, so
    there are no more combinations than lengths and remainders of these."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    given, rows, sequence = np.zeros_like(counts), [], 0
    while counts.any():
        # the largest piece left is hardest to place: it opens the bin, and the best company for it is sought
        largest = int(np.flatnonzero(counts)[-1])
        rest = counts[:capacity - largest + 1].copy()
        if largest < len(rest):
            rest[largest] -= 1
        company = dict(fullest(rest, capacity - largest)) if rest.any() else {}
        company[largest] = company.get(largest, 0) + 1
        times = min(int(counts[length]) // k for length, k in company.items())
        offset = 0
        for length, k in sorted(company.items(), reverse=True):
            rows.append((length, given[length], given[length] + times * k, sequence, k, offset))
            given[length] += times * k
            counts[length] -= times * k
            offset += length * k
        sequence += times
    return np.array(rows, np.int64).reshape(-1, 6)


def number_pieces(pieces: DataFrame) -> DataFrame:
    """`pieces` with `nth`, a number from 0 within each length. Pieces are numbered within chunks of the table, and each
    chunk starts where the ones before it end, so that a common length is never in one place."""
    within = Window.partitionBy("chunk", "length").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = pieces.withColumn("_in", F.row_number().over(within) - 1)
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (pieces.groupBy("chunk", "length").agg(F.count("*").alias("_n"))
              .select("chunk", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from")))
    return (numbered.join(starts, ["chunk", "length"])
            .withColumn("nth", F.col("_in") + F.col("_from")).drop("_in", "_from"))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
         keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if kept).

    Every document has at least its end id, so null and empty texts are pieces of length 1. Only documents longer than
    the capacity are cut. Pieces of a sequence lie side by side from offset 0. Rows that repeat an id are packed each; an
    empty table gives no rows.
    """
    rows = token_pieces(docs, vocabulary, capacity, id_col, text_col, keep_ids)
    pieces = materialise(rows.withColumn("_part", F.spark_partition_id()), "pieces")
    chunk = F.struct("_part", F.pmod(F.xxhash64("doc_id"), F.lit(8))).alias("chunk")
    pieces = pieces.select(*[c for c in pieces.columns if c != "_part"], chunk)
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # `capacity` rows at most
    plan = plan_bins(histogram, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = int(plan[:, 2].max(initial=0)) + 1
        starts = plan[:, 0] * span + plan[:, 1]
        for batch in batches:
            length, nth = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "nth"))
            row = plan[np.searchsorted(starts, length * span + nth, side="right") - 1]
            inner = nth - row[:, 1]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(row[:, 3] + inner // row[:, 4]), pa.array(row[:, 5] + inner % row[:, 4] * length)],
                names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
              + ", sequence_id long, offset long")
    return number_pieces(pieces).select(*names, "nth").mapInArrow(place, schema)
