"""Repeated byte strings across documents, by sampled prefix doubling.

A suffix array would sort every byte position. Here a position keeps its place among the sorted ones only while the string
that starts there is not unique, and what is sorted first is a sample that no repeat can escape. A rank is named by a
64-bit fingerprint of the string it stands for, so a pair of ranks at an offset has a rank at once, wherever it is:

- Inside a task ranks of 1, 2, 4, 8 and 16 bytes double to ranks of HALF (25) bytes at every position. Of each
  window of HALF + 1 positions the least rank is an anchor: a repeated string of 50 bytes holds the same anchor in both places.
- Round 1 sorts the anchors' ranks over the whole table; anchors found in one document only are dropped.
- Round 2 sorts rank pairs (p, p + HALF) of the anchors left, that is strings of 50 bytes, with their documents. Those that
  start in a document with a smaller id cover their bytes. It also tells which anchors stand in a smaller document.
- Round 3 tells which anchors are still needed: those of strings that reach beyond what is covered, and whose anchor stands
  in a smaller document.
- Round 4 sorts the rank pairs of all positions whose string has such an anchor, which settles every byte.

Positions travel packed: a chunk of documents sends each range of ranks one row with its distinct ranks, and gets
a bit for each back. Text is written once in chunks, bucketed by chunk, and the bits come to it; text itself is never
shuffled. A string that a third of the documents share is one rank per chunk.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerotally.llm.frames import binary_text
from zerotally.workspace import materialise, scratch_path

HALF = 25
LENGTH = 2 * HALF
#: Bytes of text in a chunk (a longer document is a chunk of its own), and in a bucket of the chunk table.
CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 24 << 20
#: Bytes of text for which there is one range of ranks; about a thirteenth of them have an anchor.
RANGE_BYTES = 16 << 20
BLOCK = 1 << 16
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_BYTE = np.random.default_rng(50).integers(1, 1 << 63, 256, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD6E8FEB86659FD93)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rank of the string with rank a, followed by the one with rank b."""
    h = a * _STEP
    h += b
    h ^= h >> np.uint64(32)
    h *= _TURN
    h ^= h >> np.uint64(29)
    return h


def half_ranks(data: np.ndarray) -> np.ndarray:
    """Rank of the HALF bytes from every position that has as many after it."""
    out = np.empty(max(0, len(data) - HALF + 1), np.uint64)
    for at in range(0, len(out), BLOCK):
        one = _BYTE[data[at:at + BLOCK + HALF - 1]]
        two = _pair(one[:-1], one[1:])
        four = _pair(two[:-2], two[2:])
        eight = _pair(four[:-4], four[4:])
        sixteen = _pair(eight[:-8], eight[8:])
        n = len(one) - HALF + 1
        out[at:at + n] = _pair(_pair(sixteen[:n], eight[16:16 + n]), one[24:24 + n])
    np.minimum(out, NONE - np.uint64(1), out=out)
    return out


def _sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """op over every `width` neighbours."""
    have, y = 1, x
    while have * 2 <= width:
        y = op(y[:-have], y[have:])
        have *= 2
    return op(y[:len(x) - width + 1], y[width - have:]) if have < width else y


class Replay:
    """A chunk and what the rounds have answered so far; says what the next round asks and, after all, what goes.

    `ids` and `ends` are the documents' ids and where they end in `data`.
    """

    def __init__(self, ids: np.ndarray, ends: np.ndarray, data: np.ndarray, answers: list[np.ndarray]):
        self.ids, self.ends, self.data, self.answers = ids, ends, data, answers
        self.n = len(data)

    def doc(self, at: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.ends, at, side="right")]

    @cached_property
    def left(self) -> np.ndarray:
        """Bytes from each position to the end of its document; 0 in documents that are too short for any string."""
        sizes = np.diff(self.ends, prepend=0)
        return np.where(np.repeat(sizes, sizes) >= LENGTH, np.repeat(self.ends, sizes) - np.arange(self.n), 0)

    @cached_property
    def half(self) -> np.ndarray:
        ranks = np.full(self.n, NONE)
        found = half_ranks(self.data)
        ranks[:len(found)] = found
        ranks[self.left < HALF] = NONE
        return ranks

    @cached_property
    def least(self) -> np.ndarray:
        """The least rank among the HALF + 1 positions from each position on: the anchor of the string there."""
        return _sliding(np.minimum, np.concatenate([self.half, np.full(HALF, NONE)]), HALF + 1)

    @cached_property
    def anchors(self) -> np.ndarray:
        most = _sliding(np.maximum, np.concatenate([np.zeros(HALF, np.uint64), np.where(self.left >= LENGTH, self.least, 0)]), HALF + 1)
        return np.flatnonzero((most == self.half) & (self.half != NONE))

    @staticmethod
    def _distinct(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys, their least and greatest document, and each key's place among them."""
        order = np.lexsort((docs, keys))
        k, d = keys[order], docs[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
        place = np.empty(len(k), np.int64)
        place[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(k)))
        last = np.append(first[1:], len(k)) - 1 if len(k) else first
        return k[first], d[first], d[last], place

    @cached_property
    def _first(self):
        return self._distinct(self.half[self.anchors], self.doc(self.anchors))

    @cached_property
    def alive(self) -> np.ndarray:
        """Sorted ranks of anchors that stand in two documents or more."""
        keys, low, high, _ = self._first
        return keys[self.answers[0] | (low != high)]

    def _known(self, sorted_ranks: np.ndarray) -> np.ndarray:
        """Positions whose string is whole and has one of these anchors."""
        change = np.flatnonzero(np.concatenate([[True], self.least[1:] != self.least[:-1]])) if self.n else np.empty(0, np.int64)
        at = np.searchsorted(sorted_ranks, self.least[change])
        hit = np.append(sorted_ranks, NONE)[at] == self.least[change]
        hit &= self.least[change] != NONE
        return np.flatnonzero(np.repeat(hit, np.diff(change, append=self.n)) & (self.left >= LENGTH))

    def _whole(self, at: np.ndarray) -> np.ndarray:
        return _pair(self.half[at], self.half[at + HALF])

    @cached_property
    def _second(self):
        at = self.anchors[np.isin(self._first[3], np.flatnonzero(np.isin(self._first[0], self.alive, assume_unique=True)))] if len(self.anchors) else self.anchors
        at = at[self.left[at] >= LENGTH]
        return at, self._distinct(self._whole(at), self.doc(at))

    def _cover(self, which: list[tuple[tuple, np.ndarray]]) -> np.ndarray:
        edge = np.zeros(self.n + 1, np.int32)
        for (at, (_, low, _, place)), answer in which:
            hit = at[answer[place] | (self.doc(at) > low[place])] if len(at) else at
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + LENGTH, -1)
        return np.cumsum(edge[:-1]) > 0

    @cached_property
    def _alive_low(self) -> np.ndarray:
        keys, low, _, _ = self._first
        return low[np.searchsorted(keys, self.alive)]

    @cached_property
    def _both(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What round 2 asks: strings of LENGTH and of HALF bytes, with the order that sorts them."""
        keys, low = self._second[1][:2]
        keys, low = np.concatenate([keys, self.alive]), np.concatenate([low, self._alive_low])
        order = np.argsort(keys, kind="stable")
        return keys[order], low[order], order

    @cached_property
    def _said(self) -> tuple[np.ndarray, np.ndarray]:
        """Round 2's answers for the strings of LENGTH bytes and for those of HALF bytes."""
        said = np.empty(len(self._both[2]), bool)
        said[self._both[2]] = self.answers[1]
        n = len(self._second[1][0])
        return said[:n], said[n:]

    @cached_property
    def _third(self) -> tuple[np.ndarray, np.ndarray]:
        covered = self._cover([(self._second, self._said[0])])
        total = np.concatenate([[0], np.cumsum(covered)])
        at = self._known(self.alive)
        at = at[total[at + LENGTH] - total[at] < LENGTH]
        which = np.searchsorted(self.alive, self.least[at])
        after = self._said[1][which] | (self.doc(at) > self._alive_low[which])
        needed = np.zeros(len(self.alive), bool)
        needed[which[after]] = True
        return self.alive, needed

    @cached_property
    def _fourth(self):
        at = self._known(self.alive[self.answers[2] | self._third[1]])
        return at, self._distinct(self._whole(at), self.doc(at))

    def asks(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct ranks, in order, and a number with each: nothing of use, documents, or 0 for ranks that are needed."""
        match len(self.answers):
            case 0:
                return self._first[0], self._first[1]
            case 1:
                return self._both[:2]
            case 2:
                return self._third[0], 1 - self._third[1].astype(np.int64)
            case _:
                return self._fourth[1][0], self._fourth[1][1]

    def removed(self) -> np.ndarray:
        return self._cover([(self._second, self._said[0]), (self._fourth, self.answers[3])])


ROUNDS = 4


def _answer(kind: int, counts: np.ndarray, least: np.ndarray, own: np.ndarray) -> np.ndarray:
    if kind == 0:
        return counts > 1
    return least == 0 if kind == 2 else least < own


def _replay(row: dict, bits: int) -> Replay:
    """The chunk of a joined row, with the ranges' answers put together in the order of the ranks."""
    ids, ends = (np.frombuffer(row[c], np.int64) for c in ("ids", "ends"))
    chunk = Replay(ids, ends, np.frombuffer(row["data"], np.uint8), [])
    rounds: list[dict[int, bytes]] = [{} for _ in range(ROUNDS)]
    for a in row.get("answers") or ():
        rounds[a["round"]][a["part"]] = a["bits"]
    for got in rounds[:row["rounds"]]:
        keys, _ = chunk.asks()
        parts = _slices(keys, bits)
        chunk.answers.append(np.concatenate([np.zeros(0, bool)] + [
            np.unpackbits(np.frombuffer(got[p], np.uint8), count=b - a).astype(bool) for p, a, b in parts]))
    return chunk


def _packed(keys: np.ndarray, kind: int) -> bytes:
    """Ranks as bytes; round 1 only sorts out anchors, for which the upper six bytes do."""
    return (keys >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() if kind == 0 else keys.tobytes()


def _unpacked(data: bytes, kind: int) -> np.ndarray:
    if kind:
        return np.frombuffer(data, np.uint64)
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _shortest(numbers: np.ndarray, kind: int) -> bytes:
    """Numbers as bytes of the least width that holds them; none in round 1."""
    if kind == 0:
        return b""
    low, high = numbers.min(), numbers.max()
    return numbers.astype("u1" if 0 <= low and high < 1 << 8 else "u4" if 0 <= low and high < 1 << 32 else "i8").tobytes()


def _longest(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, {n: "u1", 4 * n: "u4", 8 * n: "i8"}[len(data)]).astype(np.int64) if data else np.zeros(n, np.int64)


def _slices(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(range, from, to) of the ranges that hold keys; a range is what the first `bits` bits name."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.empty(0, np.int64)
    return list(zip(part[first].tolist(), first.tolist(), [*first[1:].tolist(), len(part)]))


def _chunked(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ends, parts, size, made = [], [], [], 0, 0
        base = TaskContext.get().partitionId() << 32

        def out() -> pa.RecordBatch:
            nonlocal size, made
            batch = pa.RecordBatch.from_pydict(
                {"chunk": [base + made], "ids": [np.array(ids, np.int64).tobytes()], "ends": [np.array(ends, np.int64).tobytes()],
                 "data": [b"".join(parts)]}, schema=pa.schema([("chunk", pa.int64()), *[(c, pa.binary()) for c in ("ids", "ends", "data")]]))
            for held in (ids, ends, parts):
                held.clear()
            size, made = 0, made + 1
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), binary_text(batch)):
                if parts and size + len(text) > chunk_bytes:
                    yield out()
                size += len(text)
                ids.append(doc_id), ends.append(size), parts.append(text)
        if parts:
            yield out()

    return docs.mapInArrow(run, "chunk long, ids binary, ends binary, data binary")


class _Chunks:
    """The chunk table, bucketed so that answers are joined to it where it lies."""

    def __init__(self, docs: DataFrame, chunk_bytes: int):
        self.spark: SparkSession = docs.sparkSession
        path = scratch_path(self.spark, "chunks")
        self.name = path.rsplit("/", 1)[1].replace("-", "_")
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.buckets = max(1, math.ceil(total / BUCKET_BYTES))
        self.bits = max(0, math.ceil(math.log2(max(1, total / RANGE_BYTES))))
        self.answers: list[DataFrame] = []
        (_chunked(docs, chunk_bytes).write.bucketBy(self.buckets, "chunk").option("path", path)
         .option("compression", "zstd").saveAsTable(self.name))

    def with_answers(self) -> DataFrame:
        chunks = self.spark.table(self.name)
        if not self.answers:
            return chunks.withColumn("answers", F.lit(None).cast("array<struct<round:int,part:long,bits:binary>>"))
        every = self.answers[0]
        for more in self.answers[1:]:
            every = every.unionByName(more)
        every = (every.repartition(self.buckets, "chunk").groupBy("chunk")
                 .agg(F.collect_list(F.struct("round", "part", "bits")).alias("answers")))
        return chunks.join(every.hint("shuffle_hash"), "chunk", "left")

    def ask(self) -> None:
        """One round: ranks to their ranges, bits back."""
        kind, bits = len(self.answers), self.bits

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0] | {"rounds": kind}
                    keys, numbers = _replay(row, bits).asks()
                    parts = _slices(keys, bits)
                    yield pa.RecordBatch.from_pydict(
                        {"chunk": [row["chunk"]] * len(parts), "part": [p for p, _, _ in parts],
                         "ranks": [_packed(keys[a:b], kind) for _, a, b in parts],
                         "numbers": [_shortest(numbers[a:b], kind) for _, a, b in parts]},
                        schema=pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("ranks", pa.binary()), ("numbers", pa.binary())]))

        def rank(table: pa.Table) -> pa.Table:
            ranks = [_unpacked(b, kind) for b in table.column("ranks").to_pylist()]
            keys = np.concatenate(ranks)
            values = np.concatenate([_longest(b, len(r)) for b, r in zip(table.column("numbers").to_pylist(), ranks)])
            order = np.argsort(keys, kind="stable")
            k, v = keys[order], values[order]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            counts = np.diff(first, append=len(k))
            said = np.empty(len(k), bool)
            said[order] = _answer(kind, np.repeat(counts, counts), np.repeat(np.minimum.reduceat(v, first), counts), v)
            at, out = 0, []
            for r in ranks:
                out.append(np.packbits(said[at:at + len(r)]).tobytes())
                at += len(r)
            return pa.table({"chunk": table.column("chunk"), "round": pa.array([kind] * len(out), pa.int32()),
                             "part": table.column("part"), "bits": pa.array(out, pa.binary())})

        sent = self.with_answers().mapInArrow(send, "chunk long, part long, ranks binary, numbers binary")
        back = sent.groupBy("part").applyInArrow(rank, "chunk long, round int, part long, bits binary")
        self.answers.append(materialise(back, "answers"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
                   keep_bytes: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (and kept, the bytes left, if asked).

    A byte goes if it lies in a string of 50 bytes that also starts in a document with a smaller id. Documents are
    judged as they come in, not by what is left of others. Null text counts as empty. Rows that share an id do not take
    from each other. Rows without an id neither lose bytes nor make others lose any. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chunks = _Chunks(rows.where("doc_id is not null"), chunk_bytes)
    for _ in range(ROUNDS):
        chunks.ask()
    bits = chunks.bits

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _replay(batch.slice(i, 1).to_pylist()[0] | {"rounds": ROUNDS}, bits)
                gone, made, start = chunk.removed(), [], 0
                for doc_id, end in zip(chunk.ids.tolist(), chunk.ends.tolist()):
                    here, text = gone[start:end], chunk.data[start:end]
                    edge = np.flatnonzero(np.diff(here.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                    left = text[~here].tobytes() if len(edge) else text.tobytes()
                    made.append((doc_id, end - start, end - start - len(left), len(edge), hashlib.sha256(left).hexdigest(),
                                 edge.tolist(), *([left] if keep_bytes else [])))
                    start = end
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*made), out)], schema=out)

    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
              ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))]
    out = pa.schema(fields + ([("kept", pa.binary())] if keep_bytes else []))
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<bigint>>"
              + (", kept binary" if keep_bytes else ""))
    result = materialise(chunks.with_answers().mapInArrow(cut, schema), "repeats")
    chunks.drop()
    zero, text = F.lit(0).cast("long"), F.col("text").cast("binary")
    free = rows.where("doc_id is null").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2(text, 256).alias("kept_sha256"), F.array().cast("array<array<bigint>>").alias("spans"), *([text.alias("kept")] if keep_bytes else []))
    return result.unionByName(free)
