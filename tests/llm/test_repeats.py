"""Repeated strings against a dictionary of all 50-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from zerotally.llm import repeats


def brute(rows):
    first, gone = {}, []
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            w = data[i:i + 50]
            if doc_id is not None and (w not in first or doc_id < first[w]):
                first[w] = doc_id
    for doc_id, text in rows:
        data = (text or "").encode()
        mask = bytearray(len(data))
        for i in range(len(data) - 49):
            if doc_id is not None and first[data[i:i + 50]] < doc_id:
                mask[i:i + 50] = b"\1" * 50
        left = bytes(b for b, m in zip(data, mask) if not m)
        spans = sum(1 for i, m in enumerate(mask) if m and (not i or not mask[i - 1]))
        gone.append((doc_id, len(data), sum(mask), spans, hashlib.sha256(left).hexdigest()))
    return gone


def _rows(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (8, 12, 15, 40, 60)]
    rows = []
    for i in range(160):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a:a + rng.randint(30, len(p))], text(rng.randint(0, 6))]
        rows.append((rng.randint(0, 100_000), rng.choice(["", " "]).join(parts)))
    rows += [(i, rows[i % 9][1]) for i in range(200_000, 200_012)]
    return rows


EDGE = [(5, None), (6, ""), (7, "a" * 49), (8, "a" * 49), (9, "b" * 50), (10, "b" * 50), (11, "b" * 51), (12, "c" * 4000), (13, "c" * 3000 + "d"),
        (14, "é" * 60), (15, "xé" * 30 + "é" * 40), (9, "b" * 60), (None, "b" * 80), (None, None), (3, "zz" + "ab" * 100), (4, "ab" * 90)]


@pytest.mark.parametrize("chunk_bytes", [300, 1 << 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_removal_matches_brute_force(spark, chunk_bytes, seed, monkeypatch):
    monkeypatch.setattr(repeats, "RANGE_BYTES", 4000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    rows = _rows(seed) + (EDGE if seed == 1 else [])
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, chunk long, data binary").repartition(6)
    got = repeats.remove_repeats(docs, chunk_bytes=chunk_bytes, keep_bytes=True).collect()
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, brute(rows)))
    for r in got:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        assert sum(b - a for a, b in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]


def test_no_rows(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ranks_name_strings():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 200_000).astype(np.uint8)  # two letters: many equal strings
    ranks = repeats.half_ranks(data)
    seen = {}
    for i in range(0, len(ranks), 7):
        assert seen.setdefault(data[i:i + repeats.HALF].tobytes(), ranks[i]) == ranks[i]
    assert len(set(seen.values())) == len(seen)
    x = rng.integers(0, 50, 300).astype(np.uint64)
    assert np.array_equal(repeats._sliding(np.minimum, x, 26), [x[i:i + 26].min() for i in range(275)])
