"""Tokens, cuts and bins."""

import itertools
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest

from zerotally.llm import packing
from zerotally.llm.queries import vocabulary

TEXTS = ["", None, " ", "  two  blanks ", "one two\nthree\n\n four", "it's  'll x 　", "<|endoftext|> a <|endoftext|>", "é" * 50, "1234567 8",
         "word " * 5000, " \x1c \x85 y", "日本語 テキスト", "😀 👨‍👩‍👧 x", "a" * 3000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def _ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder_gives_the_tokenizer_s_ids(tokenizer):
    rng = random.Random(5)
    signs = "abcXYZ 019'.,!?\n\t éßñ 　日😀<|>s"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    encoder = packing.Encoder(vocabulary())
    assert encoder._fast is not None
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == _ids(tokenizer, text)


def test_pieces_lie_side_by_side(spark, tokenizer):
    rows = [(i, t, 9, 9) for i, t in enumerate(TEXTS)] + [(100 + i, "w " * (i * 13 % 700), 9, 9) for i in range(120)] + [(1, "again", 9, 9), (None, "no id", 9, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long, chunk long").repartition(5)
    got = packing.pack(docs, vocabulary(), capacity=512, keep_ids=True).collect()
    bins = defaultdict(list)
    for r in got:
        assert len(r["ids"]) == r["length"] and zlib.crc32(struct.pack(f"<{r['length']}I", *r["ids"])) == r["ids_crc32"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 512
    total = sum(r["length"] for r in got)
    assert len(bins) == -(-total // 512)
    want = []
    for doc_id, text, *_ in rows:
        ids = _ids(tokenizer, text)
        want += [(doc_id, p, s, n) for p, (s, n) in enumerate(packing.cut(len(ids), 512))]
    assert sorted(map(repr, ((r["doc_id"], r["piece"], r["start"], r["length"]) for r in got))) == sorted(map(repr, want))
    assert packing.pack(docs.limit(0), vocabulary()).count() == 0


def test_cut_leaves_only_the_first_piece_short():
    assert packing.cut(1, 10) == [(0, 1)] and packing.cut(10, 10) == [(0, 10)]
    assert packing.cut(20, 10) == [(0, 10), (10, 10)] and packing.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]


@pytest.mark.parametrize("seed", range(8))
def test_fullest_is_the_best_combination(seed):
    rng = random.Random(seed)
    counts = np.zeros(31, np.int64)
    for _ in range(7):
        counts[rng.randint(1, 30)] += 1
    lengths = [n for n, c in enumerate(counts) for _ in range(c)]
    best = max(s for k in range(8) for c in itertools.combinations(lengths, k) if (s := sum(c)) <= 30)
    found = packing.fullest(counts, 30)
    assert sum(n * k for n, k in found) == best and all(counts[n] >= k for n, k in found)


def test_plan_places_every_piece_once():
    rng = random.Random(2)
    histogram = {n: rng.randint(1, 400) for n in rng.sample(range(1, 2049), 300)}
    plan = packing.plan_bins(histogram)
    seen, fill = defaultdict(int), defaultdict(int)
    for length, first, last, sequence, per_bin, offset in plan.tolist():
        assert seen[length] == first and (last - first) % per_bin == 0
        seen[length] = last
        for s in range(sequence, sequence + (last - first) // per_bin):
            assert fill[s] == offset
            fill[s] += per_bin * length
    assert dict(seen) == histogram and max(fill.values()) <= 2048
    total = sum(n * c for n, c in histogram.items())
    assert len(fill) <= 1.03 * total / 2048 + 1
