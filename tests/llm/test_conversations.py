"""Conversation repair against a search over strings in plain Python."""

import hashlib
import os
import random
import re
import zlib

import pytest

from zerotally.llm import conversations
from zerotally.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def edits(rows):
    """Cheapest (cost, letters, lines): for every number of rows read and last initial the least, by plain relaxation."""
    best = {"": (0, "", ())}
    for i in range(len(rows) + 1):
        for _ in range(3):
            for q, (cost, letters, lines) in list(best.items()):
                to = NEXT[q][-1]
                new = (cost + 5, letters + "I", (*lines, f"{'user' if to == 'u' else 'assistant'}:"))
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        if i == len(rows):
            break
        role, text, wrong = rows[i]
        after = {}
        for q, (cost, letters, lines) in best.items():
            ways = [(q, cost + 2, "D", ())]
            if wrong not in ("blank", "duplicate"):
                extra = 5 if wrong else 0
                if role[:1] and role[:1] in NEXT[q]:
                    ways.append((role[0], cost + extra, "K", (f"{role}:{text}",)))
                to = NEXT[q][-1]
                ways.append((to, cost + 1 + extra, "R", (f"{'user' if to == 'u' else 'assistant'}:{text}",)))
            for to, c, letter, more in ways:
                new = (c, letters + letter, lines + more)
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        best = after
    return min((best[q] for q in ("", "a") if q in best), key=lambda x: x[:2])


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows, damage=True):
    out = []
    after = damaged(rows) if damage else rows
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in mine:
            kept = re.findall(r"[^\x20\x09-\x0D]", text)
            wrong = "blank" if not kept else "duplicate" if (role, text) in seen else "" if kept[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, wrong))
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = edits(marked)
        out.append((conv, gaps, *(sum(w == k for _, _, w in marked) for k in ("blank", "duplicate", "truncated")), illegal, cost,
                    audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def made(seed, convs=40, longest=12):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(0, longest)):
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn + 3, None]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Yes.", "No!", f"text {rng.randint(0, 5)}.", "cut off", "", " \t\n", None, "é ", "Done.\n"])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_search_over_strings(spark, seed):
    rows = made(seed)
    got = conversations.repair(conversations.damage(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("seed", range(2))
def test_long_conversations_in_blocks(spark, seed, monkeypatch):
    monkeypatch.setattr(conversations, "FAN_IN", 3)
    rng = random.Random(seed)
    rows = [(conv, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice([f"t{rng.randint(0, 60)}.", "cut", "", "ok!"]))
            for conv, n in ((1, 700), (2, 200), (3, 64), (4, 1), (5, 65), (6, 130)) for i in range(n)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = conversations.repair(conversations.damage(turns))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_result_does_not_depend_on_the_blocks():
    rng = random.Random(5)
    for _ in range(30):
        rows = [(rng.choice("uasx") if rng.random() < .95 else "", rng.choice([None, None, "truncated", "blank", "duplicate"]))
                for _ in range(rng.randint(1, 30))]
        want = conversations.cheapest(rows)
        size = rng.randint(1, 6)
        blocks = [rows[i:i + size] for i in range(0, len(rows), size)]
        found = [conversations.ways(lambda e, b=b: conversations.edit_lattice(b, e)) for b in blocks]
        layers = [conversations.priced(f) for f in found]
        cost, states, closing = conversations.through(layers)
        audit = "".join("".join(a[0] for a in f[(p, q)][1]) for f, p, q in zip(found, states, states[1:])) + closing
        assert (cost, audit) == want
        for b, f in zip(blocks, found):
            assert {k: (c, "".join(a[0] for a in w)) for k, (c, w) in f.items()} == \
                {(q, e): conversations.cheapest(b, q, e) for q in range(4) for e in range(4) if conversations.cheapest(b, q, e)}


def test_prices_prove_the_cost():
    rng = random.Random(9)
    for _ in range(40):
        rows = [(rng.choice("uas"), rng.choice([None, None, None, "truncated", "blank"])) for _ in range(rng.randint(0, 25))]
        lattice = conversations.edit_lattice(rows)
        cost = conversations.auction(lattice, 0)
        assert all(lattice.prices[i] <= c + lattice.prices[j] for i, out in enumerate(lattice.arcs) for _, c, j in out)
        assert sum(a[1] for a in conversations.trace(lattice, 0)) == cost


def test_conversation_without_rows_left_nulls_and_empty_table(spark):
    empty = hashlib.sha256(b"").hexdigest()
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    turns = spark.createDataFrame([(gone, 0, "user", "Hi.", "x")], SCHEMA + ", audit string")  # a column of the result's name
    got = conversations.repair(conversations.damage(turns)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]
    nothing = spark.createDataFrame([(None, None, None, None)] * 3, SCHEMA)
    assert sorted(map(tuple, conversations.repair(conversations.damage(nothing)).collect())) == brute([(None,) * 4] * 3)
    assert conversations.repair(conversations.damage(turns.limit(0))).count() == 0


def test_very_long_text_and_equal_rows(spark):
    rows = [(1, None, "user", "word " * 1_500_000 + "."), (1, None, "assistant", "x." * 10)] + [(2, 5, "user", "Same.")] * 2000
    got = conversations.repair(conversations.damage(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_repair_conversations"](spark, FOLDER)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
