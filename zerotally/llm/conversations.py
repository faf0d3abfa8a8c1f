"""Repair of conversations: the cheapest edits that make turns alternate, found by an auction on the edit lattice.

A node is (rows read, what was written last); an arc keeps, rewrites, deletes or inserts and costs a whole number. The
auction keeps one path from the origin and a price per node with p(tail) <= cost + p(head) for every arc. The path is
extended by the arc that attains its end's least cost + p(head); where that is dearer than the end's own price, the price
rises to it and the path is contracted by one arc. When the path reaches the destination, all arcs of all cheapest
paths are tight (p(tail) = cost + p(head)), and the tight arcs are traced in the order of their letters.

Rows are put in order by one range exchange, so that a conversation of any size lies over consecutive tasks. What lies
whole inside one block of a task is repaired there. Longer ones are cut into blocks: each block prices its ways from every
entry to every exit state, further auctions with a node per block border and state price and then choose among these, 64
blocks at a time and level by level, and blocks then trace their part. Only the cells of the result, the audit and the digest,
are made in one pass over a conversation, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zerotally.workspace import materialise

BLOCK_ROWS = 64
BLOCK_BYTES = 4 << 20
#: Blocks that are joined to one at a time.
FAN_IN = 64
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Last written: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: After a state: the state that a kept system, user or assistant turn leads to, and the one that a written turn leads to.
KEEP = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
WRITE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
SPACE, ENDS = "\x20\t\n\x0b\x0c\r", ".!?"
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"
LONG_MAX = (1 << 63) - 1

Arc = tuple[str, int, int]  # letter, cost, head
Row = tuple[str, str | None]  # initial of the role, fault
Line = tuple[str, str]  # role, text


@dataclass
class Lattice:
    arcs: list[list[Arc]]  # of every node, by letter
    prices: list[int]
    target: int


def fault(text: str) -> str | None:
    """What a text shows by itself."""
    kept = text.rstrip(SPACE)
    return BLANK if not kept else None if kept[-1] in ENDS else CUT


def edit_lattice(rows: Sequence[Row], end: int | None = None) -> Lattice:
    """Nodes 4 * rows read + state. With `end` the ways stop in that state once the last row is read; without, turns can
    still be inserted there, and both an empty conversation and one that an assistant closes lead to the target."""
    n = len(rows)
    arcs: list[list[Arc]] = [[] for _ in range(STATES * (n + 1) + 1)]
    for i, (initial, wrong) in enumerate(rows):
        extra = TRUNCATED if wrong == CUT else 0
        for q in range(STATES):
            out = arcs[STATES * i + q]
            out.append(("D", DELETE, STATES * (i + 1) + q))
            out.append(("I", INSERT, STATES * i + WRITE[q]))
            if wrong not in (BLANK, DUPLICATE):
                if initial in KEEP[q]:
                    out.append(("K", extra, STATES * (i + 1) + KEEP[q][initial]))
                out.append(("R", REROLE + extra, STATES * (i + 1) + WRITE[q]))
    target = STATES * (n + 1) if end is None else STATES * n + end
    if end is None:
        for q in range(STATES):
            arcs[STATES * n + q].append(("I", INSERT, STATES * n + WRITE[q]))
        for q in (START, ASSISTANT):
            arcs[STATES * n + q].insert(0, ("", 0, target))
    # a fair start: what is still to be read costs at least each row's cheapest edit
    left, prices = 0, [0] * len(arcs)
    for i in range(n - 1, -1, -1):
        wrong = rows[i][1]
        left += DELETE if wrong else 0
        prices[STATES * i:STATES * (i + 1)] = [left] * STATES
    return Lattice(arcs, prices, target)


def auction(lattice: Lattice, origin: int) -> int | None:
    """Cost of the cheapest way from the origin; leaves the prices that prove it. None where there is no way."""
    arcs, price, target = lattice.arcs, lattice.prices, lattice.target
    live = leading_to(arcs, target)
    if origin not in live:
        return None
    if len(live) < len(arcs):
        arcs = lattice.arcs = [[a for a in out if a[2] in live] for out in arcs]
    path = [origin]
    while path[-1] != target:
        i = path[-1]
        least, head = min((cost + price[j], j) for _, cost, j in arcs[i])
        if price[i] < least:
            price[i] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(head)
    return price[origin] - price[target]


def leading_to(arcs: list[list[Arc]], target: int) -> set[int]:
    tails: list[list[int]] = [[] for _ in arcs]
    for i, out in enumerate(arcs):
        for _, _, j in out:
            tails[j].append(i)
    found, todo = {target}, [target]
    while todo:
        for i in tails[todo.pop()]:
            if i not in found:
                found.add(i)
                todo.append(i)
    return found


def trace(lattice: Lattice, origin: int) -> list[Arc]:
    """The tight way to the target whose letters come first."""
    arcs, price = lattice.arcs, lattice.prices
    path: list[Arc] = []
    nodes, tried, dead = [origin], [0], set()
    while nodes[-1] != lattice.target:
        i, at = nodes[-1], tried[-1]
        while at < len(arcs[i]):
            _, cost, j = arcs[i][at]
            at += 1
            if j not in dead and price[i] == cost + price[j]:
                break
        else:
            dead.add(i)
            nodes.pop(), tried.pop()
            path.pop()
            continue
        tried[-1] = at
        path.append(arcs[i][at - 1])
        nodes.append(j), tried.append(0)
    return path


def cheapest(rows: Sequence[Row], start: int = START, end: int | None = None) -> tuple[int, str] | None:
    """Cost and letters of the cheapest edits, of equally cheap ones the first in ASCII."""
    lattice = edit_lattice(rows, end)
    cost = auction(lattice, start)
    return None if cost is None else (cost, "".join(a[0] for a in trace(lattice, start)))


def ways(lattice_to: Callable[[int], Lattice]) -> dict[tuple[int, int], tuple[int, list[Arc]]]:
    """Cost and arcs of the cheapest way between every two states; the prices of one end serve all entries."""
    found = {}
    for e in range(STATES):
        lattice = lattice_to(e)
        for q in range(STATES):
            cost = auction(lattice, q)
            if cost is not None:
                found[q, e] = cost, trace(lattice, q)
    return found


def repaired(audit: str, turns: Sequence[Line], start: int = START) -> Iterator[str]:
    """The lines that the edits leave."""
    state, rows = start, iter(turns)
    for letter in audit:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "K":
            state = KEEP[state][role[:1]]
            yield f"{role}:{text}"
        elif letter != "D":
            state = WRITE[state]
            yield f"{ROLE_OF[state]}:{text}"


def damage(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text and `gone` (the row is only there to name its conversation) after seeded damage.

    crc32 of `conv_id:turn` mod 20: 0 drops the row, 1 empties its text, 2 takes . ! ? out, 3 repeats it, 4 makes it a
    user's. A null role or text is one space, as is a null in the key.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat(text_of(id_col), F.lit(":"), text_of(turn_col))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return (turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                         text_of(role_col).alias("role"), text_of(text_col).alias("text"), kind.alias("kind"))
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), (F.col("kind") == 0).alias("gone"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def in_order(turns: DataFrame) -> DataFrame:
    """Rows by conversation, turn (nulls first), role and text, over range partitions.

    The exchange's key holds the beginnings of role and text and a digest of both, which is what its sample brings to the
    driver, and ends in a number of the row: copies of one row spread like others.
    """
    head = lambda c: F.substring(c, 1, 32)
    rows = turns.select("conv_id", "turn", "role", "text", "gone",
                        F.xxhash64("role", "text").alias("_same"), F.monotonically_increasing_id().alias("_salt"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), head("role"), head("text"), F.col("_same"), F.col("_salt")]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv_id", "turn", "role", "text", "gone", F.spark_partition_id().alias("part")))


@dataclass
class Block:
    """Consecutive rows of one conversation, as many as the limits allow."""
    conv: object
    part: int
    place: int  # among the blocks that the conversation has in this task
    edge: bool  # the conversation may have begun in an earlier task
    turns: list[int | None] = field(default_factory=list)
    lines: list[Line] = field(default_factory=list)
    size: int = 0

    def fits(self, role: str, text: str) -> bool:
        return not self.lines or (len(self.lines) < BLOCK_ROWS and self.size + len(role) + len(text) <= BLOCK_BYTES)

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn)
        self.lines.append((role, text))
        self.size += len(role) + len(text)


def task_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, bool]]:
    """The blocks of one task's rows, and whether a block is a whole conversation for sure."""
    block = None
    for batch in batches:
        for conv, turn, role, text, gone, part in zip(*(c.to_pylist() for c in batch.columns)):
            if block is None:
                block = Block(conv, part, 0, True)
            elif block.conv != conv:
                yield block, block.place == 0 and not block.edge
                block = Block(conv, part, 0, False)
            elif not gone and not block.fits(role, text):
                yield block, False
                block = Block(conv, part, block.place + 1, block.edge)
            if not gone:
                block.add(turn, role, text)
    if block is not None:
        yield block, False


def faults(lines: Sequence[Line], seen_before: Iterable[int] = ()) -> list[Row]:
    """Initial and first fault of every row; `seen_before` holds places whose row stood in an earlier block."""
    known, rows, before = set(), [], set(seen_before)
    for i, (role, text) in enumerate(lines):
        wrong, key = fault(text), (role, text)
        if wrong != BLANK and (key in known or i in before):
            wrong = DUPLICATE
        known.add(key)
        rows.append((role[:1], wrong))
    return rows


def tally(turns: Sequence[int | None], rows: Sequence[Row]) -> dict:
    """Counts of one block, with what stands at its ends, so that blocks can be added up."""
    known = [t for t in turns if t is not None]
    return {"rows": len(rows), "low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known)),
            "blank": sum(w == BLANK for _, w in rows), "duplicate": sum(w == DUPLICATE for _, w in rows),
            "truncated": sum(w == CUT for _, w in rows),
            "illegal": sum(a + b not in LEGAL for (a, _), (b, _) in zip(rows, rows[1:])),
            "head": rows[0][0] if rows else None, "tail": rows[-1][0] if rows else None}


def joined(parts: Sequence[dict]) -> dict:
    """One tally of blocks in order."""
    parts = [p for p in parts if p["rows"]]
    dated = [p for p in parts if p["low"] is not None]
    out = {k: sum(p[k] for p in parts) for k in ("rows", "turns", "blank", "duplicate", "truncated", "illegal")}
    out["illegal"] += sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(parts, parts[1:]))
    out["turns"] -= sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:]))
    return {**out, "low": dated[0]["low"] if dated else None, "high": dated[-1]["high"] if dated else None,
            "head": parts[0]["head"] if parts else None, "tail": parts[-1]["tail"] if parts else None}


def added(parts: Sequence[dict]) -> dict:
    """The counts of a conversation from the tallies of its blocks in order."""
    out = joined(parts)
    gaps = out["high"] - out["low"] + 1 - out["turns"] if out["low"] is not None else 0
    return {"gaps": min(gaps, LONG_MAX), **{k: out[k] for k in COUNTS[1:]}}


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TALLY = ("rows long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
          "head string, tail string")
_WAYS = "cost array<long>, rank array<int>"


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def digest(role: str, text: str) -> bytes:
    raw = utf8(role)
    return hashlib.md5(len(raw).to_bytes(8, "big") + raw + utf8(text)).digest()


def _rows_of(batches: Iterator[list[dict]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        yield from pa.Table.from_pylist(rows, schema=schema).to_batches()


def _by_size(items: Iterator[tuple[dict, int]], rows: int = 2000, size: int = 8 << 20) -> Iterator[list[dict]]:
    """Lists of rows of bounded length and bytes."""
    out, held = [], 0
    for item, n in items:
        out.append(item)
        held += n
        if len(out) >= rows or held >= size:
            yield out
            out, held = [], 0
    if out:
        yield out


def _arrow(spark_schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(spark_schema))


def first_pass(ordered: DataFrame, head: str) -> DataFrame:
    """A row per conversation that lies whole in a task, with its result, or else per block, with its lines."""
    spec = f"conv_id {head}, {_RESULT}, part int, place long, turns array<long>, roles array<string>, texts array<string>, digests array<binary>"
    schema = _arrow(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items():
            for block, whole in task_blocks(batches):
                if whole:
                    rows = faults(block.lines)
                    cost, audit = cheapest(rows)
                    text = utf8("\n".join(repaired(audit, block.lines)))
                    yield {"conv_id": block.conv, **added([tally(block.turns, rows)]), "cost": cost, "audit": audit,
                           "repaired_sha256": hashlib.sha256(text).hexdigest()}, len(audit)
                else:
                    yield {"conv_id": block.conv, "part": block.part, "place": block.place, "turns": block.turns,
                           "roles": [r for r, _ in block.lines], "texts": [t for _, t in block.lines],
                           "digests": [digest(*line) for line in block.lines]}, block.size
        return _rows_of(_by_size(items()), schema)

    return ordered.mapInArrow(run, spec)


def seen_earlier(blocks: DataFrame) -> DataFrame:
    """(conv_id, part, place, seen): places of rows whose role and text stand in an earlier block of the conversation."""
    lines = blocks.select("conv_id", "part", "place", F.posexplode("digests").alias("at", "digest"))
    at = F.struct("part", "place")
    first = (lines.groupBy("conv_id", "digest").agg(F.min(at).alias("first"), F.max(at).alias("final"))
             .where("first < final").select(F.col("conv_id").alias("c"), F.col("digest").alias("g"), "first"))
    again = lines.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("g"))).where(at > F.col("first"))
    return again.groupBy("conv_id", "part", "place").agg(F.collect_list("at").alias("seen"))


def numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with `at`, their place in the conversation, and `seen`. One short row per conversation and task is summed."""
    offset = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = (blocks.groupBy("conv_id", "part").agg((F.max("place") + 1).alias("n"))
             .select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), offset.alias("_offset")))
    seen = seen_earlier(blocks).select(*(F.col(c).alias(f"_{c}") for c in ("conv_id", "part", "place")), "seen")
    here = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    rows = blocks.join(parts, here).select("conv_id", "part", "place", (F.col("place") + F.col("_offset")).alias("at"), "turns", "roles", "texts")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "part", "place")]
    return rows.join(seen, same, "left").select("conv_id", "at", "turns", "roles", "texts", "seen")


def block_rows(record: dict) -> list[Row]:
    return faults(list(zip(record["roles"], record["texts"])), record["seen"] or ())


def priced(found: dict[tuple[int, int], tuple[int, list[Arc]]]) -> dict:
    """Costs of the ways of all pairs of states, and how the letters of those from one entry state sort."""
    rank = [None] * STATES ** 2
    for q in range(STATES):
        for place, (_, e) in enumerate(sorted(([a[0] for a in way], e) for (s, e), (_, way) in found.items() if s == q)):
            rank[STATES * q + e] = place
    pairs = [(q, e) for q in range(STATES) for e in range(STATES)]
    return {"cost": [found[p][0] if p in found else None for p in pairs], "rank": rank}


def price_blocks(blocks: DataFrame, head: str) -> DataFrame:
    """Costs and ranks of the ways through every block, and its tally."""
    spec = f"conv_id {head}, at long, {_WAYS}, {_TALLY}"
    schema = _arrow(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items():
            for batch in batches:
                for i in range(batch.num_rows):
                    r = batch.slice(i, 1).to_pylist()[0]
                    rows = block_rows(r)
                    found = ways(lambda e: edit_lattice(rows, e))
                    yield {"conv_id": r["conv_id"], "at": r["at"], **tally(r["turns"], rows), **priced(found)}, 500
        return _rows_of(_by_size(items()), schema)

    return blocks.mapInArrow(run, spec)


def border_lattice(layers: Sequence[dict], end: int | None = None) -> Lattice:
    """A node per border and state; the letters are ranks, of which those of one entry state are told apart."""
    n = len(layers)
    arcs: list[list[Arc]] = [[] for _ in range(STATES * (n + 1) + 1)]
    for i, layer in enumerate(layers):
        for q in range(STATES):
            at = range(STATES * q, STATES * (q + 1))
            arcs[STATES * i + q] = sorted((layer["rank"][k], layer["cost"][k], STATES * (i + 1) + k % STATES)
                                          for k in at if layer["cost"][k] is not None)
    target = STATES * n + end if end is not None else STATES * (n + 1)
    if end is None:
        for q in range(STATES):
            arcs[STATES * n + q] = [("I", INSERT, STATES * n + WRITE[q])]
        for q in (START, ASSISTANT):
            arcs[STATES * n + q].insert(0, ("", 0, target))
    left, prices = 0, [0] * len(arcs)
    for i in range(n - 1, -1, -1):
        left += min(c for c in layers[i]["cost"] if c is not None)
        prices[STATES * i:STATES * (i + 1)] = [left] * STATES
    return Lattice(arcs, prices, target)


def through(layers: Sequence[dict], start: int = START, end: int | None = None) -> tuple[int, list[int], str]:
    """Cost, states at the borders and closing insertions of the cheapest way over blocks."""
    lattice = border_lattice(layers, end)
    cost = auction(lattice, start)
    way = trace(lattice, start)
    return cost, [start, *(a[2] % STATES for a in way[:len(layers)])], "".join(a[0] for a in way[len(layers):])


def _group(c: str) -> Column:
    return F.expr(f"{c} div {FAN_IN}")


def price_groups(rows: DataFrame, head: str) -> DataFrame:
    """`FAN_IN` consecutive blocks as one."""
    spec = f"conv_id {head}, at long, {_WAYS}, {_TALLY}"
    schema = _arrow(spec)

    def run(table: pa.Table) -> pa.Table:
        layers = sorted(table.to_pylist(), key=lambda r: r["at"])
        found = ways(lambda e: border_lattice(layers, e))
        return pa.Table.from_pylist([{"conv_id": layers[0]["conv_id"], "at": layers[0]["at"] // FAN_IN, **joined(layers), **priced(found)}], schema=schema)

    return rows.withColumn("above", _group("at")).groupBy("conv_id", "above").applyInArrow(run, spec)


def choose_last(rows: DataFrame, head: str) -> DataFrame:
    """Per block of the last level: the states at its borders; of its conversation the counts, the cost, the closing
    insertions."""
    spec = f"conv_id {head}, at long, entry int, leave int, closing string, " + ", ".join(f"{c} long" for c in [*COUNTS, "cost"])
    schema = _arrow(spec)

    def run(table: pa.Table) -> pa.Table:
        layers = sorted(table.to_pylist(), key=lambda r: r["at"])
        cost, states, closing = through(layers)
        return pa.Table.from_pylist([{"conv_id": r["conv_id"], "at": r["at"], "entry": a, "leave": b, "cost": cost,
                                      "closing": closing if r is layers[-1] else None, **added(layers)}
                                     for r, a, b in zip(layers, states, states[1:])], schema=schema)

    return rows.groupBy("conv_id").applyInArrow(run, spec)


def choose_within(rows: DataFrame, above: DataFrame, head: str) -> DataFrame:
    """Per block the states at its borders, from those of the group it is in; `closing` is set on the very last."""
    spec = f"conv_id {head}, at long, entry int, leave int, closing string"
    schema = _arrow(spec)
    above = above.select(F.col("conv_id").alias("_conv"), F.col("at").alias("above"), "entry", "leave", "closing")
    rows = (rows.select("conv_id", "at", "cost", "rank", _group("at").alias("_group"))
            .join(above, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_group") == F.col("above"))))

    def run(table: pa.Table) -> pa.Table:
        layers = sorted(table.to_pylist(), key=lambda r: r["at"])
        _, states, _ = through(layers, layers[0]["entry"], layers[0]["leave"])
        return pa.Table.from_pylist([{"conv_id": r["conv_id"], "at": r["at"], "entry": a, "leave": b,
                                      "closing": r["closing"] if r is layers[-1] else None}
                                     for r, a, b in zip(layers, states, states[1:])], schema=schema)

    return rows.groupBy("conv_id", "above").applyInArrow(run, spec)


def edited(blocks: DataFrame, chosen: DataFrame, head: str) -> DataFrame:
    """Per block its part of the audit and of the repaired text (null where it leaves no line)."""
    spec = f"conv_id {head}, at long, audit string, text string"
    schema = _arrow(spec)
    chosen = chosen.select(F.col("conv_id").alias("_conv"), F.col("at").alias("_at"), "entry", "leave", "closing")
    rows = (blocks.select("conv_id", "at", "roles", "texts", "seen")
            .join(chosen, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("at") == F.col("_at"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items():
            for batch in batches:
                for i in range(batch.num_rows):
                    r = batch.slice(i, 1).to_pylist()[0]
                    audit = cheapest(block_rows(r), r["entry"], r["leave"])[1] + (r["closing"] or "")
                    lines = list(repaired(audit, list(zip(r["roles"], r["texts"])), r["entry"]))
                    text = "\n".join(lines) if lines else None
                    yield {"conv_id": r["conv_id"], "at": r["at"], "audit": audit, "text": text}, len(text or "")
        return _rows_of(_by_size(items()), schema)

    return rows.mapInArrow(run, spec)


def assembled(pieces: DataFrame, head: str) -> DataFrame:
    """conv_id, audit, repaired_sha256 of pieces in order: the text streams through the digest and is never held."""
    spec = f"conv_id {head}, audit string, repaired_sha256 string"
    schema = _arrow(spec)
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items():
            conv, letters, hashed, lines = None, None, None, 0
            for batch in batches:
                for c, audit, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                    if letters is None or c != conv:
                        if letters is not None:
                            yield {"conv_id": conv, "audit": "".join(letters), "repaired_sha256": hashed.hexdigest()}, len(letters)
                        conv, letters, hashed, lines = c, [], hashlib.sha256(), 0
                    letters.append(audit)
                    if text is not None:
                        hashed.update(utf8(("\n" if lines else "") + text))
                        lines += 1
            if letters is not None:
                yield {"conv_id": conv, "audit": "".join(letters), "repaired_sha256": hashed.hexdigest()}, len(letters)
        return _rows_of(_by_size(items()), schema)

    return ordered.mapInArrow(run, spec)


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of `turns` (conv_id, turn, role, text, gone): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    Rows go by turn, nulls first, those of one turn by role and text. A row with `gone` only names its conversation; one
    with nothing else has zeros, an empty audit and the digest of the empty text. A row is blank without a character
    besides space and \\t to \\r, else a duplicate of an earlier row, else truncated without . ! or ? at its end. Rows
    without a conv_id are one conversation. A null role or text counts as one space; roles without a first
    letter s, u or a, empty ones too, cannot be kept. An empty table gives no rows; other columns are not looked at.
    """
    head = turns.schema["conv_id"].dataType.simpleString()
    filled = turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                          *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), "gone")
    found = materialise(first_pass(in_order(filled), head), "conversations")
    whole = found.where("part IS NULL").select("conv_id", *COUNTS, "cost", "audit", "repaired_sha256")
    blocks = found.where("part IS NOT NULL").drop(*COUNTS, "cost", "audit", "repaired_sha256")
    blocks = materialise(numbered(blocks), "blocks")
    levels = [materialise(price_blocks(blocks, head), "priced")]
    last = levels[0].agg(F.max("at")).first()[0] or 0
    while last >= FAN_IN:
        levels.append(materialise(price_groups(levels[-1], head), "priced"))
        last //= FAN_IN
    chosen = top = materialise(choose_last(levels.pop(), head), "chosen")
    for level in reversed(levels):
        chosen = materialise(choose_within(level, chosen, head), "chosen")
    totals = top.where("closing IS NOT NULL").select(F.col("conv_id").alias("_conv"), *COUNTS, "cost")
    split = assembled(edited(blocks, chosen, head), head).join(totals, F.col("conv_id").eqNullSafe(F.col("_conv")))
    return whole.unionByName(split.select(*whole.columns))
