"""Repair of the turns of conversations by Hirschberg's divide and conquer.

A conversation's role initials shall be nothing, or pairs of user and assistant with at most one system turn before them. Turns are kept, get another role, are
deleted, or are inserted. Four states tell what came before: nothing, system, user, assistant. Forward cost vectors over the first half of the turns meet
backward ones over the second half; the state in which both together are cheapest is crossed, and of several the one whose edits so far are least as
text. Both halves are then solved alike, so edits are found in linear space. An edit text ends in its turn's own letter, so none is the
beginning of another one, and the order of two texts is known from the order they had before the last turn: four ranks beside the four costs do.

A long conversation is cut into blocks where its sorted turns are, in whatever tasks. A block tells its costs from each state to each and the order of their texts;
with these, blocks are crossed as turns are, and each block is then solved by itself. Equal turns are counted before anything moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.session import ship, written

WHITE = " \t\n\x0b\x0c\r"
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: States: 0 nothing, 1 system, 2 user, 3 assistant. Where a kept initial leads, and what an inserted or reroled turn has to be.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
MADE = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
#: Inserts after the last turn.
END = {0: 0, 1: 2, 2: 1, 3: 0}
LEGAL = {"su", "ua", "au"}
#: Turns a block.
BLOCK = 1 << 16

Moves = tuple[dict[int, tuple], ...]
Vector = dict[int, tuple[int, int]]


@lru_cache(maxsize=None)
def moves(code: str) -> Moves:
    """From each state, the states after a turn with cost and edits, the cheapest and then least ones. ``code`` is x for a turn that has to go, else
    its initial (s, u, a, or o for others), in capitals where the text is truncated."""
    told = []
    for s in range(4):
        found: dict[int, tuple[int, str]] = {}
        at, cost, word = s, 0, ""
        for _ in range(3):
            ways = [(at, cost + DELETE, word + "D")]
            if code != "x":
                more = TRUNCATED * code.isupper()
                ways.append((MADE[at], cost + REROLE + more, word + "R"))
                if (to := KEPT.get((at, code.lower()))) is not None:
                    ways.append((to, cost + more, word + "K"))
            for t, c, w in ways:
                found[t] = min(found.get(t, (c, w)), (c, w))
            at, cost, word = MADE[at], cost + INSERT, word + "I"
        told.append(found)
    return tuple(told)


def forward(vector: Vector, step: Moves) -> Vector:
    """Cost of each state after one more step, and the rank of its edits as text among those of the four states."""
    best: dict[int, tuple] = {}
    for s, (cost, rank) in vector.items():
        for t, (more, word) in step[s].items():
            new = (cost + more, rank, word)
            if t not in best or new < best[t]:
                best[t] = new
    order = sorted(best, key=lambda t: best[t][1:])
    return {t: (best[t][0], rank) for rank, t in enumerate(order)}


@lru_cache(maxsize=100_000)
def _forward(states: tuple, code: str) -> tuple[int, tuple]:
    after = forward(dict(states), moves(code))
    least = min(c for c, _ in after.values())
    return least, tuple((t, (c - least, r)) for t, (c, r) in after.items())


def forward_codes(vector: Vector, codes: str) -> Vector:
    """``forward`` over many turns. Costs are held as differences, of which there are few, so steps are looked up."""
    base, states = 0, tuple(vector.items())
    for code in codes:
        more, states = _forward(states, code)
        base += more
    return {t: (base + c, r) for t, (c, r) in states}


def backward(end: dict[int, int], step: Moves) -> dict[int, int]:
    """Cost to the end from each state before a step."""
    return {s: min(costs) for s in range(4) if (costs := [c + end[t] for t, (c, _) in step[s].items() if t in end])}


def crossings(steps: list[Moves], start: int, end: dict[int, int], over=None) -> list[int]:
    """The state after each step of the cheapest way from ``start``, of several the one least as text. ``over`` may go forward over many steps at once."""
    over = over or (lambda vector, a, b: _over(vector, steps[a:b]))
    told: list[int] = []
    todo = [(0, len(steps), start, end)] if steps else []
    while todo:  # the left half is solved first, and tells where the right one starts
        a, b, s, end = todo.pop()
        s = told[-1] if s is None else s
        if b - a == 1:
            told.append(min((t for t in steps[a][s] if t in end), key=lambda t: (steps[a][s][t][0] + end[t], steps[a][s][t][1])))
            continue
        mid, back = (a + b) // 2, end
        for step in steps[mid:b][::-1]:
            back = backward(back, step)
        ahead = over({s: (0, 0)}, a, mid)
        cross = min((t for t in ahead if t in back), key=lambda t: (ahead[t][0] + back[t], ahead[t][1]))
        todo += [(mid, b, None, end), (a, mid, s, {cross: 0})]
    return told


def _over(vector: Vector, steps: list[Moves]) -> Vector:
    for step in steps:
        vector = forward(vector, step)
    return vector


def solve(codes: str, start: int, end: dict[int, int]) -> tuple[list[str], int]:
    """The edits of each turn, with inserts before it, and the state after the last."""
    states = [start, *crossings([moves(c) for c in codes], start, end, lambda vector, a, b: forward_codes(vector, codes[a:b]))]
    return [moves(c)[s][t][1] for c, s, t in zip(codes, states[:-1], states[1:], strict=True)], states[-1]


def ends() -> dict[int, int]:
    return {s: INSERT * n for s, n in END.items()}


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, damaged by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 removes its ends of sentences, 3 repeats
    it, 4 makes it the user's. Null roles and texts become one space, as do null ids and turns in the hashed text."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), k.alias("k")).where("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    again = F.explode(F.when(F.col("k") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), again.alias("copy")).drop("copy")


_KEYS = ["conv_id", "turn", "role", "digest"]
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_BLOCK = "conv_id long, block long, codes string, copies array<long>, turns array<long>, roles array<string>, digests array<binary>, initials string, least long, most long, different long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, costs array<int>"


def _pairs(a: str, b: str) -> int:
    return int(a + b not in LEGAL)


def _packed(most: int):
    """Sorted turns (conv_id, turn, role, digest, code, n, first, chunk) as blocks of at most ``most`` turns of one conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("codes", pa.string()), ("copies", pa.list_(pa.int64())), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("digests", pa.list_(pa.binary())), ("initials", pa.string()), *((c, pa.int64()) for c in ("least", "most", "different", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal")), ("costs", pa.list_(pa.int32()))])
        made, number, now, chunk = [], 0, [], 0

        def block(rows: list[tuple]) -> dict:
            codes, letters = [], [(r[2][:1] if r[2][:1] in ("s", "u", "a") else "o") for r in rows]
            count = {"blank": 0, "duplicate": 0, "truncated": 0}
            for r in rows:
                code, n, first = r[4], r[5], r[6]
                count["blank" if code == "x" else "duplicate"] += n if code == "x" or not first else n - 1
                count["truncated"] += first and code.isupper()
                codes.append(code if first else "x")
            seen = [r[1] for r in rows if r[1] is not None]
            text = "".join(codes)
            costs = [x for s in range(4) for told in [forward_codes({s: (0, 0)}, text)] for t in range(4) for x in told.get(t, (-1, -1))]
            return {
                "conv_id": rows[0][0], "block": (chunk << 32) + number, "codes": text, "copies": [r[5] for r in rows], "turns": [r[1] for r in rows], "roles": [r[2] for r in rows], "digests": [r[3] for r in rows],
                "initials": letters[0] + letters[-1], "least": min(seen, default=None), "most": max(seen, default=None), "different": len(set(seen)), "first_turn": rows[0][1], "last_turn": rows[-1][1],
                "illegal": sum(r[5] - 1 for r in rows) + sum(map(_pairs, letters[:-1], letters[1:])), "costs": costs, **count,
            }

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True):
                chunk = row[7]
                if now and (row[0] != now[0][0] or len(now) >= most):
                    made.append(block(now))
                    number, now = number + 1, []
                now.append(row)
                if len(made) >= 1000:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made = []
        if now:
            made.append(block(now))
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)

    return run


def _block_moves(costs: list[int]) -> Moves:
    told = [(costs[i], costs[i + 1]) for i in range(0, 32, 2)]
    return tuple({t: told[4 * s + t] for t in range(4) if told[4 * s + t][0] >= 0} for s in range(4))


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block the state before it and after it (null at the conversation's end); what is known of the conversation stands in its first block's row."""
    schema = pa.schema([("block", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), *((c, pa.int64()) for c in _COUNTS)])
    made, now = [], []

    def conversation(rows: list[dict]) -> list[dict]:
        steps = [_block_moves(r["costs"]) for r in rows]
        states = crossings(steps, 0, ends())
        known = [r for r in rows if r["least"] is not None]
        met = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True)]
        total = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")}
        total["illegal"] = sum(r["illegal"] for r in rows) + sum(_pairs(a["initials"][1], b["initials"][0]) for a, b in met)
        different = sum(r["different"] for r in rows) - sum(a["last_turn"] is not None and a["last_turn"] == b["first_turn"] for a, b in met)
        total["gaps"] = max(r["most"] for r in known) - min(r["least"] for r in known) + 1 - different if known else 0
        befores = [0, *states[:-1]]
        total["cost"] = sum(steps[i][s][t][0] for i, (s, t) in enumerate(zip(befores, states, strict=True))) + ends()[states[-1]] + DELETE * sum(r["more"] for r in rows)
        none = dict.fromkeys(_COUNTS, 0)
        return [{"block": r["block"], "before": s, "after": t if i < len(rows) - 1 else None} | (total if i == 0 else none) for i, (r, s, t) in enumerate(zip(rows, befores, states, strict=True))]

    for batch in batches:
        for row in batch.to_pylist():
            if now and row["conv_id"] != now[0]["conv_id"]:
                made += conversation(now)
                now = []
            now.append(row)
        if len(made) >= 1000:
            yield pa.RecordBatch.from_pylist(made, schema)
            made = []
    if now:
        made += conversation(now)
    if made:
        yield pa.RecordBatch.from_pylist(made, schema)


_EDIT = "conv_id long, block long, at long, edit string, turn long, role string, digest binary, new_role string"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's edits as one text (at -1), and a row for every turn that stays or is new; ``at`` is the place of its letter in that text."""
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("new_role", pa.string())])
    for batch in batches:
        for row in batch.to_pylist():
            words, last = solve(row["codes"], row["before"], ends() if row["after"] is None else {row["after"]: 0})
            if row["after"] is None:
                words.append("I" * END[last])
            letters, rows, state = [], [], row["before"]
            for i, word in enumerate(words):
                for letter in word:
                    own = i < len(row["codes"]) and letter != "I"
                    turn, role, digest = (row[c][i] for c in ("turns", "roles", "digests")) if own else (None, None, None)
                    if letter != "D":
                        state = KEPT[state, role[:1]] if letter == "K" else MADE[state]
                        rows.append((row["conv_id"], row["block"], len(letters), letter, turn, role, digest, role if letter == "K" else ROLES[state]))
                    letters.append(letter)
                if i < len(row["codes"]):
                    letters += "D" * (row["copies"][i] - 1)
            rows.append((row["conv_id"], row["block"], -1, "".join(letters), None, None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


@dataclass(frozen=True)
class Repaired:
    """turns: conv_id, block, at (both together the order), edit, turn, role, text; audits: conv_id, block, edits, and the conversation's counts in
    its first block's row; conversations: the ids of all."""

    turns: DataFrame
    audits: DataFrame
    conversations: DataFrame


def repair(turns: DataFrame, conversations: DataFrame, *, block: int = BLOCK) -> Repaired:
    """The cheapest edits of every conversation; ``turns`` has conv_id, turn, role, text, ``conversations`` has all conv_ids; ``block`` is turns a block.

    Turns go in the order of turn (null first), role and digest of the text. Null roles and texts count as one space. A null conv_id is a conversation of its own. A turn
    without letters (white space only) and a later turn of the same role and text are deleted; a repeated row is one of these. A turn that does not end
    in . ! or ? costs 1 where it stays. Roles that are not legal where they stand, the empty one too, are replaced or deleted. A conversation without turns
    has no edits; an empty table gives no rows. Other columns are left out, whatever their names.
    """
    spark = turns.sparkSession
    ship(spark)
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    given = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"))
    given = given.withColumn("digest", F.unhex(F.sha2("text", 256)))
    bare = F.rtrim("text", F.lit(WHITE))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    code = F.when(bare == "", "x").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), initial).otherwise(F.upper(initial))
    counted = written(given.select(*_KEYS, code.alias("code")).groupBy(*_KEYS).agg(F.first("code").alias("code"), F.count("*").alias("n")), "turns")
    # the first turn of a role and text is one row again, so a text that is often repeated is not one key
    firsts = counted.where("code <> 'x'").groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("is"), "turn")).alias("t"))
    firsts = firsts.select("conv_id", F.col("t.turn").alias("turn"), "role", "digest", F.lit(None).cast("string").alias("code"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("first"))
    marked = counted.withColumn("first", F.lit(False)).unionByName(firsts).groupBy(*_KEYS).agg(F.max("code").alias("code"), F.sum("n").alias("n"), F.max("first").alias("first"))
    ordered = written(marked, "marked").repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS).withColumn("chunk", F.spark_partition_id().cast("long"))
    blocks = written(ordered.transform(mapped, _packed(block), _BLOCK), "blocks")
    more = F.aggregate("copies", F.lit(0).cast("long"), lambda a, n: a + n - 1).alias("more")
    known = blocks.drop("codes", "copies", "turns", "roles", "digests").join(blocks.select("block", more), "block")
    crossed = written(known.repartition("conv_id").sortWithinPartitions("conv_id", "block").transform(mapped, _crossed, "block long, before int, after int, " + ", ".join(f"{c} long" for c in _COUNTS)), "crossed")
    edits = written(blocks.select("conv_id", "block", "codes", "copies", "turns", "roles", "digests").join(crossed.select("block", "before", "after"), "block").transform(mapped, _edited, _EDIT), "edits")
    audits = edits.where("at < 0").select("conv_id", "block", F.col("edit").alias("edits")).join(crossed.drop("before", "after"), "block")
    kept = edits.where("digest is not null").select(*_KEYS, F.struct("block", "at", "edit", "new_role").alias("e"))
    texts = given.select(*_KEYS, F.lit(None).cast(kept.schema["e"].dataType).alias("e"), "text")
    told = kept.withColumn("text", F.lit(None).cast("string")).unionByName(texts).groupBy(*_KEYS).agg(F.max("e").alias("e"), F.max("text").alias("text")).where("e is not null")
    stay = told.select("conv_id", "e.block", "e.at", "e.edit", "turn", F.col("e.new_role").alias("role"), "text")
    new = edits.where("at >= 0 and digest is null").select("conv_id", "block", "at", "edit", "turn", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repaired(stay.unionByName(new), audits, conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct())


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation, its edits and repaired turns in order: one row each, the turns streamed through the hash."""
    made, now = [], None

    def told(x: dict) -> tuple:
        return (x["conv_id"], *(x[c] for c in _COUNTS), "".join(x["audit"]), x["hash"].hexdigest())

    def out() -> pa.RecordBatch:
        types = [pa.int64()] * (1 + len(_COUNTS)) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], ["conv_id", *_COUNTS, "audit", "repaired_sha256"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "at", "edits", "role", "text", *_COUNTS)]
        for conv, at, edits, role, text, *counts in zip(*columns, strict=True):
            if now is None or conv != now["conv_id"]:
                if now is not None:
                    made.append(told(now))
                now = {"conv_id": conv, "audit": [], "hash": hashlib.sha256(), "any": False} | dict.fromkeys(_COUNTS, 0)
            if at == -1:
                now["audit"].append(edits)
                for c, n in zip(_COUNTS, counts, strict=True):
                    now[c] += n
            elif at >= 0:
                now["hash"].update((("\n" if now["any"] else "") + f"{role}:{text}").encode())
                now["any"] = True
        if len(made) >= 1000:
            yield out()
            made = []
    if now is not None:
        made.append(told(now))
    if made:
        yield out()


def summaries(repaired: Repaired) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (of `role:text`, joined by newlines). Ids without turns have zeros, no
    edits and the hash of nothing. One row is one text of edits and one hash, so a conversation streams through one task, in constant memory but for
    its letters."""
    rows = repaired.turns.select("conv_id", "block", "at", "role", "text").unionByName(repaired.audits.withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True)
    rows = rows.unionByName(repaired.conversations.withColumns({"block": F.lit(-1).cast("long"), "at": F.lit(-2).cast("long")}), allowMissingColumns=True)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "at")
    return ordered.transform(mapped, _summed, "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string")
