"""Cheapest repair of conversations into alternating turns, by divide and conquer over cost vectors of four states."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import written
from .turns import conversation_runs, numbered, sorted_turns

#: Turns in a block that one call solves, and blocks (or blocks of blocks) that are composed at once.
BLOCK, FAN = 1024, 1024
#: White space, ends of sentences, costs.
SPACE, ENDS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Initials of roles, as classes 0 to 3 (the last: any other), and adjacent ones that are legal.
INITIALS, LEGAL = "sua", ("su", "ua", "au")
#: States: nothing yet, after system, after user, after assistant. Where each initial leads.
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
SPEAKS = {0: "u", 1: "u", 2: "a", 3: "u"}
STATES, MISSING = range(4), 1 << 40
#: Accepting from a state: cost and edits of the turns inserted at the end.
CLOSING = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}
#: What is inserted before a turn, and what is done to it; a move is one of their pairs, written as one letter.
GAPS, DEEDS = ("", "u", "ua", "a", "au"), ("D", "K", "u", "a")
NAMES = {"u": "user", "a": "assistant"}
FIRST_CODE, FIRST_MOVE = ord("a"), ord("A")


def _steps(code: str) -> list[tuple[int, int, int, str, str]]:
    """``(state, next state, cost, edits, move)``: all ways past a turn of this code, with the turns inserted before it."""
    kind, fault = divmod(ord(code) - FIRST_CODE, 3)
    late = TRUNCATED if fault == 1 else 0
    out = []
    for start in STATES:
        at, gap = start, ""
        for k in range(3):
            edits, cost = "I" * k, INSERT * k
            deeds = [(at, DELETE, "D", "D")]
            if fault != 2:
                if kind < 3 and at in AFTER[INITIALS[kind]]:
                    deeds.append((AFTER[INITIALS[kind]][at], late, "K", "K"))
                deeds.append((AFTER[SPEAKS[at]][at], REROLE + late, "R", SPEAKS[at]))
            for after, price, edit, deed in deeds:
                if gap in GAPS:
                    out.append((start, after, cost + price, edits + edit, chr(FIRST_MOVE + GAPS.index(gap) * len(DEEDS) + DEEDS.index(deed))))
            gap, at = gap + SPEAKS[at], AFTER[SPEAKS[at]][at]
    return out


STEPS = {chr(FIRST_CODE + k): _steps(chr(FIRST_CODE + k)) for k in range(12)}


@functools.lru_cache(1 << 16)
def _forward(costs: tuple, ranks: tuple, code: str) -> tuple[tuple, tuple, int]:
    """The vector after one turn more: costs above the least, ranks of the least edits of the states, and that least cost.

    Edits up to a turn end with that turn's own, so none is the beginning of another and an earlier difference decides.
    """
    best = {}
    for start, after, cost, edits, _ in STEPS[code]:
        if costs[start] < MISSING:
            key = (costs[start] + cost, ranks[start], edits)
            best[after] = min(best.get(after, key), key)
    least = min(k[0] for k in best.values())
    order = {k: n for n, k in enumerate(sorted({k[1:] for k in best.values()}))}
    return tuple(best[s][0] - least if s in best else MISSING for s in STATES), tuple(order[best[s][1:]] if s in best else 0 for s in STATES), least


@functools.lru_cache(1 << 16)
def _backward(costs: tuple, code: str) -> tuple[tuple, int]:
    best = [MISSING] * 4
    for start, after, cost, _, _ in STEPS[code]:
        if costs[after] < MISSING:
            best[start] = min(best[start], costs[after] + cost)
    least = min(best)
    return tuple(c - least if c < MISSING else c for c in best), least


def _only(state: int) -> tuple:
    return tuple(0 if s == state else MISSING for s in STATES)


def forward(codes: str, start: int) -> tuple[tuple, tuple]:
    """Costs from ``start`` to each state behind ``codes``, and the order of their least edits."""
    costs, ranks, total = _only(start), (0, 0, 0, 0), 0
    for code in codes:
        costs, ranks, least = _forward(costs, ranks, code)
        total += least
    return tuple(c + total if c < MISSING else c for c in costs), ranks


def backward(codes: str, end: int) -> tuple:
    """Costs from each state through ``codes`` to ``end``."""
    costs, total = _only(end), 0
    for code in reversed(codes):
        costs, least = _backward(costs, code)
        total += least
    return tuple(c + total if c < MISSING else c for c in costs)


@functools.lru_cache(1 << 12)
def moves_between(codes: str, start: int, end: int) -> tuple[str, str]:
    """Edits and moves of the cheapest way through ``codes`` from ``start`` to ``end``, the least edits of the cheapest.

    The forward vector of the first half and the backward vector of the second meet in the middle; of the states with the least
    sum the one with the least edits is crossed, and both halves are solved in the same way. Only vectors and the result are held.
    """
    edits, moves, todo = [], [], [(0, len(codes), start, end)]
    while todo:
        lo, hi, a, z = todo.pop()
        if hi - lo == 1:
            _, edit, move = min((cost, edits_, move) for q, after, cost, edits_, move in STEPS[codes[lo]] if (q, after) == (a, z))
            edits.append(edit)
            moves.append(move)
        elif hi > lo:
            mid = (lo + hi) // 2
            (costs, ranks), rest = forward(codes[lo:mid], a), backward(codes[mid:hi], z)
            cross = min((costs[s] + rest[s], ranks[s], s) for s in STATES if costs[s] < MISSING and rest[s] < MISSING)[2]
            todo += [(mid, hi, cross, z), (lo, mid, a, cross)]
    return "".join(edits), "".join(moves)


def _transfer(codes: str) -> list[int]:
    """For each start: the costs to the four states and the order of their edits."""
    return [x for s in STATES for part in forward(codes, s) for x in part]


def _compose(one: list[int], two: list[int]) -> list[int]:
    """The transfer of two stretches in a row."""
    out = []
    for s in STATES:
        best = {}
        for m in STATES:
            for z in STATES:
                if one[8 * s + m] < MISSING and two[8 * m + z] < MISSING:
                    key = (one[8 * s + m] + two[8 * m + z], one[8 * s + 4 + m], two[8 * m + 4 + z])
                    best[z] = min(best.get(z, key), key)
        order = {k: n for n, k in enumerate(sorted({k[1:] for k in best.values()}))}
        out += [best[z][0] if z in best else MISSING for z in STATES] + [order[best[z][1:]] if z in best else 0 for z in STATES]
    return out


def _crossings(parts: list[list[int]], start: int, end: int) -> list[int]:
    """The states at the borders of stretches on the least of the cheapest ways: vectors from both sides meet at each border."""
    rest = [_only(end)]
    for t in reversed(parts):
        rest.append(tuple(min(t[8 * s + z] + rest[-1][z] for z in STATES) for s in STATES))
    rest.reverse()
    at, out = start, [start]
    for t, left in zip(parts, rest[1:], strict=True):
        at = min((t[8 * at + z] + left[z], t[8 * at + 4 + z], z) for z in STATES)[2]
        out.append(at)
    return out


def transfers(codes: pd.Series) -> pd.Series:
    return codes.map(_transfer)


def composed(parts: pd.Series) -> pd.Series:
    return parts.map(lambda x: functools.reduce(_compose, ([int(v) for v in t] for t in x)))


def crossed(parts: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    return pd.Series([_crossings([[int(v) for v in t] for t in x], a, z) for x, a, z in zip(parts, start, end, strict=True)])


def closed(whole: pd.Series) -> pd.DataFrame:
    """Of a whole conversation from the first state: where it ends, the cost with the turns inserted at the end, and their edits."""
    rows = []
    for t in whole:
        cost, _, tail, end = min((int(t[z]) + CLOSING[z][0], int(t[4 + z]), CLOSING[z][1], z) for z in STATES if t[z] < MISSING)
        rows.append((end, cost, tail))
    return pd.DataFrame(rows, columns=["end", "cost", "tail"])


def moved(codes: pd.Series, start: pd.Series, end: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([moves_between(c, a, z) for c, a, z in zip(codes, start, end, strict=True)], columns=["edits", "moves"])


def neighbours(codes: pd.Series) -> pd.DataFrame:
    """Adjacent turns of a block whose initials aren't legal, and its outer initials."""
    rows = []
    for c in codes:
        initials = "".join((INITIALS + "o")[(ord(x) - FIRST_CODE) // 3] for x in c)
        rows.append((sum(initials[k : k + 2] not in LEGAL for k in range(len(initials) - 1)), initials[0], initials[-1]))
    return pd.DataFrame(rows, columns=["illegal", "head", "foot"])


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage: by the crc32 of ``conv_id:turn`` modulo 20 dropped, emptied, without ends of sentences, repeated or said by the user."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat_ws(":", text["conv_id"], text["turn"]).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text["role"].alias("role"), text["text"].alias("text"), kind.alias("kind")).filter("kind <> 0")
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), copies.alias("copy")).drop("copy")


def faults(turns: DataFrame) -> DataFrame:
    """``(conv_id, at, fault, initial)``: the first fault of each row, ``blank``, ``duplicate``, ``truncated`` or null."""
    content = F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
    rest = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    rows = turns.select("conv_id", "at", content.alias("content"), (rest == "").alias("blank"), F.right(rest, F.lit(1)).isin(*ENDS).alias("ends"), initial.alias("initial"))
    seen = rows.groupBy(F.col("conv_id").alias("of_conv"), F.col("content").alias("of_content")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("content") == F.col("of_content")), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("at") > F.col("first"), "duplicate").when(~F.col("ends"), "truncated")
    return rows.select("conv_id", "at", fault.alias("fault"), "initial")


def coded() -> Column:
    """One letter for what matters of a row: the class of its initial, and whether it is sound, truncated or to be deleted."""
    kind = F.coalesce(*[F.when(F.col("initial") == c, k) for k, c in enumerate(INITIALS)], F.lit(3))
    return F.char(F.lit(FIRST_CODE) + kind * 3 + F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 1).otherwise(2))


def solved(blocks: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, block, edits, moves)`` of every block of ``(conv_id, block, codes)``, and ``(conv_id, cost, tail)``.

    The blocks of a conversation are the outer rounds of the divide and conquer: their transfers are composed ``fan`` at
    a time until one is left, and the states where the best way crosses the borders come back down the same tree.
    """
    level = written(blocks.select("conv_id", F.col("block").alias("part"), pandas_udf(transfers, "array<long>")("codes").alias("transfer")), "repair-transfers")
    levels = [level]
    while (level.agg(F.max("part")).first()[0] or 0) > 0:
        grouped = level.groupBy("conv_id", F.expr(f"part div {fan}").alias("of")).agg(F.sort_array(F.collect_list(F.struct("part", "transfer"))).alias("parts"))
        level = written(grouped.select("conv_id", F.col("of").alias("part"), "parts", pandas_udf(composed, "array<long>")(F.col("parts.transfer")).alias("transfer")), "repair-transfers")
        levels.append(level)
    ends = level.select("conv_id", "part", pandas_udf(closed, "struct<end: int, cost: long, tail: string>")(F.slice("transfer", 1, 8)).alias("c")).select("conv_id", "part", F.lit(0).alias("start"), "c.end", "c.cost", "c.tail")
    ends = written(ends, "repair-ends")
    states = ends.select(F.col("conv_id").alias("of_conv"), F.col("part").alias("of_part"), "start", "end")
    for upper in levels[:0:-1]:
        down = upper.join(states, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("part") == F.col("of_part")))
        down = down.select("conv_id", "parts", pandas_udf(crossed, "array<int>")(F.col("parts.transfer"), "start", "end").alias("at"))
        each = F.transform("parts", lambda x, k: F.struct(x["part"].alias("of_part"), F.get("at", k).alias("start"), F.get("at", k + 1).alias("end")))
        states = down.select(F.col("conv_id").alias("of_conv"), F.inline(each))
    found = blocks.join(states, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_part")))
    return found.select("conv_id", "block", pandas_udf(moved, "struct<edits: string, moves: string>")("codes", "start", "end").alias("m")).select("conv_id", "block", "m.edits", "m.moves"), ends


def repaired_turns(placed: DataFrame, moves: DataFrame, ends: DataFrame, block: int) -> DataFrame:
    """``(conv_id, place, role, text)`` of the repaired conversations, in the order of ``place`` (an array of row and number)."""
    of = moves.select(F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"), "moves")
    rows = placed.join(of, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.expr(f"place div {block}") == F.col("of_block")))
    move = F.ascii(F.substring(F.col("moves"), (F.col("place") % block + 1).cast("int"), F.lit(1))) - FIRST_MOVE
    gap, deed = F.floor(move / len(DEEDS)).cast("int"), move % len(DEEDS)

    def say(letters: str) -> Column:
        return F.array(*[F.struct(F.lit(NAMES[c]).alias("role"), F.lit("").alias("text")) for c in letters])

    nothing = F.array().cast("array<struct<role: string, text: string>>")
    role = F.when(deed == 1, F.col("role")).when(deed == 2, NAMES["u"]).otherwise(NAMES["a"])
    own = F.when(deed == 0, nothing).otherwise(F.array(F.struct(role.alias("role"), F.col("text").alias("text"))))
    put = functools.reduce(lambda c, k: c.when(gap == k, say(GAPS[k])), range(1, len(GAPS)), F.when(gap == 0, nothing))
    said = rows.select("conv_id", "place", F.concat(put, own).alias("said"))
    last = F.when(F.col("tail") == "I", say("a")).when(F.col("tail") == "II", say("ua"))
    tails = ends.filter("tail <> ''").select("conv_id", F.lit((1 << 63) - 1).alias("place"), last.alias("said"))
    out = said.filter(F.size("said") > 0).unionByName(tails).select("conv_id", "place", F.posexplode("said").alias("number", "turn"))
    return out.select("conv_id", F.array("place", F.col("number").cast("long")).alias("place"), "turn.role", "turn.text")


def transcripts(turns: DataFrame) -> DataFrame:
    """``(conv_id, sha256)`` of each conversation's ``role:text`` lines in the order of ``place``; digests stream over sorted rows."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state = None, None
        for batch in batches:
            out = []
            for c, line in zip(batch["conv"], batch["line"], strict=True):
                if state and conv == c:
                    state.update(b"\n")
                else:
                    if state:
                        out.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                state.update(line.encode())
            yield pd.DataFrame(out, columns=["conv", "sha256"])
        if state:
            yield pd.DataFrame([(conv, state.hexdigest())], columns=["conv", "sha256"])

    lines = turns.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "place", F.concat_ws(":", "role", "text").alias("line"))
    found = lines.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "line").mapInPandas(digests, "conv string, sha256 string")
    return found.select(F.when(F.col("conv") != "", F.col("conv").cast("long")).alias("conv_id"), "sha256")


def repair(conversations: DataFrame, block: int = BLOCK, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """A report per conversation, and the repaired turns ``(conv_id, place, role, text)``; rows are taken as they are.

    The report has ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` for the conversations that have rows.
    Turns are ordered by turn, null first, ties by role and then text. Blank and repeated rows are deleted, others kept, given
    another role, or deleted, and empty turns inserted, at the least cost, so that the initials of the roles are
    nothing or alternate from user to assistant after at most one system turn; of equally cheap edits those with
    the least initials are taken. A null conv_id is a conversation of its own. Roles other than system, user and assistant (by their
    initials; also empty ones) have to be changed or deleted. Long conversations are solved block by block, texts are never
    cut. An empty table gives no rows. Further columns play no part.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    turns = sorted_turns(conversations, order, [F.col(c) for c in ("conv_id", "turn", "role", "text")], "repair-turns")
    runs = conversation_runs(turns)
    rows = numbered(faults(turns), runs).select("conv_id", "place", "fault", "initial")
    rows = written(rows.withColumn("code", coded()).select("conv_id", "place", "fault", "code"), "repair-codes")
    blocks = rows.groupBy("conv_id", F.expr(f"place div {block}").alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "code"))), lambda x: x["code"]), "").alias("codes"))
    blocks = written(blocks, "repair-blocks")
    found, ends = solved(blocks, fan)
    moves = written(found, "repair-moves")

    beside = blocks.select("conv_id", "block", pandas_udf(neighbours, "struct<illegal: long, head: string, foot: string>")("codes").alias("n")).select("conv_id", "block", "n.*")
    before = F.lag("foot").over(Window.partitionBy("conv_id").orderBy("block"))
    border = F.when(F.concat(before, F.col("head")).isin(*LEGAL), 0).otherwise(F.when(before.isNotNull(), 1).otherwise(0))
    illegal = beside.select("conv_id", (F.col("illegal") + border).alias("illegal")).groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    counts = rows.groupBy("conv_id").agg(*[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    span = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count_distinct("turn")
    gaps = turns.groupBy("conv_id").agg(F.coalesce(span.cast("long"), F.lit(0)).alias("gaps"))
    audits = moves.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "edits"))), lambda x: x["edits"]), "").alias("edits"))
    report = counts
    for part in (gaps, illegal, audits, ends.select("conv_id", "cost", "tail")):
        other = part.withColumnRenamed("conv_id", "of_conv")
        report = report.join(other, F.col("conv_id").eqNullSafe(F.col("of_conv"))).drop("of_conv")
    report = report.withColumn("audit", F.concat("edits", "tail"))
    report = report.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return report, repaired_turns(numbered(turns, runs), moves, ends, block)
