"""Repair of conversation structure by alignment with the grammar of turns (operator 11).

Role initials must read `(s?(ua)+)?`. The turns of a conversation are aligned with target strings of that grammar by Wagner and
Fischer's table: keep costs 0, change of role 2, deletion 3 (required for blank and repeated turns), insertion 2, and a
truncated turn that stays 1. The alternating strings of all feasible lengths are prefixes of one another, so one table for each
of the two families (with and without s) holds every length as a column. A greedy repair, and then the cheapest one found, is
the incumbent: it bounds how far a column may lie from its row (Ukkonen's band). Equal costs are settled by the backtraced audits, of which
the least in ASCII order wins.

A conversation of up to SHORT turns is aligned at once. A longer one is cut into pieces of consecutive turns, wherever they lie:
rows are dealt by range, every piece is aligned for each state of the grammar before and after it, and the pieces' costs and
audits are put together in order. Only these small summaries of one conversation meet in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, staged

#: What the edits cost.
RETYPE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
#: Most turns of a conversation that is aligned at once, and turns of a piece of a longer one.
SHORT, PIECE = 256, 64
INFINITE = 1 << 60
BLANKS = " \t\n\x0b\x0c\r"
#: States of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)

#: A turn as the alignment sees it: its role's initial, whether it must go, what staying costs.
Turn = tuple[str, bool, int]


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: the rows after a damage drawn from conv_id and turn alone.

    Of twenty draws one drops the row (it stays marked as dropped, so that no conversation is forgotten), one empties its text, one
    removes its full stops, exclamation and question marks, one repeats it, one makes it the user's. Nulls count as one space.
    """
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_draw") == 4, "user").otherwise(F.col("role"))
    drawn = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), plain("role").alias("role"), plain("text").alias("text"), draw.alias("_draw"))
    copies = F.when(F.col("_draw") == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(F.col("_draw") == 0))
    return drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("dropped"))


def after(state: int, initial: str) -> int | None:
    """The state after a turn with this initial; none where the grammar does not allow it."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def greedy_cost(turns: list[Turn], state: int, ends: Callable[[int], bool]) -> int:
    """The cost of a repair made turn by turn: keep what fits, change the role of the rest, complete the end."""
    cost = 0
    for initial, must_go, stay in turns:
        if must_go:
            cost += DELETE
        elif (then := after(state, initial)) is not None:
            cost, state = cost + stay, then
        else:
            cost, state = cost + stay + RETYPE, ASSISTANT if state == USER else USER
    while not ends(state):
        cost, state = cost + INSERT, ASSISTANT if state == USER else USER
    return cost


def aligned(turns: list[Turn], state: int, target: str, ends: Callable[[int], bool], most: int) -> tuple[int, str] | None:
    """The cheapest cost up to `most`, and the least audit of that cost, of turning `turns` into a prefix of `target`.

    `ends(j)` tells whether the first j symbols are a string of the wanted kind. Row i of the table has the columns that lie no more than
    the band away from the number of turns, of the first i, that need not go; a cell holds the cost of all that is still to come.
    """
    spare = most - DELETE * sum(must_go for _, must_go, _ in turns)
    if spare < 0:
        return None
    rows, columns, at = len(turns), len(target), 0
    low, high = [0], [min(columns, spare // INSERT)]
    for _, must_go, _ in turns:
        at += not must_go
        low.append(max(0, at - spare // DELETE))
        high.append(min(columns, at + spare // INSERT))
    table: list[list[int]] = [[]] * (rows + 1)
    for i in range(rows, -1, -1):
        a, b = low[i], high[i]
        line = [INFINITE] * (max(0, b - a + 1) + 1)
        if i < rows:
            initial, must_go, stay = turns[i]
            below, c, d = table[i + 1], low[i + 1], high[i + 1]
        for j in range(b, a - 1, -1):
            best = INFINITE
            if i == rows:
                best = 0 if ends(j) else INFINITE
            else:
                if c <= j <= d:
                    best = DELETE + below[j - c]
                if not must_go and j < columns and c <= j + 1 <= d:
                    if target[j] == initial:
                        best = min(best, stay + below[j + 1 - c])
                    elif target[j] != "s":
                        best = min(best, RETYPE + stay + below[j + 1 - c])
            if j < b and target[j] != "s":
                best = min(best, INSERT + line[j + 1 - a])
            line[j - a] = best
        table[i] = line
    if low[0] or table[0][0] > most:
        return None
    cost, audit, i, j = table[0][0], [], 0, 0

    def cell(i: int, j: int) -> int:
        return table[i][j - low[i]] if i <= rows and low[i] <= j <= high[i] else INFINITE

    left = cost
    while i < rows or not (left == 0 and ends(j)):
        initial, must_go, stay = turns[i] if i < rows else ("", True, 0)
        symbol = target[j] if j < columns else "s"
        if i < rows and DELETE + cell(i + 1, j) == left:
            audit.append("D")
            left, i = left - DELETE, i + 1
        elif symbol != "s" and INSERT + cell(i, j + 1) == left:
            audit.append("I")
            left, j = left - INSERT, j + 1
        elif symbol == initial:
            audit.append("K")
            left, i, j = left - stay, i + 1, j + 1
        else:
            audit.append("R")
            left, i, j = left - stay - RETYPE, i + 1, j + 1
    return cost, "".join(audit)


def families(state: int, length: int) -> list[tuple[str, Callable[[int], int]]]:
    """The target strings that may follow `state`, long enough for `length` symbols, and the state after j symbols of each."""
    turns = "au" if state == USER else "ua"
    plain = (turns * (length // 2 + 1))[:length]

    def after_plain(j: int) -> int:
        return state if not j else USER if (plain[j - 1] == "u") else ASSISTANT

    out = [(plain, after_plain)]
    if state == START:
        out.append(("s" + plain, lambda j: START if not j else SYSTEM if j == 1 else USER if j % 2 == 0 else ASSISTANT))
    return out


def repair(turns: list[Turn], state: int = START, ends: tuple[int, ...] = (START, ASSISTANT)) -> tuple[int, str] | None:
    """The cheapest cost and its least audit of turns that begin in `state` and end in one of the states `ends`."""
    if not set(ends) & {USER, ASSISTANT}:  # nothing but an s may stand: no alternating string, and no more than one symbol
        most = DELETE * len(turns) + TRUNCATED
    else:
        most = greedy_cost(turns, state, lambda x: x in ends)
    best: tuple[int, str] | None = None
    for target, after_symbols in families(state, len(turns) + most // INSERT + 1):
        target = target if set(ends) & {USER, ASSISTANT} else target[:1]
        found = aligned(turns, state, target, lambda j, f=after_symbols: f(j) in ends, most)
        if found is not None and (best is None or found < best):
            best, most = found, found[0]
    return best


def rewritten(rows: list[tuple[str, str]], audit: str, state: int) -> tuple[list[tuple[str, str]], int]:
    """(role, text) of the turns that an audit leaves, and the state after them."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
        elif edit == "K":
            out.append(rows[at])
            state, at = after(state, rows[at][0][:1]), at + 1
        else:
            state = ASSISTANT if state == USER else USER
            out.append((ROLES["ua"[state == ASSISTANT]], "" if edit == "I" else rows[at][1]))
            at += edit == "R"
    return out, state


LAST = re.compile(f"[^{BLANKS}]")


def stay_cost(text: str) -> int | None:
    """What a turn of this text costs if it stays; none if it is blank."""
    body = text.rstrip(BLANKS)
    return None if not body else TRUNCATED * (body[-1] not in ".!?")


class Tally:
    """What is counted while the turns of a conversation pass in order; tallies of consecutive pieces add up."""

    FIELDS = "blank duplicate truncated illegal distinct".split()

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = None  # initials
        self.low = self.high = None  # turns
        self.rows = 0

    def add(self, turn: int | None, initial: str, blank: bool, duplicate: bool, stay: int) -> Turn:
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += not blank and not duplicate and stay
        if self.rows:
            self.illegal += (self.last or "") + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last, self.rows = initial, self.rows + 1
        if turn is not None:
            self.distinct += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        return initial, blank or duplicate, stay

    def values(self) -> dict[str, int | str | None]:
        return {k: getattr(self, k) for k in (*self.FIELDS, "first", "last", "low", "high", "rows")}

    def extend(self, other: dict) -> None:
        for name in self.FIELDS:
            setattr(self, name, getattr(self, name) + other[name])
        if self.rows and other["rows"]:
            self.illegal += self.last + other["first"] not in ("su", "ua", "au")
        if self.high is not None and other["low"] == self.high:
            self.distinct -= 1
        self.first = other["first"] if not self.rows else self.first
        self.last = other["last"] if other["rows"] else self.last
        self.low = other["low"] if self.low is None else self.low
        self.high = self.high if other["high"] is None else other["high"]
        self.rows += other["rows"]

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
NAMES = [x.split()[0] for x in RESULT.split(", ")]
TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
ORDER = ("turn", "role", "text")


def _result(tally: Tally, cost: int, audit: str) -> list:
    return [tally.gaps, tally.blank, tally.duplicate, tally.truncated, tally.illegal, cost, audit]


def _conversations(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """The groups of a task's rows, which are sorted by `keys`; rows come one by one, read about a megabyte of text at a time."""
    rows = (row for batch in batches for part in (pieces(iter([batch]), limit=1 << 20) if "text" in batch.schema.names else [batch]) for row in part.to_pylist())
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def _emitted(rows: Iterator[list], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[list] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def repair_conversations(rows: DataFrame, short: int = SHORT, piece: int = PIECE) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation of `rows`.

    `rows` has conv_id, turn, role, text and, if rows without a turn of their own are to keep a conversation, `dropped`. Turns are taken in
    the order of turn (nulls first), then role and text, so repeated rows stand together and ties do not depend on how rows are dealt. Nulls of role and
    text are one space. Rows without conv_id are one conversation. A conversation whose rows are all dropped has zeros, an
    empty audit and the hash of an empty text. Other columns are left out.
    """
    return repaired_turns(rows, short, piece, digest=True)


def repaired_turns(rows: DataFrame, short: int = SHORT, piece: int = PIECE, digest: bool = False) -> DataFrame:
    """conv_id, position, role, text of every turn after the repair; with `digest`, what `repair_conversations` returns."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)

    gone = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), plain("role"), plain("text"), gone.alias("dropped"))
    lengths = rows.groupBy("conv_id").agg(F.count("*").alias("_rows"))
    long_ones = staged(lengths.filter(F.col("_rows") > short).select(F.col("conv_id").alias("_long")), "long-conversations")
    if long_ones.isEmpty():
        return _short_ones(rows, digest)
    same = rows["conv_id"].eqNullSafe(long_ones["_long"])
    return _short_ones(rows.join(long_ones, same, "left_anti"), digest).union(_long_ones(rows.join(long_ones, same, "left_semi").filter("NOT dropped"), long_ones, piece, digest))


def _schema(rows: DataFrame, digest: bool) -> T.StructType:
    schema = T.StructType([rows.schema["conv_id"]])
    for column in (RESULT + ", repaired_sha256 string" if digest else "position long, role string, text string").split(", "):
        schema = schema.add(*column.split())
    return schema


def _short_ones(rows: DataFrame, digest: bool) -> DataFrame:
    """Conversations of a bounded number of turns: one is held at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _schema(rows, digest)
    arrow = to_arrow_schema(schema)

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for (conv_id,), found in _conversations(batches, ("conv_id",)):
            tally, turns, texts, seen = Tally(), [], [], set()
            for r in found:
                if r["dropped"]:
                    continue
                said = (r["role"], r["text"])
                stay = stay_cost(r["text"])
                turns.append(tally.add(r["turn"], r["role"][:1], stay is None, stay is not None and said in seen, stay or 0))
                texts.append(said)
                seen.add(said)
            cost, audit = repair(turns)
            after_it = rewritten(texts, audit, START)[0]
            if digest:
                yield [conv_id, *_result(tally, cost, audit), hashlib.sha256("\n".join(f"{a}:{b}" for a, b in after_it).encode()).hexdigest()]
            else:
                yield from ([conv_id, k, *x] for k, x in enumerate(after_it))

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    return dealt.mapInArrow(lambda batches: _emitted(mend(batches), arrow), schema)


def _long_ones(rows: DataFrame, ids: DataFrame, piece: int, digest: bool) -> DataFrame:
    """Conversations of any number of turns, in pieces."""
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

    # 1. All rows in order over all tasks; a task numbers its rows and cuts them into pieces.
    id_type = rows.schema["conv_id"].dataType
    said = F.md5(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit("\0"), F.length("role").cast("string"), F.lit("\0"), "role", "text").cast("binary"))
    body = F.regexp_replace("text", "[\\x20\\x09-\\x0D]+$", "")
    stay = F.when(body != "", F.when(F.substring(body, -1, 1).isin(".", "!", "?"), 0).otherwise(TRUNCATED))
    marked = rows.drop("dropped").withColumns({"said": F.unhex(said), "stay": stay.cast("int"), "part": F.lit(None).cast("int"), "at": F.lit(None).cast("long")})
    names = marked.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            columns = [batch.column(batch.schema.get_field_index(x)) for x in names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())], names)
            at += n

    order = ["conv_id", *ORDER]
    placed = staged(marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, marked.schema), "turns-in-order")
    # 2. Repeats: what was said before, in whichever piece.
    again = staged(placed.filter("stay IS NOT NULL").groupBy("said").agg(F.min(F.struct("part", "at")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("said", "first"), "said-again")
    light = placed.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "stay", "part", "at", "said").join(again, "said", "left").select(
        "conv_id", "turn", "initial", "stay", "part", "at", F.coalesce((F.col("first") < F.struct("part", "at")) & F.col("stay").isNotNull(), F.lit(False)).alias("duplicate"))
    block = (F.col("at") / piece).cast("long").alias("block")
    # 3. Each piece aligned between any two states.
    ways = T.ArrayType(T.StructType([T.StructField("enter", T.IntegerType()), T.StructField("leave", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))
    counts = "blank long, duplicate long, truncated long, illegal long, distinct long, first string, last string, low long, high long, rows long"
    summary = T.StructType([T.StructField("conv_id", id_type), T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType())])
    for column in counts.split(", "):
        summary = summary.add(*column.split())
    summary = summary.add("ways", ways)
    summary_arrow = to_arrow_schema(summary)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for (part, at, conv_id), found in _conversations(batches, ("part", "block", "conv_id")):
            tally, turns = Tally(), []
            for r in found:
                turns.append(tally.add(r["turn"], r["initial"], r["stay"] is None, r["duplicate"], r["stay"] or 0))
            options = [{"enter": a, "leave": b, "cost": x[0], "audit": x[1]} for a in STATES for b in STATES if (x := repair(turns, a, (b,))) is not None]
            yield [conv_id, part, at, *tally.values().values(), options]

    by_piece = light.withColumn("block", block).repartition("part", "block").sortWithinPartitions("part", "block", "conv_id", "at")
    pieces = staged(by_piece.mapInArrow(lambda b: _emitted(align(b), summary_arrow), summary), "aligned-pieces")
    # 4. The pieces of a conversation put together in order: the cheapest way to each state, equal costs by the audit.
    chosen = T.StructType([T.StructField("conv_id", id_type), T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType())])
    for column in ("enter integer, " + RESULT).split(", "):
        chosen = chosen.add(*column.split())
    chosen_arrow = to_arrow_schema(chosen)

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for (conv_id,), found in _conversations(batches, ("conv_id",)):
            tally, done = Tally(), []
            best: dict[int, tuple[int, str, tuple]] = {START: (0, "", ())}
            places: list[tuple[int, int]] = []
            settled: list[tuple[int, str]] = []
            for r in found:
                tally.extend(r)
                places.append((r["part"], r["block"]))
                then: dict[int, tuple[int, str, tuple]] = {}
                for way in r["ways"]:
                    if way["enter"] in best:
                        cost, audit, path = best[way["enter"]]
                        new = (cost + way["cost"], audit + way["audit"], (*path, (way["enter"], way["audit"])))
                        if way["leave"] not in then or new[:2] < then[way["leave"]][:2]:
                            then[way["leave"]] = new
                # What all ways have in common is settled, so that little is held and compared.
                shared = 0
                paths = [x[2] for x in then.values()]
                while all(len(p) > shared and p[shared] == paths[0][shared] for p in paths):
                    shared += 1
                settled += paths[0][:shared]
                cut = sum(len(a) for _, a in paths[0][:shared])
                best = {s: (c, a[cut:], p[shared:]) for s, (c, a, p) in then.items()}
            cost, _, path = min((best[s] for s in (START, ASSISTANT) if s in best), key=lambda x: x[:2])
            settled += path
            whole = "".join(a for _, a in settled)
            for (part, at), (enter, audit) in zip(places, settled, strict=True):
                done.append([conv_id, part, at, enter, *[None] * 6, audit])
            yield from done
            yield [conv_id, None, None, None, *_result(tally, cost, whole)]

    together = staged(pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").mapInArrow(lambda b: _emitted(put_together(b), chosen_arrow), chosen), "chosen-repairs")
    # 5. Turns are written anew where they lie; a piece's row of choice comes before its turns.
    after_it = T.StructType([T.StructField("conv_id", id_type), T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("k", T.LongType()),
                             T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    after_arrow = to_arrow_schema(after_it)
    choices = together.filter("part IS NOT NULL").select("conv_id", "part", "block", F.lit(-1).cast("long").alias("at"), F.col("audit").alias("role"), F.lit(None).cast("string").alias("text"), "enter")
    turns = placed.select("conv_id", "part", block, "at", "role", "text", F.lit(None).cast("int").alias("enter"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for (part, at, conv_id), found in _conversations(batches, ("part", "block", "conv_id")):
            choice = next(found)
            texts = [(r["role"], r["text"]) for r in found]
            for k, (role, text) in enumerate(rewritten(texts, choice["role"], choice["enter"])[0]):
                yield [conv_id, part, at, k, role, text]

    written = turns.unionByName(choices).repartition("part", "block").sortWithinPartitions("part", "block", "conv_id", "at").mapInArrow(
        lambda b: _emitted(rewrite(b), after_arrow, 64), after_it)
    schema = _schema(rows, digest)
    arrow = to_arrow_schema(schema)
    in_order = written.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "k")

    # 6. A digest of a whole conversation is one sequence by nature: its turns pass through one task, one at a time.
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for (conv_id,), found in _conversations(batches, ("conv_id",)):
            state, gap = hashlib.sha256(), ""
            for r in found:
                state.update(f"{gap}{r['role']}:{r['text']}".encode())
                gap = "\n"
            yield [conv_id, state.hexdigest()]

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for (conv_id,), found in _conversations(batches, ("conv_id",)):
            yield from ([conv_id, k, r["role"], r["text"]] for k, r in enumerate(found))

    if not digest:
        return in_order.mapInArrow(lambda b: _emitted(positions(b), arrow, 64), schema)
    pair = pa.schema([("conv_id", to_arrow_type(id_type)), ("sha", pa.string())])
    digests = in_order.mapInArrow(lambda b: _emitted(hashed(b), pair), T.StructType([T.StructField("_conv", id_type), T.StructField("sha", T.StringType())]))
    results = ids.join(together.filter("part IS NULL").select(F.col("conv_id").alias("_whole"), *NAMES), F.col("_long").eqNullSafe(F.col("_whole")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return results.join(digests, F.col("_long").eqNullSafe(F.col("_conv")), "left").select(
        F.col("_long").alias("conv_id"), *[F.coalesce(n, F.lit("" if n == "audit" else 0)).alias(n) for n in NAMES], F.coalesce("sha", F.lit(empty)).alias("repaired_sha256"))
