"""Repair of the structure of conversations by a square-root checkpointed dynamic program.

A repaired conversation has the role initials ``(s?(ua)+)?``. Four states tell what was emitted last (nothing, s, u, a); the backward cost vector of a place
holds, for each state, what the rest of the conversation costs at least. Vectors are stored only at checkpoints; walking forward, the vectors of one block are
computed again from the checkpoint at its end, and of the tight edits the one of the least ASCII initial is emitted.

On Spark the rows are range-partitioned and sorted from the last to the first, so that a conversation of any length is spread over tasks. A task finishes every
conversation that it holds whole and that fits a block. Of the others it writes blocks, each with the cost matrix of what follows it in its partition; the
checkpoints at the ends of partitions are chained over those matrices, one row a partition, and the blocks of a conversation are then streamed forward. Only that
last walk is sequential, as the digest of the repaired text is.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..session import staged
from .frame import narrow, refuse

#: Rows and bytes of text that a task holds of one conversation; a longer one is cut into blocks.
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
#: Role that a state needs next, and the state that it leads to.
NEEDED = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
#: Cost, relative to the cheapest state, of a state that cannot get where it should.
NEVER = 1000
#: Edits that end a conversation in each state, and their cost vector.
TAIL = ("", "II", "I", "")
END = (0, 2 * INSERT, INSERT, 0)
#: Row codes: four times the kind of the role (s, u, a, other) plus the fault; GONE rows only name their conversation.
SOUND, CUT, BLANK, DUPLICATE = range(4)
GONE = 16
LEGAL = frozenset(("su", "ua", "au"))
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row in ASCII order: initial, cost, next state."""
    kind, fault = divmod(code, 4)
    found = [("D", DELETE, state)]
    if fault < BLANK:
        more = TRUNCATED if fault == CUT else 0
        to = NEEDED[state][1]
        if kind == 0 and state == START:
            found.append(("K", more, SYSTEM))
        elif kind == to - 1 and kind > 0:
            found.append(("K", more, to))
        found.append(("R", REROLE + more, to))
    return found


@lru_cache(1 << 14)
def back(code: int, after: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    """The cost vector before a row from that after it, as its least cost and the costs above that."""
    costs = [min(cost + after[to] for _, cost, to in edits(code, state)) for state in range(4)]
    for _ in range(3):
        costs = [min(costs[s], INSERT + costs[NEEDED[s][1]]) for s in range(4)]
    least = min(costs)
    return least, tuple(c - least if c < NEVER // 2 else NEVER for c in costs)


@lru_cache(1 << 16)
def tight(code: int, after: tuple[int, ...], state: int) -> tuple[str, int, int]:
    """The ASCII-least tight edits of a row, insertions before it included: initials, cost, next state."""
    least, before = back(code, after)
    done, spent = "", 0
    while True:
        owed = least + before[state]
        # D comes before I, and I before K and R
        for name, cost, to in sorted([*edits(code, state), ("I", INSERT, -1)]):
            if name == "I":
                if INSERT + least + before[NEEDED[state][1]] == owed:
                    done, spent, state = done + "I", spent + INSERT, NEEDED[state][1]
                    break
            elif cost + after[to] == owed:
                return done + name, spent + cost, to


def walk(codes: list[int], end: tuple[int, ...], state: int) -> tuple[list[str], int, int]:
    """Edits of each row, their cost and the last state; vectors are stored every square root of the rows, and computed again block by block."""
    step = isqrt(max(len(codes) - 1, 0)) + 1
    marks = {len(codes): end}
    vector = end
    for at in range(len(codes) - 1, -1, -1):
        vector = back(codes[at], vector)[1]
        if at % step == 0:
            marks[at] = vector
    done, spent = [], 0
    for start in range(0, len(codes), step):
        stop = min(start + step, len(codes))
        after = [marks[stop]]
        for at in range(stop - 1, start, -1):
            after.append(back(codes[at], after[-1])[1])
        for at in range(start, stop):
            name, cost, state = tight(codes[at], after[stop - 1 - at], state)
            done.append(name)
            spent += cost
    return done, spent, state


#: Relative cost vectors of no rows, one for each state at the end.
IDENTITY = tuple(tuple(0 if s == e else NEVER for s in range(4)) for e in range(4))


class Costs:
    """Cost matrix of a run of rows, grown at its front: ``column[e][s]`` is what it costs from state s before the run to state e after it."""

    def __init__(self, packed: bytes | None = None):
        if packed is None:
            self.least, self.columns = [0] * 4, list(IDENTITY)
        else:
            numbers = struct.unpack("<20q", packed)
            self.least, self.columns = list(numbers[:4]), [tuple(numbers[4 + 4 * e:8 + 4 * e]) for e in range(4)]

    def prepend(self, code: int) -> None:
        for e in range(4):
            if min(self.columns[e]) < NEVER:
                least, self.columns[e] = back(code, self.columns[e])
                self.least[e] += least

    def packed(self) -> bytes:
        return struct.pack("<20q", *self.least, *(c for column in self.columns for c in column))

    def before(self, after: tuple[int, ...]) -> tuple[int, ...]:
        """The relative vector before the run from that after it."""
        ways = [[self.least[e] + self.columns[e][s] + after[e] for e in range(4) if self.columns[e][s] < NEVER and after[e] < NEVER] for s in range(4)]
        costs = [min(w) if w else None for w in ways]
        least = min(c for c in costs if c is not None)
        return tuple(NEVER if c is None else c - least for c in costs)


class Talk:
    """A conversation walked forward, block by block."""

    def __init__(self):
        self.state, self.cost, self.audit, self.digest, self.empty = START, 0, [], hashlib.sha256(), True
        self.faults, self.illegal, self.last = [0] * 4, 0, None
        self.low = self.high = None
        self.turns = 0

    def feed(self, rows: list[tuple], end: tuple[int, ...], final: bool) -> list[dict]:
        """Rows (turn, role, text, code) in order and the vector after them -> repaired turns."""
        rows = [r for r in rows if r[3] != GONE]
        done, cost, state = walk([r[3] for r in rows], end, self.state)
        out, now = [], self.state
        for (turn, role, text, code), edit in zip(rows, done):
            initial = role[:1]
            if self.last is not None and self.last + initial not in LEGAL:
                self.illegal += 1
            self.last = initial
            self.faults[code % 4] += 1
            if turn is not None and turn != self.high:
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
            for name in edit[:-1]:
                needed, now = NEEDED[now]
                out.append({"role": needed, "text": ""})
            if edit[-1] == "K":
                out.append({"role": role, "text": text})
                now = SYSTEM if code // 4 == 0 else code // 4 + 1
            elif edit[-1] == "R":
                needed, now = NEEDED[now]
                out.append({"role": needed, "text": text})
        self.state, self.cost = state, self.cost + cost
        self.audit.append("".join(done))
        if final:
            for _ in TAIL[state]:
                needed, now = NEEDED[now]
                out.append({"role": needed, "text": ""})
                self.cost += INSERT
            self.audit.append(TAIL[state])
        for turn in out:
            self.digest.update(("" if self.empty else "\n").encode() + f"{turn['role']}:{turn['text']}".encode())
            self.empty = False
        return out

    def report(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return dict(gaps=gaps, blank=self.faults[BLANK], duplicate=self.faults[DUPLICATE], truncated=self.faults[CUT], illegal=self.illegal,
                    cost=self.cost, audit="".join(self.audit), repaired_sha256=self.digest.hexdigest())


def damage(conversations: DataFrame) -> DataFrame:
    """Faults for trials, by ``crc32("conv_id:turn") % 20``: 0 loses the row (its ``gone`` is true), 1 empties the text, 2 takes its ``.!?`` away, 3 repeats the
    row, 4 makes it a user's. A null is one space, in the digest and as role or text; conv_id and turn themselves stay null."""
    rows = narrow(conversations, "conv_id", "turn", "role", "text")
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))), F.lit(20))
    rows = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fault.alias("f"))
    f = F.col("f")
    text = F.when(f == 1, "").when(f == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(f == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (f == 0).alias("gone"),
                       F.explode(F.array_repeat(F.lit(0), F.when(f == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def coded(rows: DataFrame) -> DataFrame:
    """Rows with their code: kind of role and first fault (blank, said before with the same role, truncated)."""
    sentence = F.regexp_like("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    fault = F.when(~F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), BLANK).when(sentence, SOUND).otherwise(CUT)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = staged(rows.select("conv_id", "turn", "role", "text", "gone", F.when(F.col("gone"), GONE).otherwise(4 * kind + fault).cast("int").alias("code"),
                              F.when(~F.col("gone") & (fault != BLANK), said).alias("said"), F.monotonically_increasing_id().alias("row")), "turns")
    # a null turn comes before any other
    place = F.struct(F.col("turn").isNotNull().alias("dated"), F.coalesce("turn", F.lit(0)).alias("turn"), F.col("row"))
    first = (rows.filter("said IS NOT NULL").groupBy("conv_id", "said").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
             .select(F.col("conv_id").alias("c"), F.col("said").alias("s"), "first"))
    joined = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left")
    again = F.coalesce(place > F.col("first"), F.lit(False))
    return joined.select("conv_id", "turn", "role", "text", "row", "said", F.when(again, F.col("code") - F.col("code") % 4 + DUPLICATE).otherwise(F.col("code")).alias("code"))


def _schemas(conv_type, turn_type) -> tuple[StructType, StructType]:
    turn = StructType([StructField("role", StringType()), StructField("text", StringType())])
    piece = [StructField("conv_id", conv_type), StructField("piece", IntegerType()), StructField("repaired", ArrayType(turn)),
             *[StructField(c, LongType()) for c in REPORT], StructField("audit", StringType()), StructField("repaired_sha256", StringType())]
    row = StructType([StructField("turn", turn_type), StructField("role", StringType()), StructField("text", StringType()), StructField("code", IntegerType())])
    block = [StructField("part", IntegerType()), StructField("block", IntegerType()), StructField("rows", ArrayType(row)),
             StructField("own", BinaryType()), StructField("rest", BinaryType())]
    return StructType(piece), StructType(piece + block)


class _Out:
    """Result rows, given on in Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: dict, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 200
        if self.size > BLOCK_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
        self.rows, self.size = [], 0


def _first_walk(schema: pa.Schema, most: int):
    """Rows from the last to the first -> finished conversations, and blocks of those that are long or may go on in another partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), _Out(schema)
        held: list[tuple] = []
        size = block = 0
        rest = Costs()
        conv, edge = None, True

        def cut() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, block, rest
            own = Costs()
            for row in held:
                if row[3] != GONE:
                    own.prepend(row[3])
            rows = [dict(zip(("turn", "role", "text", "code"), r)) for r in reversed(held)]
            yield from out.add(dict(conv_id=conv, part=part, block=block, rows=rows, own=own.packed(), rest=rest.packed()), size)
            for row in held:
                if row[3] != GONE:
                    rest.prepend(row[3])
            held, size, block = [], 0, block + 1

        def close(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, block, rest
            if edge or last or block:
                if held:
                    yield from cut()
            else:
                talk = Talk()
                turns = talk.feed(held[::-1], END, True)
                yield from out.add(dict(conv_id=conv, piece=0, repaired=turns, **talk.report()), size)
            held, size, block, rest = [], 0, 0, Costs()

        begun = False
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for of, *row in zip(*(some.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "code"))):
                    if begun and of != conv:
                        yield from close(False)
                        edge = False
                    elif held and (len(held) >= most or size > BLOCK_BYTES):
                        yield from cut()
                    conv, begun = of, True
                    held.append(tuple(row))
                    size += len(row[2]) + len(row[1]) + 40
        if begun:
            yield from close(True)
        yield from out.flush()

    return run


def _checkpoints(segments: DataFrame) -> DataFrame:
    """The cost vector at the end of each conversation's part: one row a part, chained backwards (parts count up from the last rows to the first)."""
    kind = segments.schema["conv_id"]
    schema = StructType([StructField("conv_id", kind.dataType), StructField("part", IntegerType()), StructField("end", ArrayType(IntegerType()))])

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        ends, vector = [], END
        for own, rest in zip(rows["own"], rows["rest"]):
            ends.append(list(vector))
            vector = Costs(own).before(Costs(rest).before(vector))
        return pd.DataFrame({"conv_id": rows["conv_id"], "part": rows["part"], "end": ends})

    return segments.groupBy("conv_id").applyInPandas(chain, schema)


def _last_walk(schema: pa.Schema):
    """Blocks of conversations from the first to the last, each with the vector at the end of its part -> pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, talk = _Out(schema), None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["number"] == 1:
                    talk = Talk()
                final = row["number"] == row["blocks"]
                rows = [(r["turn"], r["role"], r["text"], r["code"]) for r in row["rows"]]
                turns = talk.feed(rows, Costs(row["rest"]).before(tuple(row["end"])), final)
                found = dict(conv_id=row["conv_id"], piece=row["number"] - 1, repaired=turns, **(talk.report() if final else {}))
                yield from out.add(found, sum(len(t["text"]) for t in turns))
        yield from out.flush()

    return run


def repair(conversations: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """The cheapest repair of every conversation, in pieces: conv_id, piece, repaired (array of role and text) and, in the last piece, the report.

    ``conversations``: conv_id, turn, role, text and optionally gone (boolean: the row is lost, only its conv_id counts). Rows are taken by turn, nulls first;
    rows of one turn by role, the first 64 characters of the text and its digest, equal rows one after the other. Each row's first fault counts: blank, duplicate (role
    and text occurred before), truncated. Keeping costs 0, a new role 1, a deletion 2 (blank and duplicate rows have to go), an inserted turn 5, and a truncated row
    that stays 5; ties go to the ASCII-least edits (D, I, K, R). The report has gaps (missing turn numbers), blank, duplicate, truncated, illegal (neighbours
    other than su, ua, au), cost, audit (initials of the edits) and repaired_sha256 (``role:text``, joined by line ends).

    A null role or text is one space; a role whose first character is not s, u or a (none in an empty role) cannot stay. Rows with a null conv_id are one conversation. One without
    rows but lost ones has zeros, an empty audit and the digest of the empty string. Further columns are left out; an empty table gives an empty result.
    """
    refuse(conversations)
    gone = F.coalesce(F.col("gone").cast("boolean"), F.lit(False)) if "gone" in conversations.columns else F.lit(False)
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = coded(conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role"), said("text"), gone.alias("gone")))
    order = [F.col("conv_id").desc_nulls_last(), F.col("turn").desc_nulls_last(), F.substring("role", 1, 16).desc(), F.substring("text", 1, 64).desc(),
             F.col("said").desc_nulls_last(), F.col("row").desc()]
    pieces, blocks = _schemas(rows.schema["conv_id"].dataType, LongType())
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "code")
    first = staged(sorted_rows.mapInArrow(_first_walk(to_arrow_schema(blocks), block), blocks), "conversations")
    whole = first.filter("block IS NULL").select(*pieces.names)
    long = first.filter("block IS NOT NULL").select("conv_id", "part", "block", "rows", "own", "rest")
    segments = long.groupBy("conv_id", "part").agg(F.max_by(F.struct("own", "rest"), "block").alias("s")).select("conv_id", "part", "s.*")
    ends = _checkpoints(segments).select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "end")
    forward = Window.partitionBy("conv_id").orderBy(F.desc("part"), F.desc("block"))
    numbers = (long.select("conv_id", "part", "block").withColumn("number", F.row_number().over(forward))
               .withColumn("blocks", F.count("*").over(Window.partitionBy("conv_id")))
               .select(F.col("conv_id").alias("c2"), F.col("part").alias("p2"), F.col("block").alias("b2"), "number", "blocks"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    joined = (long.drop("own").join(ends, same("conv_id", "c") & (F.col("part") == F.col("p")))
              .join(numbers, same("conv_id", "c2") & (F.col("part") == F.col("p2")) & (F.col("block") == F.col("b2")))
              .select("conv_id", "rows", "rest", "end", "number", "blocks"))
    walked = joined.repartition("conv_id").sortWithinPartitions("conv_id", "number").mapInArrow(_last_walk(to_arrow_schema(pieces)), pieces)
    return whole.unionByName(walked)


def reports(pieces: DataFrame) -> DataFrame:
    """One row a conversation: its report, from the last of its pieces."""
    return pieces.filter("repaired_sha256 IS NOT NULL").select("conv_id", *REPORT, "audit", "repaired_sha256")
