"""Conversation structure repair by Four-Russians block tables.

A conversation should read ``(s?(ua)+)?``: an optional system turn, then user and assistant in
turn. Its rows are kept, given another role, or deleted, and empty turns may be
inserted; the cheapest edits win, among equal ones those whose letters (D, I, K, R)
come first in ASCII order.

A row is one of a few symbols: its role's initial and its worst fault. Where a
conversation stands in the grammar is one of four states, so the least cost of repairing all rows
from a place on is a vector of four numbers. Less its minimum, such a vector is one
of a small set, whatever the conversation's length. The tables give, for each of these vectors
and each block of ``BLOCK`` symbols, the vector before the block and
what its minimum grew by. They are computed once per Python worker; conversations are
then processed block by block, last block first, one lookup each. To read the
edits, a block is expanded backward from the vector behind it, and its letters
are chosen from its start: the least letter that keeps the cost the least. So ties are
settled by the first letter that differs, not by how a search happens to go.

No task holds a conversation: rows are numbered over the whole table in their
order (a range partitioning), and ``SEGMENT`` rows of the numbering are a segment. What a segment does to
any vector behind it, and then to any state before it, is a small table; a conversation of many segments is
settled over these, and each segment's edits are read by itself. The digests of a conversation
are sequential: its rows stream once through one task, in order, as its edits come along.

Faults (the first counts): blank, duplicate (of an earlier row's role and text in the conversation), truncated (the last
character that is not white space is none of ``.!?``). Blank and duplicate rows must be deleted.

Defined results: a null role or text is one space. Rows of equal turn are ordered by role
and text (its first 64 characters, then its hash), null turns first. Roles count by their initial alone. A null conv_id is a conversation of its own.
Rows repeated are turns repeated. A conversation all of whose rows were dropped has zeros, no edits and the digest of nothing.
Extra columns are ignored. An empty table gives no rows.
"""
from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, ranked, stage

BLOCK = 4
SEGMENT = 4096
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: states: nothing yet, after the system turn, after a user turn, after an assistant turn
STATES = range(4)
WANT = "uuau"
NEXT = (2, 2, 3, 2)
LAST = (0, 3)
#: a row's symbol is its place here: padding, a row that must go, then initial and whether truncated
SYMBOLS = ("-", "x", *(i + t for i in "suao" for t in (" ", "t")))
FAULTS = ("", "blank", "duplicate", "truncated")
FAR = 1 << 40
ROLE = {"u": "user", "a": "assistant"}
REPAIRED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
            "repaired_sha256 string")


# ------------------------------------------------------------------ cost vectors --

def inserted(cost: list[int]) -> list[int]:
    """Least costs where turns may be inserted first."""
    for _ in STATES:
        cost = [min(c, INSERT + cost[NEXT[p]]) for p, c in enumerate(cost)]
    return cost


def row_edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits that a row allows."""
    if symbol == "x":
        return [("D", DELETE, state)]
    role, more = symbol[0], TRUNCATED * (symbol[1] == "t")
    edits = [("D", DELETE, state), ("R", REROLE + more, NEXT[state])]
    if role == "s" and state == 0:
        edits.append(("K", more, 1))
    elif role == WANT[state]:
        edits.append(("K", more, NEXT[state]))
    return edits


def before(symbol: str, behind: list[int]) -> list[int]:
    """The vector before a row, from the one behind it."""
    if symbol == "-":
        return list(behind)
    return inserted([min(c + behind[q] for _, c, q in row_edits(symbol, p)) for p in STATES])


END = inserted([0 if p in LAST else FAR for p in STATES])


class Tables:
    """Transitions of normalised vectors over one symbol and over a block."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = [tuple(END)]
        number, step, grown = {self.vectors[0]: 0}, [], []
        for v in self.vectors:  # grows until closed
            step.append([])
            grown.append([])
            for s in SYMBOLS:
                to = before(s, list(v))
                least = min(to)
                to = tuple(c - least for c in to)
                if to not in number:
                    number[to] = len(self.vectors)
                    self.vectors.append(to)
                step[-1].append(number[to])
                grown[-1].append(least)
        one, cost = np.array(step), np.array(grown)
        self.to, self.cost = one, cost
        for _ in range(BLOCK - 1):  # the first symbol of a block is its highest digit, and applied last
            self.to, self.cost = (np.stack([one[self.to, s] for s in range(len(SYMBOLS))], 1).reshape(len(one), -1),
                                  np.stack([self.cost + cost[self.to, s] for s in range(len(SYMBOLS))], 1).reshape(len(one), -1))
        self.to, self.cost = self.to.astype(np.int16), self.cost.astype(np.int32)
        self.traced: dict[tuple[int, int, int], tuple[tuple[str, ...], int]] = {}

    def blocks(self, symbols: bytes) -> np.ndarray:
        """Codes of the blocks, padded at the end."""
        digits = np.zeros(-(-len(symbols) // BLOCK) * BLOCK, np.int64)
        digits[:len(symbols)] = np.frombuffer(symbols, np.uint8)
        return digits.reshape(-1, BLOCK) @ (len(SYMBOLS) ** np.arange(BLOCK - 1, -1, -1))

    def passed(self, codes: np.ndarray, vector: int) -> tuple[list[int], int, int]:
        """(the vector behind each block, the vector before the first, what the minimum grew by)."""
        behind, total = [0] * len(codes), 0
        for i in range(len(codes) - 1, -1, -1):
            behind[i] = vector
            total += int(self.cost[vector, codes[i]])
            vector = int(self.to[vector, codes[i]])
        return behind, vector, total

    def of_all(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector behind the blocks: the vector before them, and what the minimum grew by."""
        now, total = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for code in codes[::-1]:
            total += self.cost[now, code]
            now = self.to[now, code].astype(np.int64)
        return now, total

    def expand(self, code: int, vector: int, state: int) -> tuple[tuple[str, ...], int]:
        """Each row's letters (the inserts before it, its own) and the state behind the block."""
        key = (code, vector, state)
        if key not in self.traced:
            symbols = [SYMBOLS[code // len(SYMBOLS) ** i % len(SYMBOLS)] for i in range(BLOCK - 1, -1, -1)]
            costs = [list(self.vectors[vector])]
            for s in reversed(symbols):  # backward from the end of the block
                costs.insert(0, before(s, costs[0]))
            letters = []
            for i, s in enumerate(symbols):
                mine = ""
                while s != "-":
                    choice = [(x, q, i + 1) for x, c, q in row_edits(s, state) if c + costs[i + 1][q] == costs[i][state]]
                    if INSERT + costs[i][NEXT[state]] == costs[i][state]:
                        choice.append(("I", NEXT[state], i))
                    letter, state, at = min(choice)
                    mine += letter
                    if at > i:
                        break
                letters.append(mine)
            self.traced[key] = tuple(letters), state
        return self.traced[key]

    def edits(self, symbols: bytes, vector: int, state: int) -> tuple[list[str], int]:
        """Letters of each row of a segment from ``state``, ``vector`` being behind it, and the state after it."""
        codes = self.blocks(symbols)
        behind, _, _ = self.passed(codes, vector)
        out: list[str] = []
        for code, v in zip(codes.tolist(), behind):
            letters, state = self.expand(code, v, state)
            out += letters
        return out[:len(symbols)], state


@lru_cache
def tables() -> Tables:
    return Tables()


def ending(state: int) -> str:
    """Inserts that complete a conversation left in ``state``."""
    out = ""
    while state not in LAST:
        out, state = out + "I", NEXT[state]
    return out


# ------------------------------------------------------------------------- rows --

def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: the rows after damage, and those it drops, marked."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    kind = F.col("kind")
    text = (F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    return (rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                        (kind == 0).alias("dropped"),
                        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
                .drop("copy"))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with their number ``pos`` by conversation, turn, role and text, over the whole table."""
    # rows that are equal are dealt by _salt, so that no range is bound to one task
    keyed = rows.withColumns({"_head": F.left("text", F.lit(64)), "_hash": F.xxhash64("text"), "_salt": F.monotonically_increasing_id()})
    return ranked(keyed, ["conv_id", "turn", "role", "_head", "_hash", "_salt"], "op13-rows", "pos").drop("_head", "_hash", "_salt")


def faulty(rows: DataFrame) -> DataFrame:
    """``ordered`` rows' pos, conv_id, segment, symbol and fault (places in SYMBOLS and FAULTS)."""
    bare = F.rtrim(F.col("text"), F.lit(WHITESPACE))
    plain = rows.select("pos", "conv_id", F.substring("role", 1, 1).alias("initial"), "role", F.sha2("text", 256).alias("digest"),
                        (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    firsts = plain.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = (F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0))
    at = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    return (plain.join(firsts, "pos", "left").withColumn("fault", fault)
                 .select("pos", "conv_id", F.expr(f"pos div {SEGMENT}").alias("segment"), "fault",
                         F.when(F.col("fault").isin(1, 2), 1).otherwise(2 + 2 * at + (F.col("fault") == 3).cast("int")).alias("symbol")))


def segments(rows: DataFrame) -> DataFrame:
    """One row per conversation and segment: its first pos, symbols and faults as bytes, and whether the conversation has others."""
    byte = lambda c: F.unhex(F.array_join(F.transform("_all", lambda x: F.lpad(F.hex(x[c]), 2, "0")), ""))
    own = (rows.groupBy("conv_id", "segment").agg(F.sort_array(F.collect_list(F.struct("pos", "symbol", "fault"))).alias("_all"))
               .select("conv_id", "segment", F.col("_all")[0]["pos"].alias("pos"), byte("symbol").alias("symbols"), byte("fault").alias("faults")))
    many = rows.groupBy("conv_id").agg(F.min("segment").alias("_a"), F.max("segment").alias("_z")).where("_a < _z")
    many = many.select(F.col("conv_id").alias("_c"), F.lit(True).alias("_many"))
    return (own.join(many, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
               .withColumn("many", F.coalesce("_many", F.lit(False))).drop("_c", "_many"))


EDITS = "conv_id long, pos long, edits string, faults binary, cost long"


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    columns = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(columns)],
                                      [n for n, _ in columns])


def per_row(df: DataFrame, columns: list[str], fn, schema: str) -> DataFrame:
    """``fn`` of each row's columns is a row of ``schema``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch_of([fn(*row) for row in zip(*(c.to_pylist() for c in b.columns))], schema)

    return df.select(*columns).mapInArrow(run, schema)


def edits_of(found: DataFrame) -> DataFrame:
    """Each segment's letters, rows parted by commas; the first of a conversation has its cost."""
    def alone(conv_id, pos, symbols, faults):
        t = tables()
        codes = t.blocks(symbols)
        _, vector, cost = t.passed(codes, 0)
        letters, state = t.edits(symbols, 0, 0)
        return conv_id, pos, ",".join(letters) + ending(state), faults, cost + t.vectors[vector][0]

    short = per_row(found.where(~F.col("many")), ["conv_id", "pos", "symbols", "faults"], alone, EDITS)
    long = found.where("many")

    def summary(conv_id, pos, symbols):
        to, cost = tables().of_all(tables().blocks(symbols))
        return conv_id, pos, to.astype("<i2").tobytes(), cost.astype("<i8").tobytes()

    def vectors(own: pa.Table) -> pa.Table:
        """From the last segment to the first: the vector behind each, and the cost of all."""
        own = own.sort_by("pos")
        vector, cost, out = 0, 0, []
        for i in range(own.num_rows - 1, -1, -1):
            out.append([own["conv_id"][i].as_py(), own["pos"][i].as_py(), vector, None])
            cost += int(np.frombuffer(own["cost"][i].as_py(), "<i8")[vector])
            vector = int(np.frombuffer(own["to"][i].as_py(), "<i2")[vector])
        out[-1][3] = cost + tables().vectors[vector][0]
        return pa.Table.from_batches([batch_of(out, behind_schema)])

    def moves(conv_id, pos, vector, symbols):
        return conv_id, pos, bytes(tables().edits(symbols, vector, p)[1] for p in STATES)

    def states(own: pa.Table) -> pa.Table:
        """From the first segment to the last: the state before each."""
        own = own.sort_by("pos")
        state, out = 0, []
        for i in range(own.num_rows):
            out.append((own["conv_id"][i].as_py(), own["pos"][i].as_py(), state, int(i == own.num_rows - 1)))
            state = own["moves"][i].as_py()[state]
        return pa.Table.from_batches([batch_of(out, state_schema)])

    def traced(conv_id, pos, vector, cost, state, last, symbols, faults):
        letters, state = tables().edits(symbols, vector, state)
        return conv_id, pos, ",".join(letters) + (ending(state) if last else ""), faults, cost

    # of a conversation there are as many rows here as segments, each a few hundred bytes
    behind_schema, state_schema = "conv_id long, pos long, vector int, cost long", "conv_id long, pos long, state int, last int"
    to = per_row(long, ["conv_id", "pos", "symbols"], summary, "conv_id long, pos long, to binary, cost binary")
    behind = stage(to.groupBy("conv_id").applyInArrow(vectors, behind_schema), "op13-vectors").drop("conv_id")
    both = long.join(behind, "pos")
    moved = per_row(both, ["conv_id", "pos", "vector", "symbols"], moves, "conv_id long, pos long, moves binary")
    start = moved.groupBy("conv_id").applyInArrow(states, state_schema).drop("conv_id")
    return short.unionByName(per_row(both.join(start, "pos"), ["conv_id", "pos", "vector", "cost", "state", "last", "symbols", "faults"],
                                     traced, EDITS))


class Repair:
    """Counts, edits and the digest of one conversation, whose rows come in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.cost, self.audit, self.digest, self.any = conv_id, 0, [], hashlib.sha256(), False
        self.turns, self.first, self.turn, self.counts, self.illegal = 0, None, None, [0] * len(FAULTS), 0
        self.initial, self.state = None, 0

    def say(self, role: str, text: str) -> None:
        self.digest.update(("\n" * self.any + f"{role}:{text}").encode())
        self.any = True

    def add(self, turn: int | None, role: str, text: str, fault: int, letters: str) -> None:
        if turn is not None and turn != self.turn:
            self.turns, self.turn = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        self.audit.append(letters)
        for x in letters:
            if x == "K" and self.state == 0 and role[:1] == "s":
                self.say(role, text)
                self.state = 1
            elif x != "D":
                own = role if x == "K" else ROLE[WANT[self.state]]
                self.say(own, "" if x == "I" else text)
                self.state = NEXT[self.state]

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.counts[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def repair(rows: DataFrame) -> DataFrame:
    """Counts, cheapest edits and repaired text of each conversation of ``rows`` (conv_id, turn, role, text, dropped)."""
    gone = rows.where("dropped").select("conv_id").distinct()
    kept = ordered(rows.where(~F.col("dropped")).drop("dropped"))
    found = stage(segments(faulty(kept)), "op13-segments")
    edits = stage(edits_of(found), "op13-edits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, letters, faults, at, done = None, [], b"", 0, []
        for b in batches:
            for conv, kind, turn, role, text, own, own_faults, cost in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        done.append(now.row())
                    if len(done) >= 4096:
                        yield batch_of(done, REPAIRED)
                        done = []
                    now = Repair(conv)
                if kind == 1:
                    letters, faults, at = own.split(","), own_faults, 0
                    now.cost += cost or 0
                elif kind == 2:
                    now.add(turn, role, text, faults[at], letters[at])
                    at += 1
        if now is not None:
            done.append(now.row())
        if done:
            yield batch_of(done, REPAIRED)

    # a segment's edits come right before its rows; a conversation without rows comes as its id alone
    empty = {"pos": "long", "turn": "long", "role": "string", "text": "string", "edits": "string", "faults": "binary", "cost": "long"}

    def like(df: DataFrame, kind: int) -> DataFrame:
        return df.select("conv_id", F.lit(kind).alias("kind"),
                         *[(F.col(c) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in empty.items()])

    both = like(gone, 0).unionByName(like(edits, 1)).unionByName(like(kept, 2))
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")
                .select("conv_id", "kind", "turn", "role", "text", "edits", "faults", "cost").mapInArrow(run, REPAIRED))
