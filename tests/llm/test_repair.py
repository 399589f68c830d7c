import hashlib
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinspark.llm import repair as R

GRAMMAR = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, roles) of (initial, fault) rows by recursion over rows and what stands before; no states, no tables."""
    rows = tuple(rows)

    @lru_cache(None)
    def best(i, done, inserts):
        # done: "" nothing, "s", or the initial that stands last
        found = []
        if i == len(rows):
            if done in ("", "a"):
                found.append((0, ""))
        else:
            initial, fault = rows[i]
            found.append(join(2, "D", best(i + 1, done, 2)))
            if fault not in (1, 2):
                more = 5 * (fault == 3)
                for letter, cost, role in (("K", 0, initial), ("R", 1, "u"), ("R", 1, "a")):
                    if follows(done, role):
                        found.append(join(cost + more, letter, best(i + 1, role, 2)))
        if inserts:
            for role in "ua":
                if follows(done, role):
                    found.append(join(5, "I", best(i, role, inserts - 1)))
        return min((f for f in found if f is not None), default=None)

    def join(cost, letter, rest):
        return None if rest is None else (cost + rest[0], letter + rest[1])

    def follows(done, role):
        return (done + role) in ("s", "u", "su", "ua", "au")

    return best(0, "", 2)


def all_edits(rows):
    """As ``cheapest``, by trying every list of edits."""
    found = []
    gaps = ["", "u", "a", "ua", "au"]
    for inserts in product(gaps, repeat=len(rows) + 1):
        for edits in product(("D", "K", "Ru", "Ra"), repeat=len(rows)):
            cost, roles, audit = 5 * sum(map(len, inserts)), inserts[0], "I" * len(inserts[0])
            for (initial, fault), e, more in zip(rows, edits, inserts[1:]):
                if e != "D" and fault in (1, 2):
                    cost = None
                    break
                cost += {"D": 2, "K": 0}.get(e, 1) + 5 * (e != "D" and fault == 3)
                roles += {"D": "", "K": initial}.get(e, e[-1]) + more
                audit += e[0] + "I" * len(more)
            if cost is not None and GRAMMAR.fullmatch(roles):
                found.append((cost, audit))
    return min(found)


ROWS = st.lists(st.tuples(st.sampled_from("suao"), st.sampled_from([0, 0, 0, 1, 2, 3])), max_size=40)


def symbols(rows):
    return bytes(1 if f in (1, 2) else 2 + 2 * "suao".index(i) + (f == 3) for i, f in rows)


def by_tables(rows):
    t = R.tables()
    _, vector, cost = t.passed(t.blocks(symbols(rows)), 0)
    letters, state = t.edits(symbols(rows), 0, 0)
    return cost + t.vectors[vector][0], "".join(letters) + R.ending(state)


@given(ROWS)
@settings(max_examples=400, deadline=None)
def test_blocks_against_recursion(rows):
    assert by_tables(rows) == cheapest(rows)


@given(st.lists(st.tuples(st.sampled_from("suao"), st.sampled_from([0, 0, 1, 3])), max_size=3))
@settings(max_examples=40, deadline=None)
def test_recursion_against_all_edits(rows):
    assert cheapest(rows) == all_edits(rows)


@given(ROWS, st.integers(1, 9))
@settings(max_examples=100, deadline=None)
def test_segments_as_a_whole(rows, size):
    """Vectors handed from the last segment to the first, then states from the first to the last."""
    t, parts = R.tables(), [symbols(rows)[i:i + size] for i in range(0, len(rows), size)]
    vector, cost, behind = 0, 0, []
    for p in reversed(parts):
        behind.insert(0, vector)
        to, grown = t.of_all(t.blocks(p))
        cost, vector = cost + int(grown[vector]), int(to[vector])
    state, audit = 0, ""
    for p, v in zip(parts, behind):
        letters, state = t.edits(p, v, state)
        audit += "".join(letters)
    assert (cost + t.vectors[vector][0], audit + R.ending(state)) == cheapest(rows)


def test_tables_are_small():
    assert len(R.tables().vectors) < 200


def want(turns):
    """turns: (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in turns:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, rows, counts = set(), [], [0, 0, 0, 0]
        for _, role, text in own:
            bare = [c for c in text if WORD.match(c)]
            fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            counts[fault] += 1
            rows.append((role[:1] if role[:1] in tuple("sua") else "o", fault))
        cost, audit = cheapest(rows)
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        said, at, last = [], 0, ""
        for e in audit:
            if e != "I":
                _, role, text = own[at]
                at += 1
            turn = "u" if last in ("", "s", "a") else "a"
            if e == "K":
                said.append(f"{role}:{text}")
                last = role[:1]
            elif e in "IR":
                said.append(f"{R.ROLE[turn]}:{'' if e == 'I' else text}")
                last = turn
        out.append((conv, gaps, *counts[1:], illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=str)


def got(turns, monkeypatch=None):
    return sorted((tuple(r) for r in R.repair(R.damaged(turns)).collect()), key=str)


def test_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    found = got(turns.repartition(3))
    assert found == want(rows)
    assert sum(r[6] > 0 for r in found) > 5 and {c for r in found for c in r[7]} == set("DKR")


TEXTS = ["ok.", "ok", "", " \t", "why?  ", "yes!", "é ", "..\x0b", None]


@pytest.mark.parametrize("segment", [3, 4096])
def test_odd_conversations(spark, monkeypatch, segment):
    """Long conversations over many segments, nulls in any column, repeated rows, unknown roles, clashing columns."""
    monkeypatch.setattr(R, "SEGMENT", segment)
    rows = [(c, t if t % 11 else None, ["system", "user", "assistant", "tool", None, "", "Assistant"][(c * 7 + t * t) % 7] if t % 3 == 0
             else ["user", "assistant"][t % 2], TEXTS[(t * c + t // 5) % 9] if t % 4 == 0 else f"{c} says {t}.")
            for c in range(1, 12) for t in range(c * 3)]
    rows += [(None, i, "user", "x.") for i in range(5)] + [(50, None, "user", "a.")] * 2 + [(51, None, None, None)]
    rows += [(52, 5, "user", "hi."), (52, 5, "user", "hi."), (52, 6, "assistant", "yo."), (53, -3, "system", "s."), (53, 10**12, "user", "z?")]
    rows += [(c, 1, "user", "q?") for c in range(60, 100)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    turns = turns.withColumns({c: F.lit(c) for c in ("pos", "th", "dropped", "segment", "symbol", "kind", "cost", "copy", "first")})
    found = got(turns)
    assert found == want(rows)
    gone = [r for r in found if r[7] == "" and r[6] == 0]
    assert gone and all(r[8] == hashlib.sha256(b"").hexdigest() and not any(r[1:7]) for r in gone)
    assert got(turns.where("false")) == []


def test_hot_conversation(spark, monkeypatch):
    """One conversation with nearly all rows, many of them copies."""
    monkeypatch.setattr(R, "SEGMENT", 64)
    rows = [(1, t // 3, ["user", "assistant", "tool"][t % 3], "again." if t % 5 == 0 else f"{t}." if t % 7 else "cut") for t in range(900)]
    rows += [(c, 0, "user", "one?") for c in range(2, 30)]
    assert got(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)) == want(rows)
