"""Repairs of conversations against an exhaustive search, cut into pieces of any size."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from consolida.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


def every_repair(rows, faults, budget, k=0, roles="", cost=0):
    """(edits, texts) of all repairs that cost no more than the budget, by trying every edit everywhere."""
    if cost > budget or not re.fullmatch("s?(ua)*u?", roles):
        return
    if k == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
        yield "", ()
    tries = [("I", r, "", 2, k) for r in ("user", "assistant")]
    if k < len(rows):
        _, _, role, text = rows[k]
        tries.append(("D", "", "", 3, k + 1))
        if faults[k] not in ("blank", "duplicate"):
            more = faults[k] == "truncated"
            tries += [("K", role, text, more, k + 1)] + [("R", r, text, 2 + more, k + 1) for r in ("user", "assistant")]
    for letter, role, text, price, at in tries:
        if letter == "D" or role[:1] in ("s", "u", "a"):
            for edits, texts in every_repair(rows, faults, budget, at, roles + role[:1], cost + price):
                yield letter + edits, texts if letter == "D" else ((role, text), *texts)


def plain(conv, rows):
    """Digest of a conversation's rows, given in order."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]+", "", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, (audit, texts) = next((b, min(found)) for b in itertools.count() if (found := list(every_repair(rows, faults, b))))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    text = "\n".join(f"{r}:{t}" for r, t in texts)
    return (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def digests(spark, rows, bits=C.PIECE_BITS, broken=True, parts=3):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts, "conv_id").withColumn("place", F.lit(1)).withColumn("pos", F.lit("x"))
    whole = C.whole(table)
    ordered = C.ordered(C.damaged(whole) if broken else whole, bits)
    return sorted((tuple(r) for r in C.digest(C.repair(ordered), table).collect()), key=str)


def some_rows(n, most, seed):
    rng = random.Random(seed)
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
    return [(c, t, role(), rng.choice(["Yes.", "no", "What?", "", " \t", None, "Go! \n", "x\x0b"])) for c in range(n) for t in rng.sample([None, *range(9)], rng.randint(1, most))]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))


@pytest.mark.parametrize("bits", [0, 1, 15])
def test_against_every_repair(spark, bits):
    rows = some_rows(70, 5, bits)
    by = {c: [r for r in rows if r[0] == c] for c in range(70)}
    want = [plain(c, damage(in_order(own))) for c, own in by.items()]
    assert digests(spark, rows, bits) == sorted(want, key=str)


def test_odd_conversations(spark):
    """A null id, one whose rows are all dropped, repeated rows, an unknown role, a role without letters."""
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hi."), (5, dropped, "user", "Hi."), (7, 6, "system", "A."), (7, 6, "system", "A."), (8, 1, "tool", "B."), (9, 1, None, None)]
    want = [plain(c, damage(in_order([r for r in rows if r[0] == c]))) for c in (None, 5, 7, 8, 9)]
    assert digests(spark, rows) == sorted(want, key=str)
    assert [r for r in want if r[0] == 5][0][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_a_long_conversation_is_cut_into_pieces(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", f"b{t}.", f"c{t}", ""])) for t in range(700)] + [(0, 0, "user", "x."), (2, 0, "user", "x.")]
    whole, pieces = digests(spark, rows, 15, parts=1), digests(spark, rows, 2, parts=1)
    assert whole == pieces
    row = next(r for r in whole if r[0] == 1)
    assert row[6] == sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in row[7]) + sum(1 for _ in range(row[4])) - deleted_truncated(spark, rows)


def deleted_truncated(spark, rows):
    table = spark.createDataFrame([r for r in rows if r[0] == 1], SCHEMA)
    return C.repair(C.ordered(C.damaged(C.whole(table)))).where("edit = 'D' and fault = 'truncated'").count()


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "user", "Q2?"), (1, 3, "assistant", "A.")]
    out = C.repair(C.ordered(C.whole(spark.createDataFrame(rows, SCHEMA)))).orderBy("pos", "nth").collect()
    assert [(r["edit"], r["role"], r["text"], r["fault"]) for r in out] == [("K", "system", "S.", None), ("K", "user", "Q?", None), ("I", "assistant", "", None), ("K", "user", "Q2?", None), ("K", "assistant", "A.", None)]


def test_no_rows(spark):
    assert digests(spark, []) == []
