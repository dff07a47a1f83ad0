"""Exact duplicates by a tree merge of sorted digest runs.

A *leaf* is a block of consecutive rows.  Its run holds one record per distinct
text, sorted by key: the SHA-256 of the text with A-Z lowered, a second hash of
another kind and the length in bytes; the row to keep; and the number of rows.

The runs are exchanged in binomial rounds.  There are ``2 ** bits`` slots; every
round settles some of the digits in which a run's slot and the digest range of
its records still differ, so after the last round a slot holds one range of the
digests and nothing else.  (A round of one digit is the binomial exchange
between two partners; folding up to ``DIGITS`` digits into a round lets a slot
merge that many partners' runs at once.)  At every level records with equal keys
become one, and the key is compared in full, so digests that agree while the
second hash or the length differ stay apart.  A slot never holds more than its
share of the distinct texts of its partners, however many copies there are.

The answers go back the same way: a slot looks up every run it got and sends to
its sender what became of the records that have copies elsewhere.  Texts never
travel, and no group is gathered anywhere.

Of equal texts the row with the largest doc_id stays; of rows with the same id
the first one of the table does.  A null id is below all others.  Null texts are
empty; blanks count.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.llm.common import forget, materialise, rows_of, text_bytes

#: Rows of a leaf, and records that a slot is meant to hold.
LEAF = 1 << 16
#: Digits settled in a round: two to this power runs are merged at once.
DIGITS = 4
#: Records of a run that travel as one row.
CHUNK = 1 << 15

KEY = 6
ID, KNOWN, ROW, COUNT = KEY, KEY + 1, KEY + 2, KEY + 3
WIDTH = KEY + 4
_RUNS = "to long, frm long, run binary"
_RUN_SCHEMA = pa.schema([("to", pa.int64()), ("frm", pa.int64()), ("run", pa.binary())])
_LEAF_SCHEMA = pa.schema([("leaf", pa.int64()), ("slot", pa.int64()), ("n", pa.int64()), ("run", pa.binary())])
_OUT = "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string"
_OUT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("kept", pa.bool_()), ("text_sha256", pa.string())])


def _records(blobs: list[bytes]) -> np.ndarray:
    """Records as a matrix of 64-bit words: the key, the id to keep, whether there is one, its row, rows in all."""
    return np.frombuffer(b"".join(blobs), dtype=np.uint64).reshape(-1, WIDTH)


def by_key(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): places of the records by their whole key, and the group number of each place in that order.

    The first word is sorted stably, which merges runs that are sorted already;
    only if it ties between different keys are the others looked at.
    """
    order = np.argsort(records[:, 0], kind="stable")
    keys = records[order, :KEY]
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        same_first = keys[1:, 0] == keys[:-1, 0]
        if (new[1:] & same_first).any():
            order = np.lexsort([records[:, c] for c in range(KEY - 1, -1, -1)])
            keys = records[order, :KEY]
            new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    return order, np.cumsum(new) - 1


def merged(records: np.ndarray) -> np.ndarray:
    """One record per key, sorted: the largest known id, its smallest row, the sum of the counts."""
    if not len(records):
        return records
    order, group = by_key(records)
    r = records[order]
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    if len(starts) == len(r):
        return r
    best = np.lexsort((r[:, ROW], ~r[:, ID].view(np.int64), ~r[:, KNOWN], group))
    out = r[best[starts]].copy()
    out[:, COUNT] = np.add.reduceat(r[:, COUNT], starts)
    return out


def found_in(records: np.ndarray, answers: np.ndarray) -> np.ndarray:
    """For each record the place of the answer with its key, or -1."""
    both = np.concatenate([answers, records])
    if not len(both):
        return np.empty(0, np.int64)
    order, group = by_key(both)
    at = np.full(group[-1] + 1, -1, np.int64)
    is_answer = order < len(answers)
    at[group[is_answer]] = order[is_answer]
    out = np.empty(len(both), np.int64)
    out[order] = at[group]
    return out[len(answers) :]


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the table as records in their order, a leaf at a time."""
    partition, chunk = TaskContext.get().partitionId(), 0
    rows: list[tuple] = []
    digests: list[bytes] = []

    def leaf() -> pa.RecordBatch:
        nonlocal chunk
        number = partition << 20 | chunk
        out = np.empty((len(rows), WIDTH), np.uint64)
        out[:, :4] = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 4)
        out[:, 4:] = np.array(rows, np.int64).view(np.uint64)
        out[:, ROW] = np.uint64(number << 16) + np.arange(len(rows), dtype=np.uint64)
        columns = [number], [partition + chunk], [len(rows)], [out.tobytes()]
        chunk += 1
        rows.clear()
        digests.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LEAF_SCHEMA, strict=True)], schema=_LEAF_SCHEMA)

    for body, doc_id in rows_of(batches, "body", "doc_id"):
        text = body.lower()
        digests.append(hashlib.sha256(text).digest())
        second = xxhash.xxh3_64_intdigest(text)
        rows.append((second - (1 << 63), len(text), doc_id if doc_id is not None else 0, doc_id is not None, 0, 1))
        if len(rows) == LEAF:
            yield leaf()
    if rows:
        yield leaf()


def _sent(records: np.ndarray, frm: int, slot: int, mask: int, bits: int) -> Iterator[tuple[int, int, bytes]]:
    """A sorted run cut by the digits under ``mask`` of its records' ranges, in rows of at most ``CHUNK`` records."""
    where = (records[:, 0] >> np.uint64(64 - bits) if bits else np.zeros(len(records), np.uint64)) & np.uint64(mask)
    for digit in np.unique(where):
        part = records[where == digit]
        for at in range(0, len(part), CHUNK):
            yield int(slot & ~mask | int(digit)), frm, part[at : at + CHUNK].tobytes()


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RUN_SCHEMA, strict=True)] if rows else [pa.array([], f.type) for f in _RUN_SCHEMA], schema=_RUN_SCHEMA)


def _received(table: pa.Table) -> dict[int, np.ndarray]:
    """Records by the sender of their run."""
    by: dict[int, list[bytes]] = {}
    for frm, run in zip(table.column("frm").to_pylist(), table.column("run").to_pylist(), strict=True):
        by.setdefault(frm, []).append(run)
    return {frm: _records(runs) for frm, runs in by.items()}


def _answer(received: dict[int, np.ndarray], final: np.ndarray, slot: int) -> pa.Table:
    """To each sender the final record of every key of its run that has copies."""
    rows = []
    for frm, records in received.items():
        at = found_in(records, final)
        answers = final[at[at >= 0]]
        rows += [(frm, slot, answers[i : i + CHUNK].tobytes()) for i in range(0, len(answers), CHUNK)]
    return _table(rows)


def _copies(final: np.ndarray) -> np.ndarray:
    return final[final[:, COUNT] > 1]


def rounds(bits: int, digits: int = DIGITS) -> list[int]:
    """The digits that each round settles, as masks."""
    number = max(1, -(-bits // digits))
    cuts = [bits * k // number for k in range(number + 1)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _exchange(mask: int, bits: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def step(key: tuple, table: pa.Table) -> pa.Table:
        slot = key[0].as_py()
        records = merged(np.concatenate(list(_received(table).values())))
        return _table(list(_sent(records, slot, slot, mask, bits)))

    return step


def _top(key: tuple, table: pa.Table) -> pa.Table:
    received = _received(table)
    return _answer(received, _copies(merged(np.concatenate(list(received.values())))), key[0].as_py())


def _down(key: tuple, runs: pa.Table, answers: pa.Table) -> pa.Table:
    final = merged(_records(answers.column("run").to_pylist()))
    return _answer(_received(runs), final, key[0].as_py())


def _rows(key: tuple, leaf: pa.Table, answers: pa.Table) -> pa.Table:
    records, final = _records(leaf.column("run").to_pylist()), _records(answers.column("run").to_pylist())
    at = found_in(records, final)
    is_copy = at >= 0
    kept_id, kept_row, known, size = (np.where(is_copy, final[at, c] if len(final) else 0, records[:, c]) for c in (ID, ROW, KNOWN, COUNT))
    ids = lambda v, there: pa.array(v.astype(np.uint64).view(np.int64), pa.int64(), mask=there == 0)
    hexes = records[:, :4].astype(">u8").tobytes().hex()
    return pa.table(
        [
            ids(records[:, ID], records[:, KNOWN]),
            ids(kept_id, known),
            pa.array(size.astype(np.int64)),
            pa.array(kept_row == records[:, ROW]),
            pa.array([hexes[i : i + 64] for i in range(0, len(hexes), 64)], pa.string()),
        ],
        schema=_OUT_SCHEMA,
    )


def duplicates(docs: DataFrame, leaf_records: int = LEAF, digits: int = DIGITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    leaves = materialise(text_bytes(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id").mapInArrow(_leaves, "leaf long, slot long, n long, run binary"), "leaves")
    size = leaves.agg(F.count("*").alias("leaves"), F.sum("n").alias("n")).first()
    bits = max(size["leaves"] - 1, -(-(size["n"] or 0) // leaf_records) - 1, 0).bit_length()
    masks = rounds(bits, digits)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf, slot, run in rows_of(batches, "leaf", "slot", "run"):
            rows = list(_sent(merged(_records([run])), leaf, slot % (1 << bits), masks[0], bits))
            yield from _table(rows).to_batches()

    levels = [materialise(leaves.mapInArrow(first, _RUNS), "runs")]
    for mask in masks[1:]:
        levels.append(materialise(levels[-1].groupBy("to").applyInArrow(_exchange(mask, bits), _RUNS), "runs"))
    answers = materialise(levels[-1].groupBy("to").applyInArrow(_top, _RUNS), "answers")
    forget(levels.pop())
    while levels:
        below = levels.pop()
        old, answers = answers, materialise(below.groupBy("to").cogroup(answers.groupBy("to")).applyInArrow(_down, _RUNS), "answers")
        forget(old, below)
    return leaves.groupBy("leaf").cogroup(answers.withColumnRenamed("to", "leaf").groupBy("leaf")).applyInArrow(_rows, _OUT)
