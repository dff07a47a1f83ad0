"""Best-fit packing of token sequences by minimum bin slack.

Documents become byte-level BPE ids followed by a separator, and are cut into
pieces no longer than a sequence.  The plan works on the histogram of piece
lengths, which has at most ``capacity`` rows at any corpus size: for the
longest remaining length, subset-sum dynamic programming on a bit set finds the
fullest combination that fits beside it, and that combination is used as often
as the remaining counts allow.  Pieces then find their places by their rank
among pieces of equal length, counted in blocks, so no length is ever gathered
in one task.

Nulls: a null text is empty and gives one piece, the separator; a null id is
carried along.  Repeated rows are separate documents.  An empty table gives no
pieces.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.llm.common import materialise, rows_of

CAPACITY = 2048
SEPARATOR = 0
#: Pre-tokenising pattern of the byte-level BPE vocabulary (fixed by its public definition).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
PIECES = "doc_id long, place long, piece int, start long, length long, ids_crc32 long, block long, nth long"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("place", pa.int64()), ("piece", pa.int32())]
    + [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "block", "nth")]
)


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    printable = [b for lo, hi in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(lo, hi + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenIds:
    """Little-endian 32-bit ids of a text under a byte-level BPE vocabulary file.

    A second public implementation of the same algorithm runs on the file's own
    vocabulary, several times as fast as the file's usual reader; texts that
    hold a special token's string go through that reader.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        to_byte = _byte_of_char()
        added = {t["content"]: t["id"] for t in model.get("added_tokens", ())}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in added}
        self.special = tuple(added)
        self.full = Tokenizer.from_file(path)
        self.encode = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def of(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.full.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encode(text)
        return np.array(ids, dtype="<u4").tobytes()


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    ids_of, block, place = TokenIds(path), TaskContext.get().partitionId(), 0
    nth = [0] * (capacity + 1)
    end = np.array([SEPARATOR], dtype="<u4").tobytes()
    for batch in batches:
        out: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = ids_of.of(text) + end
            total = len(ids) // 4
            first = total % capacity or capacity
            at = 0
            for piece in range(-(-total // capacity)):
                length = first if piece == 0 else capacity
                crc = zlib.crc32(memoryview(ids)[4 * at : 4 * (at + length)])
                out.append((doc_id, place, piece, at, length, crc, block, nth[length]))
                nth[length] += 1
                at += length
            place += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _ARROW, strict=True)], schema=_ARROW)


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents, stored; ``nth`` counts pieces of a length within a block."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return materialise(rows.mapInArrow(lambda it: _pieces(it, tokenizer, capacity), PIECES), "pieces")


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths of the fullest combination that fits in ``room``, by a bit set of reachable sums."""
    reach, goal, steps = 1, 1 << room, []
    within = (goal << 1) - 1
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        for _ in range(min(counts[length], room // length)):
            new = (reach << length) & within & ~reach
            if not new:
                break
            steps.append((length, new))
            reach |= new
            if reach & goal:
                break
        if reach & goal:
            break
    at, taken = reach.bit_length() - 1, []
    for length, new in reversed(steps):  # a sum was first reached in exactly one step, from a sum reached before it
        if at and new >> at & 1:
            taken.append(length)
            at -= length
    return taken


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many such sequences): minimum bin slack over the whole histogram."""
    left = {k: n for k, n in histogram.items() if n > 0}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = fullest({k: n for k, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        bin_ = [longest, *rest]
        need = {k: bin_.count(k) for k in set(bin_)}
        times = min(left[k] // n for k, n in need.items())
        out.append((bin_, times))
        for k, n in need.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def _slots(bins: list[tuple[list[int], int]], capacity: int) -> dict[str, np.ndarray]:
    """Runs of ranks of each length: from which rank on, pieces per sequence, first sequence, offset."""
    rank = [0] * (capacity + 1)
    runs, base = [], 0
    for lengths, times in bins:
        at = 0
        for length in sorted(set(lengths), reverse=True):
            per = lengths.count(length)
            runs.append((length, rank[length], per, base, at))
            rank[length] += per * times
            at += per * length
        base += times
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "per", "base", "at"), table.T, strict=True))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence and offset."""
    spark = docs.sparkSession
    pieces = cut(docs, tokenizer, capacity)
    per_block = pieces.groupBy("length", "block").agg((F.max("nth") + 1).alias("n"))
    per_block = materialise(per_block, "lengths")
    histogram = {r["length"]: r["n"] for r in per_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    slots = spark.sparkContext.broadcast(_slots(plan(histogram, capacity), capacity))
    before = F.expr("sum(n) OVER (PARTITION BY length ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = per_block.select(F.col("block").alias("b"), F.col("length").alias("l"), F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, (F.col("block") == F.col("b")) & (F.col("length") == F.col("l"))).withColumn("rank", F.col("before") + F.col("nth"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        key = s["length"] << 44 | s["rank"]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "rank"))
            run = np.searchsorted(key, length << 44 | rank, "right") - 1
            nth = rank - s["rank"][run]
            sequence = s["base"][run] + nth // s["per"][run]
            offset = s["at"][run] + nth % s["per"][run] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(6)), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "place", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    out = ranked.select("doc_id", "place", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, place long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return out.drop("place")
