"""Language-model scores from a probabilistic suffix tree over words.

A context is the run of words before a token.  Its candidates grow by one word
a level: a context of d words is weighed where its suffix of d - 1 words is
retained, and it is retained when a divergence test says that it predicts: the
leave-one-out log-likelihood of its next words under its own smoothed
distribution has to exceed that under its suffix's distribution by ``gain``,
by default twice the logarithm of the number of training tokens.  Levels end
when none of their contexts is retained; neither the depth nor the number of
contexts has a bound.  ``LEAST`` = 2 leaves nothing out: a context that occurs
once has a gain of zero.  Distributions are smoothed towards the suffix's with
``MASS`` pseudo-counts, the root with 0.1 a word.  Every token is scored in the
longest retained context that stands before it.

Documents are cut into blocks that are coded once.  Each level exchanges two
lists as sorted, differenced key blocks: first the occurrences of context and
next word, then gains and sizes of contexts.  A range of keys sums what all
blocks hold and answers every block with its totals, so a frequent context is
spread over all ranges in the first list and comes once a block in the second.
Contexts stay in the answers; none is collected.  No context is weighed that
occurs too seldom for any next words to reach ``gain``: behind a retained suffix
they have a share of its occurrences at least, so the fewer these are the more
it takes.  Blocks and answers lie in tables bucketed by block: keys are
shuffled once, and so are answers.  Words are known by
64-bit hashes, contexts by as many bits as keep a chance agreement of any two
keys below one in 2 ** ``SPARE_BITS``.

Null texts are empty and consist of the end token; a null doc_id is held out;
repeated rows are separate documents.  Without training tokens every token has
the same probability, one.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from consolida.llm.common import U64, added, bucketed, forget, grouped, mixed, rows_of, shuffle_partitions, sweep, text_bytes

FOLDS = 10
ADDED = 0.1
LEAST = 2
MASS = 50.0
BLOCK_BYTES = 8_000_000
BLOCK_ROWS = 50_000
PART_BYTES = 32_000_000
LEAST_PARTS = 64
SPARE_BITS = 24
#: Whole texts that go to a worker at once.
SLICE = 256
#: Places hashed at once.
CHUNK = 1 << 17
#: Hash of the end token.
END = U64(0x9E6C63D0876A9A47)
_PACK = zstandard.ZstdCompressor(level=1)
_OPEN = zstandard.ZstdDecompressor()


def lean(out: pa.Table) -> pa.Table:
    """Passes a result on and gives the memory its making took back to the system; a worker would keep it while others need it."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()
    return out


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most ``rows`` rows for Python, as those of the default size hold tens of MB of whole texts, twice over, in every task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def packed(a: np.ndarray) -> bytes:
    return _PACK.compress(np.ascontiguousarray(a).reshape(-1).view(np.uint8))


def opened(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(_OPEN.decompress(raw), kind)


def planes(a: np.ndarray) -> np.ndarray:
    """The bytes of a whole array by place; the upper ones of small numbers compress away."""
    return a.view(np.uint8).reshape(-1, a.itemsize).T


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as byte planes of their differences."""
    return packed(planes(np.diff(keys, prepend=U64(0)).astype("<u8")))


def opened_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(opened(raw, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel(), dtype=U64)


def opened_planes(raw: bytes) -> np.ndarray:
    return opened(raw, np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel()


def fold(doc_id: Column) -> Column:
    """Remainder of crc32(doc_id as text) by the number of folds; null: 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0))


def crc_fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % FOLDS


@dataclass
class Root:
    """Training tokens and distinct words."""

    tokens: int
    words: int

    def of(self, count: np.ndarray) -> np.ndarray:
        return (count + ADDED) / (self.tokens + ADDED * (self.words + 1))

    def count(self, probability: np.ndarray) -> np.ndarray:
        return np.rint(probability * (self.tokens + ADDED * (self.words + 1)) - ADDED).astype(np.int64)


# Blocks --------------------------------------------------------------------------------------

#: ``words``: hashes of the distinct words; ``counts``: theirs in training documents;
#: ``lengths``: tokens of each document, zero once it has no place left; ``tokens``: of all its tokens;
#: ``seen``: of each token the occurrences, up to 255, of the longest run of words ending there that was counted, or the most that one left out can have;
#: ``places``: tokens with a context to be weighed at this level; ``prior``, ``which``: their probabilities in the suffix,
#: by word (and no ``which``) where that is the root.
_STATE = "block long, ids binary, flags binary, lengths binary, codes binary, words binary, counts binary, tokens binary, known binary, base binary, score binary, seen binary, places binary, prior binary, which binary"
_COLUMNS = [c.split()[0] for c in _STATE.split(", ")]


def _state(row: dict) -> pa.Table:
    return pa.table({name: pa.array([row.get(name)], pa.int64() if name == "block" else pa.binary()) for name in _COLUMNS})


#: A word of its own that no text holds, as UTF-8 has no 0xff; it stands for the end token while a block is split.
_STOP = b"\x00\xff\x00"
_BLANKS = bytes([0x20, *range(0x09, 0x0E)])
_PLAIN = bytes(0x20 if b in _BLANKS else b for b in bytes(range(256)).lower())


def _words(text: bytes) -> pa.Array:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z in lower case: its other bytes in one buffer, and where each word begins."""
    inside = np.frombuffer(b"".join((b" ", text, b" ")).translate(_PLAIN), np.uint8) != 0x20
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins = np.append(0, np.cumsum(edges[1::2] - edges[::2]))
    return pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(text.translate(_PLAIN, _BLANKS))])


class _Block:
    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.held: list[bool] = []
        self.bodies: list[bytes] = []
        self.size = 0

    def add(self, doc_id: int | None, held: bool, body: bytes) -> None:
        self.ids.append(doc_id)
        self.held.append(held)
        self.bodies.append(body)
        self.size += len(body)

    def rows(self, block: int) -> pa.Table:
        text = b" ".join(x for body in self.bodies for x in (body, _STOP))
        self.bodies.clear()
        coded = _words(text).dictionary_encode()
        del text
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
        hashes[words.index(_STOP)] = END
        keys, _, number = grouped(hashes)
        codes = number[coded.indices.to_numpy()]
        order = np.argsort(-np.bincount(codes), kind="stable")  # frequent words get small numbers
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        keys, codes = keys[order], rank[codes]
        lengths = np.diff(np.flatnonzero(codes == int(np.flatnonzero(keys == END)[0])), prepend=-1)
        learned = np.repeat(~np.array(self.held), lengths)
        row = {
            "block": block,
            "ids": packed(np.array([i or 0 for i in self.ids], np.int64)),
            "flags": packed(np.array([(i is None) + 2 * h for i, h in zip(self.ids, self.held, strict=True)], np.uint8)),
            "lengths": packed(lengths.astype(np.int64)),
            "codes": packed(planes(codes)),
            "words": keys.tobytes(),
            "counts": packed(np.bincount(codes[learned], minlength=len(keys)).astype(np.int64)),
        }
        return _state(row)


def _coded(batches: Iterable[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    block, seq, at = _Block(), 0, TaskContext.get().partitionId()
    for doc_id, held, body in rows_of(batches, "doc_id", "held", "body"):
        block.add(doc_id, held, body)
        if block.size >= block_bytes or len(block.ids) >= BLOCK_ROWS:
            yield from lean(block.rows(at << 20 | seq)).to_batches()
            block, seq = _Block(), seq + 1
    if block.ids:
        yield from lean(block.rows(at << 20 | seq)).to_batches()


def _contexts(hashes: np.ndarray, codes: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Hashes of the ``depth`` words before each place."""
    out = np.zeros(len(places), U64)
    for lo in range(0, len(places), CHUNK):
        at, part = places[lo : lo + CHUNK], out[lo : lo + CHUNK]
        for i in range(1, depth + 1):
            part[:] = mixed(part + hashes[codes[at - i]] + U64(i))
    return out


class _Level:
    """The weighed places of a block."""

    def __init__(self, row: dict, depth: int):
        self.depth = depth
        self.lengths, self.codes = opened(row["lengths"], np.int64), opened_planes(row["codes"])
        self.hashes, self.places = np.frombuffer(row["words"], U64), np.cumsum(opened(row["places"], np.int32), dtype=np.int32)
        self.learned = np.repeat(opened(row["flags"], np.uint8) < 2, self.lengths)[self.places]
        self.before = _contexts(self.hashes, self.codes, self.places, depth)
        #: Whether training documents may hold context and next word.
        self.sent = opened(row["seen"], np.uint8)[self.places] > 0

    def prior(self, row: dict) -> np.ndarray:
        """Of each place the probability in the suffix."""
        if row["which"] is None:
            return opened(row["prior"], np.float64)[self.codes[self.places]]
        return opened_keys(row["prior"]).astype(np.uint32).view(np.float32)[opened_planes(row["which"])].astype(np.float64)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct contexts, and the number of each place's."""
        if self.depth == 1:  # a number a word needs no sort of the places
            words = self.codes[self.places - 1]
            used = np.flatnonzero(np.bincount(words, minlength=len(self.hashes)))
            keys, _, number = grouped(mixed(self.hashes[used] + U64(1)))
            of = np.empty(len(self.hashes), np.int32)
            of[used] = number
            return keys, of[words]
        keys, _, number = grouped(self.before)
        return keys, number

    def events(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct contexts with next words, and the number of those of each place that is sent."""
        after, places = self.before[self.sent], self.places[self.sent]
        for lo in range(0, len(after), CHUNK):
            after[lo : lo + CHUNK] = mixed(after[lo : lo + CHUNK] + mixed(self.hashes[self.codes[places[lo : lo + CHUNK]]]))
        keys, _, number = grouped(after)
        return keys, number


def _next(row: dict, places: np.ndarray, prior: np.ndarray | None, seen: np.ndarray, depth: int, least: int, may: np.ndarray | int = 0) -> pa.Table:
    """A block with its places for contexts of ``depth`` words: those of them that occur ``least`` times.

    ``may``: of each place the fewest occurrences with which its context can reach the gain.
    """
    lengths = opened(row["lengths"], np.int64)
    begin, inside = np.cumsum(lengths) - lengths, np.ones(len(seen), bool)
    for i in range(depth):
        inside[begin[lengths > i] + i] = False
    inside, most = inside[places], seen[places - 1]  # a run occurs no oftener than another at its end
    here = inside & (most >= min(least, 255)) & (most >= may)
    left, seen = inside & ~here, seen.copy()
    seen[places[left]] = np.minimum(seen[places[left]], most[left])  # nor do those that begin with it
    places = places[here]
    if prior is not None:
        values, _, which = grouped(prior[here].astype(np.float32).view(np.uint32).astype(U64) << U64(32))
        row |= {"prior": packed_keys(values >> U64(32)), "which": packed(planes(which))}
        open_docs = np.zeros(len(lengths), bool)
        open_docs[np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[places]] = True
        if 2 * int(lengths[open_docs].sum()) < len(seen):  # documents without places have their scores; their words may go
            inside = np.repeat(open_docs, lengths)
            places, seen = (np.cumsum(inside, dtype=np.int32) - 1)[places], seen[inside]
            used, codes = np.unique(opened_planes(row["codes"])[inside], return_inverse=True)
            row |= {"lengths": packed(np.where(open_docs, lengths, 0)), "codes": packed(planes(codes.astype(np.int32))), "words": np.frombuffer(row["words"], U64)[used].tobytes()}
    row |= {"seen": packed(seen), "places": packed(np.diff(places, prepend=np.int32(0)))}
    return _state(row)


def fewest(root: Root, mass: float, gain: float) -> int:
    """Occurrences below which no context can exceed ``gain``, whatever words follow it.

    A next word that stands m times there stands m times behind every suffix
    too, so its probability is m / (tokens + the most that is added) at least.
    A word's gain grows with m; a context of n occurrences has at most that of
    n times one word.  A thousandth is left for rounding.
    """
    most = root.tokens + max(mass, ADDED * (root.words + 1))
    n = 1
    while n < 255 and n * (math.log((n - 1) / n * most + mass) - math.log(n - 1 + mass)) + 1e-3 * (n + abs(gain)) <= gain:
        n += 1
    return n


def fewest_after(size: np.ndarray, mass: float, gain: float) -> np.ndarray:
    """Of suffixes that occur ``size`` times, the occurrences, up to 255, below which no context of one word more can exceed ``gain``.

    As ``fewest``, with the suffix in place of the root: it is retained, so a
    next word that stands m times behind the context has a probability of
    m / (size + mass) there at least.
    """
    n = np.arange(2, 255)
    with np.errstate(over="ignore"):
        most = np.exp((gain - 1e-3 * (n + abs(gain))) / n) * (n - 1 + mass) - mass
    needed = np.minimum.accumulate(most * n / (n - 1) - mass)  # occurrences of a suffix that leave n of them a chance
    once = 0 > gain - 1e-3 * (1 + abs(gain))
    return np.where(once, 0, 2 + np.searchsorted(-needed, -size.astype(np.float64))).astype(np.uint8)


# Exchange ------------------------------------------------------------------------------------

_SENT = "part int, block long, keys binary, values array<binary>"
_ANSWER = "block long, part int, totals binary, own binary"
#: Of a context: its occurrences, the next words that stand once behind it, and the part of its gain that the others add.
_SUM = np.dtype([("n", "<i8"), ("once", "<i8"), ("gain", "<f8")])


def _split(block: int, keys: np.ndarray, values: np.ndarray, parts: int, shift: int) -> pa.Table:
    """The sorted keys of a block by range."""
    bounds = np.array([(i << 64) // parts for i in range(parts)], dtype=U64)
    ends = np.append(np.searchsorted(keys, bounds), len(keys)).tolist()
    full = [p for p in range(parts) if ends[p + 1] > ends[p]]
    keys = keys >> U64(shift)
    return pa.table(
        {
            "part": pa.array(full, pa.int32()),
            "block": pa.array([block] * len(full), pa.int64()),
            "keys": pa.array([packed_keys(keys[ends[p] : ends[p + 1]]) for p in full], pa.binary()),
            "values": pa.array([_packed_values(values[ends[p] : ends[p + 1]]) for p in full], pa.list_(pa.binary())),
        }
    )


def _packed_values(values: np.ndarray) -> list[bytes]:
    """Counts, or sums of contexts: most of these have no gain, which one bit says."""
    if values.dtype.names is None:
        return [_short(values)]
    some = values["gain"] != 0
    return [_short(values["n"]), _short(values["once"]), packed(np.packbits(some)), packed(planes(values["gain"][some]))]


def _opened_values(raw: list[bytes]) -> np.ndarray:
    if len(raw) == 1:
        return _long(raw[0])
    n = _long(raw[0])
    out, some = np.zeros(len(n), _SUM), np.unpackbits(opened(raw[2], np.uint8), count=len(n)).astype(bool)
    out["n"], out["once"] = n, _long(raw[1])
    out["gain"][some] = opened(raw[3], np.uint8).reshape(8, -1).T.copy().view("<f8").ravel()
    return out


def _gathered(rows: pa.Table) -> tuple[pa.Table, list[int], np.ndarray, np.ndarray, np.ndarray]:
    """What blocks sent to one range, by block: rows, sizes, first holder of each key, key of each entry, entries."""
    rows = rows.sort_by("block")
    keys = [opened_keys(k) for k in rows.column("keys").to_pylist()]
    _, first, at = grouped(np.concatenate(keys))
    return rows, [len(k) for k in keys], first, at, np.concatenate([_opened_values(c) for c in rows.column("values").to_pylist()])


def _answer(rows: pa.Table, sizes: list[int], first: np.ndarray, at: np.ndarray, totals: np.ndarray) -> pa.Table:
    """Answers of one range: each block's totals, and which keys it is the first to hold."""
    own = np.zeros(len(at), bool)
    own[first] = True
    ends = np.cumsum([0, *sizes]).tolist()
    cut = [slice(a, b) for a, b in zip(ends, ends[1:], strict=False)]
    # kept short: totals above a byte are rare and travel by themselves
    return pa.table(
        {
            "block": rows.column("block"),
            "part": rows.column("part"),
            "totals": pa.array([_short(totals[at[c]]) for c in cut], pa.binary()),
            "own": pa.array([packed(np.packbits(own[c])) for c in cut], pa.binary()),
        }
    )


def _short(totals: np.ndarray) -> bytes:
    large = totals >= 255
    more = planes(totals[large].astype("<i8")).reshape(-1)
    return packed(np.concatenate([np.minimum(totals, 255).astype(np.uint8), more, np.array([len(totals)], "<i8").view(np.uint8)]))


def _long(raw: bytes) -> np.ndarray:
    raw = opened(raw, np.uint8)
    n = int(raw[-8:].copy().view("<i8")[0])
    totals = raw[:n].astype(np.int64)
    totals[raw[:n] == 255] = raw[n:-8].reshape(8, -1).T.copy().view("<i8").ravel()
    return totals


def _summed(rows: pa.Table) -> pa.Table:
    """Occurrences of keys."""
    rows, sizes, first, at, counts = _gathered(rows)
    return _answer(rows, sizes, first, at, np.bincount(at, counts, minlength=len(first)).astype(np.int64))


def _tested(rows: pa.Table, least: int, mass: float, gain: float, known: bool = False) -> pa.Table:
    """Sizes of retained contexts, or 1 where blocks have known these from the start; zero for others."""
    rows, sizes, first, at, sums = _gathered(rows)
    size = np.bincount(at, sums["n"], minlength=len(first))
    found = np.bincount(at, sums["gain"] + sums["once"] * math.log(mass), minlength=len(first)) - size * np.log(np.maximum(size - 1, 0) + mass)
    return _answer(rows, sizes, first, at, np.where((size >= least) & (found > gain), 1 if known else size, 0).astype(np.int64))


def _answered(sent: DataFrame, n: int, answer: Callable[[pa.Table], pa.Table], tag: str) -> DataFrame:
    out = sent.repartition(n, "part").groupBy("part").applyInArrow(lambda rows: lean(answer(rows)), _ANSWER)
    return out.repartition(n, "block").withColumn("kind", F.lit(tag))


def _exchanged(sent: DataFrame, n: int, answer: Callable[[pa.Table], pa.Table], tag: str) -> DataFrame:
    """Answers in a table bucketed by block; what is read twice is shuffled once."""
    out = bucketed(_answered(sent, n, answer, tag), tag, "block", n)
    sweep(out.sparkSession)
    return out


def _answers(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A block's totals and first-holder marks, in the order of its keys."""
    order = np.argsort(rows.column("part").to_numpy())
    totals, own = rows.column("totals").to_pylist(), rows.column("own").to_pylist()
    every = [_long(totals[i]) for i in order]
    marks = [np.unpackbits(opened(own[i], np.uint8), count=len(t)).astype(bool) for i, t in zip(order, every, strict=True)]
    return np.concatenate([np.empty(0, np.int64), *every]), np.concatenate([np.empty(0, bool), *marks])


# Steps ---------------------------------------------------------------------------------------


def _words_sent(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for block, words, counts in rows_of(batches, "block", "words", "counts"):
        words = np.frombuffer(words, U64)
        order = np.argsort(words)
        yield from _split(block, words[order], opened(counts, np.int64)[order], parts, 0).to_batches()


def _begun(left: pa.Table, right: pa.Table, root: Root, least: int) -> pa.Table:
    """A block with its scores by the root, and the places of its contexts of one word."""
    row = left.to_pylist()[0]
    lengths, codes, words = opened(row["lengths"], np.int64), opened_planes(row["codes"]), np.frombuffer(row["words"], U64)
    totals, cut = np.empty(len(words), np.int64), np.cumsum(lengths) - lengths
    totals[np.argsort(words)] = _answers(right)[0]
    base = root.of(totals)
    scores = packed(np.add.reduceat(np.log10(base)[codes], cut))
    row |= {"counts": None, "tokens": row["lengths"], "known": packed(np.add.reduceat((totals > 0)[codes].astype(np.int64), cut)), "base": scores, "score": scores, "prior": packed(base)}
    return _next(row, np.arange(len(codes), dtype=np.int32), None, np.minimum(totals, 255).astype(np.uint8)[codes], 1, least)


#: What it takes to send a block's occurrences.
_PLACED = ["block", "flags", "lengths", "codes", "words", "seen", "places"]


def _events_sent(batches: Iterable[pa.RecordBatch], depth: int, parts: int, shift: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of contexts and next words in a block's training documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield from lean(_events_of(batch.slice(i, 1).to_pylist()[0], depth, parts, shift)).to_batches()


def _events_of(row: dict, depth: int, parts: int, shift: int) -> pa.Table:
    level = _Level(row, depth)
    events, event = level.events()
    counts = np.bincount(event[level.learned[level.sent]], minlength=len(events)).astype(np.int64)
    return _split(row["block"], events, counts, parts, shift)


def _gains_sent(left: pa.Table, right: pa.Table, mass: float, depth: int, parts: int, shift: int) -> pa.Table:
    """Gains and sizes of a block's contexts; each key is weighed by the block that holds it first."""
    row = left.to_pylist()[0]
    level = _Level(row, depth)
    totals, own = _answers(right)
    (contexts, context), event = level.contexts(), level.events()[1]
    first = np.flatnonzero(own & (totals > 0))
    of, before = np.zeros(len(totals), np.int32), np.zeros(len(totals))
    of[event], before[event] = context[level.sent], level.prior(row)[level.sent]
    sums, once = np.zeros(len(contexts), _SUM), totals[first] == 1  # these add log(mass) each, whatever their probability
    sums["once"], first = np.bincount(of[first[once]], minlength=len(sums)), first[~once]
    n, before = totals[first], before[first]
    sums["gain"] = np.bincount(of[first], n * (np.log(n - 1 + mass * before) - np.log(before)), minlength=len(sums))
    sums["n"] = np.bincount(context[level.learned], minlength=len(sums))
    return _split(row["block"], contexts, sums, parts, shift)


def _grown(left: pa.Table, right: pa.Table, root: Root, mass: float, gain: float, depth: int, least: int) -> pa.Table:
    """A block with what retained contexts of ``depth`` words add to its scores, and its places for those of one word more."""
    row = left.to_pylist()[0]
    level, kinds = _Level(row, depth), right.column("kind").to_numpy(zero_copy_only=False)
    total, size = np.zeros(len(level.places), np.int64), _answers(right.filter(pa.array(kinds == "tested")))[0][level.contexts()[1]]
    if depth == 1:  # every occurrence of a word has a next one, so its number is that in its own probability
        size = np.where(size > 0, root.count(opened(row["prior"], np.float64)[level.codes[level.places - 1]]), 0)
    total[level.sent] = _answers(right.filter(pa.array(kinds == "events")))[0][level.events()[1]]
    lengths, seen = level.lengths, opened(row["seen"], np.uint8).copy()
    seen[level.places] = np.minimum(total, 255)
    kept = size > 0
    places, prior = level.places[kept], level.prior(row)[kept]
    p = (total[kept] + mass * prior) / (size[kept] + mass)
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[places]
    row["score"] = packed(opened(row["score"], np.float64) + np.bincount(doc, np.log10(p) - np.log10(prior), minlength=len(lengths)))
    return _next(row, places, p, seen, depth + 1, least, fewest_after(size[kept], mass, gain))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, flags, lengths, known, base, score in rows_of(batches, "ids", "flags", "tokens", "known", "base", "score"):
        flags = opened(flags, np.uint8)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(opened(ids, np.int64).copy(), mask=(flags & 1).astype(bool)),
                "held_out": flags >= 2,
                "n_tokens": opened(lengths, np.int64).copy(),
                "n_known": opened(known, np.int64).copy(),
                "base_score": opened(base, np.float64).copy(),
                "score": opened(score, np.float64).copy(),
            }
        )


def _owned(answers: DataFrame) -> tuple[int, int]:
    """Distinct keys with a total above zero, and the sum of totals."""
    sums = answers.select("totals", "own").mapInArrow(_sums, "words long, tokens long").agg(F.sum("words"), F.sum("tokens")).first()
    return int(sums[0] or 0), int(sums[1] or 0)


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for totals, own in rows_of(batches, "totals", "own"):
        t = _long(totals)
        t = t[np.unpackbits(opened(own, np.uint8), count=len(t)).astype(bool)]
        yield pa.RecordBatch.from_pydict({"words": [int(np.count_nonzero(t))], "tokens": [int(t.sum())]})


def score(docs: DataFrame, least: int = LEAST, mass: float = MASS, gain: float | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_contexts, depth) of every row.

    ``depth``: words of the longest retained context.
    """
    n = shuffle_partitions(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = (fold(F.col("doc_id")) == 0).alias("held")
    body = text_bytes(own, "doc_id", held)
    with small_batches(docs.sparkSession, SLICE):
        blocks = bucketed(body.mapInArrow(lambda it: _coded(it, block_bytes), _STATE), "blocks", "block", n)
    parts = max(LEAST_PARTS, n, blocks.count() * block_bytes // PART_BYTES)
    first = _exchanged(blocks.mapInArrow(lambda it: _words_sent(it, parts), _SENT), n, _summed, "words")
    words, tokens = _owned(first)
    gain = 2 * math.log(max(tokens, 1)) if gain is None else gain
    root = Root(tokens, words)
    least = max(least, fewest(root, mass, gain))
    shift = max(0, 64 - SPARE_BITS - tokens.bit_length())

    def met(answers: DataFrame, step: Callable, columns: str) -> DataFrame:
        return state.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda a, b: lean(step(a, b)), columns)

    state = blocks
    state = bucketed(met(first, partial(_begun, root=root, least=least), _STATE), "level", "block", n)
    forget(blocks, first)
    depth, n_contexts = 0, 0
    while True:
        depth += 1
        sent = state.select(_PLACED).mapInArrow(partial(_events_sent, depth=depth, parts=parts, shift=shift), _SENT)
        events = _exchanged(sent, n, _summed, "events")
        sent = met(events, partial(_gains_sent, mass=mass, depth=depth, parts=parts, shift=shift), _SENT)
        tested = added(_answered(sent, n, partial(_tested, least=least, mass=mass, gain=gain, known=depth == 1), "tested"), events, "block", n)
        sweep(docs.sparkSession)
        found = _owned(tested.where("kind = 'tested'"))[0]
        if not found:
            forget(tested)
            break
        n_contexts += found
        before = state
        state = bucketed(met(tested, partial(_grown, root=root, mass=mass, gain=gain, depth=depth, least=least), _STATE), "level", "block", n)
        forget(before, tested)
    scored = state.select("ids", "flags", "tokens", "known", "base", "score").mapInArrow(_scores, SCORES)
    extra = [F.lit(v).cast("long").alias(c) for c, v in (("n_contexts", n_contexts), ("depth", depth - 1))]
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score", *extra)
