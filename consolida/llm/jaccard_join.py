"""N-gram Jaccard join with signature trees.

A document's set holds the hashes of its distinct k-word shingles.  Documents
link when ``den * |x & y| >= num * |x | y|``; the result is exact.  Documents
with equal sets are one node.

1. The top of the tree.  Sets of a size level differ in at most ``D`` elements
   when they link, so of ``D + 1 + g`` hash ranges they agree in ``1 + g`` at
   least.  The content of a range is a key; documents with an equal key meet
   under the first of them, their hub.  Keys travel as compressed blocks, one
   entry per block for keys that a block holds many times, so copies cannot
   gather in one task.  ``g`` covers the ranges that are empty by chance; a
   document with more empty ranges also sends those.
2. Below a hub, bitmaps and sizes of the sets form a signature tree: nodes hold
   OR-combined bitmaps and size ranges, and a dual traversal descends only into
   node pairs whose greatest possible overlap suffices.  Leaf pairs that pass
   and connect what was apart are the candidate links; their components, over
   all hubs, hold every link, and most documents have none.
3. The sets of a component are compared exactly, each set sent once.

Hubs and components beyond ``CELL_ROWS`` members or ``CELL_BYTES`` are dealt
into parts, and cells of two parts each are compared; then components come from
the links of all cells.  Null, empty or blank texts have an empty set and link
with nothing; rows with an equal doc_id and other texts are documents of their
own; a null doc_id stays alone, with a null component.  An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consolida.llm.common import U64, WordHashes, blank_words, forget, grouped, materialise, mixed, rows_of, shingle_set, shuffle_partitions, text_bytes
from consolida.llm.graph import components

FANOUT = 8
#: Bits of a signature, by the size of its set: a power of two between these, at least ``BITS_EACH`` for each element.
LEAST_BITS, MOST_BITS, BITS_EACH = 256, 1 << 16, 2
#: Members that are compared in one cell, and bytes of their signatures or sets.
CELL_ROWS = 8192
CELL_BYTES = 16_000_000
#: Bytes of bitmaps compared at once.
STEP_BYTES = 1 << 20
#: A block of documents: so many bytes of text or documents at most.
DOC_BLOCK_BYTES = 12_000_000
DOC_BLOCK_ROWS = 30_000
#: A key that a block holds more often than this is sent once, and its documents separately.
REPEATS = 8
#: Pairs of a hub and a document that are made distinct at once.
SPREAD = 1 << 20
#: Text behind one range of keys.
RANGE_BYTES = 32_000_000
#: Ranges of keys at least, so that the rows a pair of documents makes do not depend on the input's size.
LEAST_PARTS = 64
_HOT = 1 << 15

_KEYED = pa.schema(
    [("kind", pa.int32()), ("node", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64())]
    + [("part", pa.int32()), ("key", pa.int64()), ("keys", pa.binary()), ("owners", pa.binary())]
)
_KEYED_DDL = "kind int, node long, doc_id long, n long, hi long, lo long, part int, key long, keys binary, owners binary"


class Levels:
    """Size levels of linkable sets and the number of hash ranges of each."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        ratio = (den / num) ** 1.5
        self.first = [1]  # smallest size of each level
        while self.first[-1] < 1 << 40:
            self.first.append(int(self.first[-1] * ratio) + 1)
        self.starts = np.array(self.first)
        self.known: dict[int, tuple[int, int, np.ndarray, np.uint64]] = {}

    def ranges(self, level: int) -> tuple[int, int, np.ndarray, np.uint64]:
        """(ranges, spare ones g, their lower bounds, a hash of the level)."""
        if level not in self.known:
            most, least = self.first[level + 1] - 1, self.first[level]
            differ = (self.den - self.num) * most // self.num
            m, g = differ + 1, 0
            for _ in range(20):
                empty = m * math.exp(-least / m)
                g = math.ceil(empty + 5 * math.sqrt(empty)) if m > 1 else 0
                if m == differ + 1 + g:
                    break
                m = differ + 1 + g
            m = differ + 1 + g
            bounds = np.array([(i << 64) // m for i in range(m)], dtype=U64)
            self.known[level] = m, g, bounds, mixed(np.array([level + 1], dtype=U64))[0]
        return self.known[level]

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of a sorted set at its own level and, if a smaller level's sets can link with it, at that one."""
        n = len(shingles)
        own = int(np.searchsorted(self.starts, n, "right")) - 1
        levels = [own]
        if own and n * self.num <= (self.first[own] - 1) * self.den:
            levels.append(own - 1)
        out = []
        for level in levels:
            m, g, bounds, salt = self.ranges(level)
            at = np.searchsorted(shingles, bounds)
            filled = np.append(at[1:], n) > at
            sums = np.zeros(m, dtype=U64)
            sums[filled] = np.add.reduceat(mixed(shingles), at[filled])
            keys = mixed(mixed(sums + salt) + np.arange(m, dtype=U64))
            out.append(keys if m - int(filled.sum()) > g else keys[filled])
        return np.concatenate(out)


def _planes(values: np.ndarray) -> bytes:
    """Ascending 48-bit values as byte planes of their differences, whose upper planes compress away."""
    return np.diff(values, prepend=U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel(), dtype=U64)


def _part_bounds(parts: int) -> np.ndarray:
    return np.array([(i << 48) // parts for i in range(parts)], dtype=U64)


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128-bit hash of a set, as two signed numbers."""
    digest = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)


def signature(shingles: np.ndarray) -> bytes:
    """The bitmap of a set; one of half the width is the OR of its halves."""
    width = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * len(shingles) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(shingles & U64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, all of the narrowest width among them."""
    width = min(map(len, bitmaps)) // 8
    out = np.empty((len(bitmaps), width), U64)
    for i, raw in enumerate(bitmaps):
        out[i] = np.bitwise_or.reduce(np.frombuffer(raw, U64).reshape(-1, width), axis=0)
    return out


class _DocBlock:
    def __init__(self, block: int, levels: Levels, parts: int, repeats: int):
        self.block, self.levels, self.parts, self.repeats = block, levels, parts, repeats
        self.docs: list[tuple] = []
        self.keys: list[np.ndarray] = []
        self.owners: list[int] = []
        self.seen: set[tuple[int, int]] = set()
        self.bytes = 0

    def add(self, doc_id: int | None, shingles: np.ndarray, size: int) -> None:
        hi, lo = fingerprint(shingles)
        bitmap = None
        if len(shingles) and doc_id is not None and (hi, lo) not in self.seen:  # a copy within the block sends nothing
            self.seen.add((hi, lo))
            self.keys.append(self.levels.keys(shingles) >> U64(16))
            self.owners.append(len(self.docs))
            bitmap = signature(shingles)
        self.docs.append((doc_id, len(shingles), hi, lo, bitmap))
        self.bytes += size

    def batches(self) -> Iterator[pa.RecordBatch]:
        base, n = self.block << 16, len(self.docs)
        doc_id, size, hi, lo, bitmaps = zip(*self.docs, strict=True)
        yield _batch(n, kind=[0] * n, node=range(base, base + n), doc_id=doc_id, n=size, hi=hi, lo=lo, keys=bitmaps)
        if not self.keys:
            return
        keys = np.concatenate(self.keys)
        owners = np.repeat(np.array(self.owners), [len(k) for k in self.keys])
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        run = np.diff(np.append(first, len(keys)))
        hot = np.repeat(run > self.repeats, run)
        if hot.any():
            at, length = first[run > self.repeats], run[run > self.repeats]
            held = [owners[a : a + n].astype("<u2").tobytes() for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            yield _batch(len(at), kind=[2] * len(at), key=keys[at].astype(np.int64), node=[base] * len(at), owners=held)
            owners[at] |= _HOT
            hot[first] = False
            keys, owners = keys[~hot], owners[~hot]
        ends = np.append(np.searchsorted(keys, _part_bounds(self.parts)), len(keys)).tolist()
        full = [p for p in range(self.parts) if ends[p + 1] > ends[p]]
        yield _batch(
            len(full),
            kind=[1] * len(full),
            node=[base] * len(full),
            part=full,
            keys=[_planes(keys[ends[p] : ends[p + 1]]) for p in full],
            owners=[owners[ends[p] : ends[p + 1]].astype("<u2").tobytes() for p in full],
        )


def _batch(rows: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _KEYED], schema=_KEYED)


def _keyed(batches: Iterable[pa.RecordBatch], k: int, num: int, den: int, parts: int, repeats: int) -> Iterator[pa.RecordBatch]:
    hashes, levels, seq, at = WordHashes(), Levels(num, den), 0, TaskContext.get().partitionId()
    block = None
    for doc_id, body in rows_of(batches, "doc_id", "body"):
        block = block or _DocBlock(at << 20 | seq, levels, parts, repeats)
        block.add(doc_id, shingle_set(hashes.of(blank_words(body)), k), len(body))
        if block.bytes >= DOC_BLOCK_BYTES or len(block.docs) >= DOC_BLOCK_ROWS:
            yield from block.batches()
            block, seq = None, seq + 1
    if block:
        yield from block.batches()


def _meet(rows: pa.Table) -> pa.Table:
    """Documents of one range of keys that share a key, each with the first of them."""
    keys, nodes, hot = [], [], []
    for base, raw, owners in zip(*(rows.column(c).to_pylist() for c in ("node", "keys", "owners")), strict=True):
        own = np.frombuffer(owners, "<u2").astype(np.int64)
        keys.append(_values(raw))
        nodes.append(base + (own & _HOT - 1))
        hot.append(own >= _HOT)
    key, node, flag = np.concatenate(keys), np.concatenate(nodes), np.concatenate(hot)
    order = np.lexsort((node, key))
    key, node, flag = key[order], node[order], flag[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    run = np.diff(np.append(first, len(key)))
    hub = np.repeat(node[first], run)
    pairs = np.unique(np.stack([hub, node], axis=1)[np.repeat(run > 1, run)], axis=0)
    n, h = len(pairs), int(flag.sum())
    return pa.table(
        {
            "hub": pa.array(np.concatenate([pairs[:, 0], hub[flag]])),
            "node": pa.array(np.append(pairs[:, 1], np.zeros(h, np.int64)), mask=np.repeat([False, True], [n, h])),
            "key": pa.array(np.append(np.zeros(n, np.int64), key[flag].astype(np.int64)), mask=np.repeat([True, False], [n, h])),
        }
    )


class Forest:
    """Union-find over list positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


class Labels:
    """Components of list positions, as an array: the least position of each."""

    def __init__(self, n: int):
        self.of = np.arange(n)
        self.version = 0

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Those of the links a[i], b[i] that connect what was apart."""
        x, y = self.of[a], self.of[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        _, first = np.unique(low * len(self.of) + high, return_index=True)
        first = first[low[first] != high[first]].tolist()
        up: dict[int, int] = {}

        def root(i: int) -> int:
            while i in up:
                i = up[i]
            return i

        out = []
        for i in first:
            p, q = root(int(x[i])), root(int(y[i]))
            if p != q:
                up[max(p, q)] = min(p, q)
                out.append((int(a[i]), int(b[i])))
        if out:
            to = np.arange(len(self.of))
            for i in up:
                to[i] = root(i)
            self.of = to[self.of]
            self.version += 1
        return out


class SignatureTree:
    """Hierarchy over sets: OR-combined bitmaps, size ranges and the greatest number of elements that share bits."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((bitmaps[:, 0], sizes))
        maps, sizes = bitmaps[self.order], sizes[self.order]
        self.levels = [(maps, sizes, sizes, sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64))]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, shared = self.levels[-1]
            cut = np.arange(0, len(maps), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(shared, cut)))

    def links(self, num: int, den: int, known: Labels) -> list[tuple[int, int]]:
        """Pairs (positions in the given list) that may link and connect what was apart, down both trees at once.

        Pairs of nodes whose leaves are all connected are passed over.
        """
        out, top, ranges = [], len(self.levels) - 1, {}
        stack = [(top, np.zeros(1, np.int32), np.zeros(1, np.int32))]
        most = max(64, STEP_BYTES // self.levels[0][0][0].nbytes)
        while stack:
            level, a, b = stack.pop()
            if len(a) > most:
                stack.append((level, a[:-most], b[:-most]))
                a, b = a[-most:], b[-most:]
            if ranges.get(level, (-1,))[0] != known.version:
                low = high = known.of[self.order]
                for _ in range(level):
                    cut = np.arange(0, len(low), FANOUT)
                    low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
                ranges[level] = known.version, low, high
            _, low, high = ranges[level]
            apart = (low[a] != high[b]) | (high[a] != low[b])
            maps, least, largest, shared = self.levels[level]
            a, b = a[apart], b[apart]
            near = (largest[a] * den >= num * least[b]) & (largest[b] * den >= num * least[a])
            a, b = a[near], b[near]
            need = -(-num * (least[a] + least[b]) // (num + den))
            overlap = np.bitwise_count(maps[a] & maps[b]).sum(axis=1, dtype=np.int64) + np.minimum(shared[a], shared[b])
            enough = (a == b) | (np.minimum(overlap, np.minimum(largest[a], largest[b])) >= need)
            a, b = a[enough], b[enough]
            if not level:
                out += known.join(self.order[a], self.order[b])
            elif len(a):
                size, step = len(self.levels[level - 1][0]), np.arange(FANOUT, dtype=np.int32)
                x = np.repeat(a[:, None] * FANOUT + step, FANOUT, axis=1).ravel()
                y = np.tile(b[:, None] * FANOUT + step, FANOUT).ravel()
                fits = (x < size) & (y < size) & ((x < y) if level == 1 else (x <= y))
                stack.append((level - 1, x[fits], y[fits]))
        return out


def exact_links(sets: list[np.ndarray], num: int, den: int, known: Labels) -> list[tuple[int, int]]:
    """Links of sets (positions in the given list) that connect what was apart.

    Each set in turn, the smaller first, is counted against all larger ones
    that may link and are not connected with it, over the elements they hold.
    """
    sizes = np.array([len(x) for x in sets])
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    _, first, number = grouped(np.concatenate([sets[i] for i in order]))
    often = np.bincount(number, minlength=len(first)) > 1
    kept = often[number]
    ends = np.concatenate(([0], np.cumsum(kept)[np.cumsum(sizes) - 1]))  # an element of one set is in no overlap
    elements = number[kept]
    limit = np.searchsorted(sizes * num, sizes * den, "right")
    inside, out = np.zeros(len(first), bool), []
    for i in range(len(order)):
        own = known.of[order]
        others = np.flatnonzero(own[i + 1 : limit[i]] != own[i]) + i + 1
        if not len(others):
            continue
        inside[elements[ends[i] : ends[i + 1]]] = True
        if 4 * len(others) > limit[i] - i:
            lo, hi = others[0], others[-1] + 1
            sums = np.concatenate(([0], np.cumsum(inside[elements[ends[lo] : ends[hi]]])))
            both = sums[ends[others + 1] - ends[lo]] - sums[ends[others] - ends[lo]]
        else:
            both = np.array([np.count_nonzero(inside[elements[ends[j] : ends[j + 1]]]) for j in others])
        inside[elements[ends[i] : ends[i + 1]]] = False
        linked = others[both * (num + den) >= num * (sizes[i] + sizes[others])]
        if len(linked):
            out += known.join(np.full(len(linked), order[i]), order[linked])
    return out


_LINKS = "a long, b long"


def _groups(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...], *rest: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal keys; the rows come sorted by them."""
    now, held = None, []
    for row in rows_of(batches, *keys, *rest):
        key = row[: len(keys)]
        if key != now and held:
            yield now, held
            held = []
        now = key
        held.append(row[len(keys) :])
    if held:
        yield now, held


def _pairs(found: list[tuple[int, int]], nodes: list[int]) -> Iterator[pa.RecordBatch]:
    if found:
        yield pa.RecordBatch.from_pydict({"a": [nodes[i] for i, _ in found], "b": [nodes[j] for _, j in found]})


def _candidates(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for _, rows in _groups(batches, ("hub", "x", "y"), "node", "n", "bitmap"):
        nodes, sizes, bitmaps = zip(*rows, strict=True)
        yield from _pairs(SignatureTree(folded(bitmaps), np.array(sizes)).links(num, den, Labels(len(rows))), nodes)


def _verified(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for _, rows in _groups(batches, ("hub", "x", "y"), "node", "shingles"):
        sets = dict(rows)  # a repeated row is there more than once
        yield from _pairs(exact_links([np.frombuffer(raw, U64) for raw in sets.values()], num, den, Labels(len(sets))), list(sets))


def _shingles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The wanted sets; rows of the same doc_id with another text are not."""
    hashes, last = WordHashes(), None
    for batch in batches:
        kept, sets = [], []
        for i, (node, body, hi, lo) in enumerate(rows_of([batch], "node", "body", "hi", "lo")):
            if node == last:
                continue
            own = shingle_set(hashes.of(blank_words(body)), k)
            if fingerprint(own) == (hi, lo):
                kept.append(i)
                sets.append(own.tobytes())
                last = node
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)).take(pa.array(kept, pa.int64())) for c in ("hub", "node", "parts")] + [pa.array(sets, pa.binary())], names=["hub", "node", "parts", "shingles"])


def _spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hub, node) of the documents that hold the hot keys of a block, each pair once in ``SPREAD`` of them."""
    found: list[np.ndarray] = []
    size = 0

    def pairs() -> pa.RecordBatch:
        each = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(each[:, 0]), pa.array(each[:, 1])], names=["hub", "node"])

    for hub, base, raw in rows_of(batches, "hub", "node", "owners"):
        own = np.frombuffer(raw, "<u2").astype(np.int64) + base
        found.append(np.stack([np.full(len(own), hub), own], axis=1))
        size += len(own)
        if size >= SPREAD:
            yield pairs()
            found, size = [], 0
    if found:
        yield pairs()


def _celled(members: DataFrame, n: int, *payload: str) -> DataFrame:
    """(hub, x, y, node, payload) sorted in cells: all of a hub, or two of its ``parts``."""
    slot = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), slot))
    cells = members.select("hub", "node", *payload, slot.alias("slot"), F.explode(others).alias("other"))
    cells = cells.select("hub", F.least("slot", "other").alias("x"), F.greatest("slot", "other").alias("y"), "node", *payload)
    return cells.repartition(n, "hub", "x", "y").sortWithinPartitions("hub", "x", "y", "node")


def _parts(size: Column) -> Column:
    """Parts of a group of ``size`` bytes, from its members."""
    return F.ceil(F.greatest(F.count("*") / CELL_ROWS, F.sum(size) / CELL_BYTES)).cast("int").alias("parts")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, repeats: int = REPEATS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    body = text_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    size = body.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(LEAST_PARTS, n, size // RANGE_BYTES)
    keyed = materialise(body.mapInArrow(lambda it: _keyed(it, k, num, den, parts, repeats), _KEYED_DDL), "keyed")

    met = keyed.where("kind = 1").select("part", "node", "keys", "owners").repartition(n, "part").groupBy("part")
    met = materialise(met.applyInArrow(_meet, "hub long, node long, key long"), "met")
    hubs = met.where("key is not null").groupBy("key").agg(F.min("hub").alias("hub"))
    many = keyed.where("kind = 2").select("key", "node", "owners").join(hubs, "key").select("hub", "node", "owners").mapInArrow(_spread, "hub long, node long")
    pairs = materialise(met.where("key is null").select("hub", "node").unionByName(many).distinct(), "pairs")

    # Classes of equal sets; ``first`` stands for a class, ``doc`` is the smallest doc_id.
    rows = keyed.where("kind = 0").select("node", "doc_id", "n", "hi", "lo", F.col("keys").alias("bitmap"))
    own = rows.where("n > 0 and doc_id is not null")
    classes = own.groupBy("hi", "lo").agg(F.min("node").alias("first"), F.min("doc_id").alias("doc"), F.max("n").alias("n"), F.max("bitmap").alias("bitmap"))
    classes = materialise(classes, "classes")
    nodes = materialise(rows.drop("bitmap").join(classes.select("hi", "lo", "first"), ["hi", "lo"], "left"), "nodes")
    forget(keyed, met)

    first_of = nodes.select("node", "first")
    hub_of = first_of.select(F.col("node").alias("hub"), F.col("first").alias("hub_first"))
    groups = pairs.join(first_of, "node").join(hub_of, "hub").select(F.col("hub_first").alias("hub"), F.col("first").alias("node")).where("hub <> node").distinct()
    groups = materialise(groups.unionByName(groups.select("hub", F.col("hub").alias("node")).distinct()), "groups")
    forget(pairs)
    signed = groups.join(classes.select(F.col("first").alias("node"), "n", "bitmap"), "node")
    sizes = signed.groupBy("hub").agg(_parts(F.octet_length("bitmap")))
    cells = _celled(signed.join(sizes, "hub"), n, "n", "bitmap")
    found = materialise(cells.mapInArrow(lambda it: _candidates(it, num, den), _LINKS), "candidates")
    forget(groups)
    near = materialise(components(found).withColumnRenamed("component", "hub"), "near")

    wanted = near.join(classes.select(F.col("first").alias("id"), "doc", "n", "hi", "lo"), "id")
    wanted = wanted.join(wanted.groupBy("hub").agg(_parts(8 * F.col("n"))), "hub").select("hub", F.col("id").alias("node"), F.col("doc").alias("doc_id"), "hi", "lo", "parts")
    texts = body.join(materialise(wanted, "wanted").hint("merge"), "doc_id")
    sets = texts.mapInArrow(lambda it: _shingles(it, k), "hub long, node long, parts int, shingles binary")
    links = materialise(_celled(sets, n, "shingles").mapInArrow(lambda it: _verified(it, num, den), _LINKS), "links")
    forget(found, near)

    labels = components(links).join(classes.select(F.col("first").alias("id"), "doc"), "id")
    labels = labels.join(labels.groupBy("component").agg(F.min("doc").alias("component_id")), "component").select("id", "component_id")
    named = materialise(classes.select(F.col("first").alias("id"), "doc").join(labels, "id", "left").select(F.col("id").alias("first"), F.coalesce("component_id", "doc").alias("component_id")), "named")
    linked = nodes.where("first is not null and doc_id is not null").join(named, "first").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = nodes.where("first is null or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def brute_force(docs: pd.DataFrame, k: int, num: int, den: int) -> dict[int, tuple[int, int]]:
    """doc_id to (n_shingles, component_id), by comparing all pairs; for tests."""
    grams = {}
    for doc_id, text in zip(docs["doc_id"], docs["text"], strict=True):
        words = blank_words((text or "").encode())
        grams[doc_id] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()
    ids = sorted(grams)
    known = Forest(len(ids))
    for i, a in enumerate(ids):
        for j in range(i):
            x, y = grams[a], grams[ids[j]]
            if x and y and den * len(x & y) >= num * len(x | y):
                known.join(i, j)
    return {d: (len(grams[d]), ids[known.root(i)]) for i, d in enumerate(ids)}
