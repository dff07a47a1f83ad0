"""Alignment of two tokenizers' tokens by the bytes they cover, as relations of token ends.

Texts are cut into *segments* where both tokenizers are bound to cut: between a
character that is no white space and a blank or line break.  (The first splits
its text by a pattern none of whose parts spans such a place; of the second it
is checked that no piece of its vocabulary does.  Else a text is one segment.)
So the tokens of a text are those of its segments, and each distinct segment is
aligned once, however often the corpus holds it:

1. A block of texts becomes segment numbers; its distinct segments, with their
   counts, are all that is shuffled, by a hash of the segment.
2. Distinct segments are encoded, their tokens unfolded with ``posexplode``, ends
   are windowed sums of lengths.  An equi-join on segment and end finds the cuts
   of either side, a running count of cuts numbers the groups.
3. Links join tokens of a group whose byte ranges overlap.  ``CELL`` bytes of a
   group are joined at a time, and a pair is told where the later of its two
   tokens begins, so a group without cuts costs no more than its length.
4. Counts of id pairs weigh each link with its segment's count.  The highest
   count of an id of the second vocabulary is one row an id, so that table is
   broadcast; the table of pairs is too, up to ``PAIRS`` rows, and beyond that it
   is joined by a shuffle.
5. What became of a segment goes back to the blocks that hold it, and texts are
   put together from their segment numbers.

All of 2 to 4 works on one bucketing by the segment's hash, so of these only the
counts of pairs are shuffled.  Different segments of one hash are told apart.

A null or empty text, and one whose tokens do not give back its bytes (it holds
U+2581, which the second vocabulary reads as a blank), has no tokens: zeros, and
'' for groups and hash.  Its segments count nowhere.  Repeated rows are texts of
their own.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import cache, cached_property, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from consolida.llm.common import bucketed, forget, materialise, rows_of, shuffle_partitions, sweep
from consolida.llm.packing import PATTERN
from consolida.llm.packing import _byte_of_char as byte_of_char

#: A block ends after so many characters, or distinct segments.
BLOCK_CHARS = 32 << 20
BLOCK_SEGMENTS = 1 << 20
#: Bytes of a group that are joined at a time.
CELL = 64
#: Rows of the table of id pairs that may be broadcast.
PAIRS = 1 << 20
#: Rows of a batch handed to Spark.
BATCH = 1 << 15

_SEGMENT = re.compile(r".[^ \n]*(?:(?<=\s)[ \n][^ \n]*)*", re.S)
BLANK = "▁"
#: What a text's segments add up to.
SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Encoders:
    """Token ids and their lengths in bytes, segment by segment; either tokenizer is loaded when it is first used."""

    def __init__(self, a_path: str, b_path: str):
        self.a_path = a_path
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int32)
        self.blank = self.b.piece_to_id(BLANK)
        self.local = not any(re.search(rf"[^{BLANK}]{BLANK}|\n.|.\n", p, re.S) for p in pieces)
        self.every_byte = sum(self.b.is_byte(i) for i in range(len(pieces))) == 256

    @cached_property
    def _a(self) -> tuple[Callable[[str], list[int]], np.ndarray]:
        with open(self.a_path, encoding="utf-8") as f:
            model = json.load(f)
        byte, special = byte_of_char(), {t["content"] for t in model.get("added_tokens", ())}
        lengths = np.zeros(max(model["model"]["vocab"].values()) + 1, np.int32)
        ranks = {}
        for token, i in model["model"]["vocab"].items():
            lengths[i] = len(token)  # byte-level: a character is a byte
            if token not in special:
                ranks[bytes(byte[c] for c in token)] = i
        return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, lengths

    @property
    def a(self) -> Callable[[str], list[int]]:
        return self._a[0]

    @property
    def a_lengths(self) -> np.ndarray:
        return self._a[1]

    def segments(self, text: str) -> list[str]:
        """The segments of a blank and the text."""
        return _SEGMENT.findall(" " + text) if self.local else [" " + text]

    def b_ids(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments; the blank that the encoder puts first is the segment's own, or goes."""
        out = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        for k, s in enumerate(segments):
            if s == " ":
                out[k] = [self.blank]
            elif s[0] != " ":
                out[k] = out[k][1:]
        return out

    def whole(self, text: str) -> bool:
        """Whether the second tokenizer's tokens give back the text's bytes.

        With a piece for every byte nothing is unknown to it, so its tokens
        spell what its normaliser makes of the text.
        """
        if self.every_byte:
            return self.b.normalize(text).replace(BLANK, " ") == " " + text
        return b"".join(map(self.b_bytes.__getitem__, self.b.encode(text))) == (" " + text).encode()


@cache
def loaded(a: str, b: str) -> Encoders:
    """The encoders of two files, loaded once in a worker, whatever number of tasks it runs."""
    return Encoders(a, b)


class Numbers(dict):
    """Segments numbered as they come."""

    def __missing__(self, segment: str) -> int:
        n = self[segment] = len(self)
        return n


def packed(values: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values if isinstance(values, bytes) else values.tobytes())


def opened(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


# Segments --------------------------------------------------------------------------------------

_BLOCKS = "block long, place long, doc_id long, numbers binary, number int, segment string, n int"
_BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("numbers", pa.binary()), ("number", pa.int32()), ("segment", pa.string()), ("n", pa.int32())]
)


def _block(block: int, docs: list[tuple[int | None, np.ndarray]], numbers: Numbers) -> Iterator[pa.RecordBatch]:
    """A row for each text with its segment numbers, and one for each segment with its count."""
    segments = list(numbers)
    n = np.bincount(np.concatenate([x for _, x in docs]), minlength=len(segments)) if segments else np.zeros(0, np.int64)
    empty = lambda k, f: pa.nulls(k, f.type)
    for at in range(0, len(docs), 1024):
        some = docs[at : at + 1024]
        columns = [[block] * len(some), range(at, at + len(some)), [i for i, _ in some], [packed(x) for _, x in some]]
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, _BLOCK_SCHEMA, strict=False)]
        yield pa.RecordBatch.from_arrays(arrays + [empty(len(some), f) for f in list(_BLOCK_SCHEMA)[4:]], schema=_BLOCK_SCHEMA)
    held = np.flatnonzero(n)
    for at in range(0, len(held), BATCH):
        some = held[at : at + BATCH]
        arrays = [pa.array(np.full(len(some), block)), *(empty(len(some), f) for f in list(_BLOCK_SCHEMA)[1:4])]
        arrays += [pa.array(some.astype(np.int32)), pa.array([segments[k] for k in some], pa.string()), pa.array(n[some].astype(np.int32))]
        yield pa.RecordBatch.from_arrays(arrays, schema=_BLOCK_SCHEMA)


def _blocks(batches: Iterable[pa.RecordBatch], a: str, b: str, block_chars: int) -> Iterator[pa.RecordBatch]:
    encoders, numbers = loaded(a, b), Numbers()
    block, docs, chars = TaskContext.get().partitionId() << 24, [], 0
    for doc_id, text in rows_of(batches, "doc_id", "text"):
        found = encoders.segments(text) if text and encoders.whole(text) else []
        docs.append((doc_id, np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))))
        chars += len(text or "") + 1
        if chars >= block_chars or len(numbers) >= BLOCK_SEGMENTS:
            yield from _block(block, docs, numbers)
            block, docs, chars, numbers = block + 1, [], 0, Numbers()
    if docs:
        yield from _block(block, docs, numbers)


_ENCODED = "h long, k int, segment string, n long, a array<int>, la array<int>, b array<int>, lb array<int>"


def _lists(ids: list[list[int]], lengths: np.ndarray) -> tuple[pa.Array, pa.Array]:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])
    return pa.ListArray.from_arrays(offsets, flat), pa.ListArray.from_arrays(offsets, lengths[flat])


def _encoded(batches: Iterable[pa.RecordBatch], a: str, b: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        encoders = loaded(a, b)
        segments = batch.column("segment").to_pylist()
        lists = [*_lists([encoders.a(s) for s in segments], encoders.a_lengths), *_lists(encoders.b_ids(segments), encoders.b_lengths)]
        yield pa.RecordBatch.from_arrays([*batch.select(["h", "k", "segment", "n"]).columns, *lists], names=["h", "k", "segment", "n", "a", "la", "b", "lb"])


# Relations -------------------------------------------------------------------------------------


@contextmanager
def same_buckets(spark: SparkSession) -> Iterator[None]:
    """Joins on more columns than the tables are bucketed by need no shuffle."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def token_ends(distinct: DataFrame, ids: str, lengths: str) -> DataFrame:
    """(h, k, end, id, length, n) of every token: ends are windowed sums of lengths."""
    tokens = distinct.select("h", "k", "n", F.posexplode(F.arrays_zip(F.col(ids).alias("id"), F.col(lengths).alias("length"))).alias("pos", "t"))
    until = Window.partitionBy("h", "k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return tokens.select("h", "k", "n", F.sum("t.length").over(until).cast("int").alias("end"), F.col("t.id").alias(ids), F.col("t.length").alias(lengths))


def grouped_ends(distinct: DataFrame, ids: str, lengths: str, others: str, other_lengths: str) -> DataFrame:
    """(h, k, n, end, id, length, cut, grp) of one side's tokens: whether a token of the other side ends there too, and the number of its group.

    The tokens are joined with the other side's ends.  A left join keeps their
    places in the buckets and their order, so the running count of cuts needs
    neither a shuffle nor another sort.
    """
    there = token_ends(distinct, others, other_lengths).select("h", "k", "end", F.lit(True).alias("cut"))
    met = token_ends(distinct, ids, lengths).join(there.hint("merge"), ["h", "k", "end"], "left")
    before = Window.partitionBy("h", "k").orderBy("end").rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn("cut", F.coalesce("cut", F.lit(False)))
    return met.withColumn("grp", F.coalesce(F.sum(F.col("cut").cast("int")).over(before), F.lit(0)).cast("int"))


def links(a_ends: DataFrame, b_ends: DataFrame) -> DataFrame:
    """(h, k, a, b, n): tokens of a group whose byte ranges overlap."""

    def celled(side: DataFrame, ids: str, lengths: str, *more: str) -> DataFrame:
        begin = F.col("end") - F.col(lengths)
        cells = F.explode(F.sequence(F.floor(begin / CELL), F.floor((F.col("end") - 1) / CELL)))
        return side.select("h", "k", "grp", ids, begin.alias(f"{ids}_from"), F.col("end").alias(f"{ids}_to"), *more, cells.alias("cell"))

    met = celled(a_ends, "a", "la", "n").join(celled(b_ends, "b", "lb").hint("merge"), ["h", "k", "grp", "cell"])
    later = F.greatest("a_from", "b_from")
    return met.where((F.col("a_from") < F.col("b_to")) & (F.col("b_from") < F.col("a_to")) & (F.floor(later / CELL) == F.col("cell"))).select("h", "k", "a", "b", "n")


def cut_masks(a_ends: DataFrame) -> DataFrame:
    """(h, k, n_groups, mask, more): the cuts of each segment, as a mask of its first 64 ends and a list of the others."""
    early = F.col("cut") & (F.col("end") <= 64)
    bit = F.when(early, F.expr("shiftleft(1L, end - 1)")).otherwise(F.lit(0).cast("long"))
    masks = a_ends.groupBy("h", "k").agg(F.count(F.when(F.col("cut"), 1)).alias("n_groups"), F.bit_or(bit).alias("mask"))
    late = a_ends.where("cut and end > 64").groupBy("h", "k").agg(F.sort_array(F.collect_list("end")).alias("more"))
    return masks.join(late, ["h", "k"], "left")


_GROUPED = f"h long, segment string, {', '.join(c + ' long' for c in SUMS)}, groups string"


@cache
def _spelled(most: int) -> list[str]:
    """Every id with each of the marks that may follow it."""
    return [f"{i}{mark}" for mark in ",|;\n" for i in range(most)]


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All items and, for each, the number of its list."""
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())


def _closed(ends: np.ndarray, row: np.ndarray, mask: np.ndarray, more: dict[int, list[int]]) -> np.ndarray:
    """Whether a token's end is a cut of its segment."""
    out = (mask[row] >> np.minimum(ends - 1, 63) & 1).astype(bool) & (ends <= 64)
    for k, others in more.items():
        own = slice(*np.searchsorted(row, (k, k + 1)))
        out[own] |= np.isin(ends[own], others)
    return out


def group_texts(batch: pa.RecordBatch) -> list[str]:
    """``a1,a2|b1;a3|b2`` of every segment: the ids of either side from cut to cut.

    All tokens of a batch are put in order of segment, group and side; what
    follows a token depends on whether it ends its side, group or segment.
    """
    mask = batch.column("mask").to_numpy().astype(np.uint64).view(np.int64)
    more = {k: x for k, x in enumerate(batch.column("more").to_pylist()) if x}
    groups = np.concatenate(([0], np.cumsum(batch.column("n_groups").to_numpy())))
    sides = []
    for side, (ids, lengths) in enumerate((("a", "la"), ("b", "lb"))):
        items, row = _flat(batch.column(ids))
        run = np.cumsum(_flat(batch.column(lengths))[0].astype(np.int64))
        first = np.searchsorted(row, np.arange(batch.num_rows))
        ends = run - np.concatenate(([0], run))[first][row]
        closed = _closed(ends, row, mask, more)
        before = np.cumsum(closed) - closed  # every group has one cut on either side
        mark = np.where(closed, 1 + side, 0)
        if side:
            mark[closed & (before + 1 == groups[1:][row])] = 3
        sides.append((2 * before + side, items + 0, mark))
    key, items, mark = (np.concatenate(x) for x in zip(*sides, strict=True))
    most = int(items.max(initial=0)) + 1
    most = 1 << (most - 1).bit_length() if most > 1 else 1
    order = np.argsort(key, kind="stable")
    spelled = _spelled(most)
    text = "".join([spelled[c] for c in (mark[order] * most + items[order]).tolist()])
    return text.split("\n")[:-1]


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([*batch.select(["h", "segment", *SUMS]).columns, pa.array(group_texts(batch), pa.string())], names=["h", "segment", *SUMS, "groups"])


# Answers ---------------------------------------------------------------------------------------


def _parcels(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What became of a block's segments, many in a row: numbers and sums, and the groups' texts."""
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        table = batch.take(pa.array(order))
        starts = np.flatnonzero(np.diff(blocks[order], prepend=-1))
        sums = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("number", *SUMS)])
        texts = table.column("groups").to_pylist()
        rows = []
        for lo, hi in zip(starts, [*starts[1:], len(order)], strict=True):
            rows.append((int(blocks[order[lo]]), packed(np.ascontiguousarray(sums[:, lo:hi])), packed("\n".join(texts[lo:hi]).encode())))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["block", "sums", "texts"])


_ALIGNED = f"doc_id long, {', '.join(c + ' long' for c in SUMS)}, groups_sha256 string"
_TEXTS = f"doc_id long, {', '.join(c + ' long' for c in SUMS)}, groups string"


def _assembled(docs: pa.Table, answers: pa.Table, digest: bool) -> pa.Table:
    """The sums and groups of each text of a block."""
    parts = [np.frombuffer(opened(x), np.int64).reshape(1 + len(SUMS), -1) for x in answers.column("sums").to_pylist()]
    all_parts = np.concatenate(parts, axis=1) if parts else np.zeros((1 + len(SUMS), 0), np.int64)
    most = int(all_parts[0].max(initial=-1)) + 1
    sums, texts = np.zeros((len(SUMS), most), np.int64), [""] * most
    sums[:, all_parts[0]] = all_parts[1:]
    for part, blob in zip(parts, answers.column("texts").to_pylist(), strict=True):
        for number, text in zip(part[0].tolist(), opened(blob).decode().split("\n"), strict=True):
            texts[number] = text
    out, groups = np.zeros((len(SUMS), len(docs)), np.int64), []
    for k, blob in enumerate(docs.column("numbers").to_pylist()):
        numbers = np.frombuffer(opened(blob), np.int32)
        text = ""
        if len(numbers):
            out[:, k] = sums[:, numbers].sum(axis=1)
            text = ";".join([texts[n] for n in numbers.tolist()])
            text = hashlib.sha256(text.encode()).hexdigest() if digest else text
        groups.append(text)
    names = ["doc_id", *SUMS, "groups_sha256" if digest else "groups"]
    return pa.table([docs.column("doc_id").combine_chunks(), *map(pa.array, out), pa.array(groups, pa.string())], names=names)


def align(docs: DataFrame, a: str, b: str, digest: bool = True, block_chars: int = BLOCK_CHARS, pairs: int = PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text; ``groups`` itself without ``digest``.

    ``a`` is the file of a byte-level BPE vocabulary, ``b`` that of a
    sentencepiece model.
    """
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(partial(_blocks, a=a, b=b, block_chars=block_chars), _BLOCKS)
    blocks = bucketed(texts, "texts", "block", n, "zstd")
    held = blocks.where("segment is not null").select(F.xxhash64("segment").alias("h"), "segment", "block", "number", "n")
    held = bucketed(held.repartition(n, "h"), "segments", "h", n, "zstd")
    sweep(spark)
    same_hash = Window.partitionBy("h").orderBy("segment")
    distinct = held.groupBy("h", "segment").agg(F.sum("n").alias("n")).withColumn("k", F.row_number().over(same_hash) - 1)
    distinct = bucketed(distinct.mapInArrow(partial(_encoded, a=a, b=b), _ENCODED), "distinct", "h", n, "zstd")
    with same_buckets(spark):
        a_ends = bucketed(grouped_ends(distinct, "a", "la", "b", "lb"), "ends", "h", n, "zstd")
        b_ends = bucketed(grouped_ends(distinct, "b", "lb", "a", "la").drop("n", "cut"), "ends", "h", n, "zstd")
        linked = bucketed(links(a_ends, b_ends), "links", "h", n, "zstd")
        forget(b_ends)
        counts = materialise(linked.groupBy("a", "b").agg(F.sum("n").alias("count")), "pairs")
        highest = counts.groupBy("b").agg(F.max("count").alias("most"))  # at most a row for each id of the vocabulary
        counts = counts.join(F.broadcast(highest), "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
        counts = materialise(counts, "pairs")
        counts = F.broadcast(counts) if counts.count() <= pairs else counts.hint("merge")
        weighed = linked.join(counts, ["a", "b"]).groupBy("h", "k").agg(F.count("*").alias("n_links"), F.sum("best").alias("n_best"), F.sum("count").alias("count_sum"))
        sizes = [F.size(c).cast("long").alias(f"n_{c}") for c in ("a", "b")]
        aligned = distinct.select("*", *sizes).join(cut_masks(a_ends), ["h", "k"]).join(weighed, ["h", "k"])
        aligned = bucketed(aligned.mapInArrow(_grouped, _GROUPED), "aligned", "h", n, "zstd")
        forget(a_ends, linked, distinct)
        answers = held.drop("n").join(aligned, ["h", "segment"]).select("block", "number", *SUMS, "groups")
        answers = materialise(answers.mapInArrow(_parcels, "block long, sums binary, texts binary"), "answers", "uncompressed")
        forget(held, aligned)
    docs_of = blocks.where("numbers is not null").select("block", "doc_id", "numbers")
    put = lambda left, right: _assembled(left, right, digest)
    return docs_of.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(put, _ALIGNED if digest else _TEXTS)
