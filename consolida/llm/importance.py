"""Quality classifier by importance resampling of hashed n-grams.

Two generative models over hashed n-grams, one of target text (labelled good
and not toxic) and one of the raw corpus, give each document a log importance
weight; tempered weights plus Gumbel noise, and the top k of them, are a sample
without replacement in proportion to the weights.

* An n-gram counts once per document.  Single tokens and pairs of neighbours
  are features; so is a run of ``RUN`` equal tokens, whatever the token.
* Each n-gram has a bucket in each of two independent tables and takes the
  milder of the two ratios, so a chance collision with a bad n-gram is harmless.
* A ratio counts where its log is at most ``CEILING``, it is below one by more
  than ``Z`` standard errors and
  labelled documents bear it out: the bucket's rate among those that are not
  target is at least ``RATE`` times its rate among those that are.  Other ratios
  are one.  Ratios above one only say that a document is not of some other kind
  of bad text; they grow with length and would hide a few bad words.
* ``k`` is the expected size of a rejection sample with the tempered weights.

Counts cover all rows.  At most ``LABEL_BOUND`` labelled documents of either
kind are used, those whose ids have the smallest hashes.  Noise comes from
a hash of doc_id, so a run can be repeated.  A text that is null or has no
token has no weight and is never kept; a null doc_id takes part like any other;
equal keys at the threshold are all kept; without target documents every ratio
is one.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.llm.common import U64, materialise, mixed

LABEL_BOUND = 100_000
UNIGRAM_BITS, BIGRAM_BITS = 17, 15
SMOOTHING = 0.5
Z = 3.0
RATE = 4.0
RUN = 4
FLOOR, CEILING = -6.0, -1.6
TEMPERATURE = 0.25
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_MARKS = {c: xxhash.xxh3_64_intdigest(c) for c in ".,;:!?"}
#: Two tables for tokens, two for pairs, and places of their own for: every document; a run of equal tokens.
_SIZES = (1 << UNIGRAM_BITS, 1 << UNIGRAM_BITS, 1 << BIGRAM_BITS, 1 << BIGRAM_BITS, 2)
_STARTS = np.concatenate(([0], np.cumsum(_SIZES)))
BUCKETS = int(_STARTS[-1])
SCORES = "doc_id long, n_tokens long, log_weight double, key double"


#: Documents and bytes that are hashed together, at most; a longer document stands alone.
BLOCK_DOCS, BLOCK_BYTES = 4096, 2_000_000
_BUCKET_BITS = U64(BUCKETS.bit_length())


class _Tokens(dict):
    """Number of each piece between blanks, and the hashes of the tokens in it; emptied when it holds 400,000 pieces."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes, self.ends = array("Q"), array("q", [0])

    def __missing__(self, piece: str) -> int:
        # letters alone are one token, and most other pieces a word with a mark behind it
        if piece.isalpha():
            self.hashes.append(xxhash.xxh3_64_intdigest(piece))
        elif piece[-1:] in _MARKS and piece[:-1].isalpha():
            self.hashes.extend((xxhash.xxh3_64_intdigest(piece[:-1]), _MARKS[piece[-1]]))
        else:
            self.hashes.extend(map(xxhash.xxh3_64_intdigest, _TOKEN.findall(piece)))
        self.ends.append(len(self.hashes))
        n = self[piece] = len(self)
        return n

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the tokens of all texts one after another, and how many each has."""
        if len(self) > 400_000:
            self.clear()
            self.hashes, self.ends = array("Q"), array("q", [0])
        pieces = pc.ascii_split_whitespace(texts)  # other blanks part tokens inside a piece
        told = pieces.flatten().dictionary_encode()
        known = np.array(list(map(self.__getitem__, told.dictionary.to_numpy(zero_copy_only=False))), np.int64)
        every = known[told.indices.to_numpy()] if len(known) else known
        flat, ends = np.array(self.hashes, U64), np.array(self.ends, np.int64)
        begin, size = ends[every], ends[every + 1] - ends[every]
        last = np.cumsum(size)
        hashes = flat[np.arange(size.sum()) + np.repeat(begin - last + size, size)]
        sizes = np.diff(np.append(0, last)[np.append(0, np.cumsum(pc.list_value_length(pieces).to_numpy()))])
        return hashes, sizes


@dataclass
class Block:
    """Tokens of some documents one after another; pairs of neighbours, and documents with a run of equal tokens."""

    sizes: np.ndarray
    one: np.ndarray
    one_doc: np.ndarray
    two: np.ndarray
    two_doc: np.ndarray
    runs: np.ndarray

    def buckets(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(document, n-gram, its bucket in the first table, and in the second) of tokens, then of pairs."""
        for grams, doc, bits, at in ((self.one, self.one_doc, UNIGRAM_BITS, 0), (self.two, self.two_doc, BIGRAM_BITS, 2)):
            h, mask = mixed(grams), U64((1 << bits) - 1)
            yield doc, grams, (h & mask).astype(np.int64) + _STARTS[at], (h >> U64(40) & mask).astype(np.int64) + _STARTS[at + 1]


def _block(one: np.ndarray, sizes: np.ndarray) -> Block:
    doc = np.repeat(np.arange(len(sizes)), sizes)
    inner = doc[1:] == doc[:-1]
    two = mixed(one[:-1] * U64(3) + one[1:])[inner]
    same = inner & (one[1:] == one[:-1])
    n = max(len(same) - RUN + 2, 0)
    long = np.all([same[i : n + i] for i in range(RUN - 1)], axis=0)
    return Block(sizes, one, doc, two, doc[1:][inner], np.unique(doc[:n][long]))


def blocks(texts: pa.Array, seen: _Tokens) -> Iterator[Block]:
    """Texts (null: empty) in order, hashed in blocks."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    lo = 0
    while lo < len(texts):
        before = ends[lo - 1] if lo else 0
        hi = min(max(int(np.searchsorted(ends, before + BLOCK_BYTES, "right")), lo + 1), lo + BLOCK_DOCS)
        yield _block(*seen.of(texts[lo:hi]))
        lo = hi


def _holds(ids: np.ndarray, doc_ids: list[int | None]) -> np.ndarray:
    """Whether each document is one of the sorted ``ids``."""
    if not len(ids):
        return np.zeros(len(doc_ids), bool)
    there = np.array([d is not None for d in doc_ids], bool)
    asked = np.array([0 if d is None else d for d in doc_ids], np.int64)
    return there & (ids[np.minimum(np.searchsorted(ids, asked), len(ids) - 1)] == asked)


def _counts(batches: Iterable[pa.RecordBatch], target: np.ndarray, other: np.ndarray) -> Iterator[pa.RecordBatch]:
    seen = _Tokens()
    raw, good, bad = (np.zeros(BUCKETS, np.int64) for _ in range(3))
    for batch in batches:
        ids, at = batch.column(0).to_pylist(), 0
        is_good = _holds(target, ids)
        is_bad = ~is_good & _holds(other, ids)
        for block in blocks(batch.column(1), seen):
            n = len(block.sizes)
            keys = [np.arange(n).astype(U64) << _BUCKET_BITS | U64(_STARTS[4]), block.runs.astype(U64) << _BUCKET_BITS | U64(_STARTS[4] + 1)]
            for doc, _, a, b in block.buckets():
                keys += [doc.astype(U64) << _BUCKET_BITS | x.astype(U64) for x in (a, b)]
            key = np.sort(np.concatenate(keys))
            key = key[np.append(True, key[1:] != key[:-1])]
            doc, bucket = (key >> _BUCKET_BITS).astype(np.int64) + at, (key & U64((1 << int(_BUCKET_BITS)) - 1)).astype(np.int64)
            for counts, of in ((raw, bucket), (good, bucket[is_good[doc]]), (bad, bucket[is_bad[doc]])):
                if len(of):
                    counts += np.bincount(of, minlength=BUCKETS)
            at += n
    full = np.flatnonzero(raw)
    for lo in range(0, len(full), 50_000):
        part = full[lo : lo + 50_000]
        yield pa.RecordBatch.from_pydict({"bucket": part, "raw": raw[part], "good": good[part], "bad": bad[part]})


def log_ratios(raw: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of each bucket, noise taken out, none above zero."""
    out = np.zeros(BUCKETS)
    for lo, hi in zip(_STARTS[:-1], _STARTS[1:], strict=True):
        r, g, b = (x[lo:hi].astype(float) for x in (raw, good, bad))
        if not g.sum():
            continue
        in_r, in_g, in_b = (x[0] if hi == BUCKETS else x.sum() for x in (r, g, b))
        share = in_g / in_r
        short = share * r - g > Z * np.sqrt(share * (1 - share) * r + 1e-9)
        if in_b:
            short &= (b >= 2) & (b * in_g >= RATE * g * in_b)
        ratio = np.log((g + SMOOTHING) / (in_g + SMOOTHING * len(g))) - np.log((r + SMOOTHING) / (in_r + SMOOTHING * len(r)))
        out[lo:hi] = np.where(short & (ratio <= CEILING), np.maximum(ratio, FLOOR), 0)
    return out


def labelled_ids(labels: DataFrame, target: bool, bound: int = LABEL_BOUND) -> np.ndarray:
    """Sorted ids of at most ``bound`` labelled documents that are target, or are not."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    rows = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(good).alias("good")).where(F.col("good") == target)
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).collect()
    return np.array(sorted(r["doc_id"] for r in rows), dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> np.ndarray:
    """Log ratios of all buckets, from all of ``docs`` and at most ``bound`` labelled documents of either kind."""
    spark = docs.sparkSession
    ids = spark.sparkContext.broadcast((labelled_ids(labels, True, bound), labelled_ids(labels, False, bound)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = rows.mapInArrow(lambda it: _counts(it, *ids.value), "bucket long, raw long, good long, bad long")
    sums = counted.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("raw", "good", "bad")))
    table = np.zeros((3, BUCKETS), np.int64)
    for r in sums.collect():  # at most BUCKETS rows
        table[:, r["bucket"]] = r["raw"], r["good"], r["bad"]
    return log_ratios(*table)


def noise(doc_id: int | None, text: str) -> float:
    """Standard Gumbel noise of a document; rows without an id differ by their text."""
    own = repr(doc_id) if doc_id is not None else text
    u = (xxhash.xxh3_64_intdigest(own.encode("utf-8", "surrogatepass"), seed=11) + 0.5) / 2.0**64
    return float(-np.log(-np.log(u)))


def _weights(block: Block, ratios: np.ndarray) -> np.ndarray:
    """Log weight of each document: the milder ratio of each distinct n-gram, summed; only those below zero are told apart."""
    docs = np.arange(len(block.sizes))
    weight = ratios[_STARTS[4]] + np.where(np.isin(docs, block.runs), ratios[_STARTS[4] + 1], 0.0)
    for doc, grams, a, b in block.buckets():
        value = np.maximum(ratios[a], ratios[b])
        at = np.flatnonzero(value)
        at = at[np.lexsort((grams[at], doc[at]))]
        new = np.append(True, (doc[at][1:] != doc[at][:-1]) | (grams[at][1:] != grams[at][:-1]))[: len(at)]
        at = at[new]
        weight += np.bincount(doc[at], weights=value[at], minlength=len(docs))
    return weight


def _scores(ids: list[int | None], texts: pa.Array, ratios: np.ndarray, seen: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, log weight, key) of each document."""
    found = [(b.sizes, _weights(b, ratios)) for b in blocks(texts, seen)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    n, weight = (np.concatenate(parts) for parts in zip(*found, strict=True))
    weight = np.where(n > 0, weight, -np.inf)
    return n, weight, weight / TEMPERATURE + np.array([noise(i, "" if i is not None else texts[k].as_py() or "") for k, i in enumerate(ids)])


def _scored(batches: Iterable[pa.RecordBatch], ratios: np.ndarray) -> Iterator[pa.RecordBatch]:
    seen = _Tokens()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        n, weight, key = _scores(ids, batch.column(1), ratios, seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(weight, pa.float64()), pa.array(key, pa.float64())], names=["doc_id", "n_tokens", "log_weight", "key"])


def kth_largest(keys: DataFrame, k: int, bins: int = 4096, most: int = 20_000) -> float:
    """The k-th largest value of ``key``, by histograms that narrow down to a bounded number of rows."""
    keys = keys.where(F.col("key") > float("-inf"))
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    while True:
        here = keys.where(F.col("key").between(low, high))
        width = (high - low) / bins
        if width == 0 or low + width == low:
            return low
        counts = {r["b"]: r["n"] for r in here.groupBy(F.least(F.lit(bins - 1), F.floor((F.col("key") - low) / width)).alias("b")).agg(F.count("*").alias("n")).collect()}
        at = max(counts)
        for at in sorted(counts, reverse=True):
            if counts[at] >= k:
                break
            k -= counts[at]
        inside = here.where(F.least(F.lit(bins - 1), F.floor((F.col("key") - low) / width)) == at)
        if counts[at] <= most:
            values = sorted((r["key"] for r in inside.select("key").collect()), reverse=True)
            return values[k - 1]
        low, high = inside.agg(F.min("key"), F.max("key")).first()


@dataclass
class Selection:
    """A trained model, the scores of its corpus, and the key from which documents are kept."""

    ratios: np.ndarray
    scores: DataFrame
    threshold: float

    def rows(self, docs: DataFrame) -> DataFrame:
        """The kept rows of ``docs``, all columns as they are."""
        model = docs.sparkSession.sparkContext.broadcast((self.ratios, self.threshold))
        names = docs.columns

        def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (ratios, threshold), seen = model.value, _Tokens()
            for batch in batches:
                n, _, key = _scores(batch.column(names.index("doc_id")).to_pylist(), batch.column(names.index("text")), ratios, seen)
                yield batch.filter(pa.array((n > 0) & (key >= threshold), pa.bool_()))

        return docs.mapInArrow(keep, docs.schema)


def select(docs: DataFrame, labels: DataFrame, k: int | None = None, bound: int = LABEL_BOUND) -> Selection:
    """Train on ``docs`` and ``labels``, score every row of ``docs`` and set the threshold of the top ``k``.

    Without ``k`` it is the expected size of a rejection sample with the tempered weights.
    """
    spark = docs.sparkSession
    ratios = train(docs, labels, bound)
    model = spark.sparkContext.broadcast(ratios)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scores = materialise(rows.mapInArrow(lambda it: _scored(it, model.value), SCORES), "scores")
    expected, n = scores.agg(F.round(F.sum(F.exp(F.col("log_weight") / TEMPERATURE))), F.sum((F.col("n_tokens") > 0).cast("long"))).first()
    k = min(int(expected or 0) if k is None else k, int(n or 0))
    threshold = kth_largest(scores, k) if k else float("inf")
    return Selection(ratios, scores, threshold)


def classify(docs: DataFrame, labels: DataFrame, k: int | None = None, bound: int = LABEL_BOUND) -> DataFrame:
    """(doc_id, n_tokens, log_weight, key, kept) of every row."""
    found = select(docs, labels, k, bound)
    return found.scores.withColumn("kept", (F.col("n_tokens") > 0) & (F.col("key") >= F.lit(found.threshold)))
