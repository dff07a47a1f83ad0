"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` cuts the documents into shards of about ``SHARD_TOKENS`` words
and stores, for every term of a shard, the ascending offsets at which it
stands.  Documents of a shard are laid ``GAP`` places apart, so no phrase can
run from one document into the next.  ``search`` takes the benchmark in blocks
of bounded size, reads only the postings of its terms, brings those of a shard
together and intersects offset-adjusted lists, beginning at each window's
rarest term.  ``decontaminate`` gives one row per document.

Nulls: a null text has no words; a null id is carried along.  Repeated rows are
separate documents.  Items without words match nothing.  Empty tables give
empty results (an empty benchmark: every document, with no hits).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.llm.common import alnum_words, materialise, rows_of, shuffle_partitions, text_bytes

WINDOW = 10
SHARD_TOKENS = 400_000
GAP = 4096
#: Bytes of benchmark text that are searched for at a time.
BLOCK_BYTES = 16_000_000

INDEX_SCHEMA = "shard long, kind int, term binary, n long, offsets binary"
_ARROW = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("term", pa.binary()), ("n", pa.int64()), ("offsets", pa.binary())])


def _binary(data: bytes, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data)])


class _Shard:
    """Words of whole documents until the shard is full."""

    def __init__(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.codes: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.size = 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        terms = self.terms
        known = terms.setdefault
        self.codes.append(np.fromiter((known(w, len(terms)) for w in words), dtype=np.int32, count=len(words)))
        self.docs.append(doc_id)
        self.lengths.append(len(words))
        self.size += len(words)

    def batch(self, shard: int) -> pa.RecordBatch:
        """kind 0: one row of each term; kind 1: ids, nulls and lengths of the documents."""
        codes = np.concatenate(self.codes) if self.codes else np.empty(0, np.int32)
        lengths = np.array(self.lengths, dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths + GAP)[:-1]))
        where = np.arange(len(codes)) + np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        order = np.argsort(codes, kind="stable")
        counts = np.bincount(codes, minlength=len(self.terms))
        postings = where[order].astype(np.int32).tobytes()
        bounds = np.concatenate(([0], np.cumsum(counts))) * 4
        ids = np.array([0 if d is None else d for d in self.docs], dtype=np.int64).tobytes()
        nulls = bytes(d is None for d in self.docs)
        n = len(self.terms)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, shard)),
                pa.array(np.array([0] * n + [1], dtype=np.int32)),
                pa.array([*self.terms, nulls], pa.binary()),
                pa.array(np.append(counts, len(self.docs)).astype(np.int64)),
                _binary(postings + ids + lengths.tobytes(), np.append(bounds, len(postings) + 16 * len(self.docs))),
            ],
            schema=_ARROW,
        )


def _postings(batches: Iterator[pa.RecordBatch], shard_tokens: int) -> Iterator[pa.RecordBatch]:
    shard, seq, part = _Shard(), 0, TaskContext.get().partitionId()
    for doc_id, body in rows_of(batches, "doc_id", "body"):
        shard.add(doc_id, alnum_words(body))
        if shard.size >= shard_tokens or len(shard.docs) >= 50_000:
            yield shard.batch(part << 32 | seq)
            shard, seq = _Shard(), seq + 1
    if shard.docs:
        yield shard.batch(part << 32 | seq)


def build_index(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Postings of all words of ``docs`` (doc_id, text), stored in the shared folder."""
    rows = text_bytes(docs, "doc_id").mapInArrow(lambda it: _postings(it, shard_tokens), INDEX_SCHEMA)
    return materialise(rows, "postings")


def _windows(items: list[tuple], width: int) -> list[tuple[str, tuple[bytes, ...]]]:
    out = []
    for item_id, body in items:
        words = alnum_words(body)
        size = min(width, len(words))
        out += [(item_id, tuple(words[i : i + size])) for i in range(len(words) - size + 1) if size]
    return out


def _phrase(lists: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Those of ``starts`` at which the terms stand one after another; the rarest lists come first."""
    for i in sorted(range(len(lists)), key=lambda i: len(lists[i])):
        if not len(starts):
            break
        starts = starts[_held(lists[i], starts + i)]
    return starts


def _held(have: np.ndarray, want: np.ndarray) -> np.ndarray:
    at = np.searchsorted(have, want)
    at[at == len(have)] = len(have) - 1
    return have[at] == want


def _near(lists: list[np.ndarray], lead: int, alive: np.ndarray, slop: int) -> np.ndarray:
    """Those of the lead term's places around which the terms stand in order, up to ``slop`` words between neighbours.

    From each place every place the next term can have is followed, to the
    right and to the left, so no match is missed.
    """
    wide = 2 * (len(lists) * (slop + 1) + 1)  # a place is written as its anchor times this plus its distance
    for path, sign in ((range(lead + 1, len(lists)), 1), (range(lead - 1, -1, -1), -1)):
        code = alive * wide + wide // 2
        for i in path:
            if not len(code):
                break
            place = code // wide + code % wide - wide // 2
            code = np.unique(np.concatenate([(code + sign * d)[_held(lists[i], place + sign * d)] for d in range(1, slop + 2)]))
        alive = np.unique(code // wide)
    return alive


def _searcher(windows: list[tuple[str, tuple[bytes, ...]]], slop: int | None):
    by_phrase: dict[tuple[bytes, ...], set[str]] = {}
    for item, phrase in windows:
        by_phrase.setdefault(phrase, set()).add(item)
    number = {t: i for i, t in enumerate(dict.fromkeys(t for phrase in by_phrase for t in phrase))}
    by_width: dict[int, list[tuple[bytes, ...]]] = {}
    for phrase in by_phrase:
        by_width.setdefault(len(phrase), []).append(phrase)
    tables = [(np.array([[number[t] for t in phrase] for phrase in same]), same) for same in by_width.values()]
    reach = 1 + (slop or 0)

    def search(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        meta = rows[rows["kind"] == 1]
        count = int(meta["n"].iloc[0])
        raw = meta["offsets"].iloc[0]
        ids, lengths = np.frombuffer(raw, np.int64, count), np.frombuffer(raw, np.int64, count, 8 * count)
        starts = np.concatenate(([0], np.cumsum(lengths + GAP)[:-1]))
        terms = rows[rows["kind"] == 0]
        lists: list[np.ndarray | None] = [None] * len(number)
        sizes = np.zeros(len(number), dtype=np.int64)
        for t, o in zip(terms["term"], terms["offsets"], strict=True):
            i = number[t]
            lists[i] = np.frombuffer(o, np.int32).astype(np.int64)
            sizes[i] = len(lists[i])
        spans: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        items: dict[int, set[str]] = {}
        near: dict[int, set[str]] = {}
        for table, phrases in tables:
            counts = sizes[table]
            there = np.flatnonzero(counts.min(axis=1))
            ranked = np.argsort(counts[there], axis=1, kind="stable")[:, :2].tolist()
            for w, rare in zip(there.tolist(), ranked, strict=True):
                these, width = [lists[i] for i in table[w].tolist()], table.shape[1]
                lead = rare[0]
                alive = these[lead]
                if width > 1:  # the second rarest term has to be within reach
                    step = rare[1] - lead
                    near_by, far = (step, step * reach) if step > 0 else (step * reach, step)
                    other = these[rare[1]]
                    alive = alive[np.searchsorted(other, alive + far, "right") > np.searchsorted(other, alive + near_by)]
                if not len(alive):
                    continue
                own = by_phrase[phrases[w]]
                found = _phrase(these, alive - lead)
                if len(found):
                    doc = np.searchsorted(starts, found, "right") - 1
                    spans.append(np.stack([found, found + width], axis=1))
                    owners.append(doc)
                    for d in np.unique(doc).tolist():
                        items.setdefault(d, set()).update(own)
                    if slop is not None:
                        for d in np.unique(doc).tolist():
                            near.setdefault(d, set()).update(own)
                        alive = np.setdiff1d(alive, found + lead, assume_unique=True)
                if slop is not None and len(alive) and len(close := _near(these, lead, alive, slop)):
                    for d in np.unique(np.searchsorted(starts, close, "right") - 1).tolist():
                        near.setdefault(d, set()).update(own)
        hit = np.zeros(count, dtype=np.int64)
        if spans:
            both, doc = np.concatenate(spans), np.concatenate(owners)
            order = np.lexsort((both[:, 1], both[:, 0]))
            both, doc = both[order], doc[order]
            # documents lie GAP apart, so an earlier document's end never reaches the next one's spans
            before = np.concatenate(([0], np.maximum.accumulate(both[:, 1])[:-1]))
            np.add.at(hit, doc, np.maximum(0, both[:, 1] - np.maximum(both[:, 0], before)))
        empty: set[str] = set()
        nulls = meta["term"].iloc[0]
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if z else i for i, z in zip(ids.tolist(), nulls, strict=True)], dtype="Int64"),
                "shard": int(meta["shard"].iloc[0]),
                "place": np.arange(count),
                "n_words": lengths,
                "n_hit": hit,
                "spans": [None] * count if not spans else _per_doc(count, both, doc, starts),
                "items": [sorted(items.get(d, empty)) for d in range(count)],
                "near_items": [sorted(near.get(d, empty)) for d in range(count)],
            }
        )

    return search


def _per_doc(count: int, spans: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> list[list[int] | None]:
    out: list[list[int] | None] = [None] * count
    for (a, b), d in zip(spans.tolist(), doc.tolist(), strict=True):
        own = out[d]
        if own is None:
            own = out[d] = []
        own += [a - int(starts[d]), b - int(starts[d])]
    return out


HITS = "doc_id long, shard long, place long, n_words long, n_hit long, spans array<long>, items array<string>, near_items array<string>"


def search(index: DataFrame, benchmark: DataFrame, width: int = WINDOW, slop: int | None = None) -> DataFrame:
    """One row per indexed document: hit words, word spans and items found exactly, and items found within ``slop``."""
    spark = index.sparkSession
    items = text_bytes(benchmark, F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"))
    size = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    slot = F.pmod(F.xxhash64("body"), F.lit(blocks))
    found = None
    for b in range(blocks):
        windows = _windows([tuple(r) for r in items.where(slot == b).collect()], width)  # of bounded size
        terms = sorted({t for _, phrase in windows for t in phrase})
        wanted = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term binary"))
        # One row per term of the block: at most BLOCK_BYTES of them.
        rows = index.where("kind = 0").join(wanted, "term", "left_semi").select(*index.columns).unionByName(index.where("kind = 1"))
        here = rows.repartition(shuffle_partitions(spark), "shard").groupBy("shard").applyInPandas(_searcher(windows, slop), HITS)
        found = here if found is None else found.unionByName(here)
    if blocks == 1:
        return found
    merged = found.groupBy("shard", "place").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"),
    )
    return merged.mapInPandas(_recount, HITS)


def _recount(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words that the spans of all blocks cover together."""
    for rows in batches:
        hits = []
        for flat in rows["spans"]:
            pairs = sorted(np.asarray(flat if flat is not None else [], dtype=np.int64).reshape(-1, 2).tolist())
            reach = total = 0
            for a, b in pairs:
                total += max(0, b - max(a, reach))
                reach = max(reach, b)
            hits.append(total)
        yield rows.assign(n_hit=hits)[["doc_id", "shard", "place", "n_words", "n_hit", "spans", "items", "near_items"]]


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slop: int | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Index ``docs``, search ``benchmark`` in it; one row per document."""
    return search(build_index(docs, shard_tokens), benchmark, width, slop).drop("shard", "place")


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from ``decontaminate``'s."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )
