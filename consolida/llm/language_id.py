"""Language identification with language-bitmask n-gram filters.

The model is one bit-sliced Bloom filter: a table of 64-bit masks, one slice
(bit) per language, and one such table for every 64 languages.  An n-gram sets its languages' bits at ``HASHES`` places;
the AND of the masks at those places returns all languages that contain it at
once.  A document's n-grams give a count per language; each slice's fill gives
its false-positive rate, which is taken out of the counts before they decide.

n-grams are ``GRAM`` bytes of the UTF-8 text, A-Z lowered and runs of other
ASCII characters than letters made one blank.  A language contains an n-gram
when its share there is at least ``SHARE`` of the largest share any language
has, and it occurs ``LEAST`` times.  Counts cover all training rows; the n-gram
table is summed by Spark, and only the filter reaches the driver.  It has as
many slots as the n-grams ask for, 8 MB to 128 MB for every 64 languages; a
fuller filter has more false positives, which the correction takes out.

Texts that are null or have no letter are ``und`` with score 0; so is every
text when nothing was learned.  Ties go to the language with more training
documents, then to the first by name.  A null doc_id trains nothing and is held out.  Repeated rows are separate documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consolida.llm.common import U64, materialise, mixed

GRAM = 4
SHARE, LEAST = 0.3, 3
HASHES = 3
#: Slots of the filter: the power of two that holds ``SPARE`` for each place an n-gram may take, between these.
LEAST_BITS, MOST_BITS, SPARE = 20, 24, 2
FOLDS = 5
#: A-Z lowered, other ASCII but letters made blanks.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, n_grams long"


def grams(body: bytes) -> np.ndarray:
    """The n-grams of a text as integers, in order, with repeats."""
    clean = b" " + b" ".join(body.translate(_TABLE).split()) + b" "
    raw = np.frombuffer(clean, np.uint8).astype(np.uint32)
    if len(raw) < GRAM:
        return np.empty(0, np.uint32)
    n = len(raw) - GRAM + 1
    out = raw[:n].copy()
    for i in range(1, GRAM):
        out = out << np.uint32(8) | raw[i : n + i]
    return out


def slots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """Places of each n-gram in a filter of ``2 ** bits`` slots."""
    h = mixed(keys.astype(U64) + U64(1))
    step = h >> U64(33) | U64(1)
    mask = U64((1 << bits) - 1)
    return [((h + step * U64(i)) & mask).astype(np.int64) for i in range(HASHES)]


def fold(doc_id: Column) -> Column:
    """Remainder of crc32(doc_id as text) by the number of folds."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of each task, merged as texts come."""
    held: dict[str, list[np.ndarray]] = {}
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    size = 0

    def merge() -> None:
        for lang, parts in held.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            if lang in sums:
                both = np.concatenate([sums[lang][0], keys])
                keys, at = np.unique(both, return_inverse=True)
                counts = np.bincount(at, np.concatenate([sums[lang][1], counts])).astype(np.int64)
            sums[lang] = keys, counts
        held.clear()

    for batch in batches:
        for lang, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            g = grams(body)
            held.setdefault(lang, []).append(g)
            size += len(g)
            if size > 4_000_000:
                merge()
                size = 0
    merge()
    for lang, (keys, counts) in sums.items():
        for lo in range(0, len(keys), 50_000):
            part = slice(lo, lo + 50_000)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(keys[part]), "gram": keys[part].astype(np.int64), "n": counts[part].astype(np.int64)})


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    false: np.ndarray

    def predict(self, body: bytes) -> tuple[str, float, int]:
        if not self.languages or not any(c.isalpha() for c in body.decode(errors="replace")):
            return "und", 0.0, 0
        g = grams(body)
        masks = np.full((len(self.table), len(g)), ~U64(0))
        for at in slots(g, self.table.shape[1].bit_length() - 1):
            masks &= self.table[:, at]
        hits = np.array([np.count_nonzero(masks[i // 64] >> U64(i % 64) & U64(1)) for i in range(len(self.languages))], dtype=float)
        true = np.maximum(0.0, (hits - len(g) * self.false) / np.maximum(1 - self.false, 1e-9))
        best = int(np.argmax(true))
        total = float(true.sum())
        return self.languages[best], float(true[best]) / total if total else 0.0, len(g)


def train(rows: DataFrame) -> Model:
    """Learn from the ``lang`` and ``text`` of all ``rows``; rows without either teach nothing."""
    rows = rows.where("lang is not null and text is not null").select("lang", F.col("text").cast("binary").alias("body"))
    languages = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    words = -(-len(languages) // 64)
    if not languages:
        return Model([], np.zeros((0, 1 << LEAST_BITS), U64), np.zeros(0))
    counted = rows.mapInArrow(_counted, "lang string, gram long, n long")
    per = materialise(counted.groupBy("gram", "lang").agg(F.sum("n").alias("n")), "grams")
    places = SPARE * HASHES * per.select("gram").distinct().count()
    bits = min(MOST_BITS, max(LEAST_BITS, (places - 1).bit_length()))
    totals = {r["lang"]: r["n"] for r in per.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    of = [(lang, i // 64, 1 << i % 64 if i % 64 < 63 else -(1 << 63), 1.0 / totals[lang]) for i, lang in enumerate(languages) if totals.get(lang)]
    if of:
        per = per.join(F.broadcast(rows.sparkSession.createDataFrame(of, "lang string, word int, bit long, part double")), "lang")
        most = per.withColumn("share", F.col("n") * F.col("part")).groupBy("gram").agg(F.collect_list(F.struct("share", "n", "word", "bit")).alias("all"), F.max("share").alias("top"))
        owned = most.select("gram", F.filter("all", lambda x: (x["share"] >= SHARE * F.col("top")) & (x["n"] >= LEAST)).alias("owned"))
        masks = F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda w: F.aggregate(F.filter("owned", lambda x: x["word"] == w), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x["bit"])))
        owners = owned.select("gram", F.posexplode(masks).alias("word", "mask")).where("mask <> 0")
        filled = owners.mapInArrow(lambda it: _placed(it, bits), "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
    table = np.zeros((words, 1 << bits), dtype=U64)
    if of:
        found = filled.toPandas()  # at most one row per slot and word
        table[found["word"].to_numpy(), found["slot"].to_numpy()] = found["mask"].to_numpy().astype(np.int64).view(U64)
    fill = np.array([np.count_nonzero(table[i // 64] >> U64(i % 64) & U64(1)) / table.shape[1] for i in range(len(languages))])
    return Model(languages, table, fill**HASHES)


def _placed(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gram, word, mask = (c.to_numpy() for c in batch.columns)
        if len(gram):
            yield pa.RecordBatch.from_pydict({"slot": np.concatenate(slots(gram, bits)), "word": np.tile(word, HASHES), "mask": np.tile(mask, HASHES)})


def identify(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, counts = zip(*map(shared.value.predict, batch.column(2).to_pylist()), strict=True) if batch.num_rows else ((),) * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())], names=["doc_id", "held_out", "lang_pred", "score", "n_grams"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"))
    return rows.mapInArrow(predict, PREDICTED)


def cross_identify(docs: DataFrame) -> DataFrame:
    """Learn from the training folds of ``docs`` and predict every row."""
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(True))
    return identify(docs, train(docs.where(~held_out)), held_out)


def crc_fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % FOLDS
