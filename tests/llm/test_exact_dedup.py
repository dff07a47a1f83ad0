"""Exact duplicates against a dictionary, over one slot and over many."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from consolida.llm import exact_dedup
from consolida.llm.exact_dedup import COUNT, ID, KEY, KNOWN, ROW, WIDTH

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            out[i, keep, len(ids), left == 1 and i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
            left -= i == keep
    return out


def some_rows(n, seed):
    rng = random.Random(seed)
    texts = [None, "", " ", "É", "é", "same", "SAME", "x" * 5000] + [f"text {k}" for k in range(n // 3)]
    return [(i, "hot COPY" if rng.random() < 0.34 else rng.choice(texts)) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize(("leaf_records", "digits", "parts"), [(1 << 16, 4, 1), (20, 2, 5), (5, 3, 7), (1, 1, 2)])
def test_copies(spark, leaf_records, digits, parts):
    rows = some_rows(300, parts)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert Counter(map(tuple, exact_dedup.duplicates(docs, leaf_records, digits).collect())) == plain(rows)


def test_leaves_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "CHUNK", 2)
    records = np.zeros((7, WIDTH), np.uint64)
    records[:, 0] = np.arange(7, dtype=np.uint64) << np.uint64(61)
    sent = list(exact_dedup._sent(records, 9, 4, 0b110, 3))
    assert [to for to, _, _ in sent] == [0, 2, 4, 6] and all(frm == 9 for _, frm, _ in sent)
    assert sum(len(run) for _, _, run in sent) == records.nbytes


def test_ids_null_and_repeated(spark):
    rows = [(None, "a"), (None, "A"), (3, "a"), (3, "A"), (None, "only"), (4, "b"), (4, "b"), (-5, "neg"), (None, "neg")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("body", F.lit("x")).withColumn("run", F.lit(1))
    got = exact_dedup.duplicates(docs).collect()
    assert Counter(map(tuple, got)) == plain(rows)
    assert sum(r["kept"] for r in got) == 4


def test_no_rows(spark):
    assert exact_dedup.duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_digests_that_agree_in_part_stay_apart():
    """Two texts whose SHA-256 (or its first word) agrees, but not the second hash."""
    r = np.zeros((4, WIDTH), np.uint64)
    r[:, 0] = 7
    r[:, KEY - 2] = [1, 2, 1, 2]
    r[:, ID], r[:, KNOWN], r[:, ROW], r[:, COUNT] = [10, 20, 30, 5], 1, range(4), 1
    out = exact_dedup.merged(r)
    assert out[:, [KEY - 2, ID, COUNT]].tolist() == [[1, 30, 2], [2, 20, 2]]
    assert exact_dedup.found_in(r, out).tolist() == [0, 1, 0, 1]


@pytest.mark.parametrize("bits", range(14))
def test_rounds_settle_every_digit_once(bits):
    masks = exact_dedup.rounds(bits)
    assert sum(masks) == (1 << bits) - 1 and all(m.bit_count() <= exact_dedup.DIGITS for m in masks)
