"""Alignment of two tokenizers against whole texts, token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from consolida.llm import alignment
from consolida.llm.packing import _byte_of_char

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(A, B)


def plain(rows):
    """Each text encoded whole by either library's own reader."""
    a_reader = Tokenizer.from_file(A)
    a_reader.encode_special_tokens = True
    b_reader, byte = sentencepiece.SentencePieceProcessor(model_file=B), _byte_of_char()
    texts = []
    for doc_id, text in rows:
        a = a_reader.encode(" " + text, add_special_tokens=False) if text else None
        a = [(i, bytes(byte[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)] if text else []
        b = [(i, bytes([int(b_reader.id_to_piece(i)[3:5], 16)]) if b_reader.is_byte(i) else b_reader.id_to_piece(i).replace("▁", " ").encode()) for i in b_reader.encode(text)] if text else []
        if any(b"".join(x for _, x in side) != (" " + (text or "")).encode() for side in (a, b)):
            a, b = [], []
        texts.append((doc_id, [spans(a), spans(b)]))
    count, found = Counter(), []
    for doc_id, (a, b) in texts:
        own, j0 = [], 0
        for i, lo, hi in a:
            while j0 < len(b) and b[j0][2] <= lo:
                j0 += 1
            j = j0
            while j < len(b) and b[j][1] < hi:
                own.append((i, b[j][0]))
                j += 1
        count.update(own)
        found.append(own)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = Counter()
    for (doc_id, (a, b)), own in zip(texts, found, strict=True):
        cuts = sorted({hi for _, _, hi in a} & {hi for _, _, hi in b})
        groups = [[",".join(str(i) for i, _, hi in side if lo < hi <= end) for side in (a, b)] for lo, end in zip([0, *cuts], cuts, strict=False)]
        text = ";".join("|".join(g) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out[doc_id, len(a), len(b), len(groups), len(own), sum(count[p] == most[p[1]] for p in own), sum(count[p] for p in own), digest] += 1
    return out


def spans(tokens):
    out, at = [], 0
    for i, token in tokens:
        out.append((i, at, at + len(token)))
        at += len(token)
    return out


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = ["a", "the", "ing", " ", " ", "  ", "\n", "\t", "\r\n", ".", "!", "'s", "7", "42", "é", "é", "🙂", "漢字", " ", " ", "\x1c", "\x85", "\x00", "--------", "Word", "▁"]
    weights = [8] * (len(letters) - 1) + [0.05]
    return ["".join(rng.choices(letters, weights, k=rng.randint(0, 40))) for _ in range(n)]


ODD = [None, "", " ", "  ", "\n", "a ", " a", "x\n\n  y", "a▁b", "<|endoftext|> <s> </s> <unk>", "-" * 900, "漢" * 300, "ab" * 700, "   \n \x1c ", "word " * 500, "ﬁne ½"]


def test_segments_are_encoded_as_in_the_whole(encoders):
    a_reader = Tokenizer.from_file(A)
    a_reader.encode_special_tokens = True
    assert encoders.local
    for text in [t for t in ODD if t] + random_texts(3000, 1):
        if text:
            segments = encoders.segments(text)
            assert "".join(segments) == " " + text
            assert [i for s in segments for i in encoders.a(s)] == a_reader.encode(" " + text, add_special_tokens=False).ids, text
            if "▁" not in text:  # else there are no tokens
                assert [i for ids in encoders.b_ids(segments) for i in ids] == encoders.b.encode(text), text


@pytest.mark.parametrize(("block_chars", "pairs", "cell"), [(1 << 25, 1 << 20, 64), (300, 0, 4), (1, 10, 1)])
def test_against_whole_texts(spark, monkeypatch, block_chars, pairs, cell):
    monkeypatch.setattr(alignment, "CELL", cell)
    texts = ODD + random_texts(200 if block_chars > 1 else 40, block_chars) * 2
    rows = list(enumerate(texts)) + [(3, "word a"), (None, "a null id"), (3, "word a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit(1)).withColumn("block", F.lit("x")).repartition(3)
    got = alignment.align(docs, A, B, block_chars=block_chars, pairs=pairs).collect()
    assert Counter(map(tuple, got)) == plain(rows)


def test_groups_as_text(spark):
    docs = spark.createDataFrame([(1, "unbelievable things"), (2, "unbelievable")], "doc_id long, text string")
    got = {r["doc_id"]: r["groups"] for r in alignment.align(docs, A, B, digest=False).collect()}
    assert got[1].startswith(got[2] + ";") and got[2].count("|") == 1 + got[2].count(";")


def test_hashes_that_agree(spark):
    """Segments of one hash are told apart by their number."""
    columns = "h long, k int, segment string, n long, a array<int>, la array<int>, b array<int>, lb array<int>"
    rows = [(7, 0, "xy", 2, [1], [2], [5, 6], [1, 1]), (7, 1, "abc", 3, [1, 2], [1, 2], [5], [3])]
    distinct = spark.createDataFrame(rows, columns)
    a_ends, b_ends = alignment.grouped_ends(distinct, "a", "la", "b", "lb"), alignment.grouped_ends(distinct, "b", "lb", "a", "la")
    got = Counter((r["k"], r["a"], r["b"], r["n"]) for r in alignment.links(a_ends, b_ends).collect())
    assert got == Counter([(0, 1, 5, 2), (0, 1, 6, 2), (1, 1, 5, 3), (1, 2, 5, 3)])
    masks = {r["k"]: (r["n_groups"], r["mask"]) for r in alignment.cut_masks(a_ends).collect()}
    assert masks == {0: (1, 2), 1: (1, 4)}


def test_no_rows(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
