"""License scans: exact phrases, and short notices with a bounded number of errors.

A text becomes its words joined by single blanks.  A notice that may have ``e``
errors is split into ``e + 1`` pieces; a match with at most ``e`` errors leaves
one of them intact, so exact finds of the pieces locate every candidate, and
the regex library's bounded-error matching verifies the stretch around each.

Null and empty texts have no words and no labels; a null doc_id is carried
along; repeated rows are separate documents; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.llm.common import alnum_words, rows_of, text_bytes

#: Phrases that are matched as they are, and their labels (fixed values).
PHRASES = (
    (b"gnu general public license", "gpl"),
    (b"apache license", "apache"),
    (b"cc by", "cc-by"),
    (b"mit license", "mit"),
)
#: (notice, errors allowed, label); few enough that no other word of a notice's length fits in place of one of its words.
NOTICES = (
    (b"gnu general public license", 3, "gpl"),
    (b"gnu lesser general public license", 3, "lgpl"),
    (b"licensed under the apache license version 2 0", 5, "apache"),
    (b"apache license", 1, "apache"),
    (b"released under the mit license", 2, "mit"),
    (b"mit license", 1, "mit"),
    (b"permission is hereby granted free of charge to any person obtaining a copy", 7, "mit"),
    (b"redistribution and use in source and binary forms", 5, "bsd"),
    (b"mozilla public license", 2, "mpl"),
    (b"creative commons attribution", 2, "cc-by"),
    (b"all rights reserved", 1, "reserved"),
)
FOUND = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, spans array<struct<label:string,first_word:long,last_word:long,errors:int,exact:boolean>>"


def pieces(notice: bytes, errors: int) -> list[tuple[int, bytes]]:
    """``errors + 1`` pieces of about equal length, with their places."""
    cut = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


def pattern(notice: bytes, errors: int) -> regex.Pattern:
    """The notice between blanks with at most ``errors`` errors; the first word of one with a single error has none."""
    first, rest = notice.split(b" ", 1)
    firm, loose = (first, b" " + rest) if errors == 1 else (b"", notice)
    return regex.compile(rb"(?b)(?<= )" + regex.escape(firm) + rb"(?:" + regex.escape(loose) + rb"){e<=" + str(errors).encode() + rb"}(?= )")


def places(text: bytes, part: bytes) -> Iterator[int]:
    at = text.find(part)
    while at >= 0:
        yield at
        at = text.find(part, at + 1)


class Scanner:
    def __init__(self, notices: Iterable[tuple[bytes, int, str]] = NOTICES):
        self.notices = [
            (notice, errors, label, pieces(notice, errors), pattern(notice, errors))
            for notice, errors, label in notices
        ]

    def fuzzy(self, text: bytes) -> list[tuple[int, int, int, str]]:
        """(begin, end, errors, label) of verified matches in a text that has a blank at either end."""
        found = set()
        for notice, errors, label, parts, pattern in self.notices:
            reach = -1
            for at in sorted({at - offset for offset, part in parts for at in places(text, part)}):
                if at + len(notice) + errors <= reach:
                    continue
                begin, end = max(0, at - errors - 1), min(len(text), at + len(notice) + 2 * errors + 2)
                for m in pattern.finditer(text, begin, end):
                    lead = len(m[0]) - len(m[0].lstrip(b" "))
                    found.add((m.start() + lead, m.end(), sum(m.fuzzy_counts), label))
                    reach = m.end()
        return sorted(found)

    def scan(self, body: bytes) -> tuple:
        words = alnum_words(body)
        text = b" " + b" ".join(words) + b" "
        spans, base, firsts = [], set(), []
        for phrase, label in PHRASES:
            for at in places(text, b" " + phrase + b" "):
                spans.append((at + 1, at + 1 + len(phrase), 0, label, True))
        found, top = set(), 0.0
        for begin, end, errors, label in self.fuzzy(text):
            spans.append((begin, end, errors, label, False))
            found.add(label)
            top = max(top, 1 - errors / (end - begin + errors))
        spans.sort()
        out, index, seen = [], 0, 0
        for begin, end, errors, label, exact in spans:
            index += text.count(b" ", seen, begin)
            seen = begin
            first = index - 1
            if exact:
                base.add(label)
                firsts.append(first)
                top = 1.0
            out.append((label, first, first + text.count(b" ", begin, end), errors, exact))
        return len(words), len(firsts), min(firsts, default=None), max(firsts, default=None), sorted(base), sorted(base | found), top, out


def _scanned(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        spans = [[dict(zip(("label", "first_word", "last_word", "errors", "exact"), s, strict=True)) for s in x] for x in columns[8]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*columns[:8], spans], schema, strict=True)], schema=schema)

    for doc_id, body in rows_of(batches, "doc_id", "body"):
        rows.append((doc_id, *scanner.scan(body)))
        if len(rows) == 5000:
            yield flush()
            rows.clear()
    if rows:
        yield flush()


_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64())]
    + [("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int32()), ("exact", pa.bool_())])))]
)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with its phrases, labels and spans (words from 0)."""
    rows = text_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    return rows.mapInArrow(lambda it: _scanned(it, _SCHEMA), FOUND)


def digest(found: DataFrame) -> DataFrame:
    """The query's columns; ``spans``: label:first word:last word:errors of every place, comma-joined."""
    names = ("base_labels", "labels")
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first_word"], s["last_word"], s["errors"]))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *(F.array_join(n, ",").alias(n) for n in names), "score", F.array_join(spans, ",").alias("spans"))
