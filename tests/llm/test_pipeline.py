"""The pipeline against a plain version of its stages, and the registered queries."""

from __future__ import annotations

import re

import pandas as pd
import public_tokenizers

import corpus_pipeline
from consolida.llm import importance, jaccard_join, packing, queries, secrets
from consolida.llm.common import read

SF = "/root/testdata/sf0.001"


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]


def test_pipeline_against_brute_force(spark):
    docs = read(spark, SF, "documents")
    kept = importance.classify(docs, read(spark, SF, "labels")).where("kept").select("doc_id")
    rows = docs.join(kept, "doc_id", "left_semi").toPandas()
    component = jaccard_join.brute_force(rows, 5, 4, 5)
    rows = rows[[component[i][1] == i for i in rows["doc_id"]]]
    windows = set()
    for t in read(spark, SF, "benchmark").toPandas()["text"]:
        w = alnum(t)
        n = min(10, len(w))
        windows |= {" " + " ".join(w[a : a + n]) + " " for a in range(len(w) - n + 1) if n}
    rows = rows[[not any(x in " " + " ".join(alnum(t)) + " " for x in windows) for t in rows["text"]]]
    masked = secrets.redact(spark.createDataFrame(rows, docs.schema))
    assert masked.columns == docs.columns
    want = packing.pack(masked, public_tokenizers.path("byte_bpe_50k.json")).toPandas()
    got = corpus_pipeline.run(spark, SF).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pd.testing.assert_frame_equal(got[columns].sort_values(columns).reset_index(drop=True), want[columns].sort_values(columns).reset_index(drop=True))
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048


def test_a_repeated_document_stays_once(spark):
    docs = read(spark, SF, "documents").limit(5)
    out = corpus_pipeline.near_duplicates(spark, docs.unionByName(docs), SF)
    assert out.count() == out.select("doc_id").distinct().count() > 0


def test_entry_has_all(spark):
    import __spark_entry__ as entry

    assert {"pipeline", *queries.QUERIES} <= set(entry.queries())


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], SCHEMA)


def left(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_near_duplicates_judge_rows(spark):
    copy = "one two three four five six seven eight nine ten"
    rows = [(5, "alpha beta gamma delta epsilon zeta"), (5, copy), (4, copy.upper()), (None, copy), (None, "a null id like nothing else at all"), (None, None), (7, ""), (7, ""), (9, copy)]
    want = [(5, "alpha beta gamma delta epsilon zeta"), (4, copy.upper()), (None, "a null id like nothing else at all"), (None, None), (7, ""), (7, "")]
    out = corpus_pipeline.near_duplicates(spark, made(spark, rows), SF)
    assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert left(out) == sorted(want, key=str)


def test_decontamination_judges_rows(spark):
    item = next(r["text"] for r in read(spark, SF, "benchmark").collect() if len(alnum(r["text"])) >= 10)
    rows = [(None, item), (3, "x " + item), (3, "a quite different clean text"), (None, None), (8, ""), (8, "clean too"), (8, "clean too")]
    assert left(corpus_pipeline.decontaminate(spark, made(spark, rows), SF)) == sorted(rows[2:], key=str)


def test_stages_on_an_empty_table(spark):
    docs = made(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
