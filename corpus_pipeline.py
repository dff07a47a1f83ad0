"""Training-data pipeline over ``documents``: five stages, each on all that the one before kept.

1. quality: importance resampling; documents it does not keep go.
2. near_duplicates: 5-word shingles, similarity 0.8; of each group the document
   with the smallest doc_id stays (a null id is above all, of equal ids the first
   row stays).
3. decontamination: documents that hold a benchmark window go.
4. secrets: every secret is masked in the text; no document goes.
5. packing: pieces of at most 2048 tokens, packed into sequences.

All stages but the last return the columns of documents.

Stages 2 and 3 judge rows, not ids: rows of one id with other texts, and rows
without an id, go or stay each by its own text; of rows that are the same one
stays.  Null and empty texts are like nothing and hold no window or secret; they
stay until packing, which gives each a piece of one separator.  Columns besides
those named here are carried along whatever their names (but for ``_row``).  An
empty table gives no pieces.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consolida.llm import decontamination, importance, jaccard_join, packing, secrets
from consolida.llm.common import forget, materialise, read, shared_dir

#: Column of the rows' numbers within a stage.
ROW = "_row"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return importance.select(docs, read(spark, sf_dir, "labels")).rows(docs)


def numbered(docs: DataFrame) -> DataFrame:
    """The rows stored with a number each in ``ROW``: ids may be null or stand for several texts."""
    return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    return rows.join(materialise(gone, "gone").hint("merge"), ROW, "left_anti").drop(ROW)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    found = jaccard_join.near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text"), k=5, num=4, den=5)
    found = found.select(F.col("doc_id").alias(ROW), "component_id").join(rows.select(ROW, "doc_id"), ROW)
    found = materialise(found, "found")
    least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(ROW)))
    groups = found.groupBy("component_id").agg(least.alias("least"), F.count("*").alias("n")).where("n > 1")
    others = found.join(groups, "component_id").where(F.col(ROW) != F.col(f"least.{ROW}"))
    return without(rows, others.select(ROW))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    found = decontamination.decontaminate(rows.select(F.col(ROW).alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    return without(rows, found.where("n_hit > 0").select(F.col("doc_id").alias(ROW)))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Sampling, components and packing are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != STAGES[0][0]:
            forget(before)
    return docs
