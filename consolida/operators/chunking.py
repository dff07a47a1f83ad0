"""Packing blocks of a document, in order, into chunks of about a target size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consolida.functions.texts import images_out, minify
from consolida.operators.relations import covered
from consolida.operators.trees import outline
from consolida.plans.storage import stored

#: Sizes of the shipped configuration (fixed values): soft target and least size of a chunk in characters; context window, answer and safety reserve in tokens; characters of a token.
SOFT_TARGET, LEAST, WINDOW, RESERVE, PER_TOKEN = 70_000, 1_000, 128_000, 10_000, 3.0


def chunk_target(length: Column, window_tokens: int = WINDOW, overhead: int = 0, soft: int = SOFT_TARGET) -> Column:
    """Equal share of a document among the chunks it needs; ``overhead``: characters that every prompt adds."""
    most = min(soft, max(int(max(window_tokens - RESERVE, 0) * PER_TOKEN) - overhead, LEAST))
    chunks = F.greatest(F.lit(1), F.ceil(length / F.lit(most)))
    return F.ceil(length / chunks).cast("int")


def chunked(blocks: DataFrame, key: str, place: str, size: str, target: int | str) -> DataFrame:
    """(key, place, chunk) of every block; ``target`` is a size or a column of sizes.

    A chunk ends with the block that fills it, and the next starts empty.  The
    blocks of a document pass one after another, sorted by Spark, so a document
    of any number of blocks takes no more memory than a batch.
    """
    goal = F.lit(target).cast("long") if isinstance(target, int) else F.col(target).cast("long")
    rows = blocks.select(F.col(key).alias("k"), F.col(place).alias("p"), F.col(size).cast("long").alias("size"), goal.alias("goal"))
    rows = rows.repartition("k").sortWithinPartitions("k", "p")
    kinds = dict(rows.dtypes)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, chunk = object(), 0, 0
        for batch in batches:
            out = []
            for k, n, goal in zip(*(batch.column(c).to_pylist() for c in ("k", "size", "goal")), strict=True):
                if k != now:
                    now, at, chunk = k, 0, 0
                out.append(chunk)
                at += n
                if at >= goal:
                    at, chunk = 0, chunk + 1
            yield pa.RecordBatch.from_arrays([*batch.select(["k", "p"]).columns, pa.array(out, pa.int32())], names=["k", "p", "chunk"])

    numbered = rows.mapInArrow(number, f"k {kinds['k']}, p {kinds['p']}, chunk int")
    return numbered.select(F.col("k").alias(key), F.col("p").alias(place), "chunk")


def chunks(decrees: DataFrame, soft: int = SOFT_TARGET, window_tokens: int = WINDOW, overhead: int = 0) -> DataFrame:
    """(aiot, decree_id, chunk_index, html, images): the sections of every decree, in chunks for a model.

    Pages are minified and images give way to names first (``images`` has them).
    Sections with content of their own count, and with them all that they hold;
    those made of sections and titles only are passed over.
    """
    keys = ["aiot", "decree_id"]
    bare = decrees.select(*keys, images_out(minify(F.col("html"))).alias("p")).select(*keys, "p.html", "p.images")
    bare = stored(bare.withColumn("goal", chunk_target(F.length("html"), window_tokens, overhead, soft)), "pages")
    sections = outline(bare, *keys).where("kind = 'section' and own").withColumn("_in", covered(F.lit(True))).where("not _in").select(*keys, "start", "end")
    blocks = sections.join(bare, keys).select(*keys, "start", F.expr("substring(html, start + 1, end - start)").alias("block"), "goal", F.to_json(F.struct(*keys)).alias("doc"))
    blocks = stored(blocks, "blocks")
    numbers = chunked(blocks.withColumn("size", F.length("block")), "doc", "start", "size", "goal")
    parts = blocks.join(numbers, ["doc", "start"]).groupBy(*keys, F.col("chunk").alias("chunk_index")).agg(F.array_sort(F.collect_list(F.struct("start", "block"))).alias("b"))
    whole = F.array_join(F.transform("b", lambda b: b["block"]), "")
    return parts.select(*keys, "chunk_index", whole.alias("html")).join(bare.select(*keys, "images"), keys)
