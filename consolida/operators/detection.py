"""Operations that a model finds in decrees: chunks, one call a chunk, checks, a second call where replies are unsure, operands."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.functions.texts import images_in, json_list
from consolida.operators import trees
from consolida.operators.chunking import SOFT_TARGET, WINDOW, chunks
from consolida.operators.relations import start_filter
from consolida.operators.validation import raw_reject_reason
from consolida.plans.storage import stored
from consolida.sources.model_calls import DETECTION, CallSettings, detection_prompt, with_replies

#: Fields of a reply's objects.
ELEMENT = "struct<operation_type:string,source_article:string,target_arrete:string,target_article:string,sub_target:string,new_content_start_marker:string,new_content_end_marker:string,confidence_score:int,origin:string>"
KEYS = ["aiot", "decree_id", "chunk_index"]


def _found(chunks: DataFrame, call: Callable[[str, str], str], settings: CallSettings | None, attempt: int) -> DataFrame:
    """(the chunks' columns, usage, attempt, place, op): one row per object in a reply, one without an object for an empty reply."""
    asked = with_replies(chunks.withColumn("_prompt", detection_prompt(F.col("html"), F.col("decree_id"))), "_prompt", call, settings)
    ops = asked.select(*chunks.columns, "model", "tokens_in", "tokens_out", "seconds", "call_error", F.posexplode_outer(json_list(F.col("reply"), ELEMENT)).alias("place", "op"))
    return stored(ops.withColumn("attempt", F.lit(attempt)), "detected")


def _checked(found: DataFrame) -> DataFrame:
    """Objects of replies as raw operations of their decree, with the reason why one is none."""
    raw = found.select("*", F.col("decree_id").alias("source_arrete"), "op.source_article", "op.target_arrete", "op.target_article", "op.operation_type")
    return raw.withColumn("reject_reason", F.when(F.col("op").isNotNull(), raw_reject_reason())).drop("source_arrete", "source_article", "target_arrete", "target_article", "operation_type")


class Detected:
    """``operations``: raw operations in order of chunk and reply; ``rejected``: objects that are none; ``usage``: tokens by chunk and attempt."""

    def __init__(self, operations: DataFrame, rejected: DataFrame, usage: DataFrame):
        self.operations, self.rejected, self.usage = operations, rejected, usage


def run(chunks: DataFrame, call: Callable[[str, str], str], settings: CallSettings | None = None, threshold: int | None = 70, retry: bool = False) -> Detected:
    """Raw operations of ``chunks`` (aiot, decree_id, chunk_index, html, and images where they gave way to names).

    Objects out of form are rejected with their reason first.  Operations below
    the confidence threshold go; one without a score stays.  With ``retry`` a
    chunk with such operations is asked once more, and the second reply counts.
    A null or empty reply, and a call that failed, has no operations.
    """
    found = _checked(_found(chunks, call, settings, 1))
    tokens = found.select(*KEYS, "attempt", "model", "tokens_in", "tokens_out", "seconds", "call_error").distinct()
    valid = F.col("op").isNotNull() & F.col("reject_reason").isNull()
    unsure = valid & F.coalesce(F.col("op.confidence_score") < (threshold if threshold is not None else 0), F.lit(False))
    if retry:
        again = stored(found.where(unsure).select(*KEYS).distinct(), "unsure")
        second = _checked(_found(chunks.join(again, KEYS, "left_semi"), call, settings, 2))
        tokens = tokens.unionByName(second.select(*tokens.columns).distinct())
        found = found.join(again, KEYS, "left_anti").unionByName(second)
    rejected = found.where(F.col("reject_reason").isNotNull()).select(*KEYS, "attempt", "place", F.to_json("op").alias("op"), "reject_reason")
    kept = found.where(valid & ~unsure)
    begin, end = F.nullif("op.new_content_start_marker", F.lit("")), F.nullif("op.new_content_end_marker", F.lit(""))
    section = trees.find_section(F.col("html"), F.col("op.source_article"))
    operand = F.when(begin.isNotNull() & end.isNotNull(), trees.operand_between(section, F.col("html"), begin, end))
    if "images" in chunks.columns:
        operand = images_in(operand, F.col("images"))
    raw = kept.select(
        *KEYS, "attempt", "place", F.coalesce("op.origin", F.lit("LLM")).alias("origin"), F.col("decree_id").alias("source_arrete"), "op.source_article", "op.target_arrete", "op.target_article",
        "op.operation_type", "op.sub_target", "op.confidence_score", operand.alias("operand"),
    )
    return Detected(raw, rejected, tokens)


def detect(chunks: DataFrame, call: Callable[[str, str], str], settings: CallSettings | None = None, threshold: int | None = 70, retry: bool = False) -> DataFrame:
    """The operations of ``run``."""
    return run(chunks, call, settings, threshold, retry).operations


def included(decrees: DataFrame, ids: Sequence[str] | None) -> DataFrame:
    """Decrees with one of the given ids; all without any given."""
    return decrees if ids is None else decrees.where(F.col("decree_id").isin(*ids))


def of_decrees(
    decrees: DataFrame,
    call: Callable[[str, str], str],
    settings: CallSettings | None = None,
    start: str | None = None,
    threshold: int | None = 70,
    retry: bool = False,
    soft: int = SOFT_TARGET,
    window_tokens: int = WINDOW,
) -> Detected:
    """Operations of the decrees after the start date, by default after the first of their aiot."""
    return run(chunks(start_filter(decrees, start), soft, window_tokens, len(DETECTION)), call, settings, threshold, retry)
