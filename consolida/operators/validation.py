"""Predicates, validation and conversion of operations.

An operations table has: aiot, seq, id, origin, source_decree, source_article,
target_decree, target_article, operation_type, operand, sub_type, sub_position,
sub_description, error_codes (sorted, distinct), confidence_score.  Rows that
fail validation keep a ``reject_reason`` instead of ending the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consolida.functions.identifiers import canonical_article, valid_article, valid_decree
from consolida.functions.texts import subtarget

KINDS = {"add": "ADD", "delete": "REMOVE", "remove": "REMOVE", "replace": "REPLACE"}


def by_confidence(rows: DataFrame, least: int, *keys: str) -> DataFrame:
    """Rows whose score is null or at least ``least``; ``had_low`` tells, per ``keys``, whether any was lower."""
    low = F.coalesce(F.col("confidence_score") < least, F.lit(False))
    if not keys:
        return rows.where(~low)
    flag = F.expr(f"bool_or(confidence_score < {int(least)}) OVER (PARTITION BY {', '.join(keys)})")
    return rows.withColumn("had_low", F.coalesce(flag, F.lit(False))).where(~low)


def raw_reject_reason() -> Column:
    """The first of the checks, in their order, that a raw operation fails."""
    return (
        F.when(F.col("source_article").isNull(), F.lit("source_article"))
        .when(F.col("target_article").isNull(), F.lit("target_article"))
        .when(~valid_decree(F.col("source_arrete")), F.lit("source_arrete"))
        .when(~valid_decree(F.col("target_arrete")), F.lit("target_arrete"))
        .when(canonical_article(F.col("source_article")).isNull(), F.lit("source_article_id"))
        .when(canonical_article(F.col("target_article")).isNull(), F.lit("target_article_id"))
        .when(F.lower("operation_type") == "autre", F.lit("autre"))
        .when(~F.lower("operation_type").isin(*KINDS), F.lit("operation_type"))
    )


def derived_codes(codes: Column, kind: Column, target: Column, sub_type: Column) -> Column:
    """Codes that follow from the shape: a narrow sub-target needs an article; an addition to a whole decree is none."""
    narrow = F.coalesce(sub_type != "FULL_SECTION", F.lit(False))
    empty = F.expr("cast(array() as array<string>)")
    more = F.when((target == "ALL") & narrow, F.array(F.lit("error_extracting_operand"))).when(
        (target == "ALL") & (kind == "ADD") & ~narrow, F.array(F.lit("not_an_operation"))
    )
    return F.array_sort(F.array_distinct(F.concat(F.coalesce(codes, empty), F.coalesce(more, empty))))


def from_raw(raw: DataFrame) -> DataFrame:
    """Raw operations as operations with ``reject_reason``; replacing a whole decree is removing it."""
    known = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    kind = F.try_element_at(known, F.lower("operation_type"))
    target = canonical_article(F.col("target_article"))
    gone = (kind == "REPLACE") & (target == "ALL")
    rows = raw.withColumn("reject_reason", raw_reject_reason()).withColumn("_sub", subtarget(F.col("sub_target")))
    rows = rows.select(
        *(c for c in ("aiot", "seq", "id", "origin", "confidence_score", "reject_reason") if c in raw.columns or c == "reject_reason"),
        F.col("source_arrete").alias("source_decree"),
        canonical_article(F.col("source_article")).alias("source_article"),
        F.col("target_arrete").alias("target_decree"),
        target.alias("target_article"),
        F.when(gone, F.lit("REMOVE")).otherwise(kind).alias("operation_type"),
        F.when(~gone, F.col("operand")).alias("operand") if "operand" in raw.columns else F.lit(None).cast("string").alias("operand"),
        F.col("_sub.type").alias("sub_type"),
        F.col("_sub.position").alias("sub_position"),
        F.col("_sub.description").alias("sub_description"),
    )
    return rows.withColumn("error_codes", derived_codes(F.lit(None), F.col("operation_type"), F.col("target_article"), F.col("sub_type")))


def tagged(raw: DataFrame) -> DataFrame:
    """Tagged raw operations with canonical articles; a removal without a target means the whole decree, others go."""
    target = canonical_article(F.col("target_article"))
    removal = F.lower("operation_type").isin("delete", "remove")
    rows = raw.withColumn("source_article", canonical_article(F.col("source_article")))
    rows = rows.withColumn("target_article", F.coalesce(target, F.when(removal, F.lit("ALL"))))
    return rows.where("source_article is not null and target_article is not null")


def characterised() -> Column:
    """Reliable without a language model: a whole decree only to remove it, and content wherever some is needed."""
    kind, target = F.col("operation_type"), F.col("target_article")
    return ((target != "ALL") | (kind == "REMOVE")) & ((kind == "REMOVE") | F.col("operand").isNotNull())


def _full(null_counts: bool) -> Column:
    full = F.col("sub_type") == "FULL_SECTION"
    return F.coalesce(full, F.lit(null_counts))


def is_full_removal() -> Column:
    return (F.col("target_article") == "ALL") & F.col("operation_type").isin("REMOVE", "REPLACE") & _full(True) & (F.size("error_codes") == 0)


def is_unambiguous() -> Column:
    return F.array_contains("error_codes", "not_an_operation") | (F.col("operation_type").isin("REMOVE", "REPLACE") & _full(False))


def is_resolved() -> Column:
    return F.size("error_codes") == 0


def checked(rows: DataFrame) -> DataFrame:
    """Stored operations with a reason for each row that has ids or a kind out of form."""
    reason = (
        F.when(~valid_decree(F.col("source_decree")), F.lit("source_decree"))
        .when(~valid_decree(F.col("target_decree")), F.lit("target_decree"))
        .when(~valid_article(F.col("source_article")), F.lit("source_article"))
        .when(~valid_article(F.col("target_article")), F.lit("target_article"))
        .when(~F.coalesce(F.col("operation_type").isin("ADD", "REMOVE", "REPLACE"), F.lit(False)), F.lit("operation_type"))
    )
    return rows.withColumn("reject_reason", reason)


def with_subtarget(rows: DataFrame, phrase: str, name: str = "sub") -> DataFrame:
    """``rows`` with the parsed sub-target of a phrase; every distinct phrase is parsed once."""
    phrases = rows.select(F.col(phrase).alias("_phrase")).distinct().select("_phrase", subtarget(F.col("_phrase")).alias(name))
    return rows.join(phrases, F.col(phrase).eqNullSafe(F.col("_phrase")), "left").drop("_phrase")
