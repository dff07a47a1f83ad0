"""Multiset scores of detected operations against ground truth, and costs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consolida.functions.identifiers import sort_fragment
from consolida.functions.texts import low_severity


def operation_key(ops: DataFrame) -> DataFrame:
    """The five values by which operations are compared, without low-severity and other kinds."""
    rows = ops.where(F.col("operation_type").isin("ADD", "REPLACE", "REMOVE"))
    if "error_codes" in ops.columns:
        rows = rows.where(~low_severity(F.col("error_codes")))
    return rows.select("aiot", "source_decree", sort_fragment(F.col("source_article")).alias("source_number"), "target_decree", sort_fragment(F.col("target_article")).alias("target_number"), "operation_type")


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def scores(detected: DataFrame, truth: DataFrame, by: str, keys: Sequence[str]) -> DataFrame:
    """tp, fp, fn, precision, recall and f1 per ``by`` and, with a null ``by``, in all (micro).

    Both sides are counted before they meet, so the join sees one row per key.
    """
    counted = lambda df, name: df.groupBy(by, *keys).agg(F.count("*").alias(name))
    d = counted(detected, "d").withColumn("g", F.lit(0).cast("long"))
    g = counted(truth, "g").withColumn("d", F.lit(0).cast("long"))
    met = d.unionByName(g).groupBy(by, *keys).agg(F.sum("d").alias("d"), F.sum("g").alias("g"))
    sums = [F.sum(F.least("d", "g")).alias("tp"), F.sum("d").alias("nd"), F.sum("g").alias("ng")]
    rows = met.groupingSets([[by], []], by).agg(*sums, F.grouping(by).alias("is_total"))
    tp, nd, ng = (F.coalesce(F.col(c), F.lit(0)) for c in ("tp", "nd", "ng"))
    p, r = ratio(tp, nd), ratio(tp, ng)
    return rows.select(F.when(F.col("is_total") == 1, F.lit("TOTAL")).otherwise(F.col(by).cast("string")).alias(by), tp.alias("tp"), (nd - tp).alias("fp"), (ng - tp).alias("fn"), p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1"))


def costs(usage: DataFrame, rates: DataFrame, by: str) -> DataFrame:
    """Tokens and cost per ``by`` and in all; models without a rate cost nothing.

    ``usage``: by, model, tokens_in, tokens_out; ``rates``: model, cost_in, cost_out for a million tokens.
    """
    rows = usage.join(rates, "model", "left")
    cost = (F.col("tokens_in") * F.coalesce("cost_in", F.lit(0.0)) + F.col("tokens_out") * F.coalesce("cost_out", F.lit(0.0))) / 1e6
    out = rows.groupingSets([[by], []], by).agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.sum(cost).alias("cost"), F.grouping(by).alias("_all"))
    return out.withColumn(by, F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col(by).cast("string"))).drop("_all")


#: Columns of a score sheet in their order.
SHEET = ("aiot", "truth", "detected", "validated", "tp", "fp", "fn", "precision", "recall", "f1", "seconds", "tokens_in", "tokens_out", "cost")


def sheet(detected: DataFrame, classified: DataFrame, truth: DataFrame, usage: DataFrame, rates: DataFrame, seconds: DataFrame) -> DataFrame:
    """The score sheet of an evaluation: a row per aiot with ground truth, and one in all.

    ``detected``: operations as found; ``classified``: the same with the codes
    of their conflicts, of which those of low severity alone do not count;
    ``usage``: aiot, model, tokens_in, tokens_out; ``seconds``: aiot, seconds.
    Operations of an aiot without ground truth are left out.
    """
    known = truth.select("aiot").distinct()
    inside = lambda df: df.join(known, "aiot", "left_semi")
    detected, classified = inside(detected), inside(classified)
    kinds = F.col("operation_type").isin("ADD", "REPLACE", "REMOVE")
    counts = [
        (truth.where(kinds), "truth"),
        (detected, "detected"),
        (classified.where(~low_severity(F.col("error_codes"))), "validated"),
    ]
    found = scores(operation_key(classified), operation_key(truth), "aiot", ["source_decree", "source_number", "target_decree", "target_number", "operation_type"])
    blank = known.select("aiot").unionByName(known.sparkSession.createDataFrame([("TOTAL",)], "aiot string"))
    out = blank.join(found, "aiot", "left")
    for rows, name in counts:
        sums = rows.groupingSets([["aiot"], []], "aiot").agg(F.count("*").alias(name), F.grouping("aiot").alias("_all"))
        out = out.join(sums.select(F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col("aiot")).alias("aiot"), name), "aiot", "left")
    out = out.join(costs(inside(usage), rates, "aiot"), "aiot", "left")
    times = inside(seconds).groupingSets([["aiot"], []], "aiot").agg(F.sum("seconds").alias("seconds"), F.grouping("aiot").alias("_all"))
    out = out.join(times.select(F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col("aiot")).alias("aiot"), "seconds"), "aiot", "left")
    return out.select("aiot", *(F.coalesce(c, F.lit(0)).alias(c) for c in SHEET[1:]))
