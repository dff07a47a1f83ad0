"""Connected components of a distributed edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.llm.common import forget, materialise


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node with a neighbour, for ``edges`` (a, b); component: its smallest node.

    Each step hangs nodes under the smallest neighbour they know of.  Only
    minima are aggregated, so no neighbourhood is gathered anywhere; every step
    is written to the shared folder, which also cuts the lineage.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = materialise(pairs, "edges")
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u <> v").distinct(), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        met = large.join(low, F.col("u") == F.col("k"))
        small = met.select("u", F.col("m").alias("v")).unionByName(met.select(F.col("v").alias("u"), F.col("m").alias("v")))
        old, pairs = pairs, materialise(small.where("u <> v").distinct(), "edges")
        forget(old, large)
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _state(pairs: DataFrame) -> tuple:
    """Number of edges and a sum over them: equal when a step changed nothing."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    row = pairs.agg(F.count("*").alias("n"), F.sum(h).alias("h")).first()
    return row["n"], row["h"]
