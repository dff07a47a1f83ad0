"""Writers of operations, histories, permits, tagged pages and scores."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consolida.functions.identifiers import node_key, sort_key
from consolida.operators.relations import numbered
from consolida.sources import site_files


def operation_json(ops: DataFrame) -> DataFrame:
    """One JSON object per operation; nulls and empty code sets are left out."""
    node = lambda side: F.struct(F.col(f"{side}_decree").alias("arrete_id"), F.col(f"{side}_article").alias("article_id"))
    sub = F.when(F.col("sub_type").isNotNull(), F.struct(F.col("sub_type").alias("type"), F.col("sub_position").alias("position"), F.col("sub_description").alias("description")))
    value = F.struct("id", "origin", node("source").alias("source_id"), node("target").alias("target_id"), "operation_type", "operand", sub.alias("sub_target"), F.when(F.size("error_codes") > 0, F.array_sort("error_codes")).alias("error_codes"), "confidence_score")
    return ops.select("aiot", "seq", F.to_json(value).alias("value"))


@F.pandas_udf(T.StringType())
def pretty(value: pd.Series, depth: pd.Series) -> pd.Series:
    """JSON text with sorted keys, two blanks a level, at a depth of its own."""
    return pd.Series([None if v is None else json.dumps(json.loads(v), ensure_ascii=False, indent=2, sort_keys=True).replace("\n", "\n" + "  " * d) for v, d in zip(value, depth, strict=True)], dtype=object)


def listed_file(items: DataFrame, sites: DataFrame, filename: str, ends: str) -> DataFrame:
    """Rows of ``site_files`` for one file a site: ``items`` (aiot, nth from 1, text) between the two signs of ``ends``.

    A site without items has the two signs alone.
    """
    most = items.groupBy("aiot").agg(F.max("nth").alias("_last"))
    body = items.select("aiot", "nth", F.concat(F.when(F.col("nth") == 1, F.lit(ends[0] + "\n  ")).otherwise(F.lit(",\n  ")), "text").alias("text"))
    last = sites.select("aiot").distinct().join(most, "aiot", "left")
    last = last.select("aiot", (F.coalesce("_last", F.lit(0)) + 1).alias("nth"), F.when(F.col("_last").isNull(), F.lit(ends + "\n")).otherwise(F.lit("\n" + ends[1] + "\n")).alias("text"))
    return body.unionByName(last).withColumn("filename", F.lit(filename))


def operations_file(ops: DataFrame, sites: DataFrame) -> DataFrame:
    """``operations.json`` of every site, in order of ``seq``."""
    rows = numbered(operation_json(ops), ["aiot"], ["seq"], "nth")
    return listed_file(rows.select("aiot", "nth", pretty("value", F.lit(1)).alias("text")), sites, "operations.json", "[]")


def history_json(versions: DataFrame) -> DataFrame:
    """(aiot, key, value): every article's versions as a JSON array, keyed ``decree#article``; empty code sets are left out."""
    plain = [F.col(c) for c in ("version", "title", "content", "operation_id")]
    text = lambda *more: F.to_json(F.struct(*plain, *more), {"ignoreNullFields": "false"})
    value = F.when(F.size("error_codes") > 0, text(F.array_sort("error_codes").alias("error_codes"))).otherwise(text())
    rows = versions.groupBy("aiot", "decree_id", "article_id").agg(F.array_sort(F.collect_list(F.struct("version", value.alias("v")))).alias("_v"))
    joined = F.concat(F.lit("["), F.array_join(F.transform("_v", lambda v: v["v"]), ","), F.lit("]"))
    return rows.select("aiot", "decree_id", "article_id", joined.alias("value"), node_key(F.col("decree_id"), F.col("article_id")).alias("key"))


def history_file(versions: DataFrame, sites: DataFrame) -> DataFrame:
    """``history.json`` of every site: an object of the articles' versions, keys in order."""
    rows = numbered(history_json(versions), ["aiot"], ["key"], "nth")
    quoted = F.to_json(F.array("key"))
    name = quoted.substr(F.lit(2), F.length(quoted) - 2)
    return listed_file(rows.select("aiot", "nth", F.concat(name, F.lit(": "), pretty("value", F.lit(1))).alias("text")), sites, "history.json", "{}")


def history_order(rows: DataFrame) -> DataFrame:
    """By decree, then by the levels of the number, then by the id as text."""
    return rows.orderBy("aiot", "decree_id", sort_key(F.col("article_id")), "article_id")


def whole_files(rows: DataFrame, filename: Column, text: Column) -> DataFrame:
    """Rows of ``site_files`` for texts that are a file each."""
    return rows.select("aiot", filename.alias("filename"), F.lit(0).cast("long").alias("nth"), text.alias("text"))


def save(done, decrees: DataFrame, path: str, tagged: str | None = None) -> None:  # noqa: ANN001
    """The files of a consolidation, a folder a site: operations, history and, where there are any, permits; tagged decrees below ``tagged``."""
    site_files.write(operations_file(done.operations, decrees).unionByName(history_file(done.versions, decrees)), path)
    if done.permits is not None:
        site_files.write(whole_files(done.permits, F.lit("permis.html"), F.col("html")), path)
    if tagged:
        site_files.write(whole_files(decrees, F.col("filename"), F.col("html")), tagged)


def save_scores(scores: DataFrame, path: str) -> None:
    scores.orderBy(F.col(scores.columns[0]) == "TOTAL", scores.columns[0]).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def run_folder(root: str, stamp: str, model: str) -> str:
    """Folder of one evaluation run."""
    return f"{root}/run={stamp}_{''.join(c if c.isalnum() or c in '.-' else '_' for c in model)}"


def without_nulls(value: Column) -> Column:
    """JSON text of a value without null fields."""
    return F.to_json(value, {"ignoreNullFields": "true"})


def normal_html(html: Column) -> Column:
    return F.trim(F.regexp_replace(html, r"(?md)[ \t]+$", ""))


def index_rows(files: DataFrame) -> DataFrame:
    """One table row per aiot with links to its files in order of name."""
    link = F.concat(F.lit('<a href="'), F.col("path"), F.lit('">'), F.col("filename"), F.lit("</a>"))
    rows = files.groupBy("aiot").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("filename", link.alias("link")))), lambda x: x["link"]), " ").alias("links"))
    return rows.select("aiot", F.concat(F.lit("<tr><td>"), "aiot", F.lit("</td><td>"), "links", F.lit("</td></tr>")).alias("row"))
