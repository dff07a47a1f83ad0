"""Readers of decree folders, operations, ground truth and settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consolida.functions.identifiers import node_of, parse_filename
from consolida.functions.texts import strip_blockquotes, strip_page_separators
from consolida.operators.relations import one_decree_a_date
from consolida.operators.trees import quotes_to_alineas
from consolida.operators.validation import checked, derived_codes
from consolida.sources import site_files

NODE = "struct<arrete_id:string,article_id:string>"
OPERATION = f"id string, origin string, source_id {NODE}, target_id {NODE}, operation_type string, operand string, sub_target struct<type:string,position:int,description:string>, error_codes array<string>, confidence_score int"
#: Versions of the input dialect that are read.
DIALECT = r"^0\.2\.\d+$"


class EmptyFolder(ValueError):
    """A folder without readable documents."""


def html_files(spark: SparkSession, path: str) -> DataFrame:
    """(aiot, filename, html) of the ``*.html`` files below ``path``; the folder of a file names its aiot."""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.html").option("recursiveFileLookup", True).text(path)
    where = F.col("_metadata.file_path")
    rows = files.select(F.element_at(F.split(where, "/"), -2).alias("aiot"), F.url_decode(F.replace(F.element_at(F.split(where, "/"), -1), F.lit("+"), F.lit("%2B"))).alias("filename"), F.col("value").alias("html"))
    if rows.limit(1).count() == 0:
        raise EmptyFolder(f"no .html file in {path}")
    return rows


def decrees(files: DataFrame) -> DataFrame:
    """Decree rows with ``reject_reason`` for names and dialects that cannot be read."""
    version = F.regexp_extract("html", r"""(?is)<body\b[^>]*\bdata-arretify_version\s*=\s*["']([^"']*)["']""", 1)
    name = parse_filename(F.col("filename"))
    rows = files.withColumn("_name", name).withColumn("reject_reason", F.coalesce(F.col("_name.reason"), F.when(~version.rlike(DIALECT), F.lit("version"))))
    clean = quotes_to_alineas(strip_page_separators(F.col("html")))
    return rows.select("aiot", F.col("_name.decree_id").alias("decree_id"), "filename", clean.alias("html"), F.col("_name.file_type").alias("file_type"), F.lit(True).alias("active"), F.lit(False).alias("principal"), "reject_reason")


def load_decrees(spark: SparkSession, path: str) -> DataFrame:
    """One decree per aiot and date below ``path``."""
    rows = decrees(html_files(spark, path)).where("reject_reason is null").drop("reject_reason")
    return one_decree_a_date(rows)


def operations(spark: SparkSession, path: str) -> DataFrame:
    """Operations of ``operations.json`` files; stored codes are dropped and derived again, operands cleaned."""
    rows = spark.read.schema(OPERATION).option("multiLine", True).option("pathGlobFilter", "operations.json").option("recursiveFileLookup", True).json(path)
    aiot = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    flat = rows.select(
        aiot.alias("aiot"),
        "id",
        "origin",
        F.col("source_id.arrete_id").alias("source_decree"),
        F.col("source_id.article_id").alias("source_article"),
        F.col("target_id.arrete_id").alias("target_decree"),
        F.col("target_id.article_id").alias("target_article"),
        "operation_type",
        strip_blockquotes(strip_page_separators(F.col("operand"))).alias("operand"),
        F.col("sub_target.type").alias("sub_type"),
        F.col("sub_target.position").alias("sub_position"),
        F.col("sub_target.description").alias("sub_description"),
        F.col("error_codes").alias("stored_codes"),
        "confidence_score",
    )
    codes = derived_codes(F.lit(None), F.col("operation_type"), F.col("target_article"), F.col("sub_type"))
    # Places in a file follow ids of the form prefix and number.
    place = F.coalesce(F.regexp_extract("id", r"(\d+)$", 1).try_cast("long"), F.lit(0))
    return flat.withColumn("error_codes", codes).withColumn("seq", place)


def histories(spark: SparkSession, path: str) -> DataFrame:
    """Versions of the ``history.json`` files below the sites' folders; what is no such file gives no rows."""
    version = "struct<version:int,title:string,content:string,operation_id:string,error_codes:array<string>>"
    rows = site_files.read(spark, path, "history.json").select("aiot", F.explode(F.from_json("text", f"map<string,array<{version}>>")).alias("key", "versions"))
    rows = rows.select("aiot", "key", F.explode("versions").alias("v")).withColumn("n", node_of(F.col("key")))
    codes = F.coalesce("v.error_codes", F.expr("cast(array() as array<string>)"))
    return rows.select("aiot", F.col("n.arrete_id").alias("decree_id"), "n.article_id", "v.version", "v.title", "v.content", "v.operation_id", codes.alias("error_codes"))


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Operations to compare with, of the three kinds that change a text."""
    return operations(spark, path).where(F.col("operation_type").isin("ADD", "REPLACE", "REMOVE"))


def valid_operations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows in form, rows out of form with their reasons)."""
    out = checked(rows)
    return out.where("reject_reason is null").drop("reject_reason"), out.where("reject_reason is not null")


def strict_json(text: DataFrame, column: str, schema: str, allowed: list[str]) -> DataFrame:
    """JSON objects as rows; an unknown field or a value out of type gives ``reject_reason``, not a null."""
    parsed = F.from_json(column, schema)
    keys = F.coalesce(F.json_object_keys(column), F.expr("cast(array() as array<string>)"))
    unknown = F.size(F.array_except(keys, F.array(*(F.lit(k) for k in allowed)))) > 0
    again = F.from_json(column, "map<string,string>")
    lost = F.exists(keys, lambda k: F.element_at(again, k).isNotNull() & F.call_function("get_json_object", F.to_json(parsed), F.concat(F.lit("$."), k)).isNull())
    reason = F.when(F.json_object_keys(column).isNull(), F.lit("no object")).when(unknown, F.lit("unknown field")).when(lost, F.lit("type"))
    return text.withColumn("value", parsed).withColumn("reject_reason", reason)
