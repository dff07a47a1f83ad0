"""Tables between the stages of a plan, in the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without one uses its warehouse, on a cluster it has to be set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/consolida"


def _path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder; what is there goes when the program ends."""
    path = f"{shared_folder(spark)}/consolidate-{name}-{uuid.uuid4().hex}"
    atexit.register(removed, spark, path)
    return path


def stored(df: DataFrame, name: str, counts: dict[str, int] | None = None, by: str | None = None) -> DataFrame:
    """``df`` written as Parquet and read again, so that later stages neither repeat nor depend on its lineage.

    The table goes when the program ends.  With ``counts``, the rows that were
    written are counted on the way and noted there under ``name``.  ``by``: a
    column whose values have folders of their own.
    """
    spark = df.sparkSession
    path = _path(spark, name)
    schema, seen = df.schema, Observation(name)
    (df if counts is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))).write.partitionBy(*([by] if by else [])).parquet(path)
    if counts is not None:
        counts[name] = seen.get["rows"]
    return spark.read.schema(schema).parquet(path)


class Appended:
    """A table that grows by parts, each stored when it is added."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.schema = spark, _path(spark, name), None

    def add(self, part: DataFrame) -> None:
        self.schema = part.schema
        part.write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def bucketed(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """``df`` stored in buckets of ``keys``, as many as a shuffle has partitions: joins on all of them do not shuffle it again."""
    spark = df.sparkSession
    path = _path(spark, name)
    table = f"consolidate_{name}_{path[-32:]}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).option("path", path).format("parquet").saveAsTable(table)
    atexit.register(_dropped, spark, table)
    return spark.table(table)


def _dropped(spark: SparkSession, table: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    except Exception:
        return


def removed(spark: SparkSession, path: str) -> None:
    """Delete a stored table; nothing where the session has ended already."""
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:
        return
