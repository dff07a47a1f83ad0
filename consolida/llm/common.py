"""Helpers shared by the training-data operators.

Words, hashes and intermediate tables.  Everything that has to outlive one
stage is written as Parquet under the folder the session names in
``spark.checkpoint.dir``, so a lost executor costs a re-read and never a result.
"""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Mapping of bytes for ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` words: A-Z fall to
#: a-z, other excluded bytes become blanks.
ALNUM_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

#: Tables of the catalogue by the last part of their path.
_tables: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where it is unset a local session uses its warehouse; on a cluster that may
    be a folder of one machine, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/consolida"


def materialise(df: DataFrame, tag: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/consolida-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, tag: str, key: str, buckets: int, codec: str = "uncompressed") -> DataFrame:
    """Write ``df`` as a table bucketed by ``key`` in the shared folder and read it again.

    Grouping it by ``key`` into as many partitions needs no shuffle.
    """
    spark = df.sparkSession
    name = f"consolida_{tag}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    df.write.bucketBy(buckets, key).option("path", path).option("compression", codec).format("parquet").saveAsTable(name)
    atexit.register(_forget, spark, path)
    _tables[path.rpartition("/")[2]] = name
    return spark.table(name)


def added(df: DataFrame, table: DataFrame, key: str, buckets: int, codec: str = "uncompressed") -> DataFrame:
    """Write ``df`` into a table of ``bucketed`` and read the whole; grouping it needs no shuffle, which a union would."""
    names = [_tables[f.rsplit("/", 2)[-2]] for f in table.inputFiles()[:1]]
    if not names:  # nothing was written
        return table.unionByName(df)
    df.write.mode("append").bucketBy(buckets, key).option("compression", codec).format("parquet").saveAsTable(names[0])
    return df.sparkSession.table(names[0])


def sweep(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of queries that are done.

    Its cleaner acts when the driver collects garbage, which a driver with
    little to do puts off while the executors' disks fill.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def forget(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more, and the shuffle files they were made from."""
    for df in tables:
        for name in {f.rpartition("/")[0] for f in df.inputFiles()[:1]}:
            _forget(df.sparkSession, name)
    for df in tables[:1]:
        sweep(df.sparkSession)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        if table := _tables.pop(path.rpartition("/")[2], None):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone already; then nothing can be removed from here
        return


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The key columns and the whole text as UTF-8 bytes (null: empty)."""
    return docs.select(*keys, F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def blank_words(body: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    return body.lower().split()


def alnum_words(body: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lowering A-Z."""
    return body.translate(ALNUM_TABLE).split()


class WordHashes(dict):
    """64-bit hash of each word; emptied when it holds ``most`` words."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, element by element."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x9E3779B97F4A7C15)
    x = x ^ (x >> U64(29))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 64-bit keys in order, the first place of each, and the number of each place's key.

    Sorts the keys with their places in the low bits, which takes half the time
    of an indirect sort; keys that differ there alone and come out of order are
    left to the indirect one.
    """
    n = len(keys)
    if n:
        low = U64((1 << n.bit_length()) - 1)
        order = keys & ~low
        order |= np.arange(n, dtype=U64)
        order.sort()
        order &= low
        order = order.view(np.int64)
        full = keys[order]
        if (full[1:] >= full[:-1]).all():
            new = np.concatenate(([True], full[1:] != full[:-1]))
            at = np.empty(n, np.int32)
            at[order] = np.cumsum(new, dtype=np.int32) - 1
            return full[new], order[new], at
    out, first, at = np.unique(keys, return_index=True, return_inverse=True)
    return out, first, at.astype(np.int32)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words: the whole sequence as one."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    acc = np.zeros(n - width + 1, dtype=U64)
    for i in range(width):
        acc = mixed(acc + hashes[i : n - width + 1 + i] + U64(i + 1))
    if n < k:  # a short sequence never equals a full shingle
        acc = mixed(acc + U64(0xA5A5A5A5 + n))
    return np.unique(acc)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would fold other letters too)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
