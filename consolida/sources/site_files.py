"""Files of sites as a Spark data source: one folder a site, whole files, written all or not at all.

``register`` makes the format ``site_files`` known to a session.  Read, it gives
(aiot, filename, text) with a partition a site.  Written, it takes rows (aiot,
filename, nth, text): the texts of a file in order of ``nth`` are its content.
A file must come from one partition, so writers go through ``write``, which
sorts.  Files get their names when the whole job has succeeded; until then, and
if it fails, they stand under names of their own and are removed.

Paths are those of ``pyarrow.fs``: local or mounted folders, or addresses.
"""

from __future__ import annotations

import fnmatch
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "site_files"
READ = "aiot string, filename string, text string"
WRITTEN = "aiot string, filename string, nth long, text string"
#: Mark of files whose job has not ended; readers pass them over.
UNFINISHED = ".unfinished-"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class _Site(InputPartition):
    name: str


class _Reader(DataSourceReader):
    def __init__(self, path: str, pattern: str):
        self.path, self.pattern = path, pattern

    def partitions(self) -> list[InputPartition]:
        store, root = _opened(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return [_Site(f.base_name) for f in sorted(found, key=lambda f: f.base_name) if f.type == fs.FileType.Directory] or [_Site("")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        store, root = _opened(self.path)
        if not partition.name:  # a folder without sites
            return
        for f in sorted(store.get_file_info(fs.FileSelector(posixpath.join(root, partition.name))), key=lambda f: f.base_name):
            if f.type == fs.FileType.File and UNFINISHED not in f.base_name and fnmatch.fnmatch(f.base_name, self.pattern):
                with store.open_input_stream(f.path) as stream:
                    yield partition.name, f.base_name, stream.readall().decode(errors="replace")


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator) -> WriterCommitMessage:
        store, root = _opened(self.path)
        files, now, stream = [], None, None
        try:
            for row in rows:
                if (row["aiot"], row["filename"]) != now:
                    if stream:
                        stream.close()
                    now = row["aiot"], row["filename"]
                    folder = posixpath.join(root, row["aiot"])
                    store.create_dir(folder, recursive=True)
                    held = posixpath.join(folder, f"{UNFINISHED}{uuid.uuid4().hex}")
                    files.append((held, posixpath.join(folder, row["filename"])))
                    stream = store.open_output_stream(held)
                stream.write((row["text"] or "").encode())
        finally:
            if stream:
                stream.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, _ = _opened(self.path)
        for message in messages:
            for held, final in message.files if message else ():
                store.move(held, final)

    def abort(self, messages: list) -> None:
        store, root = _opened(self.path)
        for message in messages:
            for held, _ in message.files if message else ():
                if store.get_file_info(held).type == fs.FileType.File:
                    store.delete_file(held)


class SiteFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return READ

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("pattern", "*"))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SiteFiles)


def read(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(aiot, filename, text) of the files below the sites' folders of ``path``."""
    register(spark)
    return spark.read.format(FORMAT).option("path", path).option("pattern", pattern).load()


def write(rows: DataFrame, path: str) -> None:
    """Writes the files of ``rows`` (aiot, filename, nth, text); a file that is there already is replaced."""
    register(rows.sparkSession)
    sorted_rows = rows.select("aiot", "filename", "nth", "text").repartition("aiot", "filename").sortWithinPartitions("aiot", "filename", "nth")
    sorted_rows.write.format(FORMAT).mode("append").option("path", path).save()
