"""A stream of changes of a folder: one row whenever a file appears, goes, or is replaced in place.

Spark's own file stream remembers paths, so it does not see a file that was overwritten. This source compares what the folder holds: its
offset is the number of files and a digest over the path, time and size of each. Nothing but that offset is kept, so a
stream with a lost checkpoint merely reports the folder once more. What changed is for the reader of the stream to find out
(`plans.ingest.pending_versions` does, from the ledger).

The folder is walked directory by directory, so memory is bounded by the largest directory. Names that begin with `_` or `.` are left out, as in
Spark's listings.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SOURCE = "folder_changes"
SCHEMA = "files long, digest string"


def folder_uri(spark: SparkSession, folder: str) -> str:
    """The folder's address with its store, as other libraries than Spark take it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri().toString()
    return re.sub(r"^(\w+):/(?!/)", r"\1:///", whole)


def arrow_opens(uri: str) -> bool:
    from pyarrow import fs

    try:
        system, place = fs.FileSystem.from_uri(uri)
        system.get_file_info(place)
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def folder_state(uri: str) -> dict:
    """{files, digest} of a folder; the order of its files does not count. A folder that does not exist is empty."""
    from hashlib import blake2b

    from pyarrow import fs

    system, top = fs.FileSystem.from_uri(uri)
    files, total, left = 0, 0, [top]
    while left:
        for info in system.get_file_info(fs.FileSelector(left.pop(), allow_not_found=True)):
            name = info.base_name
            if name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"):
                continue
            if info.type == fs.FileType.Directory:
                left.append(info.path)
            else:
                entry = f"{info.path}\0{info.mtime_ns}\0{info.size}".encode()
                files, total = files + 1, total + int.from_bytes(blake2b(entry, digest_size=16).digest())
    return {"files": files, "digest": f"{total % 2**128:032x}"}


def _source(state_of):
    """The source's class. It is made here so that it travels by value: Spark's Python processes need nothing of this package."""
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    class Changes(DataSourceStreamReader):
        def __init__(self, uri):
            self.uri = uri

        def initialOffset(self):
            return {"files": 0, "digest": ""}

        def latestOffset(self):
            return state_of(self.uri)

        def partitions(self, start, end):
            return [] if start == end else [InputPartition((end["files"], end["digest"]))]

        def read(self, partition):
            yield partition.value

    class FolderChanges(DataSource):
        @classmethod
        def name(cls):
            return SOURCE

        def schema(self):
            return SCHEMA

        def streamReader(self, schema):
            return Changes(self.options["path"])

    return FolderChanges


def folder_changes(spark: SparkSession, folder: str) -> DataFrame:
    """(files, digest) as a stream: a row each time the folder's files differ from the last."""
    state_of = _by_value(folder_state)
    spark.dataSource.register(_source(state_of))
    return spark.readStream.format(SOURCE).load(folder_uri(spark, folder))


def _by_value(function):
    """A copy of a module's function that is sent whole instead of by its module's name."""
    from types import FunctionType

    copy = FunctionType(function.__code__, {"__builtins__": __builtins__}, function.__name__)
    copy.__module__ = "__main__"
    return copy
