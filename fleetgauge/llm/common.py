"""Helpers shared by the operators: staged tables, partition counts, words, bounded caches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from sys import getsizeof

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetgauge.session import shared_folder

# Compressed input bytes that one task of a shuffle should get. Texts grow about twofold when read.
TASK_BYTES = 64 * 1024**2
# Spark reports sizes it does not know as this or more.
UNKNOWN_BYTES = 2**60


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int | None):
    """For the time of an action, at most `rows` rows in a batch to or from Python. Long texts make large batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    if rows:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        if rows:
            spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def staged(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Write `df` below the shared folder and read it back.

    Cuts the lineage, so a lost executor costs no recomputation of what came before, and gives the join
    strategies real sizes. Spark removes the folder when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"
    with arrow_rows(spark, batch_rows):
        df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_at = path
    return back


def dropped(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(df._staged_at)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def input_bytes(df: DataFrame) -> int:
    """Size on disk of all tables that `df` reads, as far as the optimizer knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def task_count(df: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """Partitions for a shuffle of `df`: by input size, and never fewer than the session asks for."""
    present = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(present, input_bytes(df) // task_bytes)


def bounded_sample(df: DataFrame, by: Column, bound: int) -> DataFrame:
    """At most `bound` rows, those with the least hashes `by` (longs), then the least values.

    A first cut by hash leaves about twice the bound, so no task and no single row exchange sees more.
    """
    n = df.count()
    df = df.withColumn("_by", by)
    if n > 4 * bound:
        df = df.where(F.expr(f"pmod(_by, 2147483648L) < {int(2**31 * 2 * bound / n)}L"))
    return df.orderBy("_by", *(c for c in df.columns if c != "_by")).limit(bound).drop("_by")


def sliced(batches: Iterator, most_bytes: int = 4 * 1024**2) -> Iterator:
    """Arrow batches in parts of a few megabytes, at least a row; unused memory goes back at the end."""
    import pyarrow as pa

    for batch in batches:
        step = max(1, len(batch) * most_bytes // max(1, batch.nbytes))
        for at in range(0, len(batch), step):
            yield batch.slice(at, step)
    pa.default_memory_pool().release_unused()


# Longer keys of a cache seldom come again and are not kept.
LONG = 256
CACHE_BYTES = 128 * 1024**2


class Memo(dict):
    """A cache of `make(key)` that starts afresh when it would hold more than `limit` keys or `most_bytes` bytes."""

    def __init__(self, make, limit: int = 300_000, most_bytes: int = CACHE_BYTES):
        super().__init__()
        self.make, self.limit, self.most_bytes, self.held = make, limit, most_bytes, 0

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= LONG:
            self.grow(1, getsizeof(key) + getsizeof(value))
            self[key] = value
        return value

    def grow(self, keys: int, size: int) -> None:
        """Room for so many more keys, which with their values have `size` bytes."""
        if len(self) + keys > self.limit or self.held + size > self.most_bytes:
            self.clear()
            self.held = 0
        self.held += size


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`df` with columns c0, c1, ..., so that none can clash with names an operator makes; and {name: new name}."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def utf8(column) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; null becomes empty."""
    import pyarrow as pa

    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]
