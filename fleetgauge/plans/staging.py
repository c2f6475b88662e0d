"""Intermediate tables of one run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.session import shared_folder
from fleetgauge.sources.layers import Layers, remove_folder


class Staging:
    """Intermediate tables of one run, in a folder of its own below the shared folder.

    The folder goes when the `with` block ends, by then everything that reads it has been written.
    """

    def __init__(self, spark: SparkSession, layers: Layers):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{layers.schema}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write a result and read it back: computed once, safe from lost executors."""
        writer = df.write.partitionBy(by) if by else df.write
        writer.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        remove_folder(self.spark, self.folder)
