"""Where the tables of each layer live, and how they are read and written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

BRONZE, SILVER = "bronze_turbine_readings", "silver_turbine_readings"
SUMMARY, ANOMALIES = "daily_turbine_summary", "turbine_anomalies"
LAYER_OF = {BRONZE: "bronze", SILVER: "silver", SUMMARY: "gold", ANOMALIES: "gold"}


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def remove_file(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, False)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder; none if there is no such folder."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(place) if entry.isDirectory()]


NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Layers:
    """Tables at `<base>/<layer>[_<env>]/<schema>/<table>`, as Parquet files.

    `env` is empty for production. `table_name` gives the catalog name of the same table for sites that
    register tables: `<layer>[_<env>].<schema>.<table>`.
    """

    base: str
    env: str = ""
    schema: str = "turbine_data"
    rows_per_file: int = 20_000_000

    @classmethod
    def from_session(cls, spark: SparkSession) -> Layers:
        get = spark.conf.get
        return cls(
            get("fleetgauge.basePath"), get("fleetgauge.env", ""), get("fleetgauge.schema", "turbine_data")
        )

    def _layer(self, name: str) -> str:
        return f"{name}_{self.env}" if self.env else name

    def path(self, table: str) -> str:
        return f"{self.base}/{self._layer(LAYER_OF.get(table, 'state'))}/{self.schema}/{table}"

    def table_name(self, table: str) -> str:
        return f"{self._layer(LAYER_OF.get(table, 'state'))}.{self.schema}.{table}"

    def read(
        self, spark: SparkSession, table: str, schema: StructType | str | None = None
    ) -> DataFrame:
        """Read a table; with `schema`, a table that was never written reads as empty."""
        if schema is None:
            return spark.read.parquet(self.path(table))
        if not self.exists(spark, table):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.path(table))

    def read_days(
        self, spark: SparkSession, table: str, schema: StructType | str, wanted: Callable[[date | None], bool], by: str = "date"
    ) -> DataFrame:
        """Rows of the days that are wanted, from a table partitioned by day.

        The names of the day folders are listed; only the wanted ones are opened, where `read` and a filter would list the files of all.
        """
        folders = []
        for name in folder_names(spark, self.path(table)):
            if name.startswith(f"{by}="):
                day = name.removeprefix(f"{by}=")
                if wanted(None if day == NO_DAY else date.fromisoformat(day)):
                    folders.append(f"{self.path(table)}/{name}")
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.path(table)).parquet(*folders)

    def expose(self, spark: SparkSession) -> list[str]:
        """Make the tables written so far usable in SQL under their plain names."""
        written = [table for table in LAYER_OF if self.exists(spark, table)]
        for table in written:
            self.read(spark, table).createOrReplaceTempView(table)
        return written

    def exists(self, spark: SparkSession, table: str) -> bool:
        return folder_exists(spark, self.path(table))

    def overwrite(
        self, df: DataFrame, table: str, by: Sequence[str] = (), only_touched: bool = False
    ) -> None:
        """Replace a table, or with `only_touched` just the partitions that occur in `df`."""
        writer = (
            df.write.mode("overwrite")
            .option("maxRecordsPerFile", self.rows_per_file)
            .option("partitionOverwriteMode", "dynamic" if only_touched else "static")
        )
        if by:
            writer = writer.partitionBy(*by)
        writer.parquet(self.path(table))

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(self.path(table))


def packed(df: DataFrame, *by: str) -> DataFrame:
    """Rows gathered by the write partition in files of even size: small partitions share a task,
    large ones are split over several."""
    return df.hint("rebalance", *[F.col(c) for c in by]) if by else df.hint("rebalance")
