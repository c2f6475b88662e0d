"""CSV landing files: fixed schema, nothing lost.

Every column is read as text and cast here. Text that does not fit its type becomes NULL and is kept as
JSON in the rescue column, as are the values of columns that the schema does not have; a line with too few
or too many fields is kept there whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.sources.headers import Layout

# The columns of a landing file, in file order, and their types.
FIELDS = (
    ("timestamp", "timestamp"),
    ("turbine_id", "int"),
    ("wind_speed", "double"),
    ("wind_direction", "int"),
    ("power_output", "double"),
)
BAD_LINE = "_line"
# Version of the file a row came from; kept in the bronze layer, hidden from its readers.
FILE_TIME, FILE_SIZE = "_file_modified", "_file_size"

TEXT_SCHEMA = StructType(
    [StructField(name, StringType()) for name, _ in FIELDS] + [StructField(BAD_LINE, StringType())]
)
NAMES = tuple(name for name, _ in FIELDS)
# With enforceSchema off, a header that does not match these names fails the read instead of
# shifting values into the wrong columns.
CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD_LINE,
}


def typed_columns(cfg: SensorConfig = DEFAULT, extras: Column | None = None) -> list[Column]:
    """The typed readings and the rescue column, from text columns of the same names.

    `extras` is a map of further values to keep, none of them under a name of the schema.
    """
    typed = {name: F.col(name).try_cast(kind) for name, kind in FIELDS}
    lost = {
        name: F.when(F.col(name).isNotNull() & typed[name].isNull(), F.col(name)) for name, _ in FIELDS
    }
    lost[BAD_LINE] = F.col(BAD_LINE)
    pairs = F.create_map(*[part for name, value in lost.items() for part in (F.lit(name), value)])
    present = F.map_filter(pairs if extras is None else F.map_concat(pairs, extras), lambda _, value: value.isNotNull())
    any_lost = F.coalesce(*lost.values()).isNotNull() if extras is None else F.size(present) > 0
    return [
        *[column.alias(name) for name, column in typed.items()],
        F.when(any_lost, F.to_json(present)).alias(cfg.rescued),
    ]


def typed_readings(text: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Cast and rescue the text of a CSV read; add ingestion time, file and file version."""
    return text.select(*typed_columns(cfg), F.current_timestamp().alias(cfg.ingested), *_file_columns(cfg))


def _file_columns(cfg: SensorConfig) -> list[Column]:
    return [
        F.col("_metadata.file_path").alias(cfg.source),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
        F.col("_metadata.file_size").alias(FILE_SIZE),
    ]


def read_landing(
    spark: SparkSession, paths: str | Sequence[str], cfg: SensorConfig = DEFAULT
) -> DataFrame:
    """Batch read of a folder or of given files whose headers are the schema's; another header fails the read."""
    where = paths if isinstance(paths, str) else list(paths)
    return typed_readings(spark.read.schema(TEXT_SCHEMA).options(**CSV_OPTIONS).csv(where), cfg)


def read_by_name(
    spark: SparkSession, paths: dict[str, str], layouts: dict[str, Layout], cfg: SensorConfig = DEFAULT
) -> DataFrame | None:
    """Batch read of the files {_source_file: path}, each by the names of its own header; None if there is no file.

    Missing columns are NULL, unknown ones go to the rescue column. Files with the schema's own header are one read. The others are read
    together by their number of columns, and each line's cells are picked by the places that its file's header gives them.
    The text is parsed once.
    """
    parts = []
    plain = [paths[name] for name, layout in layouts.items() if layout.plain]
    if plain:
        parts.append(read_landing(spark, plain, cfg))
    widths: dict[int, list[str]] = {}
    for name, layout in layouts.items():
        if not layout.plain:
            widths.setdefault(len(layout.names), []).append(name)
    for width, files in sorted(widths.items()):
        parts.append(_picked(spark, [paths[name] for name in files], {name: layouts[name] for name in files}, width, cfg))
    whole = parts[0] if parts else None
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _picked(spark: SparkSession, paths: list[str], layouts: dict[str, Layout], width: int, cfg: SensorConfig) -> DataFrame:
    cells = [f"_cell{place}" for place in range(width)]
    schema = StructType([StructField(name, StringType()) for name in [*cells, BAD_LINE]])
    text = spark.read.schema(schema).options(**CSV_OPTIONS | {"enforceSchema": "true"}).csv(paths)
    text = text.select(F.array(*cells).alias("_cells"), BAD_LINE, *_file_columns(cfg))
    # As an Arrow table its size is known, so Spark can broadcast it where it is small.
    listed = [(name, layout.places(NAMES), *map(list, zip(*layout.extras) if layout.extras else ((), ()))) for name, layout in layouts.items()]
    kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int32()))
    places = spark.createDataFrame(
        pa.table([pa.array(c, k) for c, k in zip(zip(*listed), kinds)], names=[cfg.source, "_places", "_names", "_at"])
    )
    named = [F.expr(f"get(_cells, _places[{number}])").alias(name) for number, name in enumerate(NAMES)]
    joined = text.join(places, cfg.source).select(
        *named, BAD_LINE, F.expr("map_from_arrays(_names, transform(_at, at -> get(_cells, at)))").alias("_extras"),
        cfg.source, FILE_TIME, FILE_SIZE,
    )
    return joined.select(
        *typed_columns(cfg, F.col("_extras")), F.current_timestamp().alias(cfg.ingested), cfg.source, FILE_TIME, FILE_SIZE
    )


VERSION = ["_source_file", FILE_TIME, FILE_SIZE]
# Spark's file listing as a table. The content column is never selected, so no file is opened.
LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _versions(listing: DataFrame) -> DataFrame:
    return listing.select(
        "path",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
        F.col("_metadata.file_size").alias(FILE_SIZE),
    )


def landing_versions(spark: SparkSession, folder: str) -> DataFrame:
    """(path, _source_file, _file_modified, _file_size) of every file now in the folder.

    Files count whatever their extension and depth; Spark leaves out names that begin with `_` or `.`, here as in the
    stream. Only file listings are used; the files are not opened.
    """
    return _versions(
        spark.read.format("binaryFile").schema(LISTING_SCHEMA).option("recursiveFileLookup", "true").load(folder)
    )


def stream_versions(spark: SparkSession, folder: str, files_per_batch: int = 10_000) -> DataFrame:
    """`landing_versions` as a stream of the files that appear."""
    return _versions(
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
