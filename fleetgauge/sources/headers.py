"""Headers of landing files: which column of each file holds which value.

Only the beginning of a file is read for its header, by all tasks together. What Arrow cannot open (a store or a codec it does not
know) is read through Spark's text source instead, line by line.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# The first line of a file must end within so many bytes.
HEAD_BYTES = 1024**2
HEAD_SCHEMA = "_source_file string, header string, problem string, opened boolean"
NO_COLUMN, UNREADABLE = "no column of the schema in the first line", "cannot be read"


@dataclass(frozen=True)
class Layout:
    """The columns of a file in order: names of the schema, and names that only the file has."""

    names: tuple[str, ...]
    known: frozenset[str]
    # The header is the schema's names in order, and nothing else.
    plain: bool = False

    @property
    def extras(self) -> list[tuple[str, int]]:
        return [(name, place) for place, name in enumerate(self.names) if name not in self.known]

    def places(self, fields: Sequence[str]) -> list[int | None]:
        return [self.names.index(name) if name in self.known else None for name in fields]


def layout_of(header: str, fields: Sequence[str], reserved: Sequence[str] = ()) -> Layout | str:
    """The layout that a first line states, or the reason why the file cannot be read by it.

    Names count without case and blanks around them. Columns without a name get `_c` and their place; a name that the file repeats, or one
    of `reserved`, gets its place appended. A repeated column of the schema is ambiguous.
    """
    cells = next(csv.reader([header.removeprefix("\uFEFF").removesuffix("\r")]), [])
    names: list[str] = []
    known = set()
    for place, cell in enumerate(cells):
        name = cell.strip()
        if name.lower() in fields:
            name = name.lower()
            if name in known:
                return f"column {name} occurs twice"
            known.add(name)
        else:
            name = name or f"_c{place}"
            if name in names or name in reserved:
                name = f"{name}_{place}"
            while name in names:
                name += "_"
        names.append(name)
    if not known:
        return NO_COLUMN
    plain = [cell.lower() for cell in header.replace('"', "").split(",")] == list(fields)
    return Layout(tuple(names), frozenset(known), plain)


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(_source_file, header) of every file that has a line which is not blank, by Spark's text source.

    Lines are read as text by all tasks; each hands on one line for each file that begins in it. A file that cannot be read has none.
    """
    lines = spark.read.option("ignoreCorruptFiles", "true").text(list(paths)).select(
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line_id"),
        "value",
    )
    return lines.filter("_start = 0 AND trim(value) != ''").groupBy("_source_file").agg(F.min_by("value", "_line_id").alias("header"))


def file_heads(files: DataFrame, head_bytes: int = HEAD_BYTES) -> DataFrame:
    """(_source_file, header, problem, opened) for every `_source_file` of `files`; a file without a line has no header.

    `opened` is false where Arrow could not read the beginning. The tasks need nothing of this package.
    """

    def heads(batches):
        import pyarrow as pa
        from pyarrow import fs

        def head(uri):
            system, place = fs.FileSystem.from_uri(uri)
            data, whole = b"", False
            with system.open_input_stream(place, compression="detect", buffer_size=65536) as file:
                while True:
                    lines = data.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
                    full = [line for line in (lines if whole else lines[:-1]) if line.strip(b" ")]
                    if full or whole:
                        return (full[0].decode("utf-8", "replace") if full else None), None
                    if len(data) >= head_bytes:
                        return data[:200].decode("utf-8", "replace"), f"first line longer than {head_bytes} bytes"
                    more = file.read(65536)
                    data, whole = data + more, not more

        for batch in batches:
            rows = []
            for uri in batch["_source_file"].to_pylist():
                try:
                    rows.append((uri, *head(uri), True))
                except (OSError, ValueError, NotImplementedError):
                    rows.append((uri, None, None, False))
            kinds = (pa.string(), pa.string(), pa.string(), pa.bool_())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(columns, names=["_source_file", "header", "problem", "opened"])

    return files.select("_source_file").mapInArrow(heads, HEAD_SCHEMA)


def damaged_files(spark: SparkSession, names: Sequence[str]) -> list[tuple[str, str]]:
    """[(file, damage)]: the files that Arrow cannot read to their end, such as a compressed file that was cut off.

    Every file is streamed once, by all tasks together and in constant memory. The names pass through the driver, as those of a batch do.
    """

    def ends(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            rows = []
            for uri in batch["_source_file"].to_pylist():
                try:
                    system, place = fs.FileSystem.from_uri(uri)
                    with system.open_input_stream(place, compression="detect", buffer_size=0) as file:
                        while file.read(1024**2):
                            pass
                except (OSError, ValueError, NotImplementedError) as problem:
                    rows.append((uri, str(problem).splitlines()[0][:200] if str(problem) else type(problem).__name__))
            columns = [pa.array(c, pa.string()) for c in (zip(*rows) if rows else ([], []))]
            yield pa.RecordBatch.from_arrays(columns, names=["_source_file", "damage"])

    tasks = min(len(names), 4 * spark.sparkContext.defaultParallelism)
    files = spark.createDataFrame([(name,) for name in names], "_source_file string").repartition(max(1, tasks))
    return [tuple(row) for row in files.mapInArrow(ends, "_source_file string, damage string").collect()]


def file_layouts(
    spark: SparkSession, paths: dict[str, str], fields: Sequence[str], reserved: Sequence[str] = ()
) -> tuple[dict[str, Layout], list[tuple[str, str | None, str]]]:
    """({file: layout}, [(file, header, reason)]) of the files {_source_file: path}; files without any line are in neither.

    The files and their first lines pass through the driver, as the names of a batch do in any Spark file read.
    """
    tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
    files = spark.createDataFrame([(name,) for name in paths], "_source_file string").repartition(max(1, tasks))
    heads = {row["_source_file"]: row for row in file_heads(files).collect()}
    headers = {name: (row["header"], row["problem"]) for name, row in heads.items()}
    others = [name for name, row in heads.items() if not row["opened"]]
    if others:
        read = {row["_source_file"]: row["header"] for row in first_lines(spark, [paths[name] for name in others]).collect()}
        headers |= {name: (read.get(name), None if name in read else UNREADABLE) for name in others}
    layouts, refused = {}, []
    of = {header: layout_of(header, fields, reserved) for header, _ in set(headers.values()) if header is not None}
    for name, (header, problem) in headers.items():
        found = problem or (of[header] if header is not None else None)
        if isinstance(found, Layout):
            layouts[name] = found
        elif found:
            refused.append((name, header, found))
    return layouts, refused
