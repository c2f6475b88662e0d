"""WARC archives, index first: written with an index, then read by sorted and coalesced byte ranges.

`write_archives` turns each page into one record, a gzip member of its own, and returns the index: archive, offset and length of the
member, url and digest of the payload, type. `read_records` takes any rows of such an index and reads just their bytes: the rows are
gathered by stretches of an archive, sorted by offset, neighbouring ranges are read at once, and every payload is digested again.

Records with equal payloads of at least `min_bytes` bytes (equal SHA-1, XXH64 and length) share one: that of the largest page id is a response with
the payload, the others are revisits that refer to it and carry the HTTP header alone, with the full payload's length. Smaller
payloads are always responses. Which payloads occur twice is found in one aggregate over digests (no payload is shuffled for it); the pages meet that
small table in a join, which Spark makes a broadcast by its measured size, or else a shuffle whose hot keys adaptive execution splits.

Null html is an empty payload. Rows that repeat the largest page id of a payload are all responses. A null page id ranks below all
others; if a payload has no other, all its records are responses. Equal urls do not matter; a null url leaves the field out, control
characters and blanks in it are percent-encoded in the archive (the index keeps it as it is). No pages give an empty index and no archive.
Only the named columns are read. A task holds one stretch of records at a time (a few megabytes, at least one record).

Archives are written through Arrow's file systems, so the folder may be a path or any address these open. A task that is run again
writes new archives under new names; the index names those of the runs that counted, others are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from fleetgauge.llm.common import sliced, staged

# Names of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
# Extension fields, so that page ids come back.
PAGE, REFERS_TO_PAGE = "Page-Id", "Refers-To-Page-Id"
_NAMES = uuid.UUID("6f2f2a6e-6c1b-5a55-9d0c-1f0a3f4f8f10")


@dataclass(frozen=True)
class Store:
    # An archive is closed at the first record beyond this.
    archive_bytes: int = 1024**3
    # Records of one stretch of an archive are read by one task.
    stretch_bytes: int = 64 * 1024**2
    # Ranges with at most this between them are read at once, up to `read_bytes` together.
    gap_bytes: int = 64 * 1024
    read_bytes: int = 8 * 1024**2
    gzip_level: int = 6


DEFAULT = Store()


def record_id(page: str | None) -> str:
    """The same page always has the same record id; without a page id it is random."""
    return f"<urn:uuid:{uuid.uuid4() if page is None else uuid.uuid5(_NAMES, page)}>"


def plain_url(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) <= 0x20 or ord(c) == 0x7F else c for c in url)


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"".join((f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode(), block, b"\r\n\r\n"))


def page_record(row: dict, date: str) -> tuple[str, str, bytes]:
    """(type, digest, record) of one page; `refers_to` names the page that has its payload, if that is another."""
    kind = "response" if row["refers_to"] is None else "revisit"
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    page, url, other, other_url = (row[name] for name in ("page", "url", "refers_to", "refers_url"))
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page)), ("WARC-Date", date)]
    fields += [("WARC-Target-URI", url and plain_url(url)), ("WARC-Payload-Digest", f"sha1:{digest}"), (PAGE, page)]
    if other is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(other))]
        fields += [("WARC-Refers-To-Target-URI", other_url and plain_url(other_url)), (REFERS_TO_PAGE, other)]
    fields.append(("Content-Type", "application/http;msgtype=response"))
    block = HTTP.format(row["bytes"]).encode() + (row["payload"] if other is None else b"")
    return kind, digest, record(fields, block)


def parsed(member: bytes) -> tuple[dict[str, str], int, bytes]:
    """(fields, full payload length, payload) of an unpacked record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = next(int(line[15:]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    return fields, size, payload


class Archive:
    """An archive being written: appended members, and where each begins."""

    def __init__(self, folder: str, date: str, level: int):
        from pyarrow import fs

        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
        system, place = fs.FileSystem.from_uri(self.path)
        self.file, self.level, self.size = system.open_output_stream(place, compression=None), level, 0
        info = b"software: fleetgauge\r\nformat: WARC File Format 1.1\r\n"
        self.add(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], info))

    def add(self, data: bytes) -> tuple[int, int]:
        pack = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        member = pack.compress(data) + pack.flush()
        at, self.size = self.size, self.size + len(member)
        self.file.write(member)
        return at, len(member)

    def close(self) -> None:
        self.file.close()


def payloads(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(page_id, url, payload, sha1, xxh, bytes) of every page."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    named = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    return named.selectExpr("*", "sha1(payload) AS sha1", "xxhash64(payload) AS xxh", "cast(octet_length(payload) AS long) AS bytes")


def shared_payloads(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(sha1, xxh, bytes, refers_to, refers_url): the payloads that occur twice or more, and the page that keeps each."""
    groups = pages.where(F.col("bytes") >= min_bytes).groupBy("sha1", "xxh", "bytes")
    found = groups.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "url")).alias("kept")).where("n > 1")
    return found.selectExpr("sha1", "xxh", "bytes", "kept.page_id AS refers_to", "kept.url AS refers_url")


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0,
    date: datetime | None = None, store: Store = DEFAULT,
) -> DataFrame:
    """Write a record for each page to archives below `folder`; returns their index, written to `folder`/index.

    (archive, offset, length, url, digest, payload_bytes, record_type, page_id, refers_to), sorted by place in each archive.
    """
    spark, when = pages.sparkSession, (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    kind = pages.schema[key].dataType
    ours = payloads(pages, key, url, html)
    kept = staged(shared_payloads(ours, min_bytes))
    rows = ours.join(kept, ["sha1", "xxh", "bytes"], "left").selectExpr(
        "cast(page_id AS string) AS page", "url", "payload", "sha1", "bytes",
        "CASE WHEN NOT page_id <=> refers_to THEN cast(refers_to AS string) END AS refers_to", "refers_url",
    )
    place = f"{folder.rstrip('/')}/archives"
    target = spark._jvm.org.apache.hadoop.fs.Path(place)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        archive = None
        try:
            for part in sliced(batches):
                out: dict[str, list] = {name: [] for name in ("archive", "offset", "length", "url", "digest", "payload_bytes", "record_type", "page", "refers_to")}
                for row in part.to_pylist():
                    if archive is None or archive.size >= store.archive_bytes:
                        if archive:
                            archive.close()
                        archive = Archive(place, when, store.gzip_level)
                    type_, digest, data = page_record(row, when)
                    entry = (archive.path, *archive.add(data), row["url"], digest, row["bytes"], type_, row["page"], row["refers_to"])
                    for column, value in zip(out.values(), entry):
                        column.append(value)
                kinds = {"offset": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64()}
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(n, pa.string())) for n, v in out.items()], names=list(out))
        finally:
            if archive:
                archive.close()

    index = rows.mapInArrow(
        write, "archive string, offset long, length long, url string, digest string, payload_bytes long, record_type string, page string, refers_to string"
    )
    index = index.withColumns({"page_id": F.col("page").cast(kind), "refers_to": F.col("refers_to").cast(kind)}).drop("page")
    index.write.parquet(f"{folder.rstrip('/')}/index")
    return spark.read.schema(index.schema).parquet(f"{folder.rstrip('/')}/index")


def ranges(rows, store: Store) -> Iterator[tuple[str, int, int, list]]:
    """(archive, from, to, rows): neighbouring (archive, offset, length) rows, sorted, whose bytes are read at once."""
    group: list = []
    name, start, end = "", 0, 0
    for row in rows:
        archive, offset, length = row
        near = group and archive == name and offset - end <= store.gap_bytes and max(end, offset + length) - start <= store.read_bytes
        if not near:
            if group:
                yield name, start, end, group
            group, name, start, end = [], archive, offset, offset
        group.append(row)
        end = max(end, offset + length)
    if group:
        yield name, start, end, group


def read_records(index: DataFrame, key_type: str = "long", payload: bool = True, store: Store = DEFAULT) -> DataFrame:
    """The records that the index rows (archive, offset, length) name, read from the archives alone.

    (archive, offset, page_id, url, record_type, payload_digest, payload_bytes, refers_to, intact), with `payload` also the payload (null in
    revisits). `intact` tells whether a response's payload has the digest and length that its record states.
    """
    fields = "archive string, offset long, page string, url string, record_type string, payload_digest string, payload_bytes long, refers_to string, intact boolean"
    fields += ", payload binary" * payload

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        opened, file = None, None
        schema = pa.schema([
            (name, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[kind])
            for name, kind in (field.split(" ") for field in fields.split(", "))
        ])
        rows = (tuple(row.values()) for batch in batches for row in batch.to_pylist())
        try:
            for archive, start, end, group in ranges(rows, store):
                if archive != opened:
                    if file:
                        file.close()
                    system, place = fs.FileSystem.from_uri(archive)
                    opened, file = archive, system.open_input_file(place)
                data = file.read_at(end - start, start)
                out = []
                for _, offset, length in group:
                    head, size, body = parsed(zlib.decompress(data[offset - start : offset - start + length], 31))
                    kind, stated = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                    digest = base64.b32encode(hashlib.sha1(body).digest()).decode() if kind == "response" else stated
                    found = (
                        archive, offset, head.get(PAGE), head.get("WARC-Target-URI"), kind, digest, size if kind == "revisit" else len(body),
                        head.get(REFERS_TO_PAGE), digest == stated and (kind == "revisit" or size == len(body)),
                    )
                    out.append(found + ((body if kind == "response" else None),) * payload)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        finally:
            if file:
                file.close()

    wanted = index.select("archive", "offset", "length")
    stretch = F.floor(F.col("offset") / store.stretch_bytes)
    held = index.agg(F.sum("length")).first()[0] or 0
    parts = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), held // store.stretch_bytes)
    wanted = wanted.repartition(parts, "archive", stretch).sortWithinPartitions("archive", "offset")
    found = wanted.mapInArrow(read, fields)
    return found.select(
        "archive", "offset", F.col("page").cast(key_type).alias("page_id"), "url", "record_type", "payload_digest", "payload_bytes",
        F.col("refers_to").cast(key_type).alias("refers_to"), "intact", *["payload"] * payload,
    )
