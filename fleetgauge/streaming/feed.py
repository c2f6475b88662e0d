"""Streaming entry: new and changed landing files to bronze, then the clean layers, batch by batch.

Late readings are exact here, because each batch recomputes the days they change. A stateful stream
holding the last valid value could not do that: its earlier output would have to change.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.plans.build import refresh
from fleetgauge.plans.ingest import STREAM, pending_versions, take_pending
from fleetgauge.plans.ledger import ledger
from fleetgauge.sources.landing import VERSION, stream_versions
from fleetgauge.sources.layers import Layers
from fleetgauge.streaming.changes import arrow_opens, folder_changes, folder_uri

_LOG = logging.getLogger(__name__)


def start_feed(
    spark: SparkSession,
    layers: Layers,
    landing: str,
    cfg: SensorConfig = DEFAULT,
    clean: bool = True,
    files_per_batch: int = 10_000,
    every: str | None = None,
) -> StreamingQuery:
    """Read all file versions not seen yet, then stop; with `every` ("5 minutes") look again at that interval.
    `clean=False` only fills bronze.

    The stream tells that the folder changed; which versions are new is found from the ledger, and they are read by `take_files`. So the
    stream and `ingest_files` give the same rows, refuse the same files, see files changed in place, and may be used in
    turn. A batch that is run again and a stream with a new checkpoint do no harm; batch numbers come from the ledger.

    In a store that Arrow cannot list, Spark's file stream takes the place of the source; it does not see files changed in place.
    """

    def take_in(session: SparkSession, versions: DataFrame) -> None:
        take_pending(session, layers, versions, STREAM, cfg, files_per_batch)
        if clean:
            refresh(session, layers, cfg)

    def after_change(changes: DataFrame, _: int) -> None:
        session = changes.sparkSession
        if not changes.isEmpty():
            take_in(session, pending_versions(session, layers, landing))

    def after_arrival(listed: DataFrame, _: int) -> None:
        session = listed.sparkSession
        take_in(session, listed.join(ledger(session, layers).select(*VERSION), VERSION, "left_anti"))

    state = f"{layers.base}/state/{layers.schema}"
    if arrow_opens(folder_uri(spark, landing)):
        writer = folder_changes(spark, landing).writeStream.foreachBatch(after_change)
        writer = writer.option("checkpointLocation", f"{state}/changes_checkpoint")
    else:
        _LOG.warning("%s cannot be listed by Arrow: files changed in place will not be seen", landing)
        writer = stream_versions(spark, landing, files_per_batch).writeStream.foreachBatch(after_arrival)
        writer = writer.option("checkpointLocation", f"{state}/feed_checkpoint")
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()


def run_feed(
    spark: SparkSession,
    layers: Layers,
    landing: str,
    cfg: SensorConfig = DEFAULT,
    clean: bool = True,
    timeout_seconds: int | None = None,
) -> None:
    """`start_feed`, waited for until all files are in; with `timeout_seconds` it raises if that takes longer."""
    query = start_feed(spark, layers, landing, cfg, clean)
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"feed still running after {timeout_seconds} s")
