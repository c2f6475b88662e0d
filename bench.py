"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run once to warm up and then $BENCH_RUNS times; the median wall time counts, planning
included. Results go to Spark's no-op sink, so all columns of all rows are computed.

The jobs are timed once each on generated feeds of $BENCH_LOAD_ROWS rows (two sizes; empty: none): CSV ingest and refresh of the readings
on time, the same for the tenth that is late, and the full build. Devices are Zipf-distributed. These times stand
apart under "load"; they are not in the total.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetgauge.plans.build import build_all, refresh  # noqa: E402
from fleetgauge.plans.ingest import ingest_files  # noqa: E402
from fleetgauge.plans.registry import QUERIES  # noqa: E402
from fleetgauge.session import build_session  # noqa: E402
from fleetgauge.sources.generator import generate_readings  # noqa: E402
from fleetgauge.sources.landing import FIELDS  # noqa: E402
from fleetgauge.sources.layers import SILVER, Layers  # noqa: E402

HEADLINE = (
    "dedupe", "flag_missing_invalid", "forward_fill", "forward_fill_day_carry", "silver_clean",
    "silver_clean_default", "remaining_nulls", "daily_summary", "anomalies", "anomalies_window", "turbine_kpis",
    "fleet_quality", "flakiest_top5", "chart_feed", "absent_hours",
)


def load_times(spark, rows: int) -> dict[str, float]:
    """Seconds of each job over a generated feed."""
    lake = Layers(tempfile.mkdtemp(prefix="load-", dir=os.environ.get("BENCH_SCRATCH")))
    landing = f"{lake.base}/landing"
    feed = generate_readings(spark, rows, max(10, rows // 10_000), step_seconds=10, slices=8, zipf=True, late_share=0.1)
    text = feed.select(*[name for name, _ in FIELDS], "_late")
    seconds = {}

    def timed(name: str, job) -> None:
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 2)

    for part, rule in (("", "NOT _late"), ("late_", "_late")):
        text.where(rule).drop("_late").write.option("header", "true").csv(f"{landing}/{part}rows")
        timed(f"{part}ingest", lambda: ingest_files(spark, lake, landing))
        timed(f"{part}refresh", lambda: refresh(spark, lake))
    timed("full_build", lambda: build_all(spark, lake))
    assert lake.read(spark, SILVER).count() <= rows
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    sizes = [int(n) for n in os.environ.get("BENCH_LOAD_ROWS", "100000,400000").split(",") if n]
    load = {str(rows): load_times(spark, rows) for rows in sizes}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None, "cpus": int(cpus), "runs": runs,
        "load": load,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
