"""Deterministic sensor feed of any size, for load tests."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F


def generate_readings(
    spark: SparkSession,
    rows: int,
    turbines: int,
    step_seconds: int = 3600,
    hot_share: float = 0.0,
    slices: int | None = None,
    zipf: bool = False,
    late_share: float = 0.0,
) -> DataFrame:
    """`rows` raw readings; every value follows from the row number alone.

    About one row in 50 repeats an earlier reading with a later ingestion time. `hot_share` of the rows
    belong to turbine 1, the rest are spread evenly. With `zipf` the n-th turbine gets about 1 / n of what the first gets, and
    every row has a time of its own. `late_share` of the rows are ingested one to four days after their time, and marked `_late`.
    """
    base = spark.range(0, rows, 1, slices) if slices else spark.range(rows)
    number = F.col("id")
    dice = F.pmod(F.xxhash64(number, F.lit("hot")), F.lit(1_000_000))
    original = F.when(number % 50 == 49, number - turbines).otherwise(number)
    original = F.when(original < 0, number).otherwise(original)
    hot = dice < int(hot_share * 1_000_000)
    turbine = F.when(hot, F.lit(1)).otherwise(F.col("_n") % turbines + 1).cast("int")
    if zipf:
        # the inverse of the distribution of 1 / n: the logarithm of the rank is even
        even = F.pmod(F.xxhash64(F.col("_n"), F.lit("device")), F.lit(1_000_000)) / 1_000_000
        turbine = F.least(F.floor(F.exp(even * math.log(turbines + 1))), F.lit(turbines)).cast("int")
    tick = F.when(hot | F.lit(zipf), F.col("_n")).otherwise(F.floor(F.col("_n") / turbines))
    late = F.pmod(F.xxhash64(number, F.lit("late")), F.lit(1_000_000)) < int(late_share * 1_000_000)
    delay = F.when(late, 86_400 * (1 + F.pmod(F.xxhash64(number, F.lit("delay")), F.lit(4)))).otherwise(F.lit(0))
    noise = F.pmod(F.xxhash64(F.col("_n")), F.lit(10_000)) / 10_000
    dirt = F.pmod(F.xxhash64(F.col("_n"), F.lit("dirt")), F.lit(100))
    start = F.lit("2022-01-01 00:00:00").cast("timestamp_ntz")
    return base.withColumn("_n", original).select(
        (start + F.make_dt_interval(secs=tick * step_seconds)).alias("timestamp"),
        turbine.alias("turbine_id"),
        F.when(dirt == 1, -3.2).when(dirt == 2, F.lit(None)).otherwise(noise * 25).alias("wind_speed"),
        F.when(dirt == 3, 400).when(dirt == 4, F.lit(None)).otherwise((noise * 360).cast("int")).alias("wind_direction"),
        F.when(dirt == 5, -1.0).when(dirt == 6, F.lit(float("nan"))).when(dirt == 7, F.lit(None))
        .otherwise(1.5 + noise * 3).alias("power_output"),
        (start + F.make_dt_interval(secs=number + delay)).alias("_ingested_at"),
        F.concat(F.lit("data_group_"), F.floor((turbine - 1) / 5) + 1, F.lit(".csv")).alias("_source_file"),
        *[late.alias("_late")] * (late_share > 0),
    )
