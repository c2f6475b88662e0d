"""Declared quality rules, all checked in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """A SQL predicate every row should meet; NULL counts as a failure."""

    name: str
    predicate: str
    allowed_share: float = 0.0


READING_RULES = (
    Rule("device_known", "turbine_id IS NOT NULL"),
    Rule("time_known", "timestamp IS NOT NULL"),
    Rule("power_present", "NOT power_output_was_missing", 0.05),
    Rule("power_possible", "NOT power_output_was_invalid", 0.01),
    Rule("speed_present", "NOT wind_speed_was_missing", 0.05),
    Rule("speed_possible", "NOT wind_speed_was_invalid", 0.01),
    Rule("direction_present", "NOT wind_direction_was_missing", 0.05),
    Rule("direction_possible", "NOT wind_direction_was_invalid", 0.01),
    Rule("power_filled", "power_output IS NOT NULL", 0.01),
)


def check_rules(df: DataFrame, rules: Sequence[Rule] = READING_RULES) -> DataFrame:
    """(rule, checked_rows, failed_rows, allowed_share, passed) from one aggregate."""
    failures = [
        F.count_if(~F.coalesce(F.expr(r.predicate), F.lit(False))).alias(f"_f{i}")
        for i, r in enumerate(rules)
    ]
    totals = df.agg(F.count(F.lit(1)).alias("checked_rows"), *failures)
    results = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            F.col(f"_f{i}").alias("failed_rows"),
            F.lit(float(r.allowed_share)).alias("allowed_share"),
        )
        for i, r in enumerate(rules)
    ])
    rows = totals.select("checked_rows", F.explode(results).alias("r"))
    failed, allowed = F.col("r.failed_rows"), F.col("r.allowed_share")
    return rows.select(
        "r.rule", "checked_rows", "r.failed_rows", "r.allowed_share",
        (failed <= allowed * F.col("checked_rows")).alias("passed"),
    )
