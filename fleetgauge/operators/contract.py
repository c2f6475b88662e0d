"""Data contracts: declared rules over rows, keys, other tables, devices and time.

All rules over rows and over groups of one kind (a device's newest reading, its share of bad rows) come from one aggregate: counts for
each group, formed in the map tasks first, and one row over the groups. A uniqueness rule is one more aggregate on its key, a
reference one anti join. Nothing is collected, and no rule holds the rows of a key together.

| Kind | Checked | Failed |
| --- | --- | --- |
| row | rows | rows for which the predicate is not true |
| unique | rows whose key has no NULL | those beyond the first of each key |
| reference | rows whose key has no NULL | those without a partner in the named table |
| fresh | groups | groups whose newest value is older than the limit, or which have none |
| share | groups | groups in which the predicate is not true for more than the given share of rows |
| volume | 1 | 1 if the table has fewer rows than demanded |

Rows without a group count for rules over rows and volume only. A rule passes if failed <= allowed_share * checked, so an empty table
breaks volume rules alone.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fleetgauge.functions.quality import quoted
from fleetgauge.operators.rules import Rule


@dataclass(frozen=True)
class Unique:
    name: str
    columns: tuple[str, ...]
    allowed_share: float = 0.0


@dataclass(frozen=True)
class Reference:
    """Every key must occur in `table`, there under the names `keys` (the same, if not given)."""

    name: str
    columns: tuple[str, ...]
    table: str
    keys: tuple[str, ...] = ()
    allowed_share: float = 0.0


@dataclass(frozen=True)
class Fresh:
    """The newest `column` of each group lies within `seconds` before `as_of`, or before the newest of the whole table."""

    name: str
    column: str
    seconds: int
    by: tuple[str, ...]
    as_of: str | None = None
    allowed_share: float = 0.0


@dataclass(frozen=True)
class Share:
    """In each group the predicate is true for all rows but the share `most`."""

    name: str
    predicate: str
    most: float
    by: tuple[str, ...]
    allowed_share: float = 0.0


@dataclass(frozen=True)
class Volume:
    name: str
    least: int
    allowed_share: float = 0.0


KINDS = {"row": Rule, "unique": Unique, "reference": Reference, "fresh": Fresh, "share": Share, "volume": Volume}
AnyRule = Rule | Unique | Reference | Fresh | Share | Volume
RESULT = ("rule", "kind", "checked", "failed", "allowed_share", "passed")


class ContractError(ValueError):
    """A contract that cannot be read, or data that break it."""


def read_contract(text: str) -> tuple[AnyRule, ...]:
    """The rules of a contract in JSON: {"rules": [{"kind": ..., "name": ..., ...}, ...]}; the other fields are those of the kind."""
    rules: list[AnyRule] = []
    for entry in json.loads(text)["rules"]:
        given = dict(entry)
        kind = KINDS.get(given.pop("kind", "row"))
        if kind is None:
            raise ContractError(f"unknown kind of rule: {entry}")
        unknown = set(given) - {f.name for f in fields(kind)}
        if unknown:
            raise ContractError(f"unknown fields {sorted(unknown)} in rule {entry.get('name')}")
        try:
            rules.append(kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()}))
        except TypeError as e:
            raise ContractError(f"rule {entry.get('name')}: {e}") from e
    names = [rule.name for rule in rules]
    if len(set(names)) < len(names):
        raise ContractError(f"two rules have one name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    for rule in rules:
        if isinstance(rule, Fresh) and rule.as_of is not None:
            datetime.fromisoformat(rule.as_of)
    return tuple(rules)


def _kind(rule: AnyRule) -> str:
    return next(name for name, kind in KINDS.items() if type(rule) is kind)


def _fails(predicate: str) -> Column:
    return F.count_if(~F.coalesce(F.expr(predicate), F.lit(False)))


def _results(totals: DataFrame, rules: Sequence[AnyRule]) -> DataFrame:
    """One row for each rule, from one row with its columns _checked<i> and _failed<i>."""
    rows = F.array(*[
        F.struct(
            F.lit(rule.name).alias("rule"), F.lit(_kind(rule)).alias("kind"),
            F.coalesce(F.col(f"_checked{i}"), F.lit(0)).cast("long").alias("checked"),
            F.coalesce(F.col(f"_failed{i}"), F.lit(0)).cast("long").alias("failed"),
            F.lit(float(rule.allowed_share)).alias("allowed_share"),
        )
        for i, rule in enumerate(rules)
    ])
    found = totals.select(F.explode(rows).alias("r")).select("r.*")
    return found.withColumn("passed", F.col("failed") <= F.col("allowed_share") * F.col("checked")).select(*RESULT)


def _grouped(df: DataFrame, by: tuple[str, ...], rules: Sequence[AnyRule]) -> DataFrame:
    """Rules over the groups `by`, and over rows, from one aggregate for each group."""
    within: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for i, rule in enumerate(rules):
        if isinstance(rule, Fresh):
            within.append(F.max(quoted(rule.column)).alias(f"_newest{i}"))
        elif isinstance(rule, (Rule, Share)):
            within.append(_fails(rule.predicate).alias(f"_bad{i}"))
    groups = df.groupBy(*[F.col(quoted(name)) for name in by]).agg(*within)
    named = reduce(Column.__and__, [F.col(quoted(name)).isNotNull() for name in by], F.lit(True))
    over: list[Column] = []
    for i, rule in enumerate(rules):
        if isinstance(rule, Fresh):
            newest = F.col(f"_newest{i}")
            kind = df.schema[rule.column].dataType
            as_of = F.lit(rule.as_of).cast(kind) if rule.as_of else groups.agg(F.max(f"_newest{i}")).scalar()
            late = newest.isNull() | (newest < as_of - F.make_dt_interval(secs=F.lit(rule.seconds)))
            over += [F.count_if(named).alias(f"_checked{i}"), F.count_if(named & late).alias(f"_failed{i}")]
        elif isinstance(rule, Share):
            above = F.col(f"_bad{i}") > F.lit(float(rule.most)) * F.col("_rows")
            over += [F.count_if(named).alias(f"_checked{i}"), F.count_if(named & above).alias(f"_failed{i}")]
        elif isinstance(rule, Volume):
            short = F.coalesce(F.sum("_rows"), F.lit(0)) < rule.least
            over += [F.lit(1).alias(f"_checked{i}"), short.cast("int").alias(f"_failed{i}")]
        else:
            over += [F.sum("_rows").alias(f"_checked{i}"), F.sum(f"_bad{i}").alias(f"_failed{i}")]
    return _results(groups.agg(*over), rules)


def _with_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(quoted(name)).alias(f"_k{i}") for i, name in enumerate(columns)]).dropna()


def _unique(df: DataFrame, rule: Unique) -> DataFrame:
    keys = [f"_k{i}" for i in range(len(rule.columns))]
    counts = _with_key(df, rule.columns).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _results(counts.agg(F.sum("_n").alias("_checked0"), F.sum(F.col("_n") - 1).alias("_failed0")), [rule])


def _reference(df: DataFrame, rule: Reference, table: DataFrame) -> DataFrame:
    """Keys shrink to distinct ones with their counts before they meet the table, so a hot key is one row in the join."""
    keys = [f"_k{i}" for i in range(len(rule.columns))]
    counts = _with_key(df, rule.columns).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    known = _with_key(table, rule.keys or rule.columns).distinct().withColumn("_known", F.lit(True))
    marked = counts.join(known, keys, "left")
    lost = F.sum(F.when(F.col("_known").isNull(), F.col("_n")))
    return _results(marked.agg(F.sum("_n").alias("_checked0"), lost.alias("_failed0")), [rule])


def check_contract(df: DataFrame, rules: Sequence[AnyRule], tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(rule, kind, checked, failed, allowed_share, passed): one row for each rule; `tables` holds those that references name."""
    tables = tables or {}
    plain = [r for r in rules if isinstance(r, (Rule, Volume))]
    grouped: dict[tuple[str, ...], list[AnyRule]] = {}
    for rule in rules:
        if isinstance(rule, (Fresh, Share)):
            grouped.setdefault(tuple(rule.by), []).append(rule)
    if plain:
        # the counts of the first grouping add up to those of the table
        by = next(iter(grouped), ())
        grouped[by] = [*grouped.get(by, []), *plain]
    parts = [_grouped(df, by, of) for by, of in grouped.items()]
    for rule in rules:
        if isinstance(rule, Unique):
            parts.append(_unique(df, rule))
        elif isinstance(rule, Reference):
            if rule.table not in tables:
                raise ContractError(f"rule {rule.name} refers to a table that was not given: {rule.table}")
            parts.append(_reference(df, rule, tables[rule.table]))
    if not parts:
        raise ContractError("a contract without rules")
    return reduce(DataFrame.unionByName, parts)


def require(results: DataFrame) -> None:
    """Raise `ContractError` with the rules that do not hold. The results are one row for each rule."""
    broken = results.filter(~F.col("passed")).orderBy("rule").collect()
    if broken:
        raise ContractError("; ".join(f"{r['rule']}: {r['failed']} of {r['checked']} failed" for r in broken))


def breaking_rows(df: DataFrame, rules: Sequence[AnyRule], tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows that fail a row, unique or reference rule, with the names of those rules in `_broken`.

    Of rows that share a unique key all are given, as none of them is known to be the right one. Keys meet the rows as small tables of
    the keys at fault; Spark broadcasts these by their size, beyond that adaptive execution splits hot keys.
    """
    tables = tables or {}
    marks: list[Column] = []
    names = df.columns
    for i, rule in enumerate(rules):
        if isinstance(rule, Rule):
            marks.append(F.when(~F.coalesce(F.expr(rule.predicate), F.lit(False)), F.lit(rule.name)))
        elif isinstance(rule, (Unique, Reference)):
            keys = [f"_k{n}" for n in range(len(rule.columns))]
            counts = _with_key(df.select(*map(quoted, names)), rule.columns).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            if isinstance(rule, Unique):
                faulty = counts.filter("_n > 1")
            else:
                known = _with_key(tables[rule.table], rule.keys or rule.columns)
                faulty = counts.join(known, keys, "left_anti")
            own = [f"_b{i}_{n}" for n in range(len(keys))]
            faulty = faulty.select(*[F.col(k).alias(o) for k, o in zip(keys, own)])
            same = [F.col(quoted(c)) == F.col(o) for c, o in zip(rule.columns, own)]
            df = df.join(faulty, reduce(Column.__and__, same), "left")
            marks.append(F.when(F.col(own[0]).isNotNull(), F.lit(rule.name)))
    if not marks:
        return df.limit(0).withColumn("_broken", F.array().cast("array<string>"))
    broken = F.array_compact(F.array(*marks))
    return df.withColumn("_broken", broken).filter(F.size("_broken") > 0).select(*map(quoted, names), "_broken")
