"""URL filters: host and path rules first, then gradient-boosted trees on lexical features.

A rule is a host and a path start; it fits its host and all subdomains if the url's path begins with the rule's, and
the longest fitting rule decides. Urls without a rule are judged by trees trained here, on labelled urls: length, host length,
depth, digit ratio, entropy of the characters, parameters, hyphens, and the share of blocked urls under the same last one and
last two host labels. Suffix shares count all distinct labelled urls; their tables are joined by size. The trees are fitted on at
most `max_labelled` urls, those with the least hashes (a documented bound).

Everything is DataFrame and SQL expressions and Spark's own tree learner. The host suffix shares are smoothed towards the overall
share, so a suffix that training never saw gets that.

A null url, or one without `://`, has an empty host and path and fits no rule; the trees judge it like any other. Without labels of
both kinds, what no rule decides is allowed. Labels other than 0 and 1 and null urls are not trained on; a url
counts once for each label it has, however often it occurs. An empty table gives an empty table. All columns asked for pass through; result columns and
names beginning with `_u_` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from fleetgauge.llm.common import bounded_sample, staged

FEATURES = (
    "_u_length", "_u_host_length", "_u_labels", "_u_depth", "_u_digits", "_u_entropy", "_u_params", "_u_hyphens",
    "_u_fragment", "_u_last", "_u_last_two",
)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Trees:
    """`max_labelled` bounds the training sample; a url is blocked above `threshold`."""

    max_labelled: int = 20_000
    rounds: int = 10
    depth: int = 4
    threshold: float = 0.5
    smoothing: float = 20.0
    seed: int = 42


DEFAULT = Trees()


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def host_sql(url: str) -> str:
    return f"translate(regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def path_sql(url: str) -> str:
    return f"regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def rule_sql(rules: tuple[Rule, ...], host: str, path: str, value) -> str:
    """The value of the longest rule that fits, as SQL; null if none does. The list is part of the program, not data."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    cases = [
        f"WHEN ({host} = {_literal(r.host)} OR endswith({host}, {_literal('.' + r.host)})) AND startswith({path}, {_literal(r.path)}) "
        f"THEN {_literal(value(r))}"
        for r in ordered
    ]
    return f"CASE {' '.join(cases)} END" if cases else "cast(NULL AS string)"


def with_parts(urls: DataFrame, rules: tuple[Rule, ...], url: str = "url") -> DataFrame:
    """Add `host`, `path`, `rule` and the verdict of the rule as `_u_rule`."""
    found = urls.withColumns({"host": F.expr(host_sql(f"`{url}`")), "path": F.expr(path_sql(f"`{url}`"))})
    return found.withColumns({
        "rule": F.expr(rule_sql(rules, "host", "path", lambda r: r.text)),
        "_u_rule": F.expr(rule_sql(rules, "host", "path", lambda r: r.verdict)),
    })


def with_features(parts: DataFrame, url: str = "url") -> DataFrame:
    """Lexical features of `url`, `host` and `path`, apart from the suffix shares, and the suffixes themselves."""
    text = f"coalesce(`{url}`, '')"
    n = f"greatest(length({text}), 1)"
    # entropy over the distinct characters of the url: each costs one count of its occurrences
    chars = f"split({text}, '')"
    entropy = (
        f"if({text} = '', 0D, aggregate(array_distinct({chars}), 0D, (s, c) -> s - "
        f"((length({text}) - length(replace({text}, c, ''))) / {n}) * ln((length({text}) - length(replace({text}, c, ''))) / {n})))"
    )
    query = f"regexp_extract({text}, '[?]([^#]*)', 1)"
    return parts.withColumns({
        "_u_length": F.expr(f"cast(length({text}) AS double)"),
        "_u_host_length": F.expr("cast(length(host) AS double)"),
        "_u_labels": F.expr("cast(length(host) - length(replace(host, '.', '')) AS double)"),
        "_u_depth": F.expr("cast(length(path) - length(replace(path, '/', '')) AS double)"),
        "_u_digits": F.expr(f"length(regexp_replace({text}, '[^0-9]', '')) / {n}"),
        "_u_entropy": F.expr(entropy),
        "_u_params": F.expr(f"if({query} = '', 0D, 1D + length({query}) - length(replace({query}, '&', '')))"),
        "_u_hyphens": F.expr(f"cast(length({text}) - length(replace({text}, '-', '')) AS double)"),
        "_u_fragment": F.expr(f"if(contains({text}, '#'), 1D, 0D)"),
        "_u_suffix": F.expr("substring_index(host, '.', -1)"),
        "_u_suffix_two": F.expr("substring_index(host, '.', -2)"),
    })


class UrlModel:
    """Trained trees and the suffix shares of all labelled urls."""

    def __init__(self, trees, one: DataFrame, two: DataFrame, prior: float, how: Trees):
        self.trees, self.one, self.two, self.prior, self.how = trees, one, two, prior, how

    def assembled(self, features: DataFrame) -> DataFrame:
        joined = features.join(self.one, "_u_suffix", "left").join(self.two, "_u_suffix_two", "left")
        joined = joined.fillna({"_u_last": self.prior, "_u_last_two": self.prior})
        return VectorAssembler(inputCols=list(FEATURES), outputCol="_u_features").transform(joined)

    def blocked_share(self, features: DataFrame) -> DataFrame:
        """`features` with `_u_score`, the probability of the label 1."""
        scored = self.trees.transform(self.assembled(features))
        return scored.withColumn("_u_score", vector_to_array("_u_probability")[1]).drop(
            "_u_features", "_u_raw", "_u_probability", "_u_prediction"
        )


def train(labelled: DataFrame, how: Trees = DEFAULT, url: str = "url", label: str = "label") -> UrlModel | None:
    """Trees from labelled urls (1: block, 0: allow); None if there are not both."""
    known = labelled.where(F.col(url).isNotNull() & F.col(label).isin(0, 1)).select(
        F.col(url).alias("url"), F.col(label).cast("double").alias("_u_label")
    )
    known = staged(known.distinct())
    sample = bounded_sample(known, F.xxhash64("url"), how.max_labelled)
    sample = staged(with_features(with_parts(sample, ()), "url").drop("url", "path", "rule", "_u_rule"))
    if sample.select("_u_label").distinct().count() < 2:
        return None
    prior = known.agg(F.avg("_u_label")).first()[0]
    every = with_features(with_parts(known, ()), "url")

    def shares(suffix: str, name: str) -> DataFrame:
        smooth = (F.sum("_u_label") + F.lit(how.smoothing * prior)) / (F.count("*") + F.lit(how.smoothing))
        return staged(every.groupBy(suffix).agg(smooth.alias(name)))

    model = UrlModel(None, shares("_u_suffix", "_u_last"), shares("_u_suffix_two", "_u_last_two"), prior, how)
    learner = GBTClassifier(
        featuresCol="_u_features", labelCol="_u_label", predictionCol="_u_prediction", maxIter=how.rounds,
        maxDepth=how.depth, seed=how.seed,
    ).setProbabilityCol("_u_probability").setRawPredictionCol("_u_raw")
    model.trees = learner.fit(model.assembled(sample).select("_u_features", "_u_label"))
    return model


def filter_urls(urls: DataFrame, rules: tuple[Rule, ...], model: UrlModel | None, url: str = "url") -> DataFrame:
    """`urls` with `host`, `path`, `rule` and `verdict` (allow or block)."""
    passed = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict") and not c.startswith("_u_")]
    parts = with_parts(urls.select(*passed), rules, url)
    if model is None:
        return parts.withColumn("verdict", F.coalesce("_u_rule", F.lit("allow"))).drop("_u_rule")
    scored = model.blocked_share(with_features(parts, url))
    judged = F.when(F.col("_u_score") > model.how.threshold, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce(F.col("_u_rule"), judged)).select(*passed, "host", "path", "rule", "verdict")


def labelled_by_rules(urls: DataFrame, rules: tuple[Rule, ...], url: str = "url") -> DataFrame:
    """(url, label) of the urls that a rule decides: the allow and block lists as labels."""
    parts = with_parts(urls.select(F.col(url).alias("url")), rules)
    return parts.where("_u_rule IS NOT NULL").select("url", F.expr("int(_u_rule = 'block')").alias("label"))
