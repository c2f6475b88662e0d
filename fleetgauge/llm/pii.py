"""Personal data: base patterns, and identifiers found by bootstrapped contextual extraction.

The base patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers in whole texts. They are the seed entities
of a graph between instances and lexical patterns (the word before, the two words before, the word after; digits count as 0).
An instance is any run of letters, digits and `@._%+/-` with a digit, `@` or `_` in it, and any sequence of numbers or of
colon-joined groups as a whole: what an identifier may look like is left open, and precision is left to the scores. Context words are
whole words; one of over 256 code points gives no pattern. In each round, a pattern is scored by the share of its distinct
instances that are known, an instance by the noisy-or of the good patterns that extract it; instances above a
threshold become known, with the kind that speaks for them most, and stay so; rounds go on until no instance becomes known. At
the end, an unseen identifier is reported where a good
pattern extracts it and it has become known. Base spans always stay.

Everything is DataFrame and SQL expressions. Positions come from the lengths of the pieces between matches, counted in code points.
The regular expressions are possessive where that changes nothing, so long runs cost linear time and no stack. The graph
holds distinct pairs, pre-aggregated; scores are written tables, so joins split hot patterns or broadcast small sides
by size. Nothing is collected but one row for each round.

Null text counts as empty and has no spans. Repeated rows are scanned each for itself and strengthen nothing, since the graph
counts distinct strings. Equal scores are settled by the order of the kinds. An empty table gives an empty table. All columns
asked for pass through, but for names that begin with `_`; result columns replace those of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from fleetgauge.llm.common import dropped, plain_names, staged

KINDS = ("email", "ip", "card", "phone")
# A match may start where the one before ended, or where no character of its first class stands before it: that
# finds what a plain leftmost search finds, without trying every place of a long run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap tests without which a text has no match of the kind.
NEEDS = {"email": "contains({0}, '@')", "ip": r"{0} rlike '[0-9]\\.[0-9]'", "card": "{0} rlike '[0-9][0-9]'", "phone": "contains({0}, '+')"}
_DIGITS = "regexp_replace({0}, '[^0-9]', '')"
VALID = {
    "email": "true",
    "ip": "forall(split({0}, '[.]'), p -> length(ltrim('0', p)) <= 3 AND cast(right(concat('000', p), 3) AS int) <= 255)",
    "card": f"length({_DIGITS}) BETWEEN 16 AND 19 AND luhn_check({_DIGITS})",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
}
# Strings that may be identifiers: runs of these characters with a digit or a joining sign in them, numbers in groups, groups with colons.
CANDIDATES = {
    "token": (r"(?<![A-Za-z0-9@._%+/-])[A-Za-z.%+/-]*+[0-9@_][A-Za-z0-9@._%+/-]*+", "{0} rlike '[0-9@_]'"),
    "numbers": (r"(?<![A-Za-z0-9@._%+/(-])\(?[0-9]++\)?(?:[\x20./-]\(?[0-9]++\)?)++(?![A-Za-z0-9])", "{0} rlike '[0-9][) ./-]'"),
    "colons": (r"(?<![A-Za-z0-9:])[A-Za-z0-9]++(?:::?[A-Za-z0-9]++){2,}+", "contains({0}, ':')"),
}
WORD = 256  # code points that a context word may have


@dataclass(frozen=True)
class Bootstrap:
    """A pattern is good with `min_known` distinct known instances that are `min_share` of all its instances; an instance
    becomes known at a score of `min_score`."""

    min_known: int = 10
    min_share: float = 0.8
    min_score: float = 0.8


DEFAULT = Bootstrap()


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pieces(text: str, pattern: str, needs: str) -> tuple[str, str]:
    """The matches of a pattern and the texts between them, one more."""
    some = needs.format(text)
    return (
        f"if({some}, regexp_extract_all({text}, {_quoted(pattern)}, 0), array())",
        f"if({some}, split({text}, {_quoted(pattern)}, -1), array({text}))",
    )


BLOCK = 256  # matches whose places are added up one by one; texts with more are taken in blocks


def _placed(matches: str, between: str, valid: str, kind: str) -> str:
    """Matches that are valid as (kind, start, end, string).

    Places add up the lengths before them: within blocks of matches, then over blocks, so appending stays cheap when a text has
    tens of thousands of matches.
    """
    span = "struct<kind:string,start:int,end:int,string:string>"
    start = f"acc.at + length(element_at({between}, i + 1))"
    step = f"""
        named_struct('at', {start} + length(element_at({matches}, i + 1)), 'found',
          if({valid.format(f"element_at({matches}, i + 1)")}, array_append(acc.found, named_struct(
            'kind', {kind}, 'start', {start}, 'end', {start} + length(element_at({matches}, i + 1)),
            'string', element_at({matches}, i + 1))), acc.found))"""
    empty = f"cast(array() AS array<{span}>)"
    blocks = (
        f"transform(sequence(0, (size({matches}) - 1) div {BLOCK}), b -> aggregate("
        f"sequence(cast(b * {BLOCK} AS int), cast(least(size({matches}), (b + 1) * {BLOCK}) - 1 AS int)), "
        f"named_struct('at', 0, 'found', {empty}), (acc, i) -> {step}))"
    )
    starts = "aggregate(blocks, named_struct('at', 0, 'starts', cast(array() AS array<int>)), (acc, x) -> named_struct('at', acc.at + x.at, 'starts', array_append(acc.starts, acc.at)), acc -> acc.starts)"
    moved = "transform(x.found, s -> named_struct('kind', s.kind, 'start', s.start + at, 'end', s.end + at, 'string', s.string))"
    whole = f"flatten(transform(array({blocks}), blocks -> flatten(zip_with(blocks, {starts}, (x, at) -> {moved}))))"
    return f"if(size({matches}) = 0, {empty}, {whole})"


CHUNK = 512  # more than a context word; a text is cut into chunks of so many code points, so a context costs the same anywhere in a long text


def _around(spans: str, chunks: str) -> str:
    """Spans with the texts before and after them, as far as the longest word, and one code point that tells whether a word goes on."""
    chunk = f"coalesce(get({chunks}, {{0}}), '')"
    before, own, after = (chunk.format(f"{{0}} div {CHUNK} {step}") for step in ("- 1", "", "+ 1"))
    pair = f"concat({before.format('s.start')}, left({own.format('s.start')}, s.start % {CHUNK}))"
    rest = f"substr(concat({own.format('s.end')}, {after.format('s.end')}), s.end % {CHUNK} + 1, {WORD + 1})"
    return (
        f"transform({spans}, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'string', s.string, "
        f"'left', right({pair}, {WORD + 1}), 'right', {rest}))"
    )


def with_base_spans(docs: DataFrame, text: str = "text", candidates: bool = True) -> DataFrame:
    """Add `_spans`, the base spans by kind and start, and `_others`, possible identifiers that touch none of them."""
    source = f"coalesce(`{text}`, '')"
    columns, placed = {}, {}
    for kind in KINDS:
        columns[f"_m_{kind}"], columns[f"_b_{kind}"] = map(F.expr, _pieces(source, PATTERNS[kind], NEEDS[kind]))
        placed[f"_s_{kind}"] = F.expr(_placed(f"_m_{kind}", f"_b_{kind}", VALID[kind], f"'{kind}'"))
    if candidates:
        for kind, (pattern, needs) in CANDIDATES.items():
            columns[f"_m_{kind}"], columns[f"_b_{kind}"] = map(F.expr, _pieces(source, pattern, needs))
            placed[f"_s_{kind}"] = F.expr(_placed(f"_m_{kind}", f"_b_{kind}", "{0} rlike '[A-Za-z0-9]'", "'other'"))
    found = docs.withColumns(columns).withColumns(placed)
    found = found.withColumn("_spans", F.concat(*(f"_s_{kind}" for kind in KINDS)))
    if candidates:
        free = f"filter(concat({', '.join(f'_s_{kind}' for kind in CANDIDATES)}), o -> NOT exists(_spans, s -> s.start < o.end AND o.start < s.end))"
        # what ends a sentence is no part of the identifier
        core = "rtrim('._%+/-', o.string)"
        found = found.withColumn("_others", F.expr(
            f"transform({free}, o -> named_struct('kind', o.kind, 'start', o.start, 'end', o.start + length({core}), 'string', {core}))"
        ))
        some = "size(_spans) + size(_others) > 0"
        columns["_chunks"] = F.expr(f"if({some}, regexp_extract_all({source}, '(?s).{{1,{CHUNK}}}', 0), array())")
        found = found.withColumn("_chunks", columns["_chunks"])
        found = found.withColumns({c: F.expr(_around(c, "_chunks")) for c in ("_spans", "_others")})
    return found.drop(*columns, *placed)


def _contexts(span: str) -> str:
    """The lexical patterns around a span."""
    # a word that the limit cuts is left out: the first of a full left side, the last of a full right one
    space = "'[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'"
    plain = f"split(lower(regexp_replace({span}.{{0}}, '[0-9]+', '0')), {space})"
    cut = f"if(length({span}.{{0}}) > {WORD}, 1, 0)"
    before, behind = plain.format("left"), plain.format("right")
    words = f"filter({before}, (w, i) -> w <> '' AND i >= {cut.format('left')})"
    after = f"filter({behind}, (w, i) -> w <> '' AND i < size({behind}) - {cut.format('right')})"
    return (
        f"filter(array(if(size({words}) >= 1, concat('1 ', element_at({words}, -1)), NULL), "
        f"if(size({words}) >= 2, concat('2 ', element_at({words}, -2), ' ', element_at({words}, -1)), NULL), "
        f"if(size({after}) >= 1, concat('+ ', element_at({after}, 1)), NULL)), p -> p IS NOT NULL)"
    )


def bootstrap(found: DataFrame, how: Bootstrap = DEFAULT) -> tuple[DataFrame, DataFrame] | None:
    """Good patterns (`pattern`, `kind`) and known instances (`string`, `kind`) that the base patterns do not see.

    `found` is the written table of `with_base_spans`. None if nothing new is found.
    """
    seen = found.select(F.explode(F.concat("_spans", "_others")).alias("s")).select(
        "s.string", "s.kind", F.explode(F.expr(_contexts("s"))).alias("pattern")
    )
    # distinct pairs; a pattern with fewer instances than a good one needs can never become good
    pairs = staged(seen.groupBy("pattern", "string").agg(F.min("kind").alias("kind")))
    total = pairs.groupBy("pattern").agg(
        F.count("*").alias("n"), F.expr("count_if(kind = 'other')").alias("n_other")
    ).where(f"n >= {how.min_known} AND n_other > 0")
    total = staged(total.select("pattern", "n"))
    graph = staged(pairs.join(total, "pattern"))
    seeds = staged(graph.where("kind <> 'other'").select("string", "kind").distinct())
    learned, good = staged(seeds.limit(0)), None
    while True:
        labelled = graph.drop("kind").join(seeds.union(learned), "string")
        shares = labelled.groupBy("pattern", "kind").agg(F.count("*").alias("k"), F.max("n").alias("n"))
        before, good = good, staged(
            shares.where(f"k >= {how.min_known} AND k >= {how.min_share}D * n")
            .select("pattern", "kind", F.expr("least(0.99D, k / n)").alias("share"))
        )
        if before:
            dropped(before)
        scored = graph.where("kind = 'other'").select("pattern", "string").join(good, "pattern")
        scored = scored.groupBy("string", "kind").agg(F.expr("1D - exp(sum(ln(1D - share)))").alias("score"))
        best = scored.where(f"score >= {how.min_score}D").groupBy("string").agg(
            F.expr("min_by(kind, named_struct('s', -score, 'k', kind))").alias("kind")
        )
        # what is known stays known with its kind, so the set only grows and the rounds end
        new = staged(best.join(learned, "string", "left_anti"))
        if new.isEmpty():
            break
        older, learned = learned, staged(learned.union(new))
        dropped(older)
        dropped(new)
    return (good, learned) if not learned.isEmpty() else None


def find_pii(docs: DataFrame, text: str = "text", carry: list[str] | None = None, how: Bootstrap = DEFAULT) -> DataFrame:
    """The columns `carry` (all by default) with `spans` and `base_spans`: (kind, start, end), by kind and start."""
    carry = [c for c in (carry or docs.columns) if c not in ("spans", "base_spans") and c[:1] != "_"]
    # spans depend on the text alone, so what is learned meets the rows again by its hash, and no text is copied or moved
    named = docs.select(*carry, F.col(text).alias("_source"), F.xxhash64(text).alias("_hash"))
    found = staged(with_base_spans(named.select("_source", "_hash"), "_source").select("_hash", "_spans", "_others"))
    learned = bootstrap(found, how)
    result = with_base_spans(named, "_source", candidates=False)
    if learned:
        good, known = learned
        hits = (
            found.select("_hash", F.explode("_others").alias("s")).select("_hash", "s", F.explode(F.expr(_contexts("s"))).alias("pattern"))
            .join(good.select("pattern").distinct(), "pattern", "left_semi")
            .select("_hash", "s", F.col("s.string").alias("string")).join(known.withColumnRenamed("kind", "_kind"), "string")
            .groupBy("_hash").agg(F.collect_set(F.expr("named_struct('kind', _kind, 'start', s.start, 'end', s.end)")).alias("_added"))
        )
        result = result.join(staged(hits), "_hash", "left")
    else:
        result = result.withColumn("_added", F.expr("cast(NULL AS array<struct<kind:string,start:int,end:int>>)"))
    order = ", ".join(f"'{k}'" for k in KINDS)
    base = "transform(_spans, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end))"
    keyed = (
        f"array_sort(transform(concat({base}, _added), s -> "
        f"named_struct('k', cast(array_position(array({order}), s.kind) AS int), 'start', s.start, 'end', s.end)))"
    )
    spans = f"if(_added IS NULL, {base}, transform({keyed}, s -> named_struct('kind', element_at(array({order}), s.k), 'start', s.start, 'end', s.end)))"
    return result.withColumns({"spans": F.expr(spans), "base_spans": F.expr(base)}).select(*carry, "spans", "base_spans")


def joined_spans(spans: str) -> str:
    """kind:start:end of each span, joined by commas, as SQL."""
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def redacted(text: str, spans: str) -> str:
    """A text with each span replaced by its kind in brackets, as SQL. Spans that overlap count as one, of the first one's kind."""
    ordered = f"array_sort(transform({spans}, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))"
    merged = f"""aggregate({ordered}, cast(array() AS array<struct<start:int,end:int,kind:string>>), (acc, s) ->
        if(size(acc) > 0 AND s.start < element_at(acc, -1).end,
           if(s.end <= element_at(acc, -1).end, acc, array_append(slice(acc, 1, size(acc) - 1), named_struct('start',
              element_at(acc, -1).start, 'end', s.end, 'kind', element_at(acc, -1).kind))),
           array_append(acc, s)))"""
    return f"""if({text} IS NULL OR size({spans}) = 0, {text}, aggregate(array({merged}), '', (none, m) -> concat(
        array_join(transform(m, (s, i) -> concat(
            substr({text}, if(i = 0, 1, m[i - 1].end + 1), s.start - if(i = 0, 0, m[i - 1].end)), '[', upper(s.kind), ']')), ''),
        substr({text}, element_at(m, -1).end + 1))))"""


def redact_pii(docs: DataFrame, text: str = "text", how: Bootstrap = DEFAULT) -> DataFrame:
    """`docs` with every span of personal data in `text` replaced by its kind in brackets."""
    # under names of its own no column can clash with those made here
    plain, names = plain_names(docs)
    found = find_pii(plain, names[text], how=how)
    found = found.withColumn(names[text], F.expr(redacted(names[text], "spans")))
    return found.select(*[F.col(own).alias(name) for name, own in names.items()])
