"""Line dedup by site-relative frequency.

A page's lines are its text cut at \\n, compared without the spaces, tabs and returns at both ends; blank lines are not compared. For
each host, the pages that contain a line are divided by all pages of the host; a line is boilerplate of the host if that ratio
exceeds `max_ratio` and at least `min_pages` pages have it (two: a line on one page is not repeated, whatever its share of a small
host). All its occurrences on the host's pages go; other lines
stay as they are. Equal texts of a host count as one page: copies of a page say nothing about its lines. A page of
which no line would remain is left whole, as a copied page, not a frame without content; near-dup removal deals with those.

A line counts once for each page, inside the row, and counts are pre-aggregated in the map tasks, so a line on a third of all
pages costs a row for each task. Lines on fewer than `min_pages` pages go before anything is joined. Pages
are matched with their lines to drop by a hash of host and text, so repeated rows and missing ids are no special
case; the tables joined are written first, so joins know their sizes, broadcast what is small and split hot keys.

Null text stays null and has no lines; empty text has none. A null host is a host of its own. Equal lines of a page are
dropped together. An empty table gives an empty table. All columns pass through; only the text changes. Columns named `_page`,
`_drop` and `n_dropped_lines` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetgauge.llm.common import plain_names, staged

MAX_RATIO = 0.08
MIN_PAGES = 2


def _hashes(text: str) -> str:
    """The distinct lines of a text as hashes."""
    return (
        f"array_distinct(transform(filter(transform(split({text}, '\\n', -1), l -> trim(BOTH ' \\t\\r' FROM l)), "
        "l -> l <> ''), l -> xxhash64(l)))"
    )


def boilerplate_lines(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(`_host`, `_line`): from distinct pages (`_host`, `_lines`), the hashes of lines that exceed the ratio on their host."""
    often = (
        pages.select("_host", F.explode("_lines").alias("_line")).groupBy("_host", "_line").agg(F.count("*").alias("_n"))
        .where(f"_n >= {min_pages}")
    )
    totals = pages.groupBy(F.col("_host").alias("_of")).agg(F.count("*").alias("_pages"))
    return (
        often.join(totals, often["_host"].eqNullSafe(totals["_of"])).where(f"_n > {max_ratio}D * _pages").select("_host", "_line")
    )


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """`docs` with boilerplate lines removed from `text`, and `n_dropped_lines`."""
    docs, names = plain_names(docs.drop("n_dropped_lines"))
    host, text = names[host], names[text]
    page = F.xxhash64(F.col(host), F.col(text))
    lines = docs.select(F.col(host).alias("_host"), page.alias("_page"), F.expr(_hashes(f"`{text}`")).alias("_lines"))
    lines = staged(lines.groupBy("_host", "_page").agg(F.first("_lines").alias("_lines")))
    boilerplate = staged(boilerplate_lines(lines, max_ratio, min_pages))
    hits = lines.select(F.col("_host").alias("_of"), "_page", F.explode("_lines").alias("_of_line")).join(
        boilerplate, F.col("_of").eqNullSafe(F.col("_host")) & (F.col("_of_line") == F.col("_line"))
    )
    drops = staged(hits.groupBy("_page").agg(F.collect_set("_line").alias("_drop")))
    found = docs.withColumn("_page", page).join(drops, "_page", "left")
    whole = f"split(`{text}`, '\\n', -1)"
    trimmed = "trim(BOTH ' \\t\\r' FROM l)"
    gone = f"array_contains(_drop, xxhash64({trimmed}))"
    found = found.withColumn("_kept", F.expr(f"if(_drop IS NULL, NULL, filter({whole}, l -> {trimmed} = '' OR NOT {gone}))"))
    found = found.withColumn("_kept", F.expr(f"if(exists(_kept, l -> {trimmed} <> ''), _kept, NULL)"))
    return found.withColumns({
        "n_dropped_lines": F.expr(f"cast(if(_kept IS NULL, 0, size({whole}) - size(_kept)) AS long)"),
        text: F.expr(f"if(_kept IS NULL, `{text}`, array_join(_kept, '\\n'))"),
    }).select(*[F.col(own).alias(name) for name, own in names.items()], "n_dropped_lines")
