"""Ranked lexical search: each item's best documents, by dense matrix products over blocks.

Terms are the maximal matches of `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+` with A-Z in lower case. With N documents that have a term, L
terms in all of them, n terms in one, df documents with a term and tf of it in a document, a term weighs
floor(1000 ln((2N + 2) / (2 df + 1))), a document has m = 50 + (50 n N) div L, and its score is the sum of weight * ((10^9 tf) div
(1000 tf + 20 m)) over the item's distinct terms. All but the logarithm are whole numbers.

Items are taken in blocks of about `block_pairs` terms, one pass over all documents each:
1. every text is reduced to the counts of the block's terms and its length, written to the shared folder;
2. these give N, L and df (summed in each task first), and so the weights;
3. tasks build tiles: the compact vocabulary of `item_tile` items, cut to `term_tile` terms, as a dense matrix of weights, and the impacts of
   `doc_tile` documents on these terms as another. Their product is one BLAS call in float64. An impact is below 10^6, so a tile is
   narrow enough that every partial sum stays below 2^53 and is exact; tiles are added in 64-bit integers;
4. each task keeps the `k` best documents of every item, ties by smaller id; those are ranked in two rounds, so that no task gets the best of
   all tasks at once.

Texts that are null, empty or without terms do not count. Rows that repeat an id are documents of their own; equal scores and ids give equal
rows. A document with a null id counts in N, L and df but cannot be returned. Item rows with equal ids (null is one too) are one
item with all their terms; an item without terms returns nothing. Empty tables give an empty table. Ids of documents must be whole
numbers. Only the named columns are read. One block's terms pass through the driver: `block_pairs`, plus those of the longest item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from fleetgauge.llm.common import TASK_BYTES, input_bytes, sliced, staged, utf8

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# UTF-8 bytes: letters, digits and all of other characters stay, the rest parts terms.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
IMPACT = 10**9
# 10^9 tf div (1000 tf + 20 m) is below this.
MOST_IMPACT = 10**6
EXACT = 2**53


@dataclass(frozen=True)
class Tiles:
    block_pairs: int = 500_000
    item_tile: int = 128
    term_tile: int = 2048
    doc_tile: int = 512
    # Tasks whose best documents meet in one task of the first round of ranking.
    tasks_together: int = 1000


DEFAULT = Tiles()


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term): the distinct terms of every item."""
    found = F.array_distinct(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0)))
    return items.select(F.col(key).alias("item"), F.explode(found).alias("term")).distinct()


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(doc_id, n, terms, times): length of every text with terms, and how often it has those of the vocabulary."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        number = vocabulary.get
        for part in sliced(batches):
            kept, sizes, terms, times, edges = [], [], [], [], [0]
            for row, value in enumerate(utf8(part[text])):
                words = value.translate(FOLD).split()
                if not words:
                    continue
                counts = Counter(map(number, words))
                counts.pop(None, None)
                kept.append(row)
                sizes.append(len(words))
                terms.extend(counts)
                times.extend(counts.values())
                edges.append(len(terms))
            edges = pa.array(edges, pa.int32())
            lists = [pa.ListArray.from_arrays(edges, pa.array(np.array(x, "int32"))) for x in (terms, times)]
            ids = part[key].take(pa.array(kept, pa.int64())).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "times"])

    return docs.select(key, text).mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def document_frequencies(counted: DataFrame, terms: int) -> list[int]:
    """For each term of the block the documents that have it; a task hands on one row for each term."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros(terms, "int64")
        for part in batches:
            total += np.bincount(np.asarray(part["terms"].flatten()), minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype("int32")), pa.array(total[some])], names=["term", "df"])

    out = [0] * terms
    for row in counted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


class Tile:
    """Weights of some items over their compact vocabulary, as dense matrices of bounded width."""

    def __init__(self, first: int, items: list[list[int]], weights: list[int], shape: Tiles):
        import numpy as np

        self.first, self.items = first, len(items)
        row = np.repeat(np.arange(len(items)), [len(i) for i in items])
        term = np.array([t for i in items for t in i], "int32")
        self.terms, place = np.unique(term, return_inverse=True)
        weight = np.asarray(weights, "float64")[term] if len(term) else np.zeros(0)
        # partial sums of a product have at most `wide` summands of weight times impact
        self.wide = max(1, min(shape.term_tile, (EXACT - 1) // (MOST_IMPACT * max(1, int(weight.max(initial=0))))))
        order = np.argsort(place, kind="stable")
        self.row, self.place, self.weight = row[order], place[order], weight[order]

    def scores(self, row, term, impact, docs: int):
        """Whole-number scores (items x documents) from the documents' (row, term, impact)."""
        import numpy as np

        place = np.searchsorted(self.terms, term)
        ours = self.terms[np.minimum(place, len(self.terms) - 1)] == term
        row, place, impact = row[ours], place[ours], impact[ours]
        total = np.zeros((self.items, docs), "int64")
        for a in range(0, len(self.terms), self.wide):
            b = min(a + self.wide, len(self.terms))
            here = (place >= a) & (place < b)
            if not here.any():
                continue
            theirs = np.zeros((b - a, docs))
            theirs[place[here] - a, row[here]] = impact[here]
            own = np.zeros((self.items, b - a))
            low, high = np.searchsorted(self.place, (a, b))
            own[self.row[low:high], self.place[low:high] - a] = self.weight[low:high]
            total += (own @ theirs).astype("int64")
        return total


class Best:
    """The k best documents of each item so far: highest score, then smallest id. A score of 0 means none."""

    def __init__(self, items: int, k: int):
        import numpy as np

        self.k = k
        self.score = np.zeros((items, k), "int64")
        self.doc = np.full((items, k), np.iinfo("int64").max)

    def add(self, first: int, scores, docs) -> None:
        import numpy as np

        own = slice(first, first + len(scores))
        last, last_doc = self.score[own, -1:], self.doc[own, -1:]
        better = (scores > last) | ((scores == last) & (scores > 0) & (docs[None] < last_doc))
        for item in np.flatnonzero(better.any(1)).tolist():
            new, at = better[item], first + item
            score, doc = np.r_[self.score[at], scores[item, new]], np.r_[self.doc[at], docs[new]]
            order = np.lexsort((doc, -score))[: self.k]
            self.score[at], self.doc[at] = score[order], doc[order]


def best_of_tasks(
    counted: DataFrame, items, kind: str, lists: list[list[int]], weights: list[int], n_docs: int, n_terms: int, k: int, shape: Tiles
) -> DataFrame:
    """(item_id, doc_id, score): in every task the k best documents of each item. `items` are the ids in Arrow, of Spark's type `kind`."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tiles = [Tile(a, lists[a : a + shape.item_tile], weights, shape) for a in range(0, len(lists), shape.item_tile)]
        best = Best(len(lists), k)
        for batch in batches:
            for at in range(0, len(batch), shape.doc_tile):
                part = batch.slice(at, shape.doc_tile)
                part = part.filter(part["doc_id"].is_valid())
                docs = np.asarray(part["doc_id"])
                m = np.array([50 + 50 * n * n_docs // n_terms for n in part["n"].to_pylist()], "int64")
                row = np.repeat(np.arange(len(part)), np.diff(np.asarray(part["terms"].offsets)))
                term, times = np.asarray(part["terms"].flatten()), np.asarray(part["times"].flatten()).astype("int64")
                impact = IMPACT * times // (1000 * times + 20 * m[row])
                for tile in tiles:
                    best.add(tile.first, tile.scores(row, term, impact, len(docs)), docs)
        item, place = np.nonzero(best.score)
        yield pa.RecordBatch.from_arrays(
            [items.take(pa.array(item)), pa.array(best.doc[item, place]), pa.array(best.score[item, place])], names=["item_id", "doc_id", "score"]
        )

    return counted.mapInArrow(run, f"item_id {kind}, doc_id long, score long")


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item_id", *by).orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def ranked_search(
    items: DataFrame, docs: DataFrame, k: int = 50, item_key: str = "item_id", item_text: str = "text",
    key: str = "doc_id", text: str = "text", shape: Tiles = DEFAULT,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each item, best first, ties to smaller ids."""
    kind = items.schema[item_key].dataType.simpleString()
    pairs = staged(item_terms(items, item_key, item_text))
    blocks = max(1, -(-pairs.count() // shape.block_pairs))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = []
    for number in range(blocks):
        table = pairs.where(block == number).sort("item", "term").toArrow()
        names, terms = table["item"].combine_chunks(), table["term"].to_pylist()
        vocabulary = {term.encode(): i for i, term in enumerate(dict.fromkeys(terms))}
        ids, lists = _by_item(names, [vocabulary[term.encode()] for term in terms])
        counted = staged(term_counts(docs, vocabulary, key, text))
        totals = counted.agg(F.count("n").alias("docs"), F.sum("n").alias("terms")).first()
        if not totals["docs"] or not lists:
            continue
        weights = [
            math.floor(1000 * math.log((2 * totals["docs"] + 2) / (2 * df + 1)))
            for df in document_frequencies(counted, len(vocabulary))
        ]
        part = best_of_tasks(counted, ids, kind, lists, weights, totals["docs"], totals["terms"], k, shape)
        salts = max(1, input_bytes(counted) // TASK_BYTES // shape.tasks_together)
        part = _ranked(part.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts))), k, "_salt")
        found.append(_ranked(part.drop("rank"), k))
    if not found:
        return items.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found).select("item_id", "rank", "doc_id", "score")


def _by_item(names, numbers: list[int]):
    """The distinct items in order (equal ones are neighbours), and the term numbers of each."""
    import pyarrow as pa

    keys, first, lists = names.to_pylist(), [], []
    for row, (name, term) in enumerate(zip(keys, numbers)):
        if not row or name != keys[row - 1]:
            first.append(row)
            lists.append([])
        lists[-1].append(term)
    return names.take(pa.array(first, pa.int64())), lists
