"""Approximate nearest neighbours by collision counting.

Each of m random projections sorts the vectors of an index part by their projected value. A query looks at windows around its own
projected values. At radius R a window reaches `width` * R to both sides; a vector that lies in at least `min_collisions` of the m
windows is a candidate; those whose single-precision cosine can be among the best k are verified on the original vectors. The radius grows
(virtual rehashing: the same sorted arrays serve all radii; a window is a range of ranks in them) by the factor `growth`, or
once k are found to `slack` times the k-th best distance if that is less, until the k-th best is within R. With
unit vectors, projected differences are normal with the distance as deviation, so a vector at distance R collides in each window
with probability 0.683 for width 1, nearer ones more often; at a threshold of 40 in 64, one in eight at R itself is missed, one in
twenty at R / 1.06, and fewer the nearer it is. There is no cap on candidates.

Index parts hold at most about `part_rows` vectors and queries come in blocks of at most about `block_rows`; each block meets each part in a
task of its own, and the best k of each part are merged. Vectors of a part that are equal up to a power of two are one point with its k + 1 least ids, which is
exact, since further copies can be nobody's neighbour before these; a third of all rows being one vector costs nothing.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, neither do rows without id.
Ties go to the smaller id. Rows that repeat an id are candidates each for itself, but the least vector of an id alone is its query,
and no row of that id its answer. A table of k or
fewer other vectors gives all of them; an empty one gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from fleetgauge.llm.common import staged


@dataclass(frozen=True)
class Index:
    """At most 255 projections."""

    projections: int = 64
    min_collisions: int = 40
    width: float = 1.0
    first_radius: float = 0.6
    growth: float = 1.5
    slack: float = 1.06
    part_rows: int = 16_384
    block_rows: int = 4_096
    seed: int = 42


DEFAULT = Index()


def directions(dimensions: int, how: Index):
    import numpy as np

    return np.random.default_rng(how.seed).standard_normal((dimensions, how.projections))


def cosines(vectors, lengths, query, length):
    """Cosines in double precision, added up in the order of the components, so that equal vectors score equal anywhere."""
    import numpy as np

    dot = np.zeros(len(vectors))
    for d in range(vectors.shape[1]):
        dot += vectors[:, d] * query[d]
    return dot / (lengths * length)


def _lengths(vectors):
    import numpy as np

    total = np.zeros(len(vectors))
    for d in range(vectors.shape[1]):
        total += vectors[:, d] * vectors[:, d]
    return np.sqrt(total)


def scaled(vectors):
    """Each vector times the power of two that brings its greatest component between 0.5 and 1: cosines stay the same to the last bit,
    and no square overflows or vanishes."""
    import numpy as np

    if not vectors.size:
        return vectors
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])


class Part:
    """The sorted projections of one index part, and each vector's rank in them."""

    def __init__(self, ids, vectors, k: int, how: Index):
        import numpy as np

        self.k, self.how = k, how
        self.vectors, place = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, place))
        ids, place = ids[order], place[order]
        first = np.searchsorted(place, np.arange(len(self.vectors) + 1))
        self.ids = [ids[a : min(b, a + k + 1)] for a, b in zip(first[:-1], first[1:])]
        self.sizes = np.diff(first)
        self.lengths = _lengths(self.vectors)
        units = self.vectors / self.lengths[:, None]
        projected = units @ directions_of(vectors.shape[1], how)
        self.units = units.astype("float32")
        # a bound on the rounding of a single-precision cosine, some four times over
        self.rounding = 4 * (vectors.shape[1] + 2) * float(np.finfo("float32").eps)
        order = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.take_along_axis(projected, order, 0).T.copy()
        n = len(self.vectors)
        kind = "uint16" if n < 65536 else "uint32"
        self.ranks = np.empty((how.projections, n), kind)
        np.put_along_axis(self.ranks, order.T, np.broadcast_to(np.arange(n, dtype=kind), (how.projections, n)), 1)

    def search(self, query_id: int, query) -> list[tuple[float, int]]:
        """The best k found, as (-cosine, id), nearest first."""
        import numpy as np

        how, n, kind = self.how, len(self.vectors), self.ranks.dtype
        length = float(_lengths(query[None])[0])
        at = (query / length) @ directions_of(len(query), how)
        unit = (query / length).astype("float32")
        seen = np.zeros(n, bool)
        best, radius = [], how.first_radius
        while True:
            reach = how.width * radius
            low = np.array([s.searchsorted(x - reach, "left") for s, x in zip(self.sorted, at)])
            high = np.array([s.searchsorted(x + reach, "right") for s, x in zip(self.sorted, at)])
            if (high - low == n).all():
                found = np.flatnonzero(~seen)
            else:
                # ranks below the window wrap around to large numbers
                inside = self.ranks - low.astype(kind)[:, None] < (high - low).astype(kind)[:, None]
                found = np.flatnonzero((inside.view("uint8").sum(0, dtype="uint8") >= how.min_collisions) & ~seen)
            if len(found):
                seen[found] = True
                if len(found) > self.k + 1:  # others cannot be among the best k, but ties may
                    rough = self.units[found] @ unit
                    edge = np.partition(rough, -(self.k + 1))[-(self.k + 1)]
                    found = found[rough >= edge - self.rounding]
                score = cosines(self.vectors[found], self.lengths[found], query, length)
                for point, s in zip(found.tolist(), score.tolist()):
                    best += [(-s, int(i)) for i in self.ids[point] if i != query_id]
                best = sorted(best)[: self.k]
            # on unit vectors the squared distance is 2 - 2 cosine
            furthest = max(0.0, 2 + 2 * best[-1][0]) ** 0.5 if len(best) == self.k else float("inf")
            if furthest <= radius or seen.all():
                return best
            radius = min(how.slack * furthest, how.growth * radius)


_DIRECTIONS: dict = {}


def directions_of(dimensions: int, how: Index):
    if (dimensions, how) not in _DIRECTIONS:
        _DIRECTIONS[dimensions, how] = directions(dimensions, how)
    return _DIRECTIONS[dimensions, how]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector as doubles) of the rows that take part; the table's usual length is the most frequent, then the least."""
    good = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(
        "id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0 AND "
        "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(vector, x -> x <> 0)"
    )
    return good


def nearest_neighbours(
    vectors: DataFrame, queries, k: int = 5, key: str = "vec_id", vector: str = "embedding", how: Index = DEFAULT
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest other rows of each row for which `queries` (a condition on `id`) holds."""
    good = staged(usable(vectors, key, vector))
    sizes = good.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = "query_id long, rank int, id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], empty)
    good = good.where(F.size("vector") == sizes["d"])
    asked = staged(good.where(queries).groupBy(F.col("id").alias("query_id")).agg(F.min("vector").alias("query")))
    parts = -(-sizes["count"] // how.part_rows)
    blocks = max(1, -(-asked.count() // how.block_rows))
    cell = "xxhash64(id, vector)"
    index = good.select(
        F.expr(f"cast(pmod({cell}, {parts}) AS int)").alias("part"), F.explode(F.expr(f"sequence(0, {blocks - 1})")).alias("block"), "id", "vector"
    )
    asked = asked.select(
        F.explode(F.expr(f"sequence(0, {parts - 1})")).alias("part"),
        F.expr(f"cast(pmod(xxhash64(query_id), {blocks}) AS int)").alias("block"), "query_id", "query",
    )

    def search(key_, ours, theirs):
        import numpy as np
        import pyarrow as pa

        out: tuple[list, ...] = ([], [], [])
        if len(ours) and len(theirs):
            def matrix(table, name):
                return scaled(np.asarray(table[name].combine_chunks().flatten()).reshape(len(table), -1))

            part = Part(np.asarray(ours["id"]), matrix(ours, "vector"), k, how)
            for name, query in zip(theirs["query_id"].to_pylist(), matrix(theirs, "query")):
                for score, other in part.search(name, query):
                    for column, value in zip(out, (name, other, -score)):
                        column.append(value)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    found = index.groupBy("part", "block").cogroup(asked.groupBy("part", "block")).applyInArrow(
        search, "query_id long, id long, score double"
    )
    # at most k rows of each part for each query
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
