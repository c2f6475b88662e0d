"""SimHash near-duplicates: a self-join of binary tries with a Hamming budget.

Every text gets a 64-bit fingerprint of its word shingles. Equal fingerprints are one node of the link graph. For
links of at most d bits, the 64 bits are cut into d + 1 blocks; two linked fingerprints agree in one block at least.
So there is one trie for each block: its fingerprints start with that block, and only those of one block value, below one node at
depth 64 / (d + 1), are compared. From there the trie is joined with itself: node pairs are traversed
together, differing bits add up, and a pair of nodes beyond the budget is pruned. Pairs of nodes whose leaves are one component
already are pruned too, because only reachability counts; the tasks give spanning links, never all pairs.

A node with very many fingerprints is cut into buckets by its next bits, that is at a deeper level of its trie; every pair of buckets
whose bits differ within the budget is a task of its own, and other pairs are never made. So a fingerprint is copied once for each
node in reach at that level (93 of 256 for 8 bits, 697 of 65,536 for 16, the most that are used), not for each bucket. What is
then still above `task_rows` (much-alike fingerprints) is cut by a hash into parts that all meet. So no group
meets in one task and no link is lost. Components are found by rounds of joins on written tables.

Null or empty text and texts without words have the fingerprint zero and are linked like any other. A null id never names
a component unless all ids of it are null. Repeated rows come back as often as they came. Ties cannot arise: the smallest
id names the component. An empty table gives an empty table. Columns named `fingerprint` and `component_id` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from fleetgauge.llm.common import plain_names, sliced, staged, task_count, utf8
from fleetgauge.llm.components import connected_components

SEED = 42
# The most bits that cut a crowded node; each node is tested against all masks of so many bits.
CUT_BITS = 16


def fingerprint(data: bytes, shingle: int) -> int:
    """SimHash of a text as an unsigned number: the majority of each bit over all shingles, repeats included."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-shingle].tolist()]
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    set_bits = np.zeros(64, "int64")
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at : at + 65536], "<u8")
        set_bits += np.unpackbits(part.view("uint8").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="int64")
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, shingle: int, carry: list[str]) -> DataFrame:
    """The columns `carry` and `_fp`, the fingerprint as a signed long."""
    fields = [docs.schema[c] for c in carry]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in sliced(batches):
            found = np.array([fingerprint(data, shingle) for data in utf8(batch["_text"])], "uint64").view("int64")
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in carry), pa.array(found)], names=[*carry, "_fp"])

    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["_fp long"])
    return docs.select(*carry, F.col(text).alias("_text")).mapInArrow(run, ddl)


def _uniform_from(label):
    """For each place, the first place of the run of equal labels that it lies in."""
    import numpy as np

    new = np.r_[True, label[1:] != label[:-1]]
    return np.maximum.accumulate(np.where(new, np.arange(len(label)), 0))


def _merge(label, a, b) -> None:
    """Union of the components of each pair of places; a label is the least place of its component."""
    import numpy as np

    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def trie_links(group, bits, depth: int, budget: int, side=None, chunk: int = 1 << 18):
    """Join tries with themselves. `bits` (unsigned, sorted within each group) agree in their first `depth` bits within a group.

    Returns for each place the least place it is linked with through links of at most `budget` bits inside its group. If `side` is
    given (0 or 1, groups sorted by it first), a group with both has only its links from one side to the other followed. Works
    on blocks of at most about `chunk` node pairs, the deepest first, so memory is bounded.
    """
    import numpy as np

    n = len(bits)
    label = np.arange(n)
    if n < 2:
        return label
    borders = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    start, end = borders[:-1], borders[1:]
    large = end - start > 1
    start, end = start[large], end[large]
    ahead = np.r_[0, np.cumsum(np.zeros(n, "int64") if side is None else side)]
    second = end - (ahead[end] - ahead[start])
    two = (second > start) & (second < end)
    ones: dict[int, object] = {}
    run = _uniform_from(label)
    # a block: depth, first node from-to, second node from-to, differing bits; equal nodes stand for a self-pair
    first = (start, np.where(two, second, end), np.where(two, second, start), end)
    stack = [(depth, *first, np.zeros(len(start), "int64"))]
    while stack:
        level, a0, a1, b0, b1, used = stack.pop()
        if len(a0) > chunk:
            half = len(a0) // 2
            for part in (slice(half, None), slice(0, half)):
                stack.append((level, a0[part], a1[part], b0[part], b1[part], used[part]))
            continue
        joined = (run[a1 - 1] <= a0) & (run[b1 - 1] <= b0) & (label[a0] == label[b0])
        a0, a1, b0, b1, used = (x[~joined] for x in (a0, a1, b0, b1, used))
        if not len(a0):
            continue
        # pairs of single leaves, and all that is left at full depth, are compared at once
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if level == 64:
            # equal bits below one node: any leaf stands for all, because equal leaves are linked themselves
            single[:] = True
        if single.any():
            x, y = a0[single], b0[single]
            near = np.bitwise_count(bits[x] ^ bits[y]) <= budget
            if near.any():
                _merge(label, x[near], y[near])
                run = _uniform_from(label)
            a0, a1, b0, b1, used = (z[~single] for z in (a0, a1, b0, b1, used))
            if not len(a0):
                continue
        if level not in ones:
            ones[level] = np.r_[0, np.cumsum(bits >> np.uint64(63 - level) & np.uint64(1)).astype("int64")]
        count = ones[level]
        am, bm = a1 - (count[a1] - count[a0]), b1 - (count[b1] - count[b0])
        own = a0 == b0
        other = ~own
        parts = [
            (a0, am, b0, bm, used, slice(None)),
            (am, a1, bm, b1, used, slice(None)),
            (a0, am, bm, b1, used + 1, slice(None)),
            (am, a1, b0, bm, used + 1, other),
        ]
        next_ = [np.concatenate([p[i][p[5]] for p in parts]) for i in range(5)]
        a0, a1, b0, b1, used = next_
        alive = (a1 > a0) & (b1 > b0) & (used <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
        if alive.any():
            stack.append((level + 1, *(x[alive] for x in next_)))
    return label


def _rotated(fp, block, width: int):
    """Fingerprints with the bits of a block first."""
    import numpy as np

    shift = (block * width).astype("uint64")
    return np.where(shift == 0, fp, fp << shift | fp >> (np.uint64(64) - shift) % np.uint64(64))


def dealt_to_tasks(nodes: DataFrame, max_distance: int, task_rows: int) -> DataFrame:
    """Each fingerprint (`_fp`, distinct) once for each task it takes part in: (`_fp`, `_side`, `_block`, `_value`, `_i`, `_j`).

    A task is a block value and two buckets of it, with side 0 and 1, or one (twice the same number), with side 0.
    """
    blocks = max_distance + 1
    width = 64 // blocks
    if max_distance > 15:
        raise ValueError("more than 15 bits would leave blocks of under four bits")
    placed = nodes.select("_fp", F.explode(F.expr(f"sequence(0, {blocks - 1})")).alias("_block")).withColumn(
        "_value", F.expr(f"shiftrightunsigned(shiftleft(_fp, _block * {width}), {64 - width})")
    )
    ring = f"shiftleft(_fp, _block * {width}) | shiftrightunsigned(_fp, 64 - _block * {width})"
    crowded = staged(
        placed.groupBy("_block", "_value").count().where(F.col("count") > task_rows)
        .withColumn("_bits", F.expr(f"cast(least({min(CUT_BITS, 64 - width)}, ceil(log2(2 * count / {task_rows}))) AS int)"))
        .select("_block", "_value", "_bits")
    )
    cells = placed.join(crowded, ["_block", "_value"], "left").withColumn(
        "_cell", F.expr(f"shiftrightunsigned(shiftleft({ring}, {width}), 64 - _bits)")
    )
    filled = staged(
        cells.where("_bits IS NOT NULL").groupBy("_block", "_value", "_bits", "_cell").count()
        .withColumn("_parts", F.expr(f"ceil(count / {task_rows})")).drop("count")
    )
    # the filled buckets within the budget of each filled bucket, itself included
    reach = F.expr(f"filter(sequence(0L, shiftleft(1L, _bits) - 1L), m -> bit_count(m) <= {max_distance})")
    near = filled.withColumn("_mask", F.explode(reach)).select(
        "_block", "_value", "_cell", "_parts", F.expr("_cell ^ _mask").alias("_near")
    )
    others = filled.select("_block", "_value", F.col("_cell").alias("_near"), F.col("_parts").alias("_near_parts"))
    meets = staged(near.join(others, ["_block", "_value", "_near"]))
    # a bucket's number: its bits and, below them, its part
    return (
        cells.join(meets, ["_block", "_value", "_cell"], "left")
        .withColumn("_own", F.expr("if(_parts IS NULL, 0L, shiftleft(_cell, 40) | pmod(xxhash64(_fp), _parts))"))
        .withColumn("_part", F.explode(F.expr("if(_parts IS NULL, array(0L), sequence(0L, _near_parts - 1L))")))
        .withColumn("_other", F.expr("if(_parts IS NULL, 0L, shiftleft(_near, 40) | _part)"))
        .selectExpr(
            "_fp", "cast(_own > _other AS long) AS _side", "_block", "_value",
            "least(_own, _other) AS _i", "greatest(_own, _other) AS _j",
        )
    )


def near_links(nodes: DataFrame, max_distance: int = 3, task_rows: int = 4096) -> DataFrame:
    """(u, v): links that connect every two fingerprints (`_fp`, distinct) within `max_distance` bits, directly or not."""
    width = 64 // (max_distance + 1)
    dealt = dealt_to_tasks(nodes, max_distance, task_rows)
    keys = ["_block", "_value", "_i", "_j"]
    parts = task_count(nodes, 16 * 1024**2)
    dealt = dealt.repartition(parts, *keys).sortWithinPartitions(*keys)

    def links(columns):
        import numpy as np

        fp, side, block, *rest = columns
        fp = fp.view("uint64")
        group = np.cumsum(np.r_[0, np.any([c[1:] != c[:-1] for c in (block, *rest)], axis=0)])
        bits = _rotated(fp, block, width)
        order = np.lexsort((bits, side, group))
        group, bits, fp = group[order], bits[order], fp[order]
        label = trie_links(group, bits, width, max_distance, side[order])
        moved = np.flatnonzero(label != np.arange(len(label)))
        return fp[moved].view("int64"), fp[label[moved]].view("int64")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held = None
        for batch in batches:
            if not len(batch):
                continue
            columns = [np.asarray(c).astype("int64") for c in batch.columns]
            held = columns if held is None else [np.r_[a, b] for a, b in zip(held, columns)]
            if len(held[0]) < 200_000:
                continue
            last = np.flatnonzero(np.any([c[1:] != c[:-1] for c in held[2:]], axis=0))
            if len(last):  # the last group may go on in the next batch
                cut = last[-1] + 1
                u, v = links([c[:cut] for c in held])
                held = [c[cut:] for c in held]
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        if held is not None and len(held[0]):
            u, v = links(held)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def _named(prints: DataFrame, key: str, max_distance: int) -> DataFrame:
    """(`_fp`, `_root`, `component_id`) for each fingerprint of a written table of them."""
    nodes = staged(prints.groupBy("_fp").agg(F.min(key).alias("_least")))
    rooted = connected_components(near_links(nodes, max_distance))
    labelled = staged(
        nodes.join(rooted.withColumnRenamed("node", "_fp"), "_fp", "left")
        .select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    )
    names = staged(labelled.groupBy("_root").agg(F.min("_least").alias("component_id")))
    return staged(labelled.join(names, "_root").select("_fp", "_root", "component_id"))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_distance: int = 3, key: str = "doc_id", text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """The columns `carry` (all by default) with `fingerprint` (16 hexadecimal digits) and `component_id`."""
    carry = [c for c in (carry or docs.columns) if c not in ("fingerprint", "component_id")]
    if key not in carry:
        raise ValueError(f"{key} must be carried")
    plain, names = plain_names(docs.select(*carry, *[c for c in (text,) if c not in carry]))
    prints = staged(with_fingerprints(plain, names[text], shingle, [names[c] for c in carry]), batch_rows=1000)
    named = _named(prints, names[key], max_distance).drop("_root")
    found = prints.join(named, "_fp").withColumn("fingerprint", F.expr("lower(lpad(hex(_fp), 16, '0'))"))
    return found.select(*[F.col(names[c]).alias(c) for c in carry], "component_id", "fingerprint")


def one_of_each(docs: DataFrame, shingle: int = 3, max_distance: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without near-duplicates: the smallest id of each component stays; where rows repeat it, the one with the
    least hash of its text, and one of equal rows.

    Rows are chosen by id, fingerprint and hash alone; texts move once, to meet what was chosen. That join is never a
    broadcast, because what is chosen grows with the documents.
    """
    docs, names = plain_names(docs)
    key, text = names[key], names[text]
    docs = docs.withColumn("_hash", F.xxhash64(text))
    prints = staged(with_fingerprints(docs, text, shingle, [key, "_hash"]), batch_rows=1000)
    named = _named(prints, key, max_distance)
    chosen = (
        prints.withColumnRenamed(key, "_key").join(named, "_fp").where(F.col("_key").eqNullSafe(F.col("component_id")))
        .groupBy("_root").agg(F.min(F.struct("_hash", "_key")).alias("_row")).select("_row._hash", "_row._key").distinct()
    )
    chosen = staged(chosen.withColumnRenamed("_hash", "_chosen"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_chosen"))
    kept = docs.join(chosen.hint("merge"), same, "left_semi")
    first = F.row_number().over(Window.partitionBy(key, "_hash").orderBy(F.lit(0)))
    return kept.withColumn("_nth", first).where("_nth = 1").select(*[F.col(own).alias(name) for name, own in names.items()])
