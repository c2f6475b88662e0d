"""Substring dedup by fixed-block anchors.

A window is `window` consecutive words. Every text is a reference and a probe. Its reference blocks are the non-overlapping blocks of
b = (window + 1) / 2 words at places 0, b, 2b, ...; any window holds one whole block, at whatever place it starts. Every
rolling window of b words of every text probes them. A block that texts with different ids share is an anchor; its hits are extended
word by word: all windows around a hit that are themselves shared make up the maximal exact repeat. A word is removed if it
lies in such a repeat of which each window also starts in a text with a smaller id.

Steps, all over whole texts:
1. texts are dealt to chunks by a hash of id and text, so that an id of many rows is spread (one shuffle, used three times);
2. each chunk sends its distinct probes, sorted and packed to about six bytes each, to hash buckets;
3. each bucket answers each chunk with the probes that hit a block elsewhere;
4. each chunk extends its hits to windows and sends (window hash, least id);
5. each bucket answers with the least id of all, each chunk marks the words it covers.
A passage that very many texts share costs one row for each chunk, not for each pair. Blocks are compared by 48 bits, which only
chooses where to extend; windows by 64 bits, so among n windows a wrong match has a chance of about n * n / 2^65.

Null text has no words. A row with a null id is neither a reference nor changed. Rows that repeat an id do not count
against each other, and each is treated for itself; only rows equal in id and text share a chunk for certain. Texts shorter than a window stay whole. An empty table gives an
empty table. Ids must be whole numbers. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from fleetgauge.llm.common import Memo, task_count, utf8

_HASHES = None


def word_hashes(words: list[bytes]):
    import numpy as np
    from xxhash import xxh64_intdigest

    global _HASHES
    if _HASHES is None:
        _HASHES = Memo(xxh64_intdigest)
    return np.fromiter(map(_HASHES.__getitem__, words), "uint64", len(words))


def rolling(hashes, width: int):
    """Hash of every `width` neighbouring word hashes (those that cross texts too; the caller masks them)."""
    import numpy as np

    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, "uint64")
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n + k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


class Chunk:
    """The texts of a chunk as one array of word hashes, in order of their ids."""

    def __init__(self, ids: list, texts: list[bytes], window: int):
        import numpy as np

        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        self.ids = [ids[i] for i in order]
        self.words = [texts[i].split() for i in order]
        self.sizes = np.array([len(w) for w in self.words], "int64")
        self.start = np.r_[0, np.cumsum(self.sizes)].astype("int64")
        self.hashes = np.concatenate([word_hashes(w) for w in self.words] or [np.zeros(0, "uint64")])
        self.window = window
        numbers = np.array([i or 0 for i in self.ids], "int64")
        usable = np.array([i is not None for i in self.ids], bool) & (self.sizes >= window)
        self.usable = np.repeat(usable, self.sizes)
        self.id_at = np.repeat(numbers, self.sizes)
        self.place = np.arange(len(self.hashes)) - np.repeat(self.start[:-1], self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.place

    def fits(self, width: int):
        """Places of the chunk where a run of `width` words of one usable text starts."""
        import numpy as np

        n = max(0, len(self.hashes) - width + 1)
        return np.flatnonzero((self.usable & (self.left >= width))[:n])


def _groups(sorted_keys):
    import numpy as np

    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, "int64")


def _bucket_edges(keys, buckets: int, bits: int):
    """Where each bucket starts in sorted keys: buckets are equal ranges of the hash."""
    import numpy as np

    bounds = [(b << bits) // buckets for b in range(buckets)]
    return np.r_[np.searchsorted(keys, np.array(bounds, "uint64")), len(keys)]


def probes(chunk: Chunk, block: int, buckets: int):
    """(bucket, packed probes): the distinct rolling blocks, whether one is a reference block, whether two ids have it."""
    import numpy as np

    at = chunk.fits(block)
    key = (rolling(chunk.hashes, block)[at] if len(at) else np.zeros(0, "uint64")) >> np.uint64(16)
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    first = _groups(key)
    if not len(first):
        return
    last = np.r_[first[1:], len(key)] - 1
    anchor = np.logical_or.reduceat(chunk.place[at] % block == 0, first)
    shared = chunk.id_at[at[first]] != chunk.id_at[at[last]]
    key = key[first]
    edges = _bucket_edges(key, buckets, 48)
    for bucket in np.flatnonzero(np.diff(edges)):
        part = slice(edges[bucket], edges[bucket + 1])
        planes = key[part].astype("<u8").view("uint8").reshape(-1, 8)[:, :6].T
        yield int(bucket), int(part.stop - part.start), (
            planes.tobytes() + np.packbits(anchor[part]).tobytes() + np.packbits(shared[part]).tobytes()
        )


def unpacked(n: int, data: bytes):
    import numpy as np

    raw = np.frombuffer(data, "uint8")
    wide = np.zeros((n, 8), "uint8")
    wide[:, :6] = raw[: 6 * n].reshape(6, n).T
    flags = (n + 7) // 8
    bits = [np.unpackbits(raw[6 * n + k * flags : 6 * n + (k + 1) * flags])[:n].astype(bool) for k in range(2)]
    return wide.view("<u8").reshape(-1), *bits


def anchors_hit(rows: list[tuple]):
    """For each (n, data) of a bucket, the probes that hit a reference block and belong to texts of two ids or two chunks."""
    import numpy as np

    parts = [unpacked(n, data) for n, data in rows]
    key, anchor, shared = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.argsort(key, kind="stable")
    key, anchor, shared = key[order], anchor[order], shared[order]
    first = _groups(key)
    size = np.diff(np.r_[first, len(key)])
    good = np.logical_or.reduceat(anchor, first) & ((size > 1) | np.logical_or.reduceat(shared, first))
    good = key[first[good]]
    return [p[0][member(p[0], good)] for p in parts]


def member(values, sorted_set):
    import numpy as np

    if not len(sorted_set):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def extended(chunk: Chunk, hits, block: int, buckets: int):
    """(bucket, n, packed): windows around the hits, as (hash, least id, whether two ids have it)."""
    import numpy as np

    at = chunk.fits(chunk.window)
    if not len(at) or not len(hits):
        return
    hit = member(rolling(chunk.hashes, block) >> np.uint64(16), np.unique(hits))
    before = np.r_[0, np.cumsum(hit)]
    at = at[before[at + chunk.window - block + 1] > before[at]]
    if not len(at):
        return
    key = rolling(chunk.hashes, chunk.window)[at]
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    first = _groups(key)
    last = np.r_[first[1:], len(key)] - 1
    least, most, key = chunk.id_at[at[first]], chunk.id_at[at[last]], key[first]
    edges = _bucket_edges(key, buckets, 64)
    for bucket in np.flatnonzero(np.diff(edges)):
        part = slice(edges[bucket], edges[bucket + 1])
        yield int(bucket), int(part.stop - part.start), (
            key[part].astype("<u8").tobytes() + least[part].astype("<i8").tobytes() + (least != most)[part].tobytes()
        )


def least_ids(rows: list[tuple]):
    """For each (n, data) of a bucket: the windows that start in a smaller id than (some of) the chunk's own, with the least id."""
    import numpy as np

    parts = [
        (np.frombuffer(d, "<u8", n), np.frombuffer(d, "<i8", n, 8 * n), np.frombuffer(d, "bool", n, 16 * n)) for n, d in rows
    ]
    key, least = (np.concatenate([p[i] for p in parts]) for i in range(2))
    order = np.argsort(key, kind="stable")
    key, least = key[order], least[order]
    first = _groups(key)
    least, key = np.minimum.reduceat(least, first), key[first]
    for own, mine, both in parts:
        overall = least[np.searchsorted(key, own)]
        told = both | (overall < mine)
        yield int(told.sum()), own[told].astype("<u8").tobytes() + overall[told].astype("<i8").tobytes()


def removed_words(chunk: Chunk, keys, least):
    """True for each word of the chunk that a window covers whose sequence starts in a smaller id too."""
    import numpy as np

    step = np.zeros(len(chunk.hashes) + 1, "int64")
    at = chunk.fits(chunk.window)
    if len(at) and len(keys):
        order = np.argsort(keys)
        keys, least = keys[order], least[order]
        own = rolling(chunk.hashes, chunk.window)[at]
        place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        at = at[(keys[place] == own) & (least[place] < chunk.id_at[at])]
        np.add.at(step, at, 1)
        np.add.at(step, at + chunk.window, -1)
    return np.cumsum(step[:-1]) > 0


def substring_dedup(
    docs: DataFrame, window: int = 13, key: str = "doc_id", text: str = "text", parts: int | None = None
) -> DataFrame:
    """(key, n_words, n_removed, kept): the words of each text without its repeats of smaller ids, joined by one space."""
    import pyarrow as pa

    block = (window + 1) // 2
    parts = parts or task_count(docs)
    pieces = 2 * parts
    dealt = docs.select(
        F.expr(f"pmod(xxhash64(`{key}`, `{text}`), {pieces}L)").alias("chunk"),
        F.col(key).cast("long").alias("id"), F.col(text).alias("text"),
    ).repartition(parts, "chunk")
    row = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
    row_ddl = "bucket long, chunk long, n long, data binary"

    def rows(found) -> pa.Table:
        found = list(found)
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*found) if found else [[]] * 4, row)], schema=row)

    def chunk_of(table) -> Chunk:
        return Chunk(table["id"].to_pylist(), utf8(table["text"]), window)

    def probe(key_, table):
        chunk = chunk_of(table)
        return rows((b, key_[0].as_py(), n, d) for b, n, d in probes(chunk, block, pieces))

    def answer(key_, table):
        hits = anchors_hit(list(zip(table["n"].to_pylist(), table["data"].to_pylist())))
        chunks = table["chunk"].to_pylist()
        return rows((0, c, len(h), h.astype("<u8").tobytes()) for c, h in zip(chunks, hits) if len(h))

    def extend(key_, table, hits):
        import numpy as np

        data = [np.frombuffer(d, "<u8") for d in hits["data"].to_pylist()]
        if not data or not len(table):
            return rows([])
        found = extended(chunk_of(table), np.concatenate(data), block, pieces)
        return rows((b, key_[0].as_py(), n, d) for b, n, d in found)

    def least(key_, table):
        told = least_ids(list(zip(table["n"].to_pylist(), table["data"].to_pylist())))
        return rows((0, c, n, d) for c, (n, d) in zip(table["chunk"].to_pylist(), told) if n)

    def remove(key_, table, told):
        import numpy as np

        sizes, data = told["n"].to_pylist(), told["data"].to_pylist()
        keys = np.concatenate([np.frombuffer(d, "<u8", n) for n, d in zip(sizes, data)] or [np.zeros(0, "uint64")])
        ids = np.concatenate([np.frombuffer(d, "<i8", n, 8 * n) for n, d in zip(sizes, data)] or [np.zeros(0, "int64")])
        chunk = chunk_of(table)
        gone = removed_words(chunk, keys, ids)
        kept = []
        counts = np.add.reduceat(np.r_[gone, False], chunk.start[:-1]) if len(chunk.ids) else np.zeros(0, "int64")
        counts = np.where(chunk.sizes > 0, counts, 0)
        for i, words in enumerate(chunk.words):
            if counts[i]:
                own = gone[chunk.start[i] : chunk.start[i + 1]].tolist()
                words = [w for w, g in zip(words, own) if not g]
            kept.append(b" ".join(words).decode())
        return pa.table({
            "id": pa.array(chunk.ids, pa.int64()), "n_words": pa.array(chunk.sizes, pa.int64()),
            "n_removed": pa.array(counts, pa.int64()), "kept": pa.array(kept, pa.string()),
        })

    sent = dealt.groupBy("chunk").applyInArrow(probe, row_ddl)
    hits = sent.repartition(parts, "bucket").groupBy("bucket").applyInArrow(answer, row_ddl)
    windows = dealt.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(extend, row_ddl)
    told = windows.repartition(parts, "bucket").groupBy("bucket").applyInArrow(least, row_ddl)
    done = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        remove, "id long, n_words long, n_removed long, kept string"
    )
    return done.select(F.col("id").cast(docs.schema[key].dataType).alias(key), "n_words", "n_removed", "kept")
