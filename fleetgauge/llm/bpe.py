"""Byte-level BPE: a segment tree over byte positions keeps the leftmost pair of lowest rank.

The text is cut by the pre-split pattern; each piece is merged on its own, and the ids of pieces are kept in a
bounded cache. Pieces of up to 32 bytes that a batch brings anew are merged together, one row of a numpy matrix for
each tree; longer ones are merged one by one, by the same steps. A leaf of the tree holds the rank of the
pair that starts at a live byte position, an inner node the smaller of its children. The next merge is the
leftmost leaf that equals the root; it changes at most three leaves (the merged one, its right neighbour, which dies,
and its left neighbour), so a merge costs O(log n) and a piece of n bytes O(n log n), also for a single word of a
megabyte.

Null text counts as empty and gives no ids. Repeated rows are encoded each for itself; the order of rows does not
matter; an empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain
from sys import getsizeof

from pyspark.sql import DataFrame

from fleetgauge.llm.common import LONG, Memo, sliced, utf8

NONE = 1 << 40
NO = 2**31 - 1
# Characters of text that are split at a time; a longer text is one block of its own.
BLOCK = 1_000_000


class Pairs:
    """Which two ids merge to which, where the lowest merged id goes first. Merges many short pieces at a time."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        import numpy as np

        self.keys = np.array(sorted(a << 32 | b for a, b in pairs), "int64")
        self.merged = np.array([pairs[k >> 32, k & 0xFFFFFFFF] for k in self.keys.tolist()], "int32")

    def rank(self, left, right):
        """Merged ids; NO where two ids do not merge."""
        import numpy as np

        if not len(self.keys):
            return np.full(len(left), NO, "int32")
        key = left.astype("int64") << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NO)

    def merge_rows(self, token, live) -> list[bytes]:
        """Packed ids of each row: one segment tree for each, all merged in step. The width is a power of two.

        `token` holds the first ids and is used up; `live` marks those that belong to a row, from its start.
        """
        import numpy as np

        (rows, size), n = token.shape, live.sum(1)
        column = np.arange(size)
        following = np.tile(column + 1, (rows, 1))
        before = np.tile(column - 1, (rows, 1))
        tree = np.full((rows, 2 * size), NO, "int32")
        first = self.rank(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(rows, -1)
        tree[:, size : 2 * size - 1] = np.where(live[:, 1:], first, NO)
        level = size // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        flat, depth = tree.reshape(-1), size.bit_length() - 1
        while len(row := np.flatnonzero(tree[:, 1] < NO)):
            base = row * (2 * size)
            least, node = flat[base + 1], np.ones(len(row), "int64")
            for _ in range(depth):
                node = 2 * node
                node += flat[base + node] != least
            i = node - size
            j = following[row, i]
            after = following[row, j]
            token[row, i], following[row, i], live[row, j] = least, after, False
            more = after < n[row]
            before[row[more], after[more]] = i[more]
            right = self.rank(least, token[row, np.minimum(after, size - 1)])
            p = before[row, i]
            left = self.rank(token[row, np.maximum(p, 0)], least)
            flat[base + size + i] = np.where(more, right, NO)
            flat[base + size + j] = NO
            some = p >= 0
            flat[(base + size + p)[some]] = left[some]
            for leaf in (i, j, np.where(some, p, i)):
                node = size + leaf
                for _ in range(depth):
                    node = node >> 1
                    flat[base + node] = np.minimum(flat[base + 2 * node], flat[base + 2 * node + 1])
        packed = token[live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(1)) * 4
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def byte_matrix(pieces: list[bytes], size: int):
    """Pieces as rows of bytes, filled up with zeros, and which places are theirs."""
    import numpy as np

    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), "uint8").reshape(len(pieces), size)
    return raw, np.arange(size) < np.array([len(p) for p in pieces])[:, None]


def by_size(pieces: list[bytes], most: int = 8192):
    """(size, places of pieces of up to that many bytes) in blocks; sizes are powers of two from 8 on."""
    import numpy as np

    lengths = np.array(list(map(len, pieces)), "int64")
    low, high = 0, 8
    while (lengths > low).any():
        places = np.flatnonzero((lengths > low) & (lengths <= high))
        for at in range(0, len(places), most):
            yield high, places[at : at + most].tolist()
        low, high = high, 2 * high


class ByteBpe:
    """Encoder and decoder for a file of `base64(bytes) rank` lines."""

    def __init__(self, path: str, pattern: str, cache: int = 300_000):
        import numpy as np
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pieces = {rank: piece for piece, rank in self.ranks.items()}
        # the rank files mean Unicode white space; the regex module's \s also takes the separators 1C-1F
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.memo = Memo(self._packed, cache)
        pairs = {}
        for piece, rank in self.ranks.items():
            for cut in range(1, len(piece)):
                left, right = self.ranks.get(piece[:cut]), self.ranks.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.pairs = Pairs(pairs)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], "int32")

    def _packed(self, piece: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.merge(piece.encode()))

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        end = list(range(1, n + 1))  # live position -> where its bytes end, which is the next live position
        before = list(range(-1, n - 1))
        tree = [NONE] * (2 * size)
        get = ranks.get
        for i in range(n - 1):
            tree[size + i] = get(piece[i : i + 2], NONE)
        for node in range(size - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a <= b else b

        def put(i: int, rank: int) -> None:
            node = size + i
            tree[node] = rank
            while node > 1:
                other = tree[node ^ 1]
                if other < rank:
                    rank = other
                node >>= 1
                if tree[node] == rank:
                    return
                tree[node] = rank

        while (least := tree[1]) < NONE:
            node = 1
            while node < size:
                node *= 2
                if tree[node] != least:
                    node += 1
            i = node - size
            j = end[i]
            end[i] = after = end[j]
            put(j, NONE)
            if after < n:
                before[after] = i
                put(i, get(piece[i : end[after]], NONE))
            else:
                put(i, NONE)
            if (p := before[i]) >= 0:
                put(p, get(piece[p:after], NONE))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def merge_many(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Packed ids of pieces of 2 to `size` bytes (a power of two)."""
        token, live = byte_matrix(pieces, size)
        return self.pairs.merge_rows(self.byte_ids[token], live)

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of new pieces into the cache, the short ones in blocks."""
        kept = [piece for piece in pieces if len(piece) <= LONG]
        # the ids of a piece have at most four bytes for each of its own
        self.memo.grow(len(kept), 3 * sum(map(getsizeof, kept)))
        short = []
        for piece in pieces:
            data = piece.encode()
            if (rank := self.ranks.get(data)) is not None:
                self.memo[piece] = rank.to_bytes(4, "little")
            elif len(data) <= 32:
                short.append(piece)
        data = [piece.encode() for piece in short]
        for size, places in by_size(data):
            for place, ids in zip(places, self.merge_many([data[p] for p in places], size)):
                self.memo[short[place]] = ids

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(text) for text in texts]
        if len(new := set(chain.from_iterable(split)).difference(self.memo)) > 64:
            self.learn(new)
        return [b"".join(map(self.memo.__getitem__, pieces)) for pieces in split]

    def encode_packed(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode(self, text: str) -> list[int]:
        import numpy as np

        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def blocks(texts: list[bytes]) -> Iterator[list[str]]:
    """Neighbouring texts of about BLOCK bytes together, each text whole."""
    part, held = [], 0
    for text in texts:
        part.append(text.decode())
        held += len(text)
        if held >= BLOCK:
            yield part
            part, held = [], 0
    if part:
        yield part


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(path: str, pattern: str) -> ByteBpe:
    """One encoder for each Python worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(path, pattern)
    return _LOADED[path, pattern]


def bpe_encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the token ids of every text."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder = loaded(path, pattern)
        for part in sliced(batches):
            packed = chain.from_iterable(map(encoder.encode_all, blocks(utf8(part[text]))))
            ids = [np.frombuffer(p, "<u4").astype("int32") for p in packed]
            yield pa.RecordBatch.from_arrays(
                [part[key], pa.array(ids, pa.list_(pa.int32()))], schema=pa.schema([(key, part[key].type), ("ids", pa.list_(pa.int32()))])
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded): the bytes that the ids stand for."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        decoder = loaded(path, pattern)
        for part in sliced(batches):
            out = [decoder.decode(ids or ()) for ids in part["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part[key], pa.array(out, pa.binary())], schema=pa.schema([(key, part[key].type), ("decoded", pa.binary())])
            )

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, decoded binary")


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, in one pass over the texts."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        coder = loaded(path, pattern)
        for batch in sliced(batches):
            counts, ids_hash, text_hash = [], [], []
            for packed in chain.from_iterable(map(coder.encode_all, blocks(utf8(batch[text])))):
                ids = np.frombuffer(packed, "<u4")
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(packed).hexdigest())
                text_hash.append(hashlib.sha256(coder.decode(ids.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch[key], pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
