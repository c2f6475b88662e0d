"""Packing along a space-filling curve: similar documents share training sequences.

Each text becomes a vector of hashed counts of three neighbouring bytes, normalized and projected by fixed random directions to a few
dimensions. The Hilbert key of that point orders all documents; a range shuffle sorts them by it, and each partition is packed from
its first document to its last by cutting the stream of ids every `length` ids. What is left at the end of a partition is
cut into lengths that are powers of two, so no sequence needs padding.

The keys need only a cheap pass over the bytes; texts are tokenized once, after the shuffle. Equal keys (copies) are told
apart by the id and a row number, so a group of copies of any size spreads over partitions. A task holds a batch of texts.

Null text counts as empty; a document always has its end id. A null id is kept as null. Repeated rows are packed
each for itself. An empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import add
from string import punctuation
from unicodedata import normalize, ucd_3_2_0

from pyspark.sql import DataFrame, functions as F

from fleetgauge.llm.common import CACHE_BYTES, LONG, sliced, task_count, utf8

DIMENSIONS, BITS, BUCKETS, SEED = 4, 8, 256, 42


def hilbert_keys(points, bits: int = BITS):
    """Index along the Hilbert curve of integer points (one row each), after Skilling's transposed form."""
    import numpy as np

    x = points.astype("int64").T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(x[i] & q, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(t)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def directions():
    import numpy as np

    return np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS))


def hashed_counts(texts: list[bytes]):
    """How often each bucket of hashed byte triples occurs, ASCII letters lower-cased; one row for each text."""
    import numpy as np

    out = np.zeros((len(texts), BUCKETS))
    for row, data in zip(out, texts):
        b = np.frombuffer(data.lower(), "uint8").astype("uint16")
        if len(b) > 2:
            triples = (b[:-2] * np.uint16(40503) ^ b[1:-1] * np.uint16(10973) ^ b[2:] * np.uint16(27655)) >> np.uint16(8)
            row[:] = np.bincount(triples, minlength=BUCKETS)
    return out


def curve_keys(texts: list[bytes], projection):
    """Hilbert keys of texts."""
    import numpy as np

    vectors = np.log1p(hashed_counts(texts))
    vectors -= vectors.mean(1, keepdims=True)
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    points = vectors / np.where(lengths > 0, lengths, 1) @ projection
    cells = (1 / (1 + np.exp(-1.702 * points)) * (1 << BITS)).astype("int64")
    return hilbert_keys(cells.clip(0, (1 << BITS) - 1))


def with_curve_keys(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc key, text, `_curve`, `_row`)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        projection = directions()
        for batch in sliced(batches):
            curve = curve_keys(utf8(batch["_text"]), projection)
            yield pa.RecordBatch.from_arrays(
                [batch["_key"], batch["_text"], pa.array(curve, pa.int64())], names=["_key", "_text", "_curve"]
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return narrow.mapInArrow(run, f"_key {kind}, _text string, _curve long").withColumn("_row", F.monotonically_increasing_id())


class Words:
    """Token ids of whole texts by a tokenizer file that drops white space, lower-cases, and cuts runs of letters, single digits and
    runs of other characters before it merges bytes, with its own ids for the last byte of a run.

    So a word can be encoded apart from its neighbours, and its closing run of ASCII punctuation apart from the rest of it. Both are kept in
    bounded caches. New words of letters alone, nearly all, are merged in blocks by the file's merges; all others are
    given to the tokenizer itself, in one call for many, with a mark between them.
    """

    STOPS = punctuation.encode()
    MARK = b"\x01"

    def __init__(self, path: str, words: int = 300_000, parts: int = 600_000):
        import json

        import numpy as np
        from tokenizers import Tokenizer

        from fleetgauge.llm.bpe import Pairs

        self.tokenizer, self.most_words, self.most_parts = Tokenizer.from_file(path), words, parts
        self.memo: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}
        self.held = 0  # bytes of the words learned since the parts were cleared
        self.mark = self._ids(self.MARK)
        with open(path) as file:
            model = json.load(file)["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        pairs = {}
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pairs[vocabulary[left], vocabulary[right]] = vocabulary[left + right]
        # merging by the least new id is merging in the file's order
        if len(self.mark) != 1 or list(pairs.values()) != sorted(pairs.values()):
            raise ValueError("this tokenizer file is of another kind")
        self.pairs = Pairs(pairs)
        names = byte_names()
        self.inner = np.array([vocabulary[n] for n in names], "int32")
        self.last = np.array([vocabulary[n + end] for n in names], "int32")

    def _ids(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids

    def _merged(self, words: list[bytes]) -> None:
        """Ids of runs of lower-case letters."""
        import numpy as np

        from fleetgauge.llm.bpe import by_size, byte_matrix

        for size, places in by_size(words):
            part = [words[p] for p in places]
            raw, live = byte_matrix(part, size)
            token, rows = self.inner[raw], np.arange(len(part))
            ends = live.sum(1) - 1
            token[rows, ends] = self.last[raw[rows, ends]]
            self.parts.update(zip(part, self.pairs.merge_rows(token, live)))

    @staticmethod
    def _plain(part: bytes) -> bool:
        """A short run of lower-case letters that the tokenizer would leave as it is."""
        if len(part) > 32 or part.isascii():
            return False
        text = part.decode()
        return text.isalpha() and text.islower() and normalize("NFC", text).lower() == text

    @staticmethod
    def _ends_run(core: bytes) -> bool:
        """Whether the last character is a letter or number, in the oldest and the newest Unicode known here, so that punctuation behind
        it begins a run of its own."""
        if not core or core[-1] < 0x80:
            return core[-1:].isalnum()
        last = normalize("NFC", core.decode()[-1]).lower()[-1]  # a letter may become one with a mark
        return last.isalnum() and ucd_3_2_0.category(last)[0] in "LN"

    def _learn_parts(self, new: set[bytes]) -> None:
        import numpy as np

        merged = [part for part in new if part.isalpha() and len(part) < 33]  # bytes: ASCII letters
        new.difference_update(merged)
        letters = [part for part in new if self._plain(part)]
        self._merged(merged + letters)
        other = list(new.difference(letters))
        for at in range(0, len(other), 1_000):
            part = other[at : at + 1_000]
            ids = np.array(self._ids((b" " + self.MARK + b" ").join(part)), "<u4")
            cuts = np.flatnonzero(ids == self.mark[0])
            for word, a, b in zip(part, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]):
                self.parts[word] = ids[a:b].tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Lower-case words without marks and names of special tokens."""
        if len(self.parts) + len(words) > self.most_parts:
            self.parts.clear()
        stops, parts = self.STOPS, self.parts
        parts[b""] = b""
        cores = [word.rstrip(stops) for word in words]
        cores = [core if len(core) == len(word) or self._ends_run(core) else word for word, core in zip(words, cores)]
        rests = [word[len(core):] for word, core in zip(words, cores)]
        self._learn_parts(set(cores).union(rests).difference(parts))
        get = parts.__getitem__
        self.memo.update(zip(words, map(add, map(get, cores), map(get, rests))))

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        import numpy as np

        # names of special tokens are found in the raw text, so words that may hold one are given to the tokenizer as they are
        odd = any(b"<|" in data or self.MARK in data for data in texts)
        if odd:
            split = [[w if b"<|" in w else w.lower() for w in data.split()] for data in texts]
        else:
            split = [data.lower().split() for data in texts]
        new = set().union(*split).difference(self.memo)
        size = sum(map(len, new))
        if self.held + size > CACHE_BYTES // 16:
            # ids can be four times as long as a word, and its part is kept with its ids too
            self.parts.clear()
            self.held = 0
        if len(self.memo) + len(new) > self.most_words or not self.held:
            self.memo.clear()
            new = set().union(*split)
            size = sum(map(len, new))
        self.held += size
        long = [word for word in new if len(word) > LONG]
        if odd:
            for word in [w for w in new if b"<|" in w or self.MARK in w]:
                self.memo[word] = np.array(self._ids(word), "<u4").tobytes()
                new.remove(word)
        self._learn(list(new))
        found = [b"".join(map(self.memo.__getitem__, words)) for words in split]
        if long:  # the caches keep none
            for word in long:
                self.held -= len(word)
                del self.memo[word]
            for part in [part for part in self.parts if len(part) > LONG // 2]:
                del self.parts[part]
        return found


def byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(0x100 + others.index(b)) for b in range(256)]


_LOADED: dict[str, Words] = {}


def tail_lengths(rest: int) -> list[int]:
    """A rest as lengths that are powers of two, the largest first."""
    return [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def pieces_of(documents: Iterator, length: int) -> Iterator[tuple]:
    """Cut a stream of (key, ids as bytes) into sequences.

    Yields (key, start, ids, tokens of the document, sequence, offset); ids of a document that are not yet placed wait
    for at most one sequence, so memory is bounded by a sequence and a document.
    """
    sequence, waiting, held = 0, [], 0

    def placed(lengths: list[int]) -> Iterator[tuple]:
        nonlocal sequence
        queue = iter(lengths)
        room, offset = next(queue), 0
        for key, start, ids, total in waiting:
            while ids:
                if offset == room:
                    sequence, offset, room = sequence + 1, 0, next(queue)
                part, ids = ids[: 4 * (room - offset)], ids[4 * (room - offset) :]
                yield key, start, part, total, sequence, offset
                start, offset = start + len(part) // 4, offset + len(part) // 4
        sequence += 1

    for key, ids in documents:
        total, at = len(ids) // 4, 0
        while total - at + held >= length:
            take = length - held
            waiting.append((key, at, ids[4 * at : 4 * (at + take)], total))
            yield from placed([length])
            at, waiting, held = at + take, [], 0
        if at < total:
            waiting.append((key, at, ids[4 * at :], total))
            held += total - at
    if held:
        yield from placed(tail_lengths(held))


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048, key: str = "doc_id", text: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset): one row for each piece."""
    import pyarrow as pa

    kind = docs.schema[key].dataType.simpleString()
    ordered = with_curve_keys(docs, key, text)
    ordered = ordered.repartitionByRange(partitions or task_count(docs), "_curve", "_key", "_row")
    ordered = ordered.sortWithinPartitions("_curve", "_key", "_row").select("_key", "_text")

    def run(batches: Iterator) -> Iterator:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer_path not in _LOADED:
            _LOADED[tokenizer_path] = Words(tokenizer_path)
        words = _LOADED[tokenizer_path]
        first, end = TaskContext.get().partitionId() << 40, end_id.to_bytes(4, "little")
        schema = pa.schema([
            ("_key", kept_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ])

        def documents() -> Iterator:
            for batch in sliced(batches, 2 * 1024**2):
                for name, ids in zip(batch["_key"].to_pylist(), words.encode_all(utf8(batch["_text"]))):
                    yield name, ids + end

        rows = []
        for name, start, ids, total, sequence, offset in pieces_of(documents(), length):
            rows.append((name, start, len(ids) // 4, ids, total, first + sequence, offset))
            if len(rows) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_type

    kept_type = to_arrow_type(docs.schema[key].dataType)
    packed = ordered.mapInArrow(
        run, f"_key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return packed.withColumnRenamed("_key", key)
