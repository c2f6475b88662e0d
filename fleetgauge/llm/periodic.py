"""Periodic runs of words, found by Lyndon roots.

A run is a stretch of consecutive words with smallest period q, at least `min_words` and 2q words long, that no neighbouring word
extends. Every run holds a Lyndon root: the longest Lyndon word that begins at some place, under an order of the words or under
its reverse. So one candidate for each place and order is enough:
1. `lyndon_lengths` groups the suffixes of a text as phase one of Baier's suffix sorter does. Groups are taken from the greatest down; the
   nearest place to the left that is still in a lower group gets the group's prefix appended to its own. When a group is taken, its
   prefix is the longest Lyndon word at each of its places. It runs twice, the second time with the order reversed.
2. Each candidate (place, length p) is extended by the longest common extensions of its two ends, left and right. These come from exact
   names of all blocks of 1, 2, 4, ... words, for all candidates of a few megabytes of text at once.
3. Candidates whose extensions sum to p or more are runs; equal ones count once.

A word that occurs once in its text lies in no run. Texts are cut there, and pieces too short for a run are left out before step 1; what is
found does not change.

Words are `[^\\x20\\x09-\\x0D]+`. Null and empty texts have no words, no runs and an empty collapsed text. Each row is treated for itself, so
repeated rows and null ids get equal results of their own. Nothing is shuffled. A task holds a few megabytes of text at a time, but at
least one whole text, at about 150 bytes for each word in its pieces. Only the named columns are read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame

from fleetgauge.llm.common import sliced, utf8


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that begins there; smaller numbers come first."""
    n = len(symbols)
    alphabet = sorted(set(symbols))
    number = {symbol: g for g, symbol in enumerate(alphabet)}
    group = [number[symbol] for symbol in symbols]
    held: list[list[int]] = [[] for _ in alphabet]
    for place, g in enumerate(group):
        held[g].append(place)
    # groups in order, as a list linked both ways
    below = list(range(-1, len(held) - 1))
    above = [*range(1, len(held)), -1]
    width = [1] * len(held)
    left = list(range(-1, n - 1))
    taken = bytearray(n)
    lengths = [0] * n
    g = len(held) - 1
    while g >= 0:
        # places that moved on to another group stay in the old list
        inside = [place for place in held[g] if group[place] == g]
        own = width[g]
        for place in inside:
            lengths[place] = own
            taken[place] = 1
        times: dict[int, int] = {}
        for place in inside:
            before = left[place]
            while before >= 0 and taken[before]:
                further = left[before]
                if further >= 0 and taken[further]:
                    left[before] = left[further]
                before = further
            left[place] = before
            if before >= 0:
                times[before] = times.get(before, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for place, count in times.items():
            moved.setdefault((-count, group[place]), []).append(place)
        # more repeats of the prefix are greater; each new group goes right above the one it leaves
        for count, old in sorted(moved):
            new, up = len(held), above[old]
            places = moved[count, old]
            held.append(places)
            width.append(width[old] - count * own)
            below.append(old)
            above.append(up)
            above[old] = new
            if up >= 0:
                below[up] = new
            for place in places:
                group[place] = new
        g = below[g]
    return lengths


def block_names(symbols, longest: int) -> list:
    """Names of all blocks of 1, 2, 4, ... symbols up to `longest`: equal names for equal blocks."""
    import numpy as np

    names, size = [np.asarray(symbols, "int64")], 1
    while 2 * size <= longest:
        last = names[-1]
        pairs = last[:-size] * (int(last.max()) + 1) + last[size:]
        names.append(np.unique(pairs, return_inverse=True)[1].astype("int64"))
        size *= 2
    return [n.astype("int32") for n in names]


def common_extensions(names: list, first, second, step: int):
    """How many symbols agree from `first` and `second` on (`first` < `second`), to the right (step 1) or to the left (-1)."""
    import numpy as np

    total = np.zeros(len(first), "int64")
    for k in range(len(names) - 1, -1, -1):
        size, table = 1 << k, names[k]
        shift = total if step > 0 else 1 - size - total
        x, y = first + shift, second + shift
        fits = (x >= 0) & (y < len(table))
        same = np.zeros(len(first), bool)
        same[fits] = table[x[fits]] == table[y[fits]]
        total += size * same
    return total


def pieces(words: list, least: int) -> Iterator[tuple[int, int]]:
    """(from, to) of the stretches of at least `least` words that all occur twice or more in the text."""
    counts = Counter(words)
    start = 0
    for place in [*(i for i, word in enumerate(words) if counts[word] == 1), len(words)]:
        if place - start >= least:
            yield start, place
        start = place + 1


def runs_of(texts: list[list], min_words: int = 12):
    """(text number, start, length, period) of every run of the word lists, as four arrays in that order."""
    import numpy as np

    symbols, roots, places, texts_at, starts_at, longest = [0], [], [], [], [], 0
    for number, words in enumerate(texts):
        for start, end in pieces(words, max(2, min_words)):
            code: dict = {}
            piece = [code.setdefault(word, len(code) + 1) for word in words[start:end]]
            base, size = len(symbols), end - start
            for order in (piece, [-c for c in piece]):
                roots.append(np.array(lyndon_lengths(order), "int64"))
                places.append(np.arange(base, base + size))
                texts_at.append(np.full(size, number))
                starts_at.append(np.full(size, start - base))
            symbols += piece
            symbols.append(0)  # a place of no piece: extensions end there
            longest = max(longest, size)
    if not roots:
        return tuple(np.zeros(0, "int64") for _ in range(4))
    place, period = np.concatenate(places), np.concatenate(roots)
    names = block_names(symbols, longest)
    right = common_extensions(names, place, place + period, 1)
    left = common_extensions(names, place - 1, place + period - 1, -1)
    length = left + period + right
    is_run = length >= np.maximum(2 * period, min_words)
    found = np.stack([np.concatenate(texts_at), place - left + np.concatenate(starts_at), length, period])[:, is_run]
    return tuple(np.unique(found, axis=1)) if found.size else tuple(found)


def collapsed(words: list, starts, lengths, periods) -> list:
    """The words without those that some run holds after its first period."""
    import numpy as np

    if not len(starts):
        return words
    change = np.zeros(len(words) + 1, "int64")
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 12) -> DataFrame:
    """(key, n_words, runs by start and period, collapsed): one row for each row of `docs`."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for part in sliced(batches):
            words = [value.split() for value in utf8(part[text])]
            number, start, length, period = runs_of(words, min_words)
            order = np.lexsort((length, period, start, number))
            number, start, length, period = (x[order] for x in (number, start, length, period))
            edges = np.searchsorted(number, np.arange(len(words) + 1))
            kept = [
                b" ".join(collapsed(w, start[a:b], length[a:b], period[a:b])).decode()
                for w, a, b in zip(words, edges[:-1].tolist(), edges[1:].tolist())
            ]
            one = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [part[key], pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), one), pa.array(kept, pa.string())],
                names=[key, "n_words", "runs", "collapsed"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
