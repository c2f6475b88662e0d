"""Ranked search, archives and periodic runs against brute-force versions."""

import base64
import gzip
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter
from dataclasses import replace
from datetime import datetime, timezone
from fractions import Fraction

import pytest

from fleetgauge.llm import lexical, periodic, queries, warc

FOLDER = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
present = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


# ranked search
def terms(text):
    return re.findall(lexical.TERM, "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_search(items, docs, k):
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c in found) + 1))) for t in own}
        scores = []
        for i, c in found:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(3)
    some = ["Alpha", "beta", "ÉTÉ", "été", "x1", "of", "the", "日本", "a-b", "gamma"] + [f"w{i}" for i in range(60)]
    docs = [(i, pick.choice([" ", "\n", ", "]).join(pick.choice(some) for _ in range(pick.randint(0, 60)))) for i in range(150)]
    docs += [(200 + i, docs[0][1]) for i in range(40)]
    docs += [(300, None), (301, ""), (302, " -\x00/ "), (None, "alpha beta"), (0, docs[0][1]), (303, "of " * 30_000 + "w1"), (-5, "w1 w2")]
    items = [(i, " ".join(pick.choice(some) for _ in range(pick.randint(1, 12)))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "unseen words"), (0, "w59 w58"), (None, "alpha"), (None, "of"), (53, " ".join(some) * 3)]
    return items, docs


@pytest.mark.parametrize("shape", [lexical.DEFAULT, lexical.Tiles(block_pairs=60, item_tile=4, term_tile=3, doc_tile=7, tasks_together=1)])
def test_search_equals_plain_scores(spark, corpus, shape, monkeypatch):
    items, docs = corpus
    monkeypatch.setattr(lexical, "TASK_BYTES", 2_000)
    asked = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, score string")
    texts = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, rank string").repartition(5)
    found = lexical.ranked_search(asked, texts, k=7, shape=shape)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_search(items, docs, 7)


def test_search_on_empty_tables(spark):
    asked, texts = spark.createDataFrame([("a", "x")], "item_id string, text string"), spark.createDataFrame([(1, "x")], "doc_id int, text string")
    for a, b in ((asked.limit(0), texts), (asked, texts.limit(0)), (asked.limit(0), texts.limit(0))):
        found = lexical.ranked_search(a, b)
        assert found.collect() == [] and dict(found.dtypes) == {"item_id": "string", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert lexical.ranked_search(asked, texts).first()["item_id"] == "a"


def test_partial_sums_stay_exact():
    # weights so large that only nine summands are exact together
    weights = [10**9 - i for i in range(40)]
    tile = lexical.Tile(0, [list(range(40))], weights, lexical.DEFAULT)
    assert tile.wide == 9 and tile.wide * max(weights) * lexical.MOST_IMPACT < lexical.EXACT
    import numpy as np

    impact = np.array([10**6 - 1 - 7 * i for i in range(40)], "int64")
    got = tile.scores(np.zeros(40, int), np.arange(40, dtype="int32"), impact, 1)
    assert got[0, 0] == sum(w * int(i) for w, i in zip(weights, impact))


def test_best_keep_ties_by_id():
    import numpy as np

    pick = random.Random(2)
    scores = [[pick.randint(0, 4) for _ in range(60)] for _ in range(3)]
    docs = list(range(60))
    pick.shuffle(docs)
    best = lexical.Best(3, 5)
    for a in range(0, 60, 11):
        best.add(0, np.array([s[a : a + 11] for s in scores]), np.array(docs[a : a + 11]))
    for s, top, ids in zip(scores, best.score.tolist(), best.doc.tolist()):
        assert list(zip(top, ids)) == sorted(zip(s, docs), key=lambda x: (-x[0], x[1]))[:5]


# archives
@pytest.fixture(scope="module")
def web():
    pick = random.Random(4)
    rows = [(i, f"http://a.org/{i}", "<p>" + "é%d " % pick.randint(0, 9) * pick.randint(0, 200) + "</p>") for i in range(60)]
    rows += [(100 + i, None if i % 3 else "http://b.org/\r\nWARC-Type: x y", pick.choice([None, "", "same", "same 2"])) for i in range(40)]
    rows += [(200, "u", "HTTP/1.1\r\n\r\nbody\r\n\r\n"), (200, "v", "HTTP/1.1\r\n\r\nbody\r\n\r\n"), (None, "n", "same"), (None, "n", "only nulls"), (None, "m", "only nulls")]
    return rows + [(300, "long", "z" * 3_000_000), (301, "long", "z" * 3_000_000)]


def plain_records(rows, least):
    def payload(html):
        return (html or "").encode()

    kept = {}
    for page, _, html in rows:
        if page is not None and len(payload(html)) >= least:
            kept[payload(html)] = max(page, kept.get(payload(html), page))
    out = []
    for page, _, html in rows:
        data = payload(html)
        other = kept.get(data) if kept.get(data) != page else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if other is None else "revisit", other))
    return sorted(out, key=str)


SMALL = warc.Store(archive_bytes=4_000, stretch_bytes=1_000, gap_bytes=100, read_bytes=700)


@pytest.mark.parametrize(("least", "store"), [(0, warc.DEFAULT), (0, SMALL), (5, SMALL)])
def test_archives_give_every_page_back(spark, web, tmp_path, least, store):
    pages = spark.createDataFrame([(*r, "x", 1) for r in web], "page_id long, url string, html string, archive string, offset int").repartition(3)
    index = warc.write_archives(pages, f"file://{tmp_path}/crawl", min_bytes=least, date=datetime(2024, 5, 1, tzinfo=timezone.utc), store=store)
    found = warc.read_records(index, store=store).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in found), key=str) == plain_records(web, least)
    assert all(r.intact for r in found)
    texts = Counter((html or "").encode() for _, _, html in web)
    assert set(texts) == {bytes(r.payload) for r in found if r.record_type == "response"}
    listed = index.collect()
    assert sorted(((r.page_id, r.url) for r in listed), key=str) == sorted(((p, u) for p, u, _ in web), key=str)
    # the members tile each archive after its first record, and the whole file unpacks to plain records
    for name in {r.archive for r in listed}:
        raw = open(name.removeprefix("file://"), "rb").read()
        own = sorted((r.offset, r.length) for r in listed if r.archive == name)
        assert [a + b for a, b in own] == [a for a, _ in own[1:]] + [len(raw)]
        text = gzip.decompress(raw)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and text.count(b"WARC-Date: 2024-05-01T00:00:00Z") == len(own) + 1


def test_selected_records_are_read_alone(spark, web, tmp_path):
    pages = spark.createDataFrame(web, "page_id long, url string, html string").coalesce(1)
    index = warc.write_archives(pages, f"file://{tmp_path}/crawl")
    some = index.where("page_id IN (3, 4, 59)")
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_records(some).collect()}
    assert got == {p: h for p, _, h in web if p in (3, 4, 59)}
    assert warc.read_records(index.where("false")).count() == 0
    # gaps, the greatest read, long records and other archives begin new reads
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 200, 5), ("a", 205, 900), ("b", 0, 3)]
    assert [(a, s, e, len(g)) for a, s, e, g in warc.ranges(rows, replace(SMALL, gap_bytes=50))] == [
        ("a", 0, 15, 2), ("a", 200, 205, 1), ("a", 205, 1105, 1), ("b", 0, 3, 1),
    ]


def test_archives_of_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    index = warc.write_archives(none, f"file://{tmp_path}/crawl")
    assert index.count() == 0 and warc.read_records(index).count() == 0


# periodic runs
def plain_runs(words, least=12):
    out = set()
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            size = end + q - at
            if end > at and size >= max(least, 2 * q):
                part = words[at : at + size]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.add((at, size, q))
            at = max(end, at) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, words):
    found = plain_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = best[1] and math.floor(Fraction(1000 * best[1], best[2]))
    return doc_id, len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_lyndon_lengths_equal_plain_ones():
    pick = random.Random(6)
    for _ in range(400):
        s = [pick.randint(1, pick.choice([1, 2, 4])) for _ in range(pick.randint(0, 30))]
        plain = [next((j - i for j in range(i + 1, len(s)) if s[i:] >= s[j:]), len(s) - i) for i in range(len(s))]
        assert periodic.lyndon_lengths(s) == plain


def test_runs_equal_plain_ones(spark):
    pick = random.Random(7)
    texts = [(None, None), (0, ""), (1, " \n"), (2, "a " * 12), (3, "a " * 11), (4, "a b " * 3_000), (4, "a b " * 3_000), (None, "x y z " * 9)]
    for i in range(200):
        size = pick.choice([2, 3, 9])
        parts = [[pick.choice("abcdéfghij"[:size]) for _ in range(pick.randint(1, 40))]]
        for _ in range(pick.randint(0, 3)):
            parts.append([pick.choice("abcdéfghij") for _ in range(pick.randint(1, 9))] * pick.randint(1, 6))
        texts.append((10 + i, pick.choice([" ", "\n", "\t "]).join(w for p in parts for w in p)))
    frame = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, runs string").repartition(3)
    found = periodic.find_runs(frame)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=str)
    want = []
    for doc_id, text in texts:
        words = re.findall(WORD, text or "")
        runs = plain_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((doc_id, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want, key=str)
    assert periodic.find_runs(frame.limit(0)).count() == 0


@present
def test_periodic_query_equals_plain_version(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r.text or "") < 20_000 or r.doc_id % 3 == 0]
    want = [plain_row(r.doc_id, planted(r.doc_id, re.findall(WORD, r.text or ""))) for r in rows]
    ids = {r.doc_id for r in rows}
    got = [tuple(r) for r in queries.LLM_QUERIES["op13_periodic"](spark, FOLDER).collect() if r.doc_id in ids]
    assert sorted(got) == sorted(want) and sum(r[1] > 0 for r in got) > 10
