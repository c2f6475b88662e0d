"""Each operator against a brute-force version, with nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import html
import os
import random
import re

import numpy as np
import pytest
from compare import connect, differences

from fleetgauge.llm import bpe, html_text, lines, neighbours, packing, pii, quality, queries, simhash, substring, urls

FOLDER = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, _extra string"


def words(text):
    return re.findall(WORD, text or "")


@pytest.fixture(scope="module")
def docs(spark):
    pick = random.Random(1)
    base = " ".join(pick.choice(["the", "of", "alpha", "beta", "gamma", "delta", "eins", "zwei"]) + str(pick.randint(0, 40)) for _ in range(120))
    rows = [(i, f"{base} {i}", "en", "s", "x") for i in range(6)]
    rows += [(10, None, None, None, None), (11, "", "en", "s", ""), (12, " \n\t", "en", "s", ""), (None, base, "en", "s", ""), (0, rows[0][1], "en", "s", "x")]
    rows += [(20 + i, " ".join(f"w{pick.randint(0, 300)}" for _ in range(90)) + f"\nread me\nline {i}", "de", "s", "") for i in range(12)]
    rows += [(40, "z" * 30_000 + " long word and +1 (555) 123-4567", "en", None, ""), (41, "word " * 3_000, "en", "t", "")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(queries.LLM_ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(queries.LLM_QUERIES[name](spark, FOLDER), connect(FOLDER), queries.LLM_ORACLE[name]) == []


# personal data
SEEDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def seeds(text):
    return [(k, m.start(), m.end()) for k, p in SEEDS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def test_base_spans_equal_plain_patterns(spark, docs, empty):
    pick = random.Random(5)
    parts = ["a", "b.c", "@", "1", "22", ".", "192.168.1.7", "-", " ", "+", "(", "4485275742308327", "é", "😀", "x@y.zz", "_", "\n", "256.1.1.1", "+1 (555) 123-4567"]
    rows = [(i, "".join(pick.choice(parts) for _ in range(pick.randint(0, 30)))) for i in range(300)]
    rows += [(900, "1." * 3_000), (901, "9" * 50_000), (902, "a." * 9_000 + "@b" + ".c" * 9_000), (903, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: [tuple(s) for s in r.base_spans] for r in pii.find_pii(frame, carry=["doc_id"]).collect()}
    assert found == {i: seeds(t) for i, t in rows}
    assert pii.find_pii(docs).count() == docs.count() and pii.find_pii(empty).count() == 0


def plain_contexts(text, start, end):
    """The patterns around a span: words of at most 256 code points that lie within as many."""
    def shape(word):
        return re.sub("[0-9]+", "0", word).lower()

    left = [m for m in re.finditer(r"[^ \t\n\x0B\f\r]+", text[:start]) if m.start() >= start - 256]
    right = [m for m in re.finditer(r"[^ \t\n\x0B\f\r]+", text[end : end + 600]) if m.end() <= 256]
    left, right = [shape(m.group()) for m in left], [shape(m.group()) for m in right]
    return [f"1 {w}" for w in left[-1:]] + [f"2 {v} {w}" for v, w in zip(left[-2:-1], left[-1:])] + [f"+ {w}" for w in right[:1]]


def plain_others(text, base):
    """Strings that may be identifiers and touch no base span."""
    for pattern, _ in pii.CANDIDATES.values():
        for m in re.finditer(pattern, text):
            if re.search("[A-Za-z0-9]", m.group()) and not any(a < m.end() and m.start() < b for _, a, b in base):
                yield m.start(), m.start() + len(m.group().rstrip("._%+/-"))


def plain_spans(texts, how):
    """All spans of each text: rounds over sets and dictionaries, with nothing pruned, joined or written."""
    base = [seeds(t) for t in texts]
    others = [list(plain_others(t or "", b)) for t, b in zip(texts, base)]
    kinds = {}
    for t, b, o in zip(texts, base, others):
        for kind, a, z in [*b, *(("other", *place) for place in o)]:
            for pattern in plain_contexts(t, a, z):
                pair = kinds.setdefault(pattern, {})
                pair[t[a:z]] = min(kind, pair.get(t[a:z], kind))
    graph = {p: strings for p, strings in kinds.items() if len(strings) >= how.min_known and "other" in strings.values()}
    known = {(s, k) for strings in graph.values() for s, k in strings.items() if k != "other"}
    learned = {}
    while True:
        good = {}
        for p, strings in graph.items():
            for kind in pii.KINDS:
                k = sum((s, kind) in known or learned.get(s) == kind for s in strings)
                if k >= how.min_known and k >= how.min_share * len(strings):
                    good[p, kind] = min(0.99, k / len(strings))
        missed = {}
        for (p, kind), share in good.items():
            for s, k in graph[p].items():
                if k == "other":
                    missed[s, kind] = missed.get((s, kind), 1.0) * (1 - share)
        new = {}
        for (s, kind), miss in missed.items():
            if 1 - miss >= how.min_score and s not in learned:
                new[s] = min(new.get(s, (9, "")), (miss, kind))
        if not new:
            break
        learned |= {s: kind for s, (_, kind) in new.items()}
    telling = {p for p, _ in good}
    found = []
    for t, b, o in zip(texts, base, others):
        added = {(learned[t[a:z]], a, z) for a, z in o if t[a:z] in learned and telling & set(plain_contexts(t, a, z))}
        found.append(sorted(b + list(added), key=lambda x: (pii.KINDS.index(x[0]), *x[1:])))
    return found


@pytest.mark.parametrize("how", [pii.DEFAULT, pii.Bootstrap(3, 0.5, 0.6)])
@pytest.mark.parametrize("source", ["generated", "documents"])
def test_added_spans_equal_plain_rounds(spark, source, how):
    if source == "generated":
        pick = random.Random(5)
        heads = ["contact:", "login", "ref. no", "Kunde 12", "call", "see"]
        pools = [[f"{w}{g}{i}" if i % 3 else f"{w}-{g}/{i:03d}." for i in range(25)] for g, w in enumerate(["usr", "x_", "AB", "k@", "0", "q:7:"])]
        base = [lambda i: f"user{i}@mail.com", lambda i: f"10.0.{i % 250}.{i // 250}", lambda i: f"+49 30 {100000 + i}"]
        texts = []
        for i in range(1_200):
            part = []
            for _ in range(pick.randint(1, 3)):
                g = pick.randrange(6)
                # a head tells seeds of its kind, identifiers of its own group, and those of the next
                draw = pick.random()
                what = base[g % 3](pick.randrange(400)) if draw < 0.85 - 0.1 * g else pick.choice(pools[g if draw < 0.95 else (g + 1) % 6])
                part += [pick.choice(["a", "the", "12", "e\u0301t\u00e9", "\U0001F600"]), heads[g], what, pick.choice(["now", "or", "2024", ";"])]
            texts.append(pick.choice([" ", "  ", "\n"]).join(part))
        texts += [None, "", texts[0], texts[1], "w" * 300 + " usr01 " + "v" * 300]
    else:
        if not os.path.isdir(FOLDER):
            pytest.skip("test tables not present")
        texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    want = plain_spans(texts, how)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = pii.find_pii(frame, carry=["doc_id"], how=how).orderBy("doc_id").collect()
    assert [[tuple(s) for s in r.spans] for r in found] == want
    if source == "generated":
        assert sum(map(len, want)) > sum(len(seeds(t)) for t in texts) + 20


def test_contexts_find_unseen_identifiers_and_redaction_replaces_spans(spark):
    rows = [(i, f"please write to contact: user{i}@mail.com now") for i in range(20)] + [(50, "my contact: user9912345 é"), (51, "the year 2024 is clean")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find_pii(frame).collect()}
    assert [tuple(s) for s in found[50]] == [("email", 12, 23)] and found[51] == []
    red = dict(pii.redact_pii(frame).collect())
    assert red[50] == "my contact: [EMAIL] é" and red[0] == "please write to contact: [EMAIL] now" and red[51] == rows[-1][1]


def test_rounds_follow_chains_of_contexts(spark):
    # each word stands before identifiers that the word before it tells, and before a quarter as many new ones
    sizes, heads = (640, 160, 40, 10, 2), ("contact:", "member", "handle", "alias")
    groups = [[f"user{i}@mail.com" for i in range(640)]] + [[f"{'xabcd'[g]}-{70000 + i}" for i in range(sizes[g])] for g in range(1, 5)]
    rows = [f"{head} {s}" for g, head in enumerate(heads) for s in groups[g] + groups[g + 1]] + ["other z-77777"]
    found = pii.find_pii(spark.createDataFrame([(r,) for r in rows], "text string")).collect()
    assert {r.text: [s.kind for s in r.spans] for r in found} == {r: ["email"] for r in rows[:-1]} | {rows[-1]: []}


def test_contexts_reach_over_other_numbers(spark):
    dated = [f"on 2024-05-{i % 28 + 1:02d} by: user{i}@mail.com" for i in range(20)] + [f"by: the by: {w}{i}-7000{i}" for i in range(10) for w in "pq"]
    unit = [f"unit {i} user{i}@host.org" for i in range(20)]
    rows = dated + unit + ["on 2024-05-01 by: user99123", "é" * 700 + " 4 unit 12 7750123", "7750124"]
    found = pii.find_pii(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[tuple(s) for s in r.spans] for r in found[-3:]] == [[("email", 18, 27)], [("email", 711, 718)], []]


def test_contexts_are_whole_words_and_any_identifier_fills_the_slot(spark):
    long, same_end = "a" * 200 + "contact-person:", "b" * 200 + "contact-person:"
    rows = [f"write to {long} user{i}@mail.com now" for i in range(20)] + [f"contact: user{i}@host.org" for i in range(120)]
    rows += [f"{'c' * 300} user{i}@far.org" for i in range(20)]
    asked = {
        f"{same_end} user99123": [], f"{long} user99123": [(216, 225)], f"say {'c' * 300} user77123": [],
        "contact: bob7": [(9, 13)], "contact: bob@intranet": [(9, 21)], "contact: x_y": [(9, 12)], "contact: ab12:cd34:ef56:7890": [(9, 13), (9, 28)],
        "contact: 030 1234 5678": [(9, 12), (9, 22)], "contact: (030) 4455-6677": [(9, 24)], "contact: someone": [], "in 2024 at 12:30:45 (1 2)": [],
        "é" * 600 + " contact: bob7!": [(610, 614)], "contact: ____ @": [],
    }
    frame = spark.createDataFrame([(r,) for r in [*rows, *asked]], "text string").repartition(3)
    found = {r.text: [(s.start, s.end) for s in r.spans] for r in pii.find_pii(frame).collect()}
    assert {t: found[t] for t in asked} == asked and all(len(found[r]) == 1 for r in rows)
    assert {s.kind for r in pii.find_pii(frame).collect() for s in r.spans} == {"email"}


def test_redaction_keeps_columns_of_any_name(spark):
    row = ("mail a@b.cc", "x", "y", "z", "w", 1, 2)
    kind = "text string, spans string, base_spans string, _hash string, `a b` string, _source int, _added int"
    frame = spark.createDataFrame([row], kind)
    assert tuple(pii.redact_pii(frame).first()) == ("mail [EMAIL]", *row[1:]) and pii.redact_pii(frame).columns == frame.columns


# near-duplicates
def plain_fingerprint(text, n=3):
    from xxhash import xxh64_intdigest

    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, budget=3):
    label = list(range(len(prints)))
    while True:
        new = [min(label[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= budget) for i in range(len(prints))]
        if new == label:
            return label
        label = new


def test_near_duplicates_equal_all_pairs(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    label = classes(prints)
    least = {c: min((i for (i, _), k in zip(rows, label) if k == c and i is not None), default=None) for c in label}
    want = sorted(((i, f"{p:016x}", least[c]) for (i, _), p, c in zip(rows, prints, label)), key=str)
    found = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == want
    kept = [r.doc_id for r in simhash.one_of_each(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, least.values()))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).columns == docs.columns


@pytest.mark.parametrize("task_rows", [4096, 20, 3])
def test_trie_join_finds_every_link(spark, task_rows):
    from fleetgauge.llm.components import connected_components

    random_ = np.random.default_rng(3)
    base = random_.integers(0, 2**63, size=8, dtype=np.uint64)
    prints = base[random_.integers(0, 8, 160)]
    for i in range(len(prints)):
        for bit in random_.integers(0, 64, random_.integers(0, 7)):
            prints[i] ^= np.uint64(1) << np.uint64(bit)
    prints = np.unique(prints)
    label, signed = classes(prints.tolist()), prints.view("int64").tolist()
    groups = {}
    for c, s in zip(label, signed):
        groups.setdefault(c, []).append(s)
    nodes = spark.createDataFrame([(s,) for s in signed], "_fp long")
    found = connected_components(simhash.near_links(nodes, 3, task_rows)).collect()
    assert dict(map(tuple, found)) == {s: min(g) for g in groups.values() if len(g) > 1 for s in g}


def test_buckets_out_of_reach_never_meet(spark):
    """All share one block; eight more bits cut them, so each meets the 93 buckets within three bits, not all 256."""
    prints = [5 << 48 | int(i) for i in np.random.default_rng(4).choice(2**48, 16_000, replace=False)]
    nodes = spark.createDataFrame([(p,) for p in prints], "_fp long")
    dealt = simhash.dealt_to_tasks(nodes, 3, 160).where("_block = 0")
    n, most = dealt.groupBy("_fp").count().selectExpr("count(*)", "max(count)").first()
    assert n == 16_000 and most == 93
    assert dealt.groupBy("_i", "_j").count().selectExpr("max(count)").first()[0] <= 2 * 160


# tokens
def test_bpe_equals_the_library_and_decodes_to_the_text(docs, empty):
    import tiktoken

    path, pattern = queries.vocabulary("byte_bpe_multi_50k.tiktoken"), queries.split_pattern()
    coder = bpe.ByteBpe(path, pattern)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=coder.ranks, special_tokens={})
    pick = random.Random(1)
    parts = ["a", "b", "th", " ", "\n", "é", "日", "1", "\x1c", "'s", "😀", "ab", "!!", "\t", "ß", "\u2003"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 60))) for _ in range(500)] + ["ab" * 5_000]
    assert [coder.encode(t) for t in texts] == [library.encode_ordinary(t) for t in texts]
    text = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    ids = bpe.bpe_encode(docs, path, pattern).where("doc_id IS NOT NULL")
    assert {r.doc_id: r.ids for r in ids.collect()} == {i: library.encode_ordinary(t) for i, t in text.items()}
    assert {r.doc_id: bytes(r.decoded).decode() for r in bpe.bpe_decode(ids, path, pattern).collect()} == text
    trip = {r.doc_id: r for r in bpe.bpe_round_trip(docs, path, pattern).collect()}
    assert all(trip[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in text.items())
    assert bpe.bpe_round_trip(empty, path, pattern).count() == 0


def test_packing_places_every_id_once(docs, empty):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    odd = ["A<|endoftext|>b <|ENDOFTEXT|> İ", "don't STOP,! é, e\u0301; \x01 x\x01y", "\u00a0a\u2003b"]
    coder = packing.Words(path)
    for text, ids in zip(odd, coder.encode_all([t.encode() for t in odd])):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    packed = packing.pack_documents(docs, path, length=64, partitions=3).collect()
    want = sorted(library.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.where("doc_id > 0").collect())
    found, sequences = {}, {}
    for r in sorted(packed, key=lambda r: r.start):
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id:
            found.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert sorted(found.values()) == want
    for parts in sequences.values():
        total = 0
        for offset, length in sorted(parts):
            assert offset == total
            total += length
        assert total <= 64 and total.bit_count() == 1
    assert packing.pack_documents(empty, path).count() == 0


def test_words_for_packing_equal_the_library():
    from tokenizers import Tokenizer

    pick = random.Random(9)
    letters = ["the", "Straße", "é", "e\u0301", "ΑΣ", "ñ", "İ", "\u0958", "ﬁ", "ไทย", "中文", "한", "²", "Ⅷ", "٣", "7", "10", "\u0345", "\U0001e900", "ჲ", "\u1c89", "\ua7da"]
    marks = [*"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", "€", "…", "’", "\u0338", "\u200d", "😀", "'s", "'LL", "|>", "***", "$$$", "\xa0", "\x01"]
    texts = [
        " ".join("".join(pick.choice(letters if pick.random() < 0.6 else marks) for _ in range(pick.randint(1, 6))) for _ in range(60))
        for _ in range(1_500)
    ]
    texts += ["x" * 300 + "." * 40 + " " + "." * 300 + " y" + "?" * 254, "<|endoftext|>. a<|b ."]
    path = queries.vocabulary("word_bpe_49k.json")
    words, library = packing.Words(path), Tokenizer.from_file(path)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(w, "<u4").tolist() for w in words.encode_all([t.encode() for t in part])] == want


def test_hilbert_curve_steps_to_neighbours():
    points = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    keys = packing.hilbert_keys(points, 3)
    assert sorted(keys) == list(range(512))
    assert np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1).max() == 1


# substrings, quality and lines beyond the SQL twins
def test_substring_dedup_equals_all_windows(docs, empty):
    rows = [(r.doc_id, words(r.text)) for r in docs.collect()]
    first = {}
    for i, w in rows:
        for j in range(len(w) - 12):
            if i is not None:
                key = tuple(w[j : j + 13])
                first[key] = min(i, first.get(key, i))
    want = []
    for i, w in rows:
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if i is not None and first[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    found = substring.substring_dedup(docs, parts=2).collect()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert substring.substring_dedup(empty).count() == 0


def test_an_id_of_many_rows_is_spread(spark):
    shared = " ".join(f"s{i}" for i in range(20))
    rows = [(7, f"own{i} {shared} end{i}") for i in range(300)] + [(None, f"n{i} {shared}") for i in range(100)] + [(9, f"x {shared} y"), (5, "z " + shared[:-4])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = substring.substring_dedup(frame, parts=8).collect()
    # id 5 has the first nineteen shared words, so id 7 keeps the twentieth; id 9 loses all
    assert {(r.doc_id, r.n_removed) for r in found} == {(5, 0), (7, 19), (9, 20), (None, 0)}
    assert len(found) == len(rows)


def test_quality_on_odd_rows(docs, empty):
    found = {r.doc_id: r for r in quality.judge_quality(docs).collect()}
    assert found[10].n_words == 0 and found[10].base_failed and not found[10].kept
    assert found[41].base_failed and found[41].n_repeat_words == 3_000 and found[20].kept
    assert found[20]._extra == "" and quality.judge_quality(empty).count() == 0


def test_word_rule_can_reject_in_any_language(spark):
    pick = random.Random(4)

    def prose(common, share):
        return " ".join(pick.choice(common) if pick.random() < share else "".join(pick.choice("aeinorst") for _ in range(5)) for _ in range(300))

    own = {"en": ["the", "of", "and", "to"], "xx": ["ona", "tiro", "sen", "rat"], None: ["nesi", "tor", "asa", "rin"]}
    rows = [(f"{lang} {i}", prose(common, 0.23), lang) for lang, common in own.items() for i in range(40)]
    rows += [(f"{lang} none", prose(["stone"], 0), lang) for lang in own]
    frame = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    assert sorted(r.doc_id for r in quality.judge_quality(frame).where("NOT kept").collect()) == ["None none", "en none", "xx none"]
    assert [r.doc_id for r in quality.judge_quality(frame, quality.DEFAULT).where("NOT kept").collect()] == ["en none"]


def test_lines_drop_frames_but_not_copies(spark, empty):
    rows = [(i, f"Home | About\nown text {i}\n\n Home | About\t") for i in range(12)] + [(20 + i, "a copied page\nwith lines") for i in range(30)]
    rows += [(60, None), (61, ""), (62, "Home | About")]
    frame = spark.createDataFrame([(i, t, "h") for i, t in rows], "doc_id long, text string, source string")
    found = {r.doc_id: r for r in lines.drop_boilerplate(frame, max_ratio=0.5).collect()}
    assert found[3].text == "own text 3\n" and found[3].n_dropped_lines == 2
    assert found[25].text == "a copied page\nwith lines" and found[60].text is None and found[61].text == "" and found[62].text == "Home | About"
    assert lines.drop_boilerplate(empty).count() == 0


def test_the_ratio_decides_on_small_hosts(spark):
    rows = [(f"Home | About\nown text {i}", "nine") for i in range(9)] + [(("menu\n" if i < 5 else "") + ("rare\n" if i < 4 else "") + f"page {i}", "fifty") for i in range(50)]
    rows += [("a single page\nof a host", "one")]
    frame = spark.createDataFrame(rows, "text string, source string")
    found = {r.text: r.n_dropped_lines for r in lines.drop_boilerplate(frame).collect()}
    assert found == {f"own text {i}": 1 for i in range(9)} | {("rare\n" if i < 4 else "") + f"page {i}": int(i < 5) for i in range(50)} | {rows[-1][0]: 0}


# pages
def test_blocks_decode_references_and_skip_raw_elements():
    page = "<head><title>x</title></head><body><script>var t='</p>';</script><p>a &amp;  b<br>c<p>d<!-- e --><b>f</b><div>g"
    assert [b.text for b in html_text.blocks_of(page)] == ["a & b c", "df", "g"]
    assert html_text.blocks_of("") == [] and [b.text for b in html_text.blocks_of("a < b")] == ["a < b"]
    odd = {
        "<p>Let <math><mi>x</mi></math> be<p>c": ["Let x be", "c"], "<p>a <svg><text>b</text> c<p>d": ["a b c", "d"], "<p>a<noscript>b</noscript>c": ["abc"],
        "<p>a<xmp>1 < 2 <b> &amp;</xmp>c": ["a", "1 < 2 <b> &amp;", "c"], "<xmp>open <p>": ["open <p>"], "so<img src=x>me<input>thing<wbr>": ["something"],
        "<video>no <b>player</b></video> x<object>y</object>": ["no player xy"], "a<textarea>b</textarea><template><p>c</template><iframe>d</iframe>e": ["ae"],
    }
    assert {k: [b.text for b in html_text.blocks_of(k)] for k in odd} == odd


def test_whole_paths_and_blocks_count():
    deep = "".join(f"<div class=c{i}>" for i in range(3_000)) + "<p>x" + "".join("</div><p>y" for _ in range(2_999))
    blocks = html_text.blocks_of(deep)
    assert len(blocks) == 3_000 and len(list(html_text.marks_inside_out(blocks[0].path))) == 3_001
    outer, middle = ("<div class=zebra>" + "<div>" * 30 + "<p>x", "<div>" * 15 + "<div class=zebra>" + "<div>" * 15 + "<p>x")
    a, b = (html_text.vectors_of(html_text.blocks_of(page))[0] for page in (outer, middle))
    assert (a == b).all() and a[: html_text.PATH].sum() == 3
    late = html_text.vectors_of([html_text.Block("x" * 900 + "1" * 100, None, 0)])[0]
    assert late[-2] == pytest.approx(0.1)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
def test_labeller_on_held_out_layouts_and_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    how = html_text.Labeller(max_pages=60, layouts=500)
    model = html_text.train_labeller(pages, how)
    texts = {1: ["some prose that is long enough to be the text of an article"], 0: ["home about terms of use and privacy"]}
    other = html_text.laid_out(texts, html_text.Labeller(layouts=150, seed=7))
    right = total = 0
    for page in other:
        x, mask = html_text.padded([html_text.vectors_of(page)])
        score = model.scores(x, mask)[:, 0] > 0.5
        right += sum(int(s) == b.label for s, b in zip(score, page))
        total += len(page)
    assert right / total > 0.95
    rows = [(r.url, r.html) for r in pages.collect()] + [("n", None), ("e", "")]
    found = {r.url: r.text for r in html_text.extract_text(spark.createDataFrame(rows, "url string, html string"), model, ["url"]).collect()}
    for url, page in rows:
        article = re.search(r"<article>(.*?)</article>", page or "", re.S)
        parts = re.split("</?(?:p|h1)>", article[1]) if article else []
        clean = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", p))).strip() for p in parts]
        assert found[url] == "\n".join(p for p in clean if p)


def test_url_parts_rules_and_trees(spark):
    pick = random.Random(2)
    rows = [(f"http://{'casino-' if bad else ''}host{pick.randint(0, 99)}.example.{'net' if bad else 'org'}/p/{i}{'?a=1&b=2' if bad else ''}", bad)
            for i, bad in enumerate([0, 1] * 300)]
    model = urls.train(spark.createDataFrame(rows, "url string, label int"))
    asked = [("http://casino-host500.example.net/p/9?a=1&b=2", "casino-host500.example.net", "/p/9", None, "block"),
             ("http://host500.example.info/p/9", "host500.example.info", "/p/9", None, "allow"),
             ("HTTP://X.Example.ORG/es/1?q://z", "x.example.org", "/es/1", "example.org/es/", "block"),
             ("https://a.org/", "a.org", "/", "org/", "allow"), ("x://example.org/en/17#f", "example.org", "/en/17", "example.org/en/1", "block")]
    frame = spark.createDataFrame([(a[0],) for a in asked], "url string")
    assert sorted(map(tuple, urls.filter_urls(frame, queries.RULES, model).collect())) == sorted(asked)
    odd = spark.createDataFrame([(None,), ("",), ("no scheme",), ("a://",)], "url string")
    assert {(r.host, r.path, r.rule) for r in urls.filter_urls(odd, queries.RULES, model).collect()} == {("", "", None)}
    assert urls.train(frame.limit(0).selectExpr("url", "1 AS label")) is None
    assert {r.verdict for r in urls.filter_urls(odd, (), None).collect()} == {"allow"}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
def test_url_parts_and_rules_equal_sql_on_all_pages(spark):
    """All but the verdict of the trees is plain SQL."""
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    listed = ", ".join(f"('{rule}', '{rule.split('/', 1)[0]}', '/{rule.split('/', 1)[1]}')" for rule in rules)
    sql = f"""
        WITH rules(rule, rule_host, rule_path) AS (VALUES {listed}),
        rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS tail FROM pages),
        parts AS (SELECT page_id, lower(regexp_extract(tail, '^[^/?#]*')) AS host,
            regexp_extract(substr(tail, length(regexp_extract(tail, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest)
        SELECT page_id, host, path, (SELECT arg_max(rule, length(rule)) FROM rules
            WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule FROM parts"""
    want = connect(FOLDER).execute(sql).fetchall()
    found = queries.op8_urls(spark, FOLDER).collect()
    assert sorted(want, key=str) == sorted(((r.page_id, r.host, r.path, r.rule) for r in found), key=str)
    assert all(r.verdict == rules[r.rule] if r.rule else r.verdict in ("allow", "block") for r in found)
    assert {r.rule for r in found} - {None}


def test_pages_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.filter_urls(pages, queries.RULES, None).count() == 0
    assert urls.train(urls.labelled_by_rules(pages, queries.RULES)) is None
    texts = html_text.extract_text(pages, html_text.BiLstm(8, 4, 1), ["page_id", "url"])
    assert texts.collect() == [] and {"page_id", "url", "text"} <= set(texts.columns)


def test_suffix_shares_count_all_labelled_urls(spark):
    rows = [(f"http://www.host{i % 150}.org/{i}", int(i % 150 < 50)) for i in range(600)]
    model = urls.train(spark.createDataFrame(rows, "url string, label int"), urls.Trees(max_labelled=40, rounds=1))
    assert model.prior == pytest.approx(1 / 3)
    assert {r._u_suffix_two: r._u_last_two for r in model.two.collect()} == {
        f"host{i}.org": pytest.approx((4 * (i < 50) + 20 / 3) / 24) for i in range(150)
    }


def test_neighbours_recall_ties_and_odd_vectors(spark):
    random_ = np.random.default_rng(1)
    data = random_.normal(size=(1_500, 16)).round(3)
    data[100:700] = data[100]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    odd = [(5_000, None), (5_050, [0.0] * 16), (5_100, [float("nan")] * 16), (5_150, [None] * 16), (5_200, [1.0]), (None, [1.0] * 16)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    how = neighbours.Index(part_rows=400, block_rows=10)
    found = {}
    for r in neighbours.nearest_neighbours(frame, "id % 50 = 0", how=how).collect():
        found.setdefault(r.query_id, {})[r.rank] = r.id
    unit = data / np.linalg.norm(data, axis=1)[:, None]
    hits = 0
    for q in range(0, 1_500, 50):
        score = (unit @ unit[q]).round(12)
        score[q] = -9
        hits += len(set(np.lexsort((np.arange(1_500), -score))[:5].tolist()) & set(found[q].values()))
    assert hits / 150 >= 0.9 and set(found) == set(range(0, 1_500, 50))
    assert [found[150][k] for k in range(1, 6)] == [100, 101, 102, 103, 104]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[:3] for r in neighbours.nearest_neighbours(few, "id % 50 = 0").collect()] == [(0, 1, 1)]
    assert neighbours.nearest_neighbours(few.limit(0), "id % 50 = 0").count() == 0
    far = spark.createDataFrame([(0, [1e-200, 0.0]), (1, [1e200, 1e200]), (2, [0.0, 5e-324]), (3, [-2.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.id, round(r.score, 9)) for r in neighbours.nearest_neighbours(far, "id % 50 = 0").collect()] == [(1, 0.707106781), (2, 0.0), (3, -1.0)]
    assert np.array_equal(neighbours.cosines(data, neighbours._lengths(data), data[3], neighbours._lengths(data[3:4])[0]), neighbours.cosines(
        *(v := neighbours.scaled(data), neighbours._lengths(v)), v[3], neighbours._lengths(v[3:4])[0]))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
def test_pipeline_keeps_what_its_stages_keep(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = quality.judge_quality(docs).where("kept").select(*docs.columns)
    clean = [(r.doc_id, r.text) for r in lines.drop_boilerplate(good).collect()]
    label = classes([plain_fingerprint(t) for _, t in clean])
    least = {}
    for (i, t), c in zip(clean, label):
        least[c] = min(least.get(c, (i, t)), (i, t))
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in docs.collect()) == sorted(i for i, _ in least.values())
    texts = dict(least.values())
    for r in docs.collect():
        if not seeds(texts[r.doc_id]):
            assert r.text == texts[r.doc_id]
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in pieces} == set(texts) and all(0 <= r.ids_crc32 < 2**32 for r in pieces)


def test_pipeline_of_no_documents(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.collect() == [] and found.columns[0] == "doc_id"


# names and memory
MADE = "_fp _text _key _hash _chosen _nth _kept _page _drop _root _least _source _spans _others _added spans base_spans _curve _row _word_lang c0 c1".split()


@pytest.mark.parametrize("name", ["near_duplicates", "one_of_each", "redact_pii", "drop_boilerplate", "judge_quality"])
def test_columns_of_any_name_pass_through(spark, name):
    rows = [(i, f"line one {i // 2}\nmail a@b{i}.cc and words", "s", "en", *(f"{c}{i}" for c in MADE)) for i in range(6)]
    frame = spark.createDataFrame(rows, ["doc_id", "text", "source", "lang", *MADE])
    operator = {"near_duplicates": simhash.near_duplicates, "one_of_each": simhash.one_of_each, "redact_pii": pii.redact_pii,
                "drop_boilerplate": lines.drop_boilerplate, "judge_quality": quality.judge_quality}[name]
    # the result columns spans and base_spans are made by find_pii alone
    found = {r.doc_id: r for r in operator(frame).collect()}
    assert found and all(found[i][c] == f"{c}{i}" for i in found for c in MADE)


def test_caches_are_bounded_by_bytes(monkeypatch):
    from fleetgauge.llm import common, packing

    memo = common.Memo(lambda key: key * 2, most_bytes=20_000)
    for i in range(2_000):
        assert memo[f"key {i} " + "x" * (i % 400)] == (f"key {i} " + "x" * (i % 400)) * 2
        assert memo.held <= 20_000 and all(len(k) <= common.LONG for k in memo)
    pick = random.Random(8)
    texts = ["".join(chr(pick.randint(0x4E00, 0x9FFF)) for _ in range(1_500)) for _ in range(300)]
    texts += [" ".join(pick.choice("abcdefgh") * pick.randint(1, 300) + str(pick.randint(0, 9)) for _ in range(200)) for _ in range(50)]
    path = queries.vocabulary("byte_bpe_multi_50k.tiktoken")
    coder, small = bpe.ByteBpe(path, queries.split_pattern()), bpe.ByteBpe(path, queries.split_pattern())
    small.memo.most_bytes = 100_000
    word_path = queries.vocabulary("word_bpe_49k.json")
    words, few = packing.Words(word_path), packing.Words(word_path)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(word_path)
    for at in range(0, len(texts), 25):
        part = texts[at : at + 25]
        assert coder.encode_all(part) == small.encode_all(part)
        data = [t.encode() for t in part]
        whole = words.encode_all(data)
        with monkeypatch.context() as patch:
            patch.setattr(packing, "CACHE_BYTES", 100_000)
            assert few.encode_all(data) == whole
        assert [np.frombuffer(w, "<u4").tolist() for w in whole] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        for cache in (coder.memo, small.memo, words.memo, few.memo, words.parts, few.parts):
            assert all(len(k) <= common.LONG for k in cache)
            # unspaced texts leave nothing; later the small caches hold one call's words at most
            held = sum(len(k) + len(v) for k, v in cache.items())
            assert held < 200_000 if at < 300 else cache in (coder.memo, words.memo, words.parts) or held < 3 * sum(map(len, data))
