"""One query for each operator, over its whole table, and the SQL twins of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetgauge.llm import bpe, html_text, lexical, lines, neighbours, packing, periodic, pii, quality, simhash, substring, urls, warc
from fleetgauge.llm.common import table
from fleetgauge.session import removed_at_exit, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

SHINGLE, MAX_BITS = 3, 3
RULES = (
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
)


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents"), carry=["doc_id"])
    counts = [F.expr(f"cast(size(filter(base_spans, s -> s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.expr(f"sha2({pii.joined_spans('base_spans')}, 256)").alias("base_sha256"),
        F.expr(pii.joined_spans("spans")).alias("spans"),
    )


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), SHINGLE, MAX_BITS, carry=["doc_id"])
    return found.select("doc_id", "fingerprint", "component_id")


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    return bpe.bpe_round_trip(table(spark, folder, "documents"), path, split_pattern())


def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    found = html_text.extract_text(pages, html_text.train_labeller(pages), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_substring(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.substring_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, folder, "documents").select("doc_id", "text", "lang"), carry=["doc_id"])
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept")


def op7_lines(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.drop_boilerplate(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "source", "n_dropped_lines", F.sha2("text", 256).alias("text_sha256"))


def op8_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    model = urls.train(urls.labelled_by_rules(pages, RULES))
    return urls.filter_urls(pages, RULES, model).select("page_id", "host", "path", "rule", "verdict")


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    found = neighbours.nearest_neighbours(table(spark, folder, "embeddings"), "id % 50 = 0")
    return found.withColumnRenamed("id", "vec_id")


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_search(table(spark, folder, "benchmark"), table(spark, folder, "documents"))


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages, place = table(spark, folder, "pages"), f"{shared_folder(spark)}/llm/warc-{uuid.uuid4().hex}"
    removed_at_exit(spark, place)
    index = warc.write_archives(pages, place)
    found = warc.read_records(index, pages.schema["page_id"].dataType.simpleString(), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by a checksum of their id, go on with their last part repeated."""
    words = "regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)"
    chosen = docs.selectExpr("doc_id", "text", "crc32(cast(cast(doc_id AS string) AS binary)) AS h").selectExpr(
        "doc_id", "text", f"CASE WHEN h % 10 = 0 THEN {words} END AS words", "h div 10 AS g"
    )
    placed = chosen.selectExpr("*", "if(size(words) > 0, size(words), NULL) AS n").selectExpr("*", "cast(g % n AS int) AS a")
    placed = placed.selectExpr("*", "cast(1 + (n - a) div (3 + g % 8) AS int) AS p")
    tail = "slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) AS int))), 1, n - a)"
    return placed.selectExpr("doc_id", f"if(n IS NULL, text, concat_ws(' ', slice(words, 1, a), {tail})) AS text")


def op13_periodic(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(with_planted_periods(table(spark, folder, "documents").select("doc_id", "text")))
    longest = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))"
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.selectExpr("*", f"{longest} AS best", f"{listed} AS listed").selectExpr(
        "doc_id", "cast(size(runs) AS long) AS n_runs", "-best.start AS start", "best.length AS length", "-best.period AS period",
        "1000 * best.length div -best.period AS exponent_milli", "sha2(listed, 256) AS runs_sha256", "sha2(collapsed, 256) AS collapsed_sha256",
    )


LLM_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_pii, op2_simhash, op3_bpe, op4_html, op5_substring, op6_quality, op7_lines, op8_urls, op9_neighbours, op10_packing,
        op11_search, op12_warc, op13_periodic,
    )
}

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CLASSES = {
    "lower": "[^a-z]", "upper": "[^A-Z]", "digit": "[^0-9]", "space": r"[^\x20\x09-\x0D]",
    "stop": r"""[^.,;:!?''"()\-]""", "symbol": "[^#*$%&|<>]", "two_byte": r"[^\x{80}-\x{7FF}]", "more_bytes": r"[\x{0}-\x{7FF}]",
}


def _sql_distance(ours: str, theirs: str) -> str:
    """Distance of the histogram rows (doc_id, lang, place, n) from (lang, place, n); places a document lacks add ln 2 times their share."""
    return f"""
        SELECT doc_id, sqrt(greatest(0.0, (sum(p * ln(2 * p / (p + q)) + if(q > 0, q * ln(2 * q / (p + q)), 0))
                 + ln(2) * greatest(0.0, 1 - sum(q))) / (2 * ln(2)))) AS d
        FROM (SELECT o.doc_id, o.n::DOUBLE / sum(o.n) OVER (PARTITION BY o.doc_id) AS p, coalesce(t.n::DOUBLE / t.total, 0) AS q
              FROM (SELECT * FROM {ours} WHERE n > 0) o
              JOIN (SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM {theirs}) t
                ON t.lang IS NOT DISTINCT FROM o.lang AND t.place = o.place AND t.total > 0)
        GROUP BY doc_id"""


LLM_ORACLE: dict[str, str] = {
    "op5_substring": f"""
        WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS s
                    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split WHERE len(words) >= 13)),
        firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos
                 FROM (SELECT w.doc_id, w.i FROM windows w JOIN firsts f ON w.s = f.s AND f.least < w.doc_id)),
        placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split),
        kept AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.pos) AS text, count(*) AS n
                 FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY p.doc_id)
        SELECT s.doc_id, len(s.words)::BIGINT AS n_words, (len(s.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
               sha256(coalesce(k.text, '')) AS kept_sha256
        FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id""",
    "op6_quality": f"""
        WITH split AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
        placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split),
        windows AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times
                    FROM (SELECT doc_id, pos, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c FROM placed
                          WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE c IS NOT NULL),
        repeats AS (SELECT doc_id, count(DISTINCT pos) AS n
                    FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM windows WHERE times > 1) GROUP BY doc_id),
        lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n
                  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
                  WHERE regexp_matches(line, {_WORD}) GROUP BY doc_id),
        base AS (SELECT s.doc_id, s.lang, s.text, len(s.words)::BIGINT AS n_words,
                   length(regexp_replace(s.text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
                   length(regexp_replace(s.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
                 FROM split s LEFT JOIN lines l ON s.doc_id = l.doc_id LEFT JOIN repeats r ON s.doc_id = r.doc_id),
        judged AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM base),
        profile AS (SELECT doc_id, lang, text, [{', '.join(f"length(regexp_replace(text, '{p}', '', 'g'))" for p in _CLASSES.values())}] AS c FROM judged),
        classes AS (SELECT doc_id, lang, unnest(list_append(c, length(text) - list_sum(c))) AS n, unnest(range(0, {len(_CLASSES) + 1})) AS place FROM profile),
        bare AS (SELECT p.doc_id, s.lang, trim({_LOWER.format('word')}, '.,;:!?') AS word FROM placed p JOIN split s ON p.doc_id = s.doc_id),
        common AS (SELECT lang, word FROM bare WHERE word <> '' GROUP BY lang, word
                   QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) <= {quality.LEARNED.learned_words}),
        words AS (SELECT b.doc_id, b.lang, coalesce(c.word, '') AS place, count(*) AS n
                  FROM bare b LEFT JOIN common c ON b.lang IS NOT DISTINCT FROM c.lang AND b.word = c.word GROUP BY ALL),
        good AS (SELECT doc_id FROM judged WHERE NOT base_failed),
        class_reference AS (SELECT lang, place, sum(n) AS n FROM classes SEMI JOIN good USING (doc_id) GROUP BY lang, place),
        places AS (SELECT DISTINCT lang, place FROM words),
        word_reference AS (SELECT p.lang, p.place, coalesce(sum(w.n), 0) AS n
                           FROM places p LEFT JOIN (SELECT * FROM words SEMI JOIN good USING (doc_id)) w
                             ON w.lang IS NOT DISTINCT FROM p.lang AND w.place = p.place GROUP BY p.lang, p.place),
        char_distance AS ({_sql_distance('classes', 'class_reference')}),
        word_distance AS ({_sql_distance('words', 'word_reference')}),
        -- a text without any frequent word has this distance, all of it in the share q of the other words
        most AS (SELECT lang, sqrt(greatest(0.0, (ln(2 / (1 + q)) + if(q > 0, q * ln(2 * q / (1 + q)), 0) + ln(2) * (1 - q)) / (2 * ln(2)))) AS most
                 FROM (SELECT lang, coalesce(sum(n) FILTER (place = ''), 0)::DOUBLE / sum(n) AS q FROM word_reference GROUP BY lang HAVING sum(n) > 0))
        SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               (NOT base_failed AND (n_words < {quality.LEARNED.min_words} OR (coalesce(c.d, 0) <= {quality.LEARNED.max_char_distance}
                AND coalesce(w.d <= {quality.LEARNED.max_word_share}::DOUBLE * m.most, true)))) AS kept
        FROM judged j LEFT JOIN char_distance c ON j.doc_id = c.doc_id LEFT JOIN word_distance w ON j.doc_id = w.doc_id
        LEFT JOIN most m ON j.lang IS NOT DISTINCT FROM m.lang""",
    "op11_search": rf"""
        WITH words AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format('text')}, '{lexical.TERM}')) AS term FROM documents),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
        totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
        asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format('text')}, '{lexical.TERM}')) AS term FROM benchmark),
        found AS (SELECT c.* FROM counts c SEMI JOIN asked a ON c.term = a.term),
        weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
                    FROM (SELECT term, count(*) AS df FROM found GROUP BY term), totals),
        impacts AS (SELECT f.doc_id, f.term, (1000000000 * f.tf) // (1000 * f.tf + 20 * (50 + (50 * s.n * t.docs) // t.terms)) AS impact
                    FROM found f JOIN sizes s ON f.doc_id = s.doc_id, totals t),
        scores AS (SELECT a.item_id, i.doc_id, sum(w.w * i.impact)::BIGINT AS score
                   FROM asked a JOIN weights w ON a.term = w.term JOIN impacts i ON a.term = i.term GROUP BY a.item_id, i.doc_id)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
        WHERE rank <= 50""",
    "op12_warc": """
        WITH payloads AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
        kept AS (SELECT hex, max(page_id) AS page_id FROM payloads GROUP BY hex),
        digits AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(hex, 10 * k + 1, 10))::BIGINT >> (35 - 5 * j) & 31)::INTEGER + 1, 1),
                                          '' ORDER BY k, j) AS digest
                   FROM kept, range(0, 4) a(k), range(0, 8) b(j) GROUP BY hex)
        SELECT p.page_id, payload_bytes, digest AS payload_digest, if(k.page_id = p.page_id, 'response', 'revisit') AS record_type,
               if(k.page_id = p.page_id, NULL, k.page_id) AS refers_to
        FROM payloads p JOIN kept k ON p.hex = k.hex JOIN digits d ON p.hex = d.hex""",
    "op7_lines": f"""
        WITH pages AS (SELECT DISTINCT source, text FROM documents),
        lines AS (SELECT DISTINCT source, text, trim(line, ' ' || chr(9) || chr(13)) AS line
                  FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM pages)
                  WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
        totals AS (SELECT source, count(*) AS n FROM pages GROUP BY source),
        boilerplate AS (SELECT l.source, l.line FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
                        GROUP BY l.source, l.line, t.n HAVING count(*) >= {lines.MIN_PAGES} AND count(*) > {lines.MAX_RATIO} * t.n),
        all_lines AS (SELECT source, text, unnest(string_split(text, chr(10))) AS line,
                             unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM pages),
        marked AS (SELECT a.*, b.line IS NOT NULL AS gone, trim(a.line, ' ' || chr(9) || chr(13)) <> '' AS full_line
                   FROM all_lines a LEFT JOIN boilerplate b
                     ON a.source IS NOT DISTINCT FROM b.source AND trim(a.line, ' ' || chr(9) || chr(13)) = b.line),
        cut AS (SELECT source, text, count(*) FILTER (gone) AS n,
                       string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept
                FROM marked GROUP BY source, text HAVING bool_or(gone) AND bool_or(full_line AND NOT gone))
        SELECT d.doc_id, d.source, coalesce(c.n, 0)::BIGINT AS n_dropped_lines, sha256(coalesce(c.kept, d.text)) AS text_sha256
        FROM documents d LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source AND d.text = c.text""",
}
