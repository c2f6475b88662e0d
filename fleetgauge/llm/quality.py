"""Quality rules: divergence of a document's character and word profile from its language.

A pass counts, for every whole text, the base figures and two histograms: classes of characters, and common function
words beside all other words. The reference of a language is the sum of the histograms of all its documents that pass the
base rules. A document is rejected if it fails the base rules, or if it is long enough to judge and the Jensen-Shannon
distance (base 2, 0 to 1) of either histogram from its language's reference exceeds a threshold.

The words of a language are its most frequent ones, counted over all its documents, and the threshold of the word distance is a
share of the greatest distance that the language's reference allows, that of a text with none of its words: so the rule can reject
in any language. `DEFAULT` takes fixed words of four languages and a fixed threshold instead, as the SQL twin of op6_quality does; it
cannot reject for lack of words in other languages.

Null text counts as empty: no words, so the base rules reject it. A null language is a language of its own. Repeated
rows are judged each for itself. A document shorter than `min_words`, or one whose reference is empty, is judged by
the base rules alone. An empty table gives an empty table. Columns of any other name pass through untouched;
result columns and `_text` replace columns of the same name. The language must be carried.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

from pyspark.sql import DataFrame, Window, functions as F

from fleetgauge.llm.common import Memo, arrow_rows, plain_names, sliced, staged, utf8

# Frequent function words of four languages, for `DEFAULT`.
COMMON_WORDS = (
    "the of and to in is that for it as was on are by be with",
    "der die und das den von zu mit sich des auf ist im dem ein nicht",
    "de la que el en los se del las por un con una su para al",
    "le les et des une du est pour qui dans par sur pas au ne ce",
)
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other", "two_byte", "more_bytes")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityRules:
    """`max_char_distance` and `max_word_distance` reject above them, from `min_words` words on. With `learned_words`, so many
    words of each language are learned, and `max_word_share` of the greatest possible distance takes the place of `max_word_distance`."""

    min_words: int = 100
    max_char_distance: float = 0.30
    max_word_distance: float = 0.30
    common_words: tuple[str, ...] = tuple(dict.fromkeys(" ".join(COMMON_WORDS).split()))
    learned_words: int = 0
    max_word_share: float = 0.9

    @property
    def places(self) -> int:
        return self.learned_words or len(self.common_words)


DEFAULT = QualityRules()
LEARNED = QualityRules(learned_words=32)
COUNTED, COUNTED_BYTES = 200_000, 32 * 1024**2  # distinct words that a task counts before it passes them on


def class_of_bytes():
    """Class number of each byte value; bytes inside a character have none (-1)."""
    import numpy as np

    kinds = np.full(256, CLASSES.index("other"))
    kinds[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    kinds[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    kinds[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    kinds[[9, 10, 11, 12, 13, 32]] = CLASSES.index("space")
    kinds[[*b".,;:!?'\"()-"]] = CLASSES.index("stop")
    kinds[[*b"#*$%&|<>"]] = CLASSES.index("symbol")
    kinds[0x80:0xC0] = -1
    kinds[0xC0:0xE0] = CLASSES.index("two_byte")
    kinds[0xE0:] = CLASSES.index("more_bytes")
    return kinds


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    import numpy as np

    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], "int64")
    if len(number) == len(words):
        return 0
    pair = ids[:-1] * len(number) + ids[1:]
    pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(number) + ids[2:]
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= again
    return int(covered.sum())


def bare(words: list[bytes]) -> Iterator[bytes]:
    """Words in lower case without the stops around them."""
    return (w.lower().strip(b".,;:!?") for w in words)


def frequent_words(docs: DataFrame, n: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """(`_word_lang`, `_common`): the `n` most frequent words of each language over all documents; equal counts by the word."""
    kind = docs.schema[lang].dataType.simpleString()
    docs = docs.select(F.col(lang).alias("_word_lang"), F.col(text).alias("_text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts: dict[object, Counter] = {}

        def passed(of) -> Iterator:
            for key, own in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(own), of), pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.int64())],
                    names=["_word_lang", "_word", "_n"],
                )
            counts.clear()

        of = None
        for batch in sliced(batches):
            of = batch["_word_lang"].type
            for key, data in zip(batch["_word_lang"].to_pylist(), utf8(batch["_text"])):
                counts.setdefault(key, Counter()).update(filter(None, bare(data.split())))
            if sum(map(len, counts.values())) >= COUNTED or sum(len(w) for own in counts.values() for w in own) >= COUNTED_BYTES:
                yield from passed(of)
        yield from passed(of)

    found = docs.mapInArrow(run, f"_word_lang {kind}, _word binary, _n long").groupBy("_word_lang", "_word").agg(F.sum("_n").alias("_n"))
    place = F.row_number().over(Window.partitionBy("_word_lang").orderBy(F.desc("_n"), "_word"))
    found = found.withColumn("_place", place).where(f"_place <= {n}")
    return found.groupBy("_word_lang").agg(
        F.expr("transform(array_sort(collect_list(struct(_place, _word))), x -> x._word)").alias("_common")
    )


def profile(data: bytes, kinds, common: dict[bytes, int], places: int) -> tuple[list[int], list[int], list[int]]:
    """Base figures, character classes, common words (the last count is of all other words) of a text."""
    import numpy as np

    words = data.split()
    seen = np.bincount(np.frombuffer(data, "uint8"), minlength=256)
    classes = np.bincount(kinds[kinds >= 0], weights=seen[kinds >= 0], minlength=len(CLASSES)).astype("int64").tolist()
    lines = [line for line in data.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    histogram = [0] * (places + 1)
    for place in map(common.get, bare(words)):
        histogram[-1 if place is None else place] += 1
    return (
        [len(words), sum(classes) - classes[CLASSES.index("space")], classes[CLASSES.index("symbol")],
         len(lines) - len(set(lines)), repeated_words(words)],
        classes,
        histogram,
    )


def with_profiles(docs: DataFrame, carry: list[str], rules: QualityRules = DEFAULT, text: str = "text") -> DataFrame:
    """The columns `carry`, the base figures and the arrays `_classes` and `_words`. Learned words are in `_common`."""
    words, places = rules.common_words, rules.places
    learned = ["_common"] if rules.learned_words else []
    names = [*BASE, "_classes", "_words"]
    kept = [docs.schema[c] for c in carry]
    docs = docs.select(*carry, F.col(text).alias("_text"), *learned)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds, listed = class_of_bytes(), tuple(w.encode() for w in words)
        numbered = Memo(lambda common: {w: i for i, w in enumerate(common)}, 1_000)
        for batch in sliced(batches):
            own = (tuple(c or ()) for c in batch["_common"].to_pylist()) if learned else repeat(listed)
            found = [profile(data, kinds, numbered[common], places) for data, common in zip(utf8(batch["_text"]), own)]
            base = list(zip(*(f[0] for f in found))) or [[]] * len(BASE)
            yield pa.RecordBatch.from_arrays(
                [*(batch[f.name] for f in kept), *(pa.array(c, pa.int64()) for c in base),
                 pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found], pa.list_(pa.int64()))],
                names=[f.name for f in kept] + names,
            )

    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} long" for n in BASE])
    return docs.mapInArrow(run, f"{ddl}, _classes array<long>, _words array<long>")


def _distance(ours: str, theirs: str) -> str:
    """Jensen-Shannon distance of two count arrays as SQL; null where one of them is empty."""
    total = "aggregate({0}, 0D, (s, x) -> s + x)"
    term = "if(p > 0D, p * ln(2D * p / (p + q)), 0D) + if(q > 0D, q * ln(2D * q / (p + q)), 0D)"
    terms = f"zip_with(transform({ours}, x -> x / {total.format(ours)}), transform({theirs}, x -> x / {total.format(theirs)}), (p, q) -> {term})"
    return (
        f"if({total.format(ours)} > 0D AND {total.format(theirs)} > 0D, "
        f"sqrt(greatest(0D, aggregate({terms}, 0D, (s, x) -> s + x) / (2D * ln(2D)))), NULL)"
    )


BASE_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"


def language_references(profiles: DataFrame, rules: QualityRules = DEFAULT, lang: str = "lang") -> DataFrame:
    """(language, summed histograms, word distance of a text without common words) over all documents that pass the base rules."""
    sums = [f"sum(_classes[{i}])" for i in range(len(CLASSES))], [f"sum(_words[{i}])" for i in range(rules.places + 1)]
    found = profiles.where(f"NOT {BASE_FAILED}").groupBy(F.col(lang).alias("_ref_lang")).agg(
        F.expr(f"array({', '.join(sums[0])})").alias("_ref_classes"), F.expr(f"array({', '.join(sums[1])})").alias("_ref_words")
    )
    none = f"concat(array_repeat(0L, {rules.places}), array(1L))"
    return found.withColumn("_ref_most", F.expr(_distance(none, "_ref_words")))


def judge_quality(
    docs: DataFrame, rules: QualityRules = LEARNED, text: str = "text", lang: str = "lang", carry: list[str] | None = None
) -> DataFrame:
    """The columns `carry` (all by default) with the base figures, both distances, `base_failed` and `kept`."""
    made = [*BASE, "char_distance", "word_distance", "base_failed", "kept"]
    asked = [c for c in (carry or docs.columns) if c not in made]
    docs, names = plain_names(docs.select(*dict.fromkeys([*asked, lang, text])))
    lang, text, carry = names[lang], names[text], [names[c] for c in dict.fromkeys([*asked, lang])]
    word_rule = f"coalesce(word_distance, 0D) <= {rules.max_word_distance}D"
    if rules.learned_words:
        words = staged(frequent_words(docs, rules.learned_words, text, lang), 1000)
        # a small table again, so each text gets its language's words without moving
        docs = docs.join(words, F.col(lang).eqNullSafe(words["_word_lang"]), "left")
        word_rule = f"coalesce(word_distance <= {rules.max_word_share}D * _ref_most, true)"
    with arrow_rows(docs.sparkSession, 1000):
        narrow = with_profiles(docs, [lang], rules, text)
        references = staged(language_references(narrow, rules, lang))
    # a second pass costs less than a copy of all texts; the written reference is small and so is broadcast, and no text moves
    profiles = with_profiles(docs, carry, rules, text)
    joined = profiles.join(references, profiles[lang].eqNullSafe(references["_ref_lang"]), "left")
    return (
        joined.withColumn("char_distance", F.expr(_distance("_classes", "_ref_classes")))
        .withColumn("word_distance", F.expr(_distance("_words", "_ref_words")))
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn(
            "kept",
            F.expr(
                f"NOT base_failed AND (n_words < {rules.min_words} OR (coalesce(char_distance, 0D) <= {rules.max_char_distance}D "
                f"AND {word_rule}))"
            ),
        )
        .select(*[F.col(names[c]).alias(c) for c in asked], *made)
    )
