"""Quality rule: distribution divergence of a document from its language's references, with column expressions only."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.common import ASCII_SPACE, stage

#: fixed values: frequent function words of the languages the histogram looks at
COMMON_WORDS = sorted(
    set(
        "the of and to in is that it for was with as "
        "le la les de des et un une est que dans pour "
        "der die und das ist nicht mit ein den von zu sich "
        "el los las y en por con para una del se que".split()
    )
)
#: character classes, as bodies of a Java character class; what none of them holds is the last class
CHAR_CLASSES = {
    "upper": "A-Z",
    "digit": "0-9",
    "space": ASCII_SPACE,
    "mark": r"!-/:-@\[-`{-~",
    "wide": r"^\x00-\x7F",
}
MIN_CHARS = 200
MIN_COMMON = 20
MAX_CHAR_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.65
#: references are one row per language; up to so many rows are broadcast
BROADCAST_LANGUAGES = 10_000


def _count_of(text: Column, body: str) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{body}]+", ""))).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""
    starts = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    hashed = F.transform(
        starts,
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )
    return F.sort_array(hashed)


def _covered(sorted_windows: Column) -> Column:
    def twice(x, k):
        before = F.get(sorted_windows, k - 1)["h"]
        after = F.get(sorted_windows, k + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

    return F.sort_array(F.transform(F.filter(sorted_windows, twice), lambda x: x["i"]))


def _length_of(starts: Column) -> Column:
    """Size of the union of three-word stretches at ascending ``starts``."""
    steps = F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3))).cast("long"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)


def document_features(docs: DataFrame) -> DataFrame:
    """Base counts and both histograms of every row, in one pass over the text."""
    first = docs.select(
        F.col("doc_id"), F.coalesce("lang", F.lit("")).alias("language"), F.coalesce("text", F.lit("")).alias("t")
    )
    split = first.select("*", F.array_remove(F.split("t", f"[{ASCII_SPACE}]+"), "").alias("w"))
    windows = split.select("*", _repeat_words(F.col("w")).alias("win"))
    covered = windows.select("*", _covered(F.col("win")).alias("cov"))
    filled = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    common = F.filter("w", lambda x: F.lower(x).isin(COMMON_WORDS))
    counted = covered.select(
        "*",
        filled.alias("lines"),
        F.concat(F.lit(" "), F.lower(F.array_join(common, "  ")), F.lit(" ")).alias("c"),
        *[_count_of(F.col("t"), body).alias(name) for name, body in CHAR_CLASSES.items()],
    )
    n_chars = F.char_length("t").cast("long")
    others = n_chars - functools.reduce(operator.add, [F.col(n) for n in CHAR_CLASSES])
    times = [
        F.floor((F.char_length("c") - F.char_length(F.replace(F.col("c"), F.lit(f" {w} "), F.lit("")))) / (len(w) + 2))
        for w in COMMON_WORDS
    ]
    return counted.select(
        "doc_id",
        "language",
        n_chars.alias("n_chars"),
        F.size("w").cast("long").alias("n_words"),
        (n_chars - F.col("space")).alias("word_chars"),
        _count_of(F.col("t"), "#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _length_of(F.col("cov")).alias("n_repeat_words"),
        F.array(*[F.col(n) for n in CHAR_CLASSES], others).alias("classes"),
        F.array(*[x.cast("long") for x in times]).alias("common"),
    )


def language_references(features: DataFrame) -> DataFrame:
    """Histogram sums over all documents of each language; the row of language '' sums every document."""
    sums = lambda name, n: F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(n)]).alias(f"ref_{name}")
    by_language = features.groupBy("language").agg(sums("classes", len(CHAR_CLASSES) + 1), sums("common", len(COMMON_WORDS)))
    again = lambda name, n: F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(n)]).alias(name)
    everything = by_language.groupBy().agg(
        again("ref_classes", len(CHAR_CLASSES) + 1), again("ref_common", len(COMMON_WORDS))
    )
    return by_language.where("language <> ''").unionByName(everything.select(F.lit("").alias("language"), "*"))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)


def jensen_shannon(counts: Column, reference: Column, n: Column, m: Column) -> Column:
    """Jensen-Shannon distance (root of the divergence in bits) of two histograms; null if one is empty.

    ``n`` and ``m`` are their totals, as columns of the row: a formula here would be worked out again for each class.
    """

    def term(x, y):
        p, q = x / n, y / m
        part = lambda a: F.when(a > 0, a * F.log2(2 * a / (p + q))).otherwise(0.0)
        return part(p) + part(q)

    added = F.aggregate(F.zip_with(counts, reference, term), F.lit(0.0), lambda a, b: a + b)
    return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(added / 2, F.lit(0.0))))


def quality_verdicts(
    docs: DataFrame,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    min_chars: int = MIN_CHARS,
    min_common: int = MIN_COMMON,
) -> DataFrame:
    """Base counts and the divergence verdict for every row of ``docs (doc_id, text, lang, ...)``.

    A document is compared with the histograms of all documents of its ``lang`` (of all languages where that is null
    or empty). It is not kept if it has at least ``min_chars`` code points and its character classes are further than
    ``max_char_distance``, or at least ``min_common`` common words and those are further than ``max_word_distance``,
    or if the base rules fail. Null texts count as empty (they fail the base rules). Rows are judged one by one, so
    repeated rows and null ids stay as they are; other columns are ignored; an empty table gives an empty result.
    """
    features = stage(document_features(docs), "quality-features")
    references = stage(language_references(features), "quality-references")
    side = F.broadcast(references) if references.count() <= BROADCAST_LANGUAGES else references
    joined = features.join(side, "language", "left")
    histograms = ("classes", "ref_classes", "common", "ref_common")
    joined = joined.select("*", *[_total(F.col(h)).alias(f"n_{h}") for h in histograms])
    measured = joined.select(
        "*",
        jensen_shannon(*[F.col(h) for h in ("classes", "ref_classes", "n_classes", "n_ref_classes")]).alias("char_distance"),
        jensen_shannon(*[F.col(h) for h in ("common", "ref_common", "n_common", "n_ref_common")]).alias("word_distance"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )
    far = ((F.col("n_chars") >= min_chars) & (F.coalesce("char_distance", F.lit(0.0)) > max_char_distance)) | (
        (F.col("n_common") >= min_common) & (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)
    )
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance", "n_common", "n_chars",
    )
