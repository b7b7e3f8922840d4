"""Personal data: fixed patterns, and contextual extraction bootstrapped from what they find.

What the fixed patterns find are seeds. The words before a value are a lexical pattern; patterns and the values that
follow them, seeds and other values of the shape of a kind, form a bipartite graph. In each round the patterns that
enough believed values support are taken up, a pattern's confidence in a kind is the share of believed values of that
kind among all values after it, and a value is believed as far as its confident patterns are (seeds fully). Values
believed in one round support further patterns in the next. Values after confident patterns are identifiers that the
fixed patterns missed.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.common import stage

KINDS = ("email", "ip", "card", "phone")
#: a pattern needs so many different believed values ...
MIN_SEEDS = 3
#: ... and so much confidence
MIN_CONFIDENCE = 0.6
ROUNDS = 4

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only begin where a run of digits begins
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
#: shapes of what the fixed patterns do not take: addresses written around, and digits with separators
_AROUND = re.compile(r"@|\(at\)|\[at\]")
_PART = re.compile(r"[^\s@,;<>]+")
_STOPS = frozenset("@,;<>")
_DIGITS = re.compile(r"[(+]?[0-9](?:[ ().\-/]{0,2}[0-9])++")
MIN_DIGITS, MAX_DIGITS = 7, 19


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses; looks left from each ``@``, so long runs without one cost nothing."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return out


def _short_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind and start, in code points."""
    out = [(0, a, b) for a, b in emails(text)]
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if all(map(_short_number, m[0].split("."))):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((3, *m.span()))
    return out


def plain_word(word: str) -> str:
    return word.strip("\"'.,;:!?()[]{}<>*#$%&|-=") or word


def pattern_keys(words: list[str]) -> list[int]:
    """Keys of the last word and of the last two words of ``words``, without their outer punctuation."""
    import xxhash

    plain = [plain_word(w) for w in words[-2:]]
    said = plain[-1:] + [" ".join(plain)] * (len(plain) == 2)
    return [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 1) - (1 << 63) for w in said]


def contexts(text: str, starts: list[int]) -> dict[int, list[int]]:
    """The pattern keys before each of ``starts``. A word ends where a value starts, so that a label may be glued to it.

    Every character is looked at once.
    """
    out, words, before = {}, [], 0
    for start in sorted(set(starts)):
        words = (words + text[before:start].lower().split())[-2:]
        out[start], before = pattern_keys(words), start
    return out


def around_shapes(text: str) -> list[tuple[int, int]]:
    """Addresses that may be written around their ``@``; looks left and right from each mark, over no character twice."""
    out, free = [], 0
    for mark in _AROUND.finditer(text):
        start = mark.start()
        while start > free and not text[start - 1].isspace() and text[start - 1] not in _STOPS:
            start -= 1
        domain = _PART.match(text, mark.end()) if start < mark.start() else None
        if domain:
            out.append((start, domain.end()))
        free = max(free, domain.end() if domain else mark.end())
    return out


def unseen(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Values of the shape of a kind that overlap no base span and each other neither, by start."""
    found = [(a, b, 0) for a, b in around_shapes(text)]
    for m in _DIGITS.finditer(text):
        digits = len(_NOT_DIGIT.sub("", m[0]))
        if MIN_DIGITS <= digits <= MAX_DIGITS:  # a longer run is no value, and is not cut into some
            found.append((*m.span(), 2 if digits >= 16 else 1 if m[0].count(".") == 3 else 3))
    out, spans, i, reach, free = [], sorted((a, b) for _, a, b in taken), 0, 0, 0
    for a, b, kind in sorted(found):
        while i < len(spans) and spans[i][0] < b:
            reach, i = max(reach, spans[i][1]), i + 1
        if a >= reach and a >= free:
            out.append((kind, a, b))
            free = b
    return out


def value_key(kind: int, value: str) -> str:
    """One spelling of a value: digits alone for numbers, lower case and a plain ``@`` for addresses."""
    return _AROUND.sub("@", value.lower()) if kind == 0 else _NOT_DIGIT.sub("", value)


_VALUE = "kind: int, start: long, end: long, value: string, seed: boolean, patterns: array<long>"
_ROWS = f"doc_id long, base array<struct<kind: int, start: long, end: long>>, values array<struct<{_VALUE}>>"


def _value_type():
    span = [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
    return pa.list_(pa.struct(span)), pa.list_(pa.struct([*span, ("value", pa.string()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.int64()))]))


def extract(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: its base spans, and all values with the keys of the patterns before them."""

    def run(batches):
        base_type, values_type = _value_type()
        for batch in batches:
            ids, all_base, all_values = batch.column(0), [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                found = [(s, True) for s in base] + [(s, False) for s in unseen(text, base)]
                before = contexts(text, [a for (_, a, _), _ in found])
                all_base.append([dict(zip(("kind", "start", "end"), s)) for s in base])
                all_values.append(
                    [
                        {"kind": k, "start": a, "end": b, "value": value_key(k, text[a:b]), "seed": seed, "patterns": before[a]}
                        for (k, a, b), seed in found
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(all_base, base_type), pa.array(all_values, values_type)], ["doc_id", "base", "values"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ROWS)


def confident_patterns(
    rows: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, rounds: int = ROUNDS
) -> DataFrame:
    """``(pattern, kind, confidence)`` of the patterns to trust, from the graph of patterns and values in ``rows``.

    Values and patterns are counted before they are joined, so that a pattern or a value with a large share of all
    occurrences is one row of the graph. What the seeds contribute does not change from round to round and is added up
    once; only the edges of other values are walked again.
    """
    values = rows.select(F.explode("values").alias("v")).select("v.kind", "v.value", "v.seed", F.explode("v.patterns").alias("pattern"))
    edges = stage(values.groupBy("pattern", "kind", "value").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "pii-edges")
    seeds = edges.where("seed").select("kind", "value").distinct().withColumn("known", F.lit(True))
    known = edges.join(seeds, ["kind", "value"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    known = stage(known, "pii-known")  # a value that is a seed anywhere is believed everywhere
    sums = known.groupBy("pattern", "kind").agg(
        F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("sure"), F.count_if("known").alias("seeds")
    )
    after = known.groupBy("pattern").agg(F.sum("n").alias("total"))
    fixed = stage(sums.join(after, "pattern"), "pii-patterns")
    unsure = known.where("NOT known").select("pattern", "kind", "value", "n")
    belief = stage(unsure.select("kind", "value").distinct().withColumn("score", F.lit(0.0)), "pii-belief")
    trusted = None
    for _ in range(rounds):
        scored = unsure.join(belief, ["kind", "value"])
        added = scored.groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("more"), F.count_if(F.col("score") >= min_confidence).alias("others")
        )
        # one unbelieved value more keeps a pattern that was met a few times from being sure
        share = (F.col("sure") + F.coalesce("more", F.lit(0.0))) / (F.col("total") + 1)
        support = F.col("seeds") + F.coalesce("others", F.lit(0))
        trusted = fixed.join(added, ["pattern", "kind"], "left").where((support >= min_seeds) & (share >= min_confidence))
        trusted = stage(trusted.select("pattern", "kind", share.alias("confidence")), "pii-confidence")
        doubt = unsure.join(trusted, ["pattern", "kind"]).groupBy("kind", "value").agg(F.sum(F.log1p(-F.col("confidence"))).alias("doubt"))
        believed = belief.select("kind", "value").join(doubt, ["kind", "value"], "left")
        belief = stage(believed.select("kind", "value", F.coalesce(1 - F.exp("doubt"), F.lit(0.0)).alias("score")), "pii-belief")
    return trusted


def find_personal_data(docs: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``(doc_id, base, found)`` for every row of ``docs (doc_id, text, ...)``: spans as ``(kind, start, end)``.

    ``base`` holds the spans of the fixed patterns, ``found`` what trusted patterns add; neither overlaps the other.
    ``kind`` counts ``KINDS``; offsets are code points, the end is exclusive. Null texts count as empty. Rows are kept
    apart even where a doc_id is null or repeated; other columns are ignored; an empty table gives an empty result.
    """
    rows = stage(extract(docs).withColumn("row", F.monotonically_increasing_id()), "pii-rows")
    trusted = confident_patterns(rows, min_seeds, min_confidence)
    values = rows.select("row", F.explode("values").alias("v")).where("NOT v.seed")
    hits = values.select("row", "v.kind", "v.start", "v.end", F.explode("v.patterns").alias("pattern")).join(trusted, ["pattern", "kind"])
    per_row = hits.groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("found"))
    none = F.array().cast("array<struct<kind: int, start: bigint, end: bigint>>")
    return rows.select("row", "doc_id", "base").join(per_row, "row", "left").select(
        "doc_id", "base", F.array_sort(F.coalesce("found", none)).alias("found")
    )


def span_digests(found: DataFrame) -> DataFrame:
    """Counts of the base spans, their digest, and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def text(spans):
        each = F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.array_join(each, ",")

    counts = [F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.concat("base", "found")).alias("spans")
    )


def _of_kind(kind: int):
    return lambda span: span["kind"] == kind
