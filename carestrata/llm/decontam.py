"""Benchmark decontamination by spaced seeds.

A window is 13 words; a document leaks if one of its windows equals a benchmark window in at least 11 places. The 13
places are cut into four blocks. Two substitutions touch at most two blocks, so two others are untouched: with one
mask for each pair of blocks (the other places are ignored) every such window pair has an equal hash under some mask.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.llm.common import stage, words_of

WINDOW = 13
MIN_EQUAL = 11
BLOCKS = (range(0, 4), range(4, 7), range(7, 10), range(10, 13))
MASKS = [tuple(a) + tuple(b) for a, b in itertools.combinations(BLOCKS, 2)]
#: a benchmark item with fewer words is never looked for; one below the window is looked for whole and unchanged
MIN_ITEM_WORDS = 5
#: the filter that spares most document windows the join has at most so many bits; a fuller one only spares fewer
MAX_FILTER_BITS = 1 << 27
#: words a task remembers with their hashes before it starts anew
REMEMBERED_WORDS = 300_000
#: up to so many benchmark hashes are broadcast for the join
BROADCAST_HASHES = 400_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    import xxhash

    out = [known.get(w) for w in words]
    if None in out:
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        for i, w in enumerate(words):
            if out[i] is None:
                out[i] = known[w] = xxhash.xxh64_intdigest(w)
    return np.array(out, dtype=np.uint64)


def masked_hashes(hashes: np.ndarray, width: int) -> list[np.ndarray]:
    """Under each mask the hash of every window of ``width`` words, ignored places left out.

    Words are weighted by their place and summed by block; a mask is the sum of its two blocks.
    """
    n = max(len(hashes) - width + 1, 0)
    sums = []
    for block in BLOCKS if width == WINDOW else (range(width),):
        total = np.full(n, np.uint64((block[0] + 1) * width * 1_000_003), dtype=np.uint64)
        for p in block:
            total += hashes[p : p + n] * np.uint64((0x9E3779B97F4A7C15 * (2 * p + 1)) % 2**64 | 1)
        sums.append(total)
    return [_mix(a + b) for a, b in itertools.combinations(sums, 2)] if width == WINDOW else [_mix(sums[0])]


def _bits(keys: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    return keys & np.uint64(n_bits - 1), (keys >> np.uint64(32)) & np.uint64(n_bits - 1)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``(key, words, item_id)``: each distinct benchmark window under each mask, with the smallest item that has it."""

    def run(batches):
        known: dict[bytes, int] = {}
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = word_hashes(words_of(text), known)
                width = min(WINDOW, len(hashes))
                if width < MIN_ITEM_WORDS:
                    continue
                keys = np.stack(masked_hashes(hashes, width), axis=1).astype(np.int64)
                for i, row in enumerate(keys):
                    rows.append((item, hashes[i : i + width].astype(np.int64).tolist(), row.tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                    ["item_id", "words", "keys"],
                )

    chosen = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    windows = chosen.mapInArrow(run, "item_id long, words array<long>, keys array<long>")
    distinct = windows.groupBy("words").agg(F.min("item_id").alias("item_id"), F.first("keys").alias("keys"))
    return distinct.select(F.explode("keys").alias("key"), "words", "item_id")


def key_filter(spark: SparkSession, windows: DataFrame, n_keys: int) -> np.ndarray:
    """A Bloom filter of the benchmark hashes: two bits a hash, its size bounded by ``MAX_FILTER_BITS``."""
    n_bits = 1 << 16
    while n_bits < min(1024 * n_keys, MAX_FILTER_BITS):
        n_bits *= 2
    low = F.col("key").bitwiseAND(F.lit(n_bits - 1))
    high = F.expr("shiftrightunsigned(key, 32)").bitwiseAND(F.lit(n_bits - 1))
    bits = windows.select(F.explode(F.array(low, high)).alias("bit"))
    filled = bits.groupBy(F.expr("bit div 32").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("mask")
    )
    out = np.zeros(n_bits // 32, dtype=np.uint32)
    rows = filled.select(F.col("word").cast("long").alias("word"), "mask").toArrow()  # at most n_bits / 32 rows
    out[rows["word"].to_numpy()] = rows["mask"].to_numpy().astype(np.uint32)
    return out


def document_hits(docs: DataFrame, bloom: np.ndarray, widths: list[int]) -> DataFrame:
    """``(doc_id, words, keys)`` of every document window that the filter lets through under some mask."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        known: dict[bytes, int] = {}
        table = shared.value
        n_bits = len(table) * 32

        def there(bit: np.ndarray) -> np.ndarray:
            return (table[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = []
                split = [words_of(text) for text in part.column(1).to_pylist()]
                hashes = word_hashes([w for words in split for w in words], known)
                lengths = np.array([len(words) for words in split], dtype=np.int64)
                owner = np.repeat(np.arange(len(split)), lengths)
                left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(hashes))  # words to the text's end
                ids = part.column(0).to_pylist()
                for width in widths:
                    keys = masked_hashes(hashes, width)
                    inside = left[: len(keys[0])] >= width
                    hit = np.stack([there(a) & there(b) for a, b in (_bits(k, n_bits) for k in keys)]) & inside
                    for i in np.flatnonzero(hit.any(axis=0)).tolist():
                        met = [int(k[i].astype(np.int64)) for k, h in zip(keys, hit) if h[i]]
                        rows.append((ids[owner[i]], hashes[i : i + width].astype(np.int64).tolist(), met))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                        ["doc_id", "words", "keys"],
                    )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, words array<long>, keys array<long>")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, n_windows, item_id)`` of the documents that hold benchmark windows.

    ``n_windows`` counts the distinct windows, ``item_id`` is the smallest item one of them belongs to. Words are
    compared with A-Z lower-cased. Null and short texts on either side have no window; an item below the window but of
    at least ``MIN_ITEM_WORDS`` words is looked for whole. Rows with one doc_id (null included) are judged together;
    other columns are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    windows = stage(benchmark_windows(benchmark), "leak-windows")
    n_keys = windows.count()
    widths = sorted(r[0] for r in windows.select(F.size("words")).distinct().collect())  # at most nine widths
    hits = stage(document_hits(docs, key_filter(spark, windows, n_keys), widths), "leak-hits")
    wanted = windows.select("key", F.col("words").alias("other"), "item_id")
    seeds = hits.groupBy("words").agg(F.first("keys").alias("keys")).select("words", F.explode("keys").alias("key"))
    equal = F.aggregate(F.zip_with("words", "other", lambda a, b: (a == b).cast("int")), F.lit(0), lambda a, b: a + b)
    enough = F.when(F.size("words") == WINDOW, F.lit(MIN_EQUAL)).otherwise(F.size("words"))
    same = (F.size("words") == F.size("other")) & (equal >= enough)
    side = F.broadcast(wanted) if n_keys <= BROADCAST_HASHES else wanted
    verified = stage(seeds.join(side, "key").where(same).groupBy("words").agg(F.min("item_id").alias("item_id")), "leak-verified")
    found = hits.select("doc_id", "words").join(verified, "words")
    return found.groupBy("doc_id").agg(F.countDistinct("words").alias("n_windows"), F.min("item_id").alias("item_id"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, contaminated, n_windows, item_id)`` for every row of ``docs``, as ``leaks`` tells."""
    found = stage(leaks(docs, benchmark), "leaks").withColumnRenamed("doc_id", "leak_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("leak_id")), "left")
    return joined.select(
        "doc_id", F.col("n_windows").isNotNull().alias("contaminated"),
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"), "item_id",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id holds no benchmark window."""
    found = stage(leaks(docs, benchmark).select(F.col("doc_id").alias("leak_id")), "leaks")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["leak_id"]), "left_anti")
