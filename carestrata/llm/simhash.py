"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments, one fewer than exact segment matching needs for two differing bits, so
that of any two linked fingerprints one segment differs in at most one bit. Every segment is indexed 32 times, each
time without one of its bits; linked fingerprints meet under at least one such key, are joined by equality and verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.common import stage, words_of
from carestrata.llm.components import connected_components

SEED = 42
#: keys with up to so many fingerprints are joined pair by pair; larger ones go through shared neighbours
PAIRED_KEY = 8


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bit of the shingles' XXH64, as a signed 64-bit integer; zero without a word."""
    import xxhash

    words = words_of(text)
    if not words:
        return 0
    runs = [words[i:] for i in range(min(shingle, len(words)))]
    shingles = list(map(b" ".join, zip(*runs))) if len(words) >= shingle else [b" ".join(words)]
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(shingles), 65536):
        part = shingles[start : start + 65536]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in part), dtype="<u8", count=len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(shingles), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of every row; a null text counts as empty."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            fps = [fingerprint(texts[i].as_py(), shingle) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, fp long")


def signatures(fps: DataFrame) -> DataFrame:
    """``(key, fp)``: 64 keys for each fingerprint; the key holds segment, left-out bit and the segment's other bits."""
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = fps.repartition(spread).select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("b"))
    segment = "shiftrightunsigned(fp, 32 * (b div 32)) & 4294967295L"
    return keys.select(
        F.expr(f"shiftleft(cast(b as bigint), 32) | (({segment}) & ~shiftleft(1L, cast(b % 32 as int)))").alias("key"), "fp"
    )


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges ``(u, v)`` whose connectivity equals that of all pairs of distinct ``fps`` at ``max_bits`` (at most 2).

    Keys that few fingerprints share are joined and verified. The members of a larger key would give pairs by the
    square, so they meet at their one-bit neighbours instead: two fingerprints differ in at most two bits exactly if
    they have such a neighbour in common, and no neighbour has more than 65 fingerprints.
    """
    if not 1 <= max_bits <= 2:
        raise ValueError("two segments with one left-out bit find at most two differing bits")
    keys = signatures(fps)
    shared = stage(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-keys")
    # the list of shared keys grows with the input, so it is never broadcast
    members = stage(keys.join(shared.hint("merge"), "key"), "simhash-members")

    few = members.where(F.col("n") <= PAIRED_KEY)
    other = few.select("key", F.col("fp").alias("other"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits
    pairs = few.join(other, "key").where((F.col("fp") < F.col("other")) & close).select(F.col("fp").alias("u"), F.col("other").alias("v"))

    many = members.where(F.col("n") > PAIRED_KEY).select("fp").distinct()
    if max_bits == 1:  # sharing a neighbour means two bits; one bit means being a neighbour
        near = many.select("fp", F.explode(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))).alias("node"))
        met = near.join(many.select(F.col("fp").alias("node")), "node").select(F.col("fp").alias("u"), F.col("node").alias("v"))
    else:
        nodes = F.expr("concat(array(fp), transform(sequence(0, 63), b -> fp ^ shiftleft(1L, b)))")
        near = many.select("fp", F.explode(nodes).alias("node"))
        groups = near.groupBy("node").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        met = groups.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v"))
    return pairs.union(met)


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs (doc_id, text, ...)``.

    Documents are linked when their fingerprints differ in at most ``max_bits`` bits; ``component_id`` is the smallest
    doc_id reachable over links, the document's own included. Equal fingerprints are one vertex, so copies cost
    nothing. Null or empty texts have fingerprint zero and are linked like any other. A row without doc_id takes part
    and gets the component of its fingerprint (null if no member has an id); repeated rows stay repeated; other
    columns are ignored; an empty table gives an empty result.
    """
    fps = stage(fingerprints(docs, shingle), "simhash-fps")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    parts = connected_components(links(distinct.select("fp"), max_bits)).select(F.col("u").alias("fp"), "component")
    labelled = stage(
        distinct.join(parts, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")),
        "simhash-parts",
    )
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = stage(labelled.join(named, "component").select("fp", "component_id"), "simhash-named")
    return fps.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group; rows without doc_id are kept."""
    parts = simhash_components(docs, shingle, max_bits).select("doc_id", "component_id")
    gone = parts.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
