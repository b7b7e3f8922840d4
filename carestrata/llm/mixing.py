"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.common import stage

SEED = 20_240
#: share of a source in the mix grows with its documents to this power unless weights are given
TEMPERATURE = 0.5
#: a rate above this is drawn as a sum of equal Poisson parts, so that exp(-rate) stays a normal number
PART_RATE = 64.0
#: rates are one row per source; up to so many rows are broadcast
BROADCAST_SOURCES = 10_000


def mixing_rates(
    docs: DataFrame, weights: dict[str, float] | None = None, mean_rate: float = 1.0, temperature: float = TEMPERATURE
) -> DataFrame:
    """``(source, n_docs, rate)``: the mean number of copies that brings each source to its weight.

    The mix aims at ``mean_rate`` times all documents. Without ``weights`` a source weighs its documents to the power
    ``temperature``. With ``weights`` a source that is not named has weight zero; they need not add up to one, but one
    of a source present must be positive for any row to come out.
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
    weighed = counts.select("source", "n_docs", weight.alias("weight"))
    total = weighed.agg(F.sum("n_docs").alias("all_docs"), F.sum("weight").alias("all_weight"))
    rate = F.lit(float(mean_rate)) * F.col("all_docs") * F.col("weight") / F.col("all_weight") / F.col("n_docs")
    return weighed.join(F.broadcast(total)).select(  # one row of totals
        "source", "n_docs", F.when(F.col("all_weight") > 0, rate).otherwise(0.0).alias("rate")
    )


def _with_distribution(rates: DataFrame) -> DataFrame:
    """Adds the number of parts and the cumulative distribution of one part."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE).cast("int"))
    split = rates.withColumn("parts", parts).withColumn("mu", F.col("rate") / F.col("parts"))
    last = F.ceil(F.col("mu") + 12 * F.sqrt("mu") + 24).cast("int")

    def step(a, k):
        p = a["p"] * F.col("mu") / k
        return F.struct(p.alias("p"), (a["c"] + p).alias("c"), F.concat(a["cdf"], F.array(a["c"] + p)).alias("cdf"))

    none = F.exp(-F.col("mu"))
    start = F.struct(none.alias("p"), none.alias("c"), F.array(none).alias("cdf"))
    return split.select("source", "parts", F.aggregate(F.sequence(F.lit(1), last), start, step)["cdf"].alias("cdf"))


def _uniform(*parts) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / float(2**52)


def poisson_mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    mean_rate: float = 1.0,
    temperature: float = TEMPERATURE,
    seed: int = SEED,
) -> DataFrame:
    """Every row of ``docs (doc_id, source, ...)`` as often as its draw says, in a global random order.

    A row's count is the inverse of the Poisson distribution of its source's rate at a number hashed from ``seed`` and
    ``doc_id``: the same on every run, whatever the partitions. Adds ``copy`` (1, 2, ...) and ``shuffle_key``, by which
    the result is sorted; input columns of these names are replaced, all others stay. Null sources are a source of
    their own, a null doc_id hashes as ``null``, repeated rows draw the same count each, and an empty table gives an
    empty result.
    """
    rates = stage(mixing_rates(docs, weights, mean_rate, temperature), "mix-rates")
    drawn_by = _with_distribution(rates)
    side = F.broadcast(drawn_by) if rates.count() <= BROADCAST_SOURCES else drawn_by
    kept = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    joined = rows.join(side, F.col("row.source").eqNullSafe(F.col("source")))
    key = F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null"))
    each = F.transform(
        F.sequence(F.lit(1), F.col("parts")),
        lambda j: F.size(F.filter("cdf", lambda c: c <= _uniform(F.lit(str(seed)), key, j.cast("string")))),
    )
    count = F.aggregate(each, F.lit(0), lambda a, b: a + b)
    copies = joined.select("row", count.alias("count")).where("count > 0")
    exploded = copies.select("row", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    order = F.md5(F.concat_ws(":", F.lit(f"order {seed}"), key, F.col("copy").cast("string")).cast("binary"))
    return exploded.select("row", "copy", order.alias("shuffle_key")).orderBy("shuffle_key").select("row.*", "copy", "shuffle_key")
