"""Encounters and patients kept by day, from which totals of any period are merged without reading the fact.

A row holds, for one day, one group and one range of 32,768 surrogate keys, how many encounters there were and a bitmap
of the patients they belong to. Counts add up and bitmaps combine by OR, so distinct patients of a month, a year or a
slice are exact and come from the state alone. The state is partitioned by month like the fact: a day that arrives late,
or is corrected, replaces its month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions.aggregates import blank_if_zero
from carestrata.plans import periods
from carestrata.plans.refresh import MONTH, drop_months
from carestrata.plans.star import ENCOUNTER, Star, internal, split_field
from carestrata.sources import tables


def encounter_days(star: Star, group_by: list[str] | None = None) -> DataFrame:
    """``(date_key, group columns, _range, _patients, _n)``; encounters without a patient have no range and an empty bitmap."""
    day, sk = f"{ENCOUNTER}.start_date_key", f"{ENCOUNTER}.patient_sk"
    frame, key = star.frame(ENCOUNTER, [day, sk, *(group_by or [])]), F.col(internal(sk))
    groups = [internal(g) for g in group_by or []]
    rows = frame.groupBy(F.col(internal(day)).alias("date_key"), *groups, F.bitmap_bucket_number(key).alias("_range"))
    bitmap = F.bitmap_construct_agg(F.bitmap_bit_position(key))
    return rows.agg(bitmap.alias("_patients"), F.count(F.lit(1)).alias("_n"))


def _by_month(days: DataFrame) -> DataFrame:
    return days.withColumn(MONTH, F.expr("CAST(date_key DIV 100 AS INT)")).hint("rebalance", MONTH)


def store_days(star: Star, name: str, group_by: list[str] | None = None) -> None:
    tables.replace_table(_by_month(encounter_days(star, group_by)), name, [MONTH])


def refresh_days(star: Star, name: str, months: list[int | None], group_by: list[str] | None = None) -> None:
    """Rebuild the given months of a stored state from the fact; the other months of both are not read."""
    if not months:
        return
    spark, dated = star.encounters.sparkSession, [m for m in months if m is not None]
    key = F.col("start_date_key")
    spans = [key.between(m * 100, m * 100 + 99) for m in dated] + ([key.isNull()] if None in months else [])
    wanted = spans[0]
    for span in spans[1:]:
        wanted = wanted | span
    part = star.with_encounters(star.encounters.filter(wanted))
    tables.overwrite_table_partitions(_by_month(encounter_days(part, group_by)), name)
    left = {r[0] for r in part.encounters.select(F.expr("CAST(start_date_key DIV 100 AS INT)")).distinct().collect()}
    drop_months(spark, name, set(months) - left)


def read_days(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(MONTH)


def _merged(days: DataFrame, keys: list[Column | str]) -> DataFrame:
    """``(keys, _n, _value)``: encounters and distinct patients, where no patient is one more value."""
    ranges = days.groupBy(*keys, "_range").agg(F.bitmap_or_agg("_patients").alias("_patients"), F.sum("_n").alias("_n"))
    names = [c for c in ranges.columns if c not in ("_range", "_patients", "_n")]
    known = F.sum(F.when(F.col("_range").isNotNull(), F.bitmap_count("_patients")).otherwise(1))
    return ranges.groupBy(*names).agg(F.sum("_n").alias("_n"), known.alias("_value"))


def totals(days: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """total_encounters and total_patients by the state's groups, over all its days; one row without groups."""
    out = _merged(days, [internal(g) for g in group_by or []])
    return out.select(
        *[F.col(internal(g)).alias(split_field(g)[1]) for g in group_by or []],
        blank_if_zero(F.coalesce("_n", F.lit(0))).alias("total_encounters"),
        blank_if_zero(F.coalesce("_value", F.lit(0))).alias("total_patients"),
    )


def encounters_to_date(star: Star, days: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """:func:`periods.encounters_to_date` from the state; ``star`` gives the calendar only."""
    keys = [internal(g) for g in group_by or []]
    daily = days.filter(F.col("date_key").isNotNull()).groupBy(*keys, "date_key").agg(F.sum("_n").alias("_n"))
    return periods.running_totals(star, daily, group_by)


def patients_by_month(star: Star, days: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """:func:`periods.patients_by_month` from the state; ``star`` gives the calendar only."""
    keys = [internal(g) for g in group_by or []]
    calendar = star.days.select("date_key", (F.col("year") * 12 + F.col("month") - 1).alias("_month_index"))
    dated = days.join(F.broadcast(calendar), "date_key")  # size fixed by the calendar's bounds
    monthly = _merged(dated, [*keys, "_month_index"]).select(*keys, "_month_index", "_value")
    return periods.compared_months(star, monthly, "patients", group_by)
