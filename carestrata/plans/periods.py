"""Time comparisons on the full calendar; any output period is filtered afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.functions.aggregates import blank_if_zero, distinct_with_blank, divide, only_value, rows
from carestrata.plans.star import (
    DATE,
    ENCOUNTER,
    MEASURES,
    Label,
    Slicers,
    Star,
    internal,
    slice_condition,
    slice_frame,
    split_field,
)

_MONTH_INDEX = "_month_index"


def _selected_days(star: Star, slicers: Slicers | None) -> DataFrame | None:
    """Calendar days that the date slicers select, None if there are no date slicers."""
    on_days = {k: v for k, v in (slicers or {}).items() if split_field(k)[0] == DATE}
    if not on_days:
        return None
    days = star.days.select("*", *[F.col(split_field(k)[1]).alias(internal(k)) for k in on_days])
    return days.filter(slice_condition(on_days)).select(*star.days.columns)


def _output_period(out: DataFrame, star: Star, slicers: Slicers | None, keys: list[str]) -> DataFrame:
    """Rows of ``out`` in the period the date slicers select; the comparison itself has seen the whole calendar."""
    days = _selected_days(star, slicers)
    if days is None:
        return out
    return out.join(F.broadcast(days.select(*keys).distinct()), keys, "left_semi")  # size fixed by the calendar's bounds


def _sliced(star: Star, fields: list[str], slicers: Slicers | None) -> DataFrame:
    """Encounters with ``fields``; date slicers wait until the comparison is made, as it crosses them."""
    kept = {k: v for k, v in (slicers or {}).items() if split_field(k)[0] != DATE}
    frame = star.frame(ENCOUNTER, [*fields, *kept])
    return frame.filter(slice_condition(kept)) if kept else frame


def encounters_to_date(
    star: Star, group_by: list[str] | None = None, slicers: Slicers | None = None
) -> DataFrame:
    """Encounters of each day with running month and year totals, for every calendar day up to the last year in use."""
    keys = [internal(g) for g in group_by or []]
    frame = _sliced(star, [f"{ENCOUNTER}.start_date_key", *(group_by or [])], slicers)
    daily = (
        frame.filter(F.col(f"{ENCOUNTER}__start_date_key").isNotNull())
        .groupBy(*keys, F.col(f"{ENCOUNTER}__start_date_key").alias("date_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return _output_period(running_totals(star, daily, group_by), star, slicers, ["full_date"])


def running_totals(star: Star, daily: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """Month and year to date from ``daily``: one row ``(group columns, date_key, _n)`` per day and group.

    The days shrink to one row per year, with a map of at most 366 entries. Spreading that row over the year's calendar
    days fills the gaps, and the windows keep its partitioning.
    """
    keys = [internal(g) for g in group_by or []]
    yearly = daily.groupBy(*keys, F.floor(F.col("date_key") / 10000).cast("int").alias("year")).agg(
        F.map_from_entries(F.collect_list(F.struct("date_key", "_n"))).alias("_days")
    )
    calendar = star.days.select("year", "month", "full_date", "date_key")  # size fixed by the calendar's bounds
    filled = yearly.join(F.broadcast(calendar), "year").select(
        *keys, "year", "month", "full_date", F.coalesce(F.try_element_at("_days", "date_key"), F.lit(0)).alias("_n")
    )
    by_year = Window.partitionBy(*keys, "year").orderBy("full_date")
    by_month = Window.partitionBy(*keys, "year", "month").orderBy("full_date")
    return filled.select(
        *[F.col(internal(g)).alias(split_field(g)[1]) for g in group_by or []],
        "full_date",
        blank_if_zero(F.col("_n")).alias("encounters"),
        blank_if_zero(F.sum("_n").over(by_month)).alias("encounters_mtd"),
        blank_if_zero(F.sum("_n").over(by_year)).alias("encounters_ytd"),
    )


def _month_over_month(
    star: Star, expression: Column, name: str, uses: list[str], group_by: list[str] | None, slicers: Slicers | None
) -> DataFrame:
    """Monthly value, prior month and change."""
    keys = [internal(g) for g in group_by or []]
    year, month = f"{DATE}.year", f"{DATE}.month"
    frame = _sliced(star, [year, month, *uses, *(group_by or [])], slicers)
    index = (F.col(internal(year)) * 12 + F.col(internal(month)) - 1).alias(_MONTH_INDEX)
    monthly = (
        frame.filter(F.col(internal(year)).isNotNull()).groupBy(*keys, index).agg(expression.alias("_value"))
    )
    return _output_period(compared_months(star, monthly, name, group_by), star, slicers, ["year", "month"])


def compared_months(star: Star, monthly: DataFrame, name: str, group_by: list[str] | None = None) -> DataFrame:
    """Each month beside the one before, from ``monthly``: ``(group columns, _month_index, _value)``, one row per month.

    A monthly row is its own month's value and the next month's prior one, so the two meet in one more aggregation over
    a few rows.
    """
    keys = [internal(g) for g in group_by or []]
    none = F.lit(None).cast("bigint")
    roles = F.array(
        F.struct(F.col(_MONTH_INDEX).alias("_at"), F.col("_value").alias("_now"), none.alias("_prior")),
        F.struct((F.col(_MONTH_INDEX) + 1).alias("_at"), none.alias("_now"), F.col("_value").alias("_prior")),
    )
    met = (
        monthly.select(*keys, F.inline(roles))
        .groupBy(*keys, F.col("_at").alias(_MONTH_INDEX))
        .agg(F.max("_now").alias("_now"), F.max("_prior").alias("_prior"))
    )
    bounds = star.days.agg(F.max(F.col("year") * 12 + F.col("month") - 1)).scalar()
    change = divide(F.coalesce("_now", F.lit(0)) - F.col("_prior"), F.col("_prior"), F.lit(None).cast("double"))
    return met.filter(F.col(_MONTH_INDEX) <= bounds).select(
        *[F.col(internal(g)).alias(split_field(g)[1]) for g in group_by or []],
        F.floor(F.col(_MONTH_INDEX) / 12).cast("int").alias("year"),
        (F.col(_MONTH_INDEX) % 12 + 1).cast("int").alias("month"),
        F.col("_now").alias(name),
        F.col("_prior").alias(f"{name}_prior_month"),
        change.alias(f"{name}_mom_pct"),
    )


def encounters_by_month(star: Star, group_by: list[str] | None = None, slicers: Slicers | None = None) -> DataFrame:
    return _month_over_month(star, rows(), "encounters", [], group_by, slicers)


def patients_by_month(star: Star, group_by: list[str] | None = None, slicers: Slicers | None = None) -> DataFrame:
    sk = f"{ENCOUNTER}.patient_sk"
    return _month_over_month(star, distinct_with_blank(F.col(internal(sk))), "patients", [sk], group_by, slicers)


def context_labels(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Page title and selected period as text for the current slicers."""
    slicers = slicers or {}
    on_days = {k: v for k, v in slicers.items() if split_field(k)[0] == DATE}
    days = star.days.select(*[F.col(c).alias(f"{DATE}__{c}") for c in star.days.columns])
    if on_days:
        days = days.filter(slice_condition(on_days))
    period = days.agg(
        F.struct(
            only_value(F.col(f"{DATE}__year"), "All Years").alias("year"),
            only_value(F.col(f"{DATE}__quarter"), "All Quarters").alias("quarter"),
        )
    ).scalar()
    on_facts = {k: v for k, v in slicers.items() if split_field(k)[0] != "gold_dim_condition"}
    frame = star.frame(ENCOUNTER, [f"{ENCOUNTER}.encounter_class", *on_facts])
    frame = slice_frame(star, frame, ENCOUNTER, on_facts)
    shown = frame.agg(only_value(F.col(f"{ENCOUNTER}__encounter_class"), "All Classes").alias("shown_class"))
    return shown.withColumn("_period", period).select(
        F.concat_ws(" | ", F.lit("Healthcare Analytics"), "_period.year", "shown_class").alias("page_title"),
        F.concat_ws(" — ", "_period.year", "_period.quarter").alias("selected_period"),
    )


def with_periods(star: Star, base: DataFrame, names: list[str], group_by: list[str], slicers: Slicers) -> DataFrame:
    """``base``, grouped by ``group_by``, with period comparisons and labels added.

    A group's comparison is that of the last day (month) of the calendar that is in the group and in the date slicers.
    Groups that only a comparison has become rows of their own.
    """
    on_days = [g for g in group_by if split_field(g)[0] == DATE]
    others = [g for g in group_by if g not in on_days]
    keys, day_keys = [split_field(g)[1] for g in group_by], [split_field(g)[1] for g in on_days]
    other_keys = [split_field(g)[1] for g in others]
    days = _selected_days(star, slicers)
    days = star.days if days is None else days
    out = base
    for by_day in (True, False):
        wanted = [n for n in names if getattr(MEASURES[n], "by_day", None) is by_day]
        for subject in ("encounters", "patients"):
            mine = [n for n in wanted if n.startswith(subject)]
            if not mine:
                continue
            if by_day:
                values, at = encounters_to_date(star, others, slicers), "full_date"
            else:
                build = encounters_by_month if subject == "encounters" else patients_by_month
                values, at = build(star, others, slicers), "_at"
                values = values.withColumn(at, F.col("year") * 12 + F.col("month")).drop("year", "month")
            period = days.select("*", (F.col("year") * 12 + F.col("month")).alias("_at")) if not by_day else days
            last = period.groupBy(*[F.col(k).alias(f"_{k}") for k in day_keys]).agg(F.max(at).alias("_last"))  # one row per date group of the calendar
            columns = [MEASURES[n].column for n in mine]
            shown = values.join(F.broadcast(last), F.col(at) == F.col("_last")).select(
                *[F.col(k) if k in other_keys else F.col(f"_{k}").alias(k) for k in keys], *[F.col(c).alias(n) for c, n in zip(columns, mine)]
            )
            if not keys:
                picked = shown.agg(*[F.max(n).alias(n) for n in mine]).select(F.struct(*mine)).scalar()
                out = out.withColumn("_all", picked)
                out = out.withColumns({n: F.col("_all")[n] for n in mine}).drop("_all")
                continue
            stacked = out.unionByName(shown, allowMissingColumns=True)
            measures = [c for c in stacked.columns if c not in keys]
            out = stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])
    labels = [n for n in names if isinstance(MEASURES[n], Label)]
    if labels:
        out = out.withColumn("_labels", context_labels(star, slicers).select(F.struct(*labels)).scalar())
        out = out.withColumns({n: F.col("_labels")[n] for n in labels}).drop("_labels")
    return out
