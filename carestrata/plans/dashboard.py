"""The queries behind the two dashboard pages; every one takes the page's slicers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.plans.star import DATE, ENCOUNTER, PATIENT, Slicers, Star, evaluate, internal, reaches, selects, slice_frame, split_field

# The observation codes two charts are limited to, and the slicer fields of both pages.
CHART_CODES = ["Blood Pressure", "Body Weight", "Heart rate", "Blood Glucose"]
SLICER_FIELDS = {
    "state": f"{PATIENT}.state",
    "gender": f"{PATIENT}.gender",
    "encounter_class": f"{ENCOUNTER}.encounter_class",
    "status": f"{ENCOUNTER}.status",
}


def cards(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return evaluate(
        star, ["active_conditions", "total_patients", "avg_los_days", "total_encounters"], None, slicers
    )


def encounters_by_month_type(star: Star, slicers: Slicers | None = None) -> DataFrame:
    by = [f"{DATE}.month_name", f"{ENCOUNTER}.encounter_type"]
    return evaluate(star, ["total_encounters"], by, slicers).orderBy(F.desc("total_encounters"))


def patients_by_gender(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return evaluate(star, ["total_patients"], [f"{PATIENT}.gender"], slicers).orderBy(F.desc("total_patients"))


def encounters_by_age_group(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """In band order by the companion sort column."""
    by = [f"{PATIENT}.age_group", f"{PATIENT}.age_group_sort_order"]
    return evaluate(star, ["total_encounters"], by, slicers).orderBy("age_group_sort_order")


def encounters_by_class(star: Star, slicers: Slicers | None = None) -> DataFrame:
    out = evaluate(star, ["total_encounters"], [f"{ENCOUNTER}.encounter_class"], slicers)
    return out.orderBy(F.desc("total_encounters"))


def encounters_by_stay(star: Star, slicers: Slicers | None = None) -> DataFrame:
    by = [f"{ENCOUNTER}.los_bucket", f"{ENCOUNTER}.los_bucket_sort_order"]
    return evaluate(star, ["total_encounters"], by, slicers).orderBy(F.desc("total_encounters"))


def status_table(star: Star, slicers: Slicers | None = None) -> DataFrame:
    out = evaluate(star, ["total_patients", "total_encounters"], [f"{ENCOUNTER}.status"], slicers)
    return out.orderBy(F.desc("total_encounters"))


def encounters_by_state(star: Star, slicers: Slicers | None = None) -> DataFrame:
    out = evaluate(star, ["total_encounters"], [f"{PATIENT}.state"], slicers)
    return out.orderBy(F.desc("total_encounters"))


def _sliced_encounters(star: Star, fields: list[str], slicers: Slicers | None) -> DataFrame:
    active = {k: v for k, v in (slicers or {}).items() if reaches(ENCOUNTER, k)}
    return slice_frame(star, star.frame(ENCOUNTER, [*fields, *active]), ENCOUNTER, active)


def _encounters_with_codes(star: Star, by_month: bool, slicers: Slicers | None, codes: list[str]) -> DataFrame:
    """Encounters that have an observation of each code.

    Observations shrink to the few codes of each encounter before the join, and both sides meet on the encounter id, so
    a code or an encounter with very many observations costs one row per map task.
    """
    of_encounter = (
        star.observations.filter(F.lower("observation_code_text").isin([c.lower() for c in codes]))
        .groupBy("encounter_id")
        .agg(F.collect_set("observation_code_text").alias("_codes"))
    )
    fields = [f"{ENCOUNTER}.encounter_id", *([f"{DATE}.month_name"] if by_month else [])]
    frame = _sliced_encounters(star, fields, slicers)
    met = frame.join(of_encounter, F.col(f"{ENCOUNTER}__encounter_id") == F.col("encounter_id"))
    keys = [F.col(f"{DATE}__month_name").alias("month_name")] if by_month else []
    each = met.select(*keys, F.explode("_codes").alias("observation_code_text"))
    by = ["month_name", "observation_code_text"] if by_month else ["observation_code_text"]
    return each.groupBy(*by).agg(F.count(F.lit(1)).alias("total_encounters")).orderBy(F.desc("total_encounters"))


def encounters_by_month_code(
    star: Star, slicers: Slicers | None = None, codes: list[str] | None = None
) -> DataFrame:
    return _encounters_with_codes(star, True, slicers, codes or CHART_CODES)


def encounters_by_code(star: Star, slicers: Slicers | None = None, codes: list[str] | None = None) -> DataFrame:
    return _encounters_with_codes(star, False, slicers, codes or CHART_CODES)


def patients_by_condition(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Patients with at least one encounter, by the texts of their conditions."""
    seen = _sliced_encounters(star, [f"{ENCOUNTER}.patient_sk"], slicers)
    seen = seen.select(F.col(f"{ENCOUNTER}__patient_sk").alias("patient_sk")).distinct()
    people = star.patients.select("patient_sk", "patient_business_key").join(seen, "patient_sk", "left_semi")
    texts = star.conditions.select("patient_business_key", "condition_text").distinct()
    met = texts.join(people, "patient_business_key")
    return met.groupBy("condition_text").agg(F.count(F.lit(1)).alias("total_patients")).orderBy(
        F.desc("total_patients")
    )


def slicer_lists(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """The value lists of the four value slicers as (slicer, value, encounters), with the encounters each selects.

    A list shows what the other slicers leave: every filter counts but the list's own. The fact is read once and shrinks
    to the combinations of the four values, each with the own-filters it passes, before the lists are counted.
    """
    active = {k: v for k, v in (slicers or {}).items() if reaches(ENCOUNTER, k)}
    others = {k: v for k, v in active.items() if k not in SLICER_FIELDS.values()}
    frame = star.frame(ENCOUNTER, [*SLICER_FIELDS.values(), *others])
    frame = slice_frame(star, frame, ENCOUNTER, others)
    values = {name: F.col(internal(field)) for name, field in SLICER_FIELDS.items()}
    combined = frame.groupBy(*[v.alias(n) for n, v in values.items()]).agg(F.count(F.lit(1)).alias("n"))

    def passes(name: str) -> Column:
        field = SLICER_FIELDS[name]
        if field not in active:
            return F.lit(True)
        return F.coalesce(selects(F.col(name), active[field]), F.lit(False))

    passed = {name: passes(name) for name in values}
    entries = []
    for name in values:
        kept = reduce(lambda a, b: a & b, [passed[o] for o in values if o != name])
        entries.append(F.when(kept, F.struct(F.lit(name).alias("slicer"), F.col(name).cast("string").alias("value"))))
    each = combined.select("n", F.explode(F.array(*entries)).alias("e")).filter(F.col("e").isNotNull())
    return each.groupBy("e.slicer", "e.value").agg(F.sum("n").alias("total_encounters"))


def date_hierarchy(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Year, quarter, month and day as the date slicer offers them, with the encounters that start each day.

    All days of the calendar are offered; the encounters are those under every slicer but the date's own.
    """
    active = {k: v for k, v in (slicers or {}).items() if split_field(k)[0] != DATE}
    key = f"{ENCOUNTER}.start_date_key"
    frame = _sliced_encounters(star, [key], active)
    counted = frame.groupBy(F.col(internal(key)).alias("start_date_key")).agg(F.count(F.lit(1)).alias("total_encounters"))
    days = star.days.select("year", "quarter", "month_name", "full_date", "date_key").distinct()
    return (
        days.join(counted, F.col("date_key") == F.col("start_date_key"), "left")
        .select("year", "quarter", "month_name", "full_date", "total_encounters")
        .orderBy("full_date")
    )


DATASETS = {
    "cards": cards,
    "month_type": encounters_by_month_type,
    "gender": patients_by_gender,
    "age_group": encounters_by_age_group,
    "class": encounters_by_class,
    "los_bucket": encounters_by_stay,
    "status_table": status_table,
    "month_code": encounters_by_month_code,
    "code": encounters_by_code,
    "state": encounters_by_state,
    "condition_patients": patients_by_condition,
}
