"""Gold star schema: calendar, dimensions, facts and reporting views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions import calendar as cal
from carestrata.operators.keys import dense_key
from carestrata.operators.scd2 import current_rows

CALENDAR_START, CALENDAR_END = date(2020, 1, 1), date(2030, 12, 31)


def dim_date(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    day = F.col("full_date")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    return days.select(
        "full_date",
        cal.date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def gold_dim_patient(dim_patient: DataFrame, as_of: date, key_type: str = "int") -> DataFrame:
    """Current patients with a dense surrogate key, age and age band; beyond 2^31 patients take ``bigint`` keys."""
    age = F.col("age")
    people = current_rows(dim_patient).select(
        F.col("patient_id").alias("patient_business_key"),
        "gender",
        "birth_date",
        cal.age_in_years(F.col("birth_date"), as_of).alias("age"),
        *["family_name", "given_name", "city", "state", "postal_code", "country"],
        *["marital_status", "active_flag", "scd_effective_start_date", "scd_effective_end_date"],
    )
    keyed = dense_key(people, "patient_business_key", "patient_sk", key_type)
    return keyed.select(
        *["patient_sk", "patient_business_key", "gender", "birth_date", "age"],
        cal.age_band(age).alias("age_group"),
        cal.age_band_position(age).alias("age_group_sort_order"),
        *[c for c in people.columns if c not in ("patient_business_key", "gender", "birth_date", "age")],
    )


def gold_dim_condition(dim_condition: DataFrame, key_type: str = "int") -> DataFrame:
    """Current conditions with a dense surrogate key."""
    kept = current_rows(dim_condition).select(
        F.col("condition_id").alias("condition_business_key"),
        *["clinical_status", "verification_status", "condition_text", "condition_code"],
        F.col("patient_id").alias("patient_business_key"),
        *["onset_date", "recorded_date", "scd_effective_start_date", "scd_effective_end_date"],
    )
    keyed = dense_key(kept, "condition_business_key", "condition_sk", key_type)
    return keyed.select("condition_sk", *kept.columns)


def _with_patient_sk(rows: DataFrame, patients: DataFrame) -> DataFrame:
    """Left lookup of the surrogate key; an unknown patient keeps a null key.

    Only the two key columns of the dimension travel. Spark chooses broadcast or a shuffle by measured size, and a
    patient with many rows is split by the adaptive skew join.
    """
    lookup = patients.select("patient_sk", F.col("patient_business_key").alias("patient_id"))
    return rows.join(lookup, "patient_id", "left")


def fact_encounter(silver_encounter: DataFrame, patients: DataFrame, by_day: bool = False) -> DataFrame:
    """One row per encounter; ``by_day`` lays it out as :func:`clustered_by_day` says."""
    stay = F.col("length_of_stay_days")
    joined = _with_patient_sk(silver_encounter, patients)
    if by_day:  # before the columns that follow from the dates, which the shuffle then does not carry
        joined = clustered_by_day(joined, "period_start", "encounter_id")
    joined = joined.withColumn(
        "length_of_stay_days", F.datediff("period_end", "period_start").cast("double")
    )
    return joined.select(
        "encounter_id",
        "patient_sk",
        cal.date_key(F.col("period_start")).alias("start_date_key"),
        cal.date_key(F.col("period_end")).alias("end_date_key"),
        *["status", "encounter_class", "encounter_type", "service_provider", "period_start", "period_end"],
        "length_of_stay_days",
        cal.stay_band(stay).alias("los_bucket"),
        cal.stay_band_position(stay).alias("los_bucket_sort_order"),
    )


def fact_observation(silver_observation: DataFrame, patients: DataFrame, by_day: bool = False) -> DataFrame:
    """One row per observation; ``by_day`` lays it out as :func:`clustered_by_day` says."""
    joined = _with_patient_sk(silver_observation, patients)
    if by_day:
        joined = clustered_by_day(joined, "effective_date", "observation_id")
    return joined.select(
        "observation_id",
        "patient_sk",
        "encounter_id",
        cal.date_key(F.col("effective_date")).alias("observation_date_key"),
        *["status", "observation_code_text", "observation_code", "coding_system"],
        *["value_numeric", "value_unit", "value_string", "effective_date"],
    )


def clustered_by_day(fact: DataFrame, day: str, row_key: str) -> DataFrame:
    """The fact laid out by day for writing, so that date filters skip files.

    Ranges run over day and row key together: a day with very many rows is spread over several files.
    """
    return fact.repartitionByRange(day, row_key).sortWithinPartitions(day, row_key)


def _with_day(fact: DataFrame, key: str, days: DataFrame, columns: list[str]) -> DataFrame:
    """Left lookup of calendar columns; the calendar's size is fixed by its bounds, so it is broadcast."""
    side = days.select(F.col("date_key").alias(key), *columns)
    return fact.join(F.broadcast(side), key, "left")


def vw_fact_encounter(facts: DataFrame, patients: DataFrame, days: DataFrame) -> DataFrame:
    who = patients.select(
        "patient_sk",
        "patient_business_key",
        "gender",
        F.col("city").alias("patient_city"),
        F.col("state").alias("patient_state"),
    )
    dated = _with_day(facts, "start_date_key", days, ["full_date", "year", "month_name", "quarter"])
    return dated.join(who, "patient_sk", "left").select(
        *["encounter_id", "status", "encounter_class", "encounter_type", "service_provider"],
        *["length_of_stay_days", "patient_business_key", "gender", "patient_city", "patient_state"],
        F.col("full_date").alias("encounter_start_date"),
        *["year", "month_name", "quarter"],
    )


def vw_fact_observation(facts: DataFrame, patients: DataFrame, days: DataFrame) -> DataFrame:
    who = patients.select("patient_sk", "patient_business_key", "gender")
    dated = _with_day(facts, "observation_date_key", days, ["full_date", "year", "month_name"])
    return dated.join(who, "patient_sk", "left").select(
        *["observation_id", "status", "observation_code_text", "value_numeric", "value_unit"],
        *["patient_business_key", "gender"],
        F.col("full_date").alias("observation_date"),
        *["year", "month_name"],
    )


def vw_condition_distribution(conditions: DataFrame, patients: DataFrame) -> DataFrame:
    """Conditions per text, status and gender.

    Counting per patient first shrinks the join input and spreads a patient with many conditions over the map side.
    """
    per_patient = conditions.groupBy("patient_business_key", "condition_text", "clinical_status").agg(
        F.count(F.lit(1)).alias("_n")
    )
    joined = per_patient.join(patients.select("patient_business_key", "gender"), "patient_business_key", "left")
    return joined.groupBy("condition_text", "clinical_status", "gender").agg(
        F.sum("_n").alias("condition_count")
    )
