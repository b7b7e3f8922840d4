import datetime as dt

from pyspark.sql import functions as F

from carestrata.functions import calendar as cal
from carestrata.operators import gold


def test_calendar(spark):
    days = gold.dim_date(spark)
    assert days.count() == 4018
    row = days.filter("full_date = '2024-12-29'").first()
    assert (row["date_key"], row["day_name"], row["day_of_week"], row["is_weekend"]) == (20241229, "Sunday", 1, True)
    assert (row["week_of_year"], row["month_name"], row["quarter"]) == (52, "December", 4)
    short = gold.dim_date(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1))
    assert [r["date_key"] for r in short.orderBy("date_key").collect()] == [20240228, 20240229, 20240301]


def test_age_bands(spark):
    as_of = dt.date(2023, 6, 30)  # the 365.25-day rule leaves an exact 18th birthday at 17
    births = [dt.date(2005, 6, 30), dt.date(2005, 6, 29), dt.date(1973, 6, 29), dt.date(1940, 1, 1), None]
    df = spark.createDataFrame([(b,) for b in births], "b date").withColumn("age", cal.age_in_years(F.col("b"), as_of))
    got = df.select("age", cal.age_band(F.col("age")), cal.age_band_position(F.col("age"))).collect()
    assert [tuple(r) for r in got] == [
        (17, "0-17", 1),
        (18, "18-34", 2),
        (50, "50-64", 4),
        (83, "65+", 5),
        (None, "Unknown", 99),
    ]


def test_stay_bands(spark):
    days = [-2.0, 0.0, 1.0, 1.5, 3.0, 7.0, 8.0, 14.0, 30.0, 31.0, None]
    df = spark.createDataFrame([(d,) for d in days], "d double")
    got = [r[0] for r in df.select(cal.stay_band_position(F.col("d"))).collect()]
    assert got == [1, 1, 1, 2, 2, 3, 4, 4, 5, 6, 99]
    assert df.select(cal.stay_band(F.col("d"))).first()[0] == "0 – 1 day"


def test_orphans_keep_a_null_key(spark):
    enc = spark.createDataFrame(
        [("e1", "p1"), ("e2", "gone"), ("e3", None)],
        "encounter_id string, patient_id string",
    )
    for c in ("status", "encounter_class", "encounter_type", "service_provider"):
        enc = enc.withColumn(c, F.lit("x"))
    enc = enc.withColumns({"period_start": F.lit(dt.date(2024, 1, 1)), "period_end": F.lit(None).cast("date")})
    people = spark.createDataFrame([(1, "p1")], "patient_sk int, patient_business_key string")
    got = {r["encounter_id"]: r for r in gold.fact_encounter(enc, people).collect()}
    assert {k: v["patient_sk"] for k, v in got.items()} == {"e1": 1, "e2": None, "e3": None}
    assert got["e1"]["start_date_key"] == 20240101 and got["e1"]["end_date_key"] is None
    assert got["e1"]["los_bucket"] == "Not Applicable"
