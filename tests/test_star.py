import datetime as dt

import pytest
from pyspark.sql import functions as F

from carestrata.functions.aggregates import distinct_with_blank, divide, only_value, rows
from carestrata.operators import gold
from carestrata.plans import dashboard, periods
from carestrata.plans.star import CONDITION, DATE, ENCOUNTER, OBSERVATION, PATIENT, Star, evaluate, slicer_values

STATUS, CLASS = f"{ENCOUNTER}.status", f"{ENCOUNTER}.encounter_class"
GENDER = f"{PATIENT}.gender"


@pytest.fixture(scope="module")
def star(spark):
    encounters = spark.createDataFrame(
        [
            # id, sk, start, end, status, class, los
            ("e1", 1, 20240115, 20240116, "FINISHED", "IMP", 1.0),
            ("e2", 1, 20240220, 20240301, "FINISHED", "IMP", 10.0),
            ("e3", 2, 20240220, None, "ARRIVED", "AMB", None),
            ("e4", None, 20240405, 20240406, "ARRIVED", None, 1.0),
            ("e5", 2, 20250101, 20250103, "FINISHED", "AMB", 2.0),
        ],
        "encounter_id string, patient_sk int, start_date_key int, end_date_key int, status string, "
        "encounter_class string, length_of_stay_days double",
    ).withColumns({"encounter_type": F.lit("t"), "los_bucket": F.lit("b"), "los_bucket_sort_order": F.lit(1)})
    observations = spark.createDataFrame(
        [
            ("o1", 1, "e1", 20240115, "FINAL", "Heart rate", 60.0),
            ("o2", 1, "e1", 20240116, "FINAL", "Heart rate", None),
            ("o3", 2, "e3", 20240221, "FINAL", "Body Weight", 80.0),
            ("o4", 3, "e9", 20240221, "FINAL", "Body Height", 1.0),
        ],
        "observation_id string, patient_sk int, encounter_id string, observation_date_key int, status string, "
        "observation_code_text string, value_numeric double",
    )
    conditions = spark.createDataFrame(
        [("p1", "ACTIVE", "flu"), ("p1", "RESOLVED", "flu"), ("p3", "ACTIVE", "cold"), (None, "ACTIVE", "cold")],
        "patient_business_key string, clinical_status string, condition_text string",
    )
    patients = spark.createDataFrame(
        [(1, "p1", "MALE", "S1"), (2, "p2", "FEMALE", "S2"), (3, "p3", None, "S2")],
        "patient_sk int, patient_business_key string, gender string, state string",
    ).withColumns({"age_group": F.lit("0-17"), "age_group_sort_order": F.lit(1)})
    return Star(encounters, observations, conditions, patients, gold.dim_date(spark))


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_blank_counts_as_a_patient(star):
    assert table(evaluate(star, ["total_patients", "total_encounters"])) == [(3, 5)]


def test_counts_over_nothing_are_blank(star):
    none = {CLASS: ["VR"]}
    got = evaluate(star, ["total_encounters", "total_patients", "encounters_per_patient"], None, none)
    assert table(got) == [(None, None, 0.0)]


def test_own_filter_replaces_group_and_slicer(star):
    got = evaluate(star, ["total_encounters", "encounters_finished"], [STATUS])
    assert table(got) == [("ARRIVED", 2, 3), ("FINISHED", 3, 3)]
    sliced = evaluate(star, ["total_encounters", "encounters_finished"], None, {STATUS: ["ARRIVED"]})
    assert table(sliced) == [(2, 3)]


def test_only_overriding_measures(star):
    got = evaluate(star, ["encounters_finished"], [STATUS])
    assert table(got) == [("ARRIVED", 3), ("FINISHED", 3)]


def test_partly_overridden_groups_keep_null_keys(star):
    got = evaluate(star, ["total_encounters", "encounters_finished"], [CLASS, STATUS])
    assert table(got) == sorted(
        [("AMB", "ARRIVED", 1, 1), ("AMB", "FINISHED", 1, 1), ("IMP", "FINISHED", 2, 2), (None, "ARRIVED", 1, None)],
        key=repr,
    )


def test_status_share(star):
    got = evaluate(star, ["encounter_status_pct"], [CLASS, STATUS], {STATUS: ["FINISHED"]})
    assert table(got) == [("AMB", "FINISHED", 0.5), ("IMP", "FINISHED", 1.0)]


def test_inpatient_stay(star):
    got = evaluate(star, ["avg_los_days", "max_los_days", "avg_los_all_classes", "total_los_days"])
    assert table(got) == [(5.5, 10.0, 3.5, 14.0)]


def test_stay_by_discharge_month(star):
    got = evaluate(star, ["avg_los_by_discharge_date"], [f"{DATE}.year", f"{DATE}.month"])
    found = {(r["year"], r["month"]): r["avg_los_by_discharge_date"] for r in got.collect()}
    assert found[(2024, 1)] == 1.0 and found[(2024, 3)] == 10.0 and found[(2024, 4)] is None


def test_two_facts_by_patient_field(star):
    got = evaluate(star, ["total_encounters", "total_observations", "observations_per_patient"], [GENDER])
    assert table(got) == sorted([("FEMALE", 2, 1, 1.0), ("MALE", 2, 2, 2.0), (None, 1, 1, 1.0)], key=repr)


def test_field_out_of_reach_repeats_the_total(star):
    got = evaluate(star, ["total_encounters", "total_conditions"], [CLASS])
    assert {r["total_conditions"] for r in got.collect()} == {4}
    with pytest.raises(ValueError):
        evaluate(star, ["total_conditions"], [CLASS])


def test_slicers_reach_only_related_facts(star):
    male = {GENDER: ["MALE"]}
    names = ["total_encounters", "total_observations", "total_conditions"]
    assert table(evaluate(star, names, None, male)) == [(2, 2, 2)]
    assert table(evaluate(star, names, None, {CLASS: ["IMP"]})) == [(2, 4, 4)]
    assert table(evaluate(star, names, None, {f"{DATE}.year": [2025]})) == [(1, None, 4)]
    assert table(evaluate(star, ["total_encounters"], None, {CLASS: [None, "IMP"]})) == [(3,)]


def test_condition_measures(star):
    got = evaluate(star, ["patients_with_condition", "condition_resolution_rate"], [f"{CONDITION}.condition_text"])
    assert table(got) == [("cold", 2, None), ("flu", 1, 0.5)]


def test_observation_measures(star):
    names = ["total_observations", "numeric_observations", "avg_observation_value"]
    got = evaluate(star, names, [f"{OBSERVATION}.observation_code_text"])
    assert table(got) == [("Body Height", 1, 1, 1.0), ("Body Weight", 1, 1, 80.0), ("Heart rate", 2, 1, 60.0)]


def test_running_totals_fill_gaps(star):
    got = {r["full_date"]: r for r in periods.encounters_to_date(star).collect()}
    assert len(got) == 366 + 365
    day = got[dt.date(2024, 2, 25)]
    assert (day["encounters"], day["encounters_mtd"], day["encounters_ytd"]) == (None, 2, 3)
    assert got[dt.date(2024, 3, 5)]["encounters_mtd"] is None and got[dt.date(2024, 3, 5)]["encounters_ytd"] == 3
    assert got[dt.date(2024, 1, 1)]["encounters_ytd"] is None
    assert got[dt.date(2025, 1, 1)]["encounters_ytd"] == 1


def test_prior_month_across_empty_months_and_years(star):
    got = {(r["year"], r["month"]): tuple(r)[2:] for r in periods.encounters_by_month(star).collect()}
    assert got[(2024, 1)] == (1, None, None)
    assert got[(2024, 2)] == (2, 1, 1.0)
    assert got[(2024, 3)] == (None, 2, -1.0)
    assert got[(2024, 4)] == (1, None, None)
    assert (2024, 6) not in got
    assert got[(2025, 1)] == (1, None, None)
    people = {(r["year"], r["month"]): tuple(r)[2:4] for r in periods.patients_by_month(star).collect()}
    assert people[(2024, 2)] == (2, 1) and people[(2024, 4)] == (1, None)


def test_date_slicer_filters_the_output_period(star):
    year = {f"{DATE}.year": [2025], CLASS: ["AMB"]}
    whole = {(r["year"], r["month"]): r for r in periods.encounters_by_month(star, None, {CLASS: ["AMB"]}).collect()}
    sliced = {(r["year"], r["month"]): r for r in periods.encounters_by_month(star, None, year).collect()}
    assert set(sliced) == {(2025, 1), (2025, 2)} and all(whole[k] == r for k, r in sliced.items())
    days = periods.encounters_to_date(star, None, {f"{DATE}.year": [2024], f"{DATE}.month": [3]})
    assert {(r["full_date"].year, r["full_date"].month) for r in days.collect()} == {(2024, 3)} and days.count() == 31


def test_slicers_compare_without_case(star):
    for low, up in (({CLASS: ["amb"]}, {CLASS: ["AMB"]}), ({f"{DATE}.month_name": ["march"]}, {f"{DATE}.month_name": ["March"]})):
        assert table(evaluate(star, ["total_encounters"], None, low)) == table(evaluate(star, ["total_encounters"], None, up))


def test_period_measures_by_name(star):
    by = [f"{DATE}.year", f"{DATE}.month"]
    names = ["total_encounters", "encounters_mtd", "encounters_ytd", "encounters_prior_month", "encounters_mom_pct"]
    got = {(r["year"], r["month"]): r for r in evaluate(star, names, by).collect()}
    months = {(r["year"], r["month"]): r for r in periods.encounters_by_month(star).collect()}
    for key, row in months.items():
        assert got[key]["encounters_prior_month"] == row["encounters_prior_month"]
        assert got[key]["encounters_mom_pct"] == row["encounters_mom_pct"]
        assert got[key]["encounters_mtd"] == got[key]["total_encounters"] == row["encounters"]
    one = evaluate(star, ["encounters_ytd", "patients_mom_pct", "page_title"], None, {f"{DATE}.year": [2024], f"{DATE}.month": [4]})
    last = periods.encounters_to_date(star, None, {f"{DATE}.date_key": [20240430]}).first()
    assert one.first()["encounters_ytd"] == last["encounters_ytd"] and one.first()["page_title"].startswith("Healthcare")
    assert one.first()["patients_mom_pct"] == periods.patients_by_month(star, None, {f"{DATE}.year": [2024], f"{DATE}.month": [4]}).first()["patients_mom_pct"]


def test_labels(star):
    assert table(periods.context_labels(star)) == [
        ("Healthcare Analytics | All Years | All Classes", "All Years — All Quarters")
    ]
    got = periods.context_labels(star, {f"{DATE}.year": [2024], f"{DATE}.quarter": [2], CLASS: ["IMP"]})
    assert got.first()["selected_period"] == "2024 — 2"
    one = periods.context_labels(star, {CLASS: ["IMP"]}).first()["page_title"]
    assert one == "Healthcare Analytics | All Years | IMP"


def test_bridged_charts(star):
    assert table(dashboard.encounters_by_code(star)) == [("Body Weight", 1), ("Heart rate", 1)]
    assert table(dashboard.encounters_by_month_code(star)) == [("February", "Body Weight", 1), ("January", "Heart rate", 1)]
    assert table(dashboard.encounters_by_code(star, None, ["Body Height"])) == []
    assert table(dashboard.patients_by_condition(star)) == [("flu", 1)]
    assert table(dashboard.patients_by_condition(star, {CLASS: ["AMB"]})) == []


def test_every_dataset_takes_slicers(star):
    for build in dashboard.DATASETS.values():
        assert build(star, {GENDER: ["MALE"], f"{DATE}.year": [2024]}).count() >= 1


def test_slicer_lists(star):
    assert table(slicer_values(star, STATUS)) == [("ARRIVED",), ("FINISHED",)]
    assert dashboard.date_hierarchy(star).count() == 4018


def test_aggregate_rules(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "v int")
    got = df.agg(distinct_with_blank(F.col("v")), rows(F.col("v") > 5), only_value(F.col("v"), "All")).first()
    assert tuple(got) == (2, None, "All")
    assert df.filter("v = 1").agg(only_value(F.col("v"), "All")).first()[0] == "1"
    none = F.lit(None).cast("int")
    cases = [divide(F.lit(1), F.lit(0), F.lit(0.0)), divide(F.lit(1), none, F.lit(0.0)), divide(none, F.lit(2), F.lit(0.0))]
    assert tuple(df.select(*cases).first()) == (0.0, 0.0, None)


def test_sliced_lists_read_the_fact_once(spark, sf_dir):
    from carestrata.plans import dashboard
    from carestrata.plans.lakehouse import open_lakehouse
    from carestrata.registry import star_of

    star = star_of(open_lakehouse(spark, sf_dir))
    slicers = {"gold_dim_patient.gender": ["male", None], "fact_encounter.status": ["finished"], "dim_date.year": [2023]}
    lists = dashboard.slicer_lists(star, slicers)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "encounter_class" in line for line in plan.splitlines()) == 1
    everything = star.frame("fact_encounter", ["fact_encounter.status", "gold_dim_patient.gender", "dim_date.year"])
    base = everything.filter("dim_date__year = 2023")
    by_gender = {r[0]: r[1] for r in base.filter("lower(fact_encounter__status) = 'finished'").groupBy("gold_dim_patient__gender").count().collect()}
    by_status = {r[0]: r[1] for r in base.filter("lower(gold_dim_patient__gender) = 'male' OR gold_dim_patient__gender IS NULL").groupBy("fact_encounter__status").count().collect()}
    got = {(r["slicer"], r["value"]): r["total_encounters"] for r in lists.collect()}
    assert {v: n for (s, v), n in got.items() if s == "gender"} == by_gender
    assert {v: n for (s, v), n in got.items() if s == "status"} == by_status
