"""Shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from carestrata.operators.bronze import rows_to_insert
from carestrata.plans.lakehouse import open_lakehouse
from carestrata.registry import all_queries

# these write files and streams of their own and are covered elsewhere
HEAVY = {"run_two_days", "stream_bronze_result", "compact_preserves", "raw_folder_census", "bronze_manifest_valid"}
HEAVY |= {"stream_bronze_complete_batches", "run_log_and_events", "lifecycle_events"}
PYTHON = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in all_queries() if n not in HEAVY])
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(all_queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not PYTHON.search(text)


@pytest.mark.parametrize("resource", ["patient", "encounter", "observation", "condition"])
def test_silver_is_one_scan_and_one_shuffle(spark, sf_dir, resource):
    text = plan(open_lakehouse(spark, sf_dir).derive(f"silver_{resource}"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert text.count("WindowGroupLimit") == 2
    assert "resource_json" not in text  # the JSON copy is never read


def test_nested_fields_are_pruned(spark, sf_dir):
    lake = open_lakehouse(spark, sf_dir)
    text = plan(lake.table("bronze_encounter").select(F.col("resource_data.class.code")))
    assert "ReadSchema: struct<resource_data:struct<class:struct<code:string>>>" in text


def test_silver_date_filter_prunes_partitions(spark, sf_dir):
    lake = open_lakehouse(spark, sf_dir)
    text = plan(lake.derive("silver_patient_first"))
    assert re.search(r"PartitionFilters: \[[^\]]*ingestion_date#\d+ = 2024-01-01", text)


def test_merge_prunes_the_target(spark, sf_dir):
    events = open_lakehouse(spark, sf_dir).table("bronze_event")
    text = plan(rows_to_insert(events, events, partition_dates=["2024-01-05"]))
    assert "2024-01-05" in text and text.count("FileScan") == 2


def test_class_chart_reads_one_column(spark, sf_dir):
    text = plan(all_queries()["dash_class"](spark, sf_dir))
    assert "ReadSchema: struct<encounter_class:string>" in text


def test_date_slicer_reaches_the_fact_scan(spark, sf_dir):
    from carestrata.plans.star import DATE, evaluate
    from carestrata.registry import star_of

    star = star_of(open_lakehouse(spark, sf_dir))
    sliced = evaluate(star, ["total_encounters"], None, {f"{DATE}.year": [2023]})
    assert sliced.first()[0] == star.encounters.filter("start_date_key div 10000 = 2023").count()
    scan = next(l for l in plan(sliced).splitlines() if "FileScan" in l and "start_date_key" in l)
    assert re.search(r"DataFilters: \[[^\]]*start_date_key#\d+ >= ", scan)


def test_facts_are_laid_out_by_day(spark, sf_dir):
    facts = open_lakehouse(spark, sf_dir).table("fact_encounter")
    spans = facts.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("start_date_key").alias("lo"), F.max("start_date_key").alias("hi")
    )
    ordered = sorted((r["lo"], r["hi"]) for r in spans.collect())
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))


def test_surrogate_keys_rank_no_row_in_a_single_task(spark, sf_dir):
    text = plan(all_queries()["gold_dim_patient"](spark, sf_dir))
    window = text[text.index("Window ") :]
    assert "_block" in window.splitlines()[0] and "patient_business_key" not in window.splitlines()[0]


def test_totals_by_day_do_not_read_the_fact(spark, sf_dir):
    text = plan(all_queries()["patients_mom_from_days"](spark, sf_dir))
    assert "encounter_days" in text and "patient_sk" not in text and "start_date_key" not in text


def test_a_query_builds_only_the_tables_it_reads(spark, sf_dir):
    from carestrata.plans import dashboard, day_state
    from carestrata.plans.lakehouse import Lakehouse
    from carestrata.registry import star_of

    lh = Lakehouse(spark, sf_dir)
    star = star_of(lh)
    dashboard.encounters_by_age_group(star).collect()
    day_state.encounter_days(star.with_encounters(star.encounters.limit(5))).collect()
    built = set(lh._stored)
    assert {"bronze_patient", "silver_patient", "dim_patient", "gold_dim_patient", "bronze_encounter", "fact_encounter"} <= built
    assert not [t for t in built if "observation" in t or "condition" in t]


def test_partitioned_layers_are_written_by_tasks_of_the_advisory_size(spark, sf_dir):
    from carestrata.plans.lakehouse import Lakehouse

    # without merging of small tasks the few rows here are written as many would be
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        events = Lakehouse(spark, sf_dir).table("bronze_event")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = events.groupBy("ingestion_date", F.col("_metadata.file_path").alias("f")).count()
    assert files.groupBy("ingestion_date").count().agg(F.max("count")).first()[0] > 1
    assert files.agg(F.sum("count")).first()[0] == events.count()
