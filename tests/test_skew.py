"""A third of the rows under one key: results stay whole and joins may not rely on broadcast."""

import pytest
from pyspark.sql import functions as F

from carestrata.operators import checks, gold, silver
from carestrata.operators.bronze import merge_insert_new, rows_to_insert
from carestrata.plans.star import ENCOUNTER, PATIENT, Star, evaluate
from carestrata.sources.storage import stage

N = 30000


@pytest.fixture(autouse=True)
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(spark, key="k"):
    return spark.range(N).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(key)
    )


def test_dedup_keeps_one_row_per_map_task_before_the_shuffle(spark):
    df = hot(spark).repartition(8)
    out = silver.dedup_latest(df, "k", [F.desc("id")])
    assert out.count() == N - N // 3 + 1
    assert out.filter("k = 'hot'").first()["id"] == N - 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and exchange < partial  # below the exchange, so before it


def split_by_skew(df):
    """Collect ``df`` and tell whether its final plan split a skewed join."""
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_merge_with_a_hot_key_on_both_sides(spark):
    batch = F.when(F.col("id") % 7 == 0, "1").otherwise("0")
    target = stage(hot(spark, "resource_id").withColumn("batch_id", F.when(F.col("resource_id") == "hot", "h").otherwise(batch)), "t")
    moved = F.when((F.col("id") >= N // 2) & (F.col("resource_id") != "hot"), "new").otherwise(F.col("batch_id"))
    source = stage(target.withColumn("batch_id", moved), "s")
    fresh = rows_to_insert(target, source)
    assert split_by_skew(fresh)
    assert fresh.count() == source.filter("batch_id = 'new'").count() == N // 3
    assert merge_insert_new(target, source).count() == N + N // 3


def test_fact_lookup_with_hot_patient_and_hot_null(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string"))
    enc = spark.range(N).select(F.col("id").cast("string").alias("encounter_id"), key.alias("patient_id"))
    for c in ("status", "encounter_class", "encounter_type", "service_provider"):
        enc = enc.withColumn(c, F.sha2("encounter_id", 256))
    enc = enc.withColumns({"period_start": F.lit(None).cast("date"), "period_end": F.lit(None).cast("date")})
    enc = stage(enc.repartition(8), "enc")
    people = enc.select("patient_id").where("patient_id is not null").distinct()
    people = people.select(F.xxhash64("patient_id").alias("patient_sk"), F.col("patient_id").alias("patient_business_key"))
    out = gold.fact_encounter(enc, stage(people, "people"))
    got = out.agg(F.count("*"), F.count("patient_sk"), F.count_distinct("patient_sk")).first()
    assert tuple(got) == (N, 2 * N // 3, N // 3 + 1)
    assert split_by_skew(out)


def test_measure_join_with_a_hot_patient(spark):
    fact = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("patient_sk"),
        F.sha2(F.col("id").cast("string"), 256).alias("status"),
    )
    people = spark.range(N).select(F.col("id").cast("int").alias("patient_sk"), (F.col("id") % 2).alias("gender"))
    star = Star(stage(fact.repartition(8), "f"), None, None, stage(people, "p"), None)
    frame = star.frame(ENCOUNTER, [f"{PATIENT}.gender", f"{ENCOUNTER}.status"])
    assert split_by_skew(frame)
    got = evaluate(star, ["total_encounters", "total_patients"], [f"{PATIENT}.gender"])
    want = fact.join(people, "patient_sk").groupBy("gender").agg(F.count("*"), F.count_distinct("patient_sk"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_orphans_counts_hot_and_null_keys_once_each(spark):
    child = hot(spark).withColumn("k", F.when(F.col("id") % 2 == 0, F.col("k")))
    parent = child.filter("k <> 'hot'").select("k")
    want = child.filter("k is null or k = 'hot'").count()
    assert checks.orphans(child, parent, "k").first()[0] == want
