from pyspark.sql import Window
from pyspark.sql import functions as F

from carestrata.operators.keys import dense_key


def test_equals_global_row_number(spark, rows):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id").repartition(7)
    want = df.withColumn("sk", F.row_number().over(Window.orderBy("k")))
    assert rows(dense_key(df, "k", "sk").select("k", "id", "sk")) == rows(want)


def test_null_key_sorts_first(spark, rows):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert rows(dense_key(df, "k", "sk")) == rows(spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, sk int"))


def test_common_prefix_and_many_blocks(spark):
    df = spark.range(3000).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("k")).repartition(16)
    got = [r["k"] for r in dense_key(df, "k", "sk").orderBy("sk").collect()]
    assert got == sorted(f"p{i}" for i in range(3000))


def test_arrival_order_is_dense_without_sort(spark):
    df = spark.range(0, 1000, 1, 9)
    numbered = dense_key(df, None, "n", "bigint")
    assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 1001))
    assert numbered.select("id").distinct().count() == 1000


def test_empty(spark):
    assert dense_key(spark.createDataFrame([], "k string"), "k", "sk").count() == 0


def test_stable_when_read_twice(spark, rows):
    keyed = dense_key(spark.range(100).select(F.col("id").cast("string").alias("k")), "k", "sk")
    assert rows(keyed) == rows(keyed)
