import datetime as dt

import pytest
from pyspark.sql import functions as F

from carestrata.operators import checks
from carestrata.plans.views import create_views
from carestrata.sources import tables
from carestrata.sources.storage import split_limit, stage


def test_replace_may_read_the_table_it_replaces(spark, database):
    name = f"{database}.t"
    tables.replace_table(spark.range(5), name)
    tables.replace_table(spark.table(name).withColumn("twice", F.col("id") * 2), name)
    assert spark.table(name).agg(F.sum("twice")).first()[0] == 20
    assert spark.table(name).columns == ["id", "twice"]


def test_old_versions_go_when_asked(spark, database):
    name = f"{database}.t"
    for n in (1, 2, 3):
        tables.replace_table(spark.range(n), name)
    assert tables.drop_old_versions(spark, name) == 0  # readers may still be on them
    assert tables.drop_old_versions(spark, name, 0) == 2
    assert tables.drop_old_versions(spark, name, 0) == 0
    assert spark.table(name).count() == 3


def test_interrupted_swap_is_finished(spark, database):
    name = f"{database}.t"
    tables.replace_table(spark.range(4), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__next")  # as if stopped before the rename
    tables.finish_swap(spark, name)
    tables.finish_swap(spark, name)
    assert spark.table(name).count() == 4


def test_partitioned_replace_keeps_types(spark, database):
    name = f"{database}.t"
    df = spark.createDataFrame([(1, True, dt.date(2024, 1, 1)), (2, False, None)], "id int, flag boolean, d date")
    tables.replace_table(df, name, ["flag", "d"])
    assert {f.name: f.dataType.simpleString() for f in spark.table(name).schema} == {
        "id": "int",
        "flag": "boolean",
        "d": "date",
    }
    assert spark.table(name).filter("flag and d = date'2024-01-01'").count() == 1
    assert checks.is_partitioned_by(spark, name, ["flag", "d"])


def test_overwrite_only_touched_partitions(spark, database):
    name = f"{database}.t"
    tables.create_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string"), name, ["p"])
    tables.overwrite_table_partitions(spark.createDataFrame([(9, "b")], "id int, p string"), name)
    assert sorted((r["id"], r["p"]) for r in spark.table(name).collect()) == [(1, "a"), (9, "b")]


def test_append_and_evolve(spark, database):
    name = f"{database}.t"
    tables.create_partitioned(spark.createDataFrame([(1, "a")], "id int, p string"), name, ["p"])
    tables.evolve_and_append(spark.createDataFrame([("b", 2)], "p string, id int"), name)
    tables.evolve_and_append(spark.createDataFrame([(3, "c", 7.0)], "id int, p string, more double"), name)
    assert sorted((r["id"], r["p"], r["more"]) for r in spark.table(name).collect()) == [
        (1, "a", None),
        (2, "b", None),
        (3, "c", 7.0),
    ]
    assert checks.is_partitioned_by(spark, name, ["p"])


def test_quarantine_rerun_does_not_double(spark, tmp_path):
    rejected = spark.createDataFrame([(None, "x")], "id string, ingestion_date string")
    for day in ("2024-01-01", "2024-01-01", "2024-01-02"):
        tables.write_quarantine(rejected, str(tmp_path), "Patient", day)
    back = spark.read.schema("id string, ingestion_date string").json(f"{tmp_path}/patient")
    assert sorted(r["ingestion_date"] for r in back.collect()) == ["2024-01-01", "2024-01-02"]


def test_compaction_keeps_every_row(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("p"))
    df.repartition(8).write.partitionBy("p").parquet(path)
    schema = "id bigint, p string"
    tables.compact(spark, path, schema, "p")
    after = spark.read.schema(schema).parquet(path)
    assert sorted(tuple(r) for r in after.collect()) == sorted(tuple(r) for r in df.collect())
    detail = tables.table_detail(after, ["p"]).collect()
    assert [r["num_files"] for r in detail] == [1, 1, 1]
    first = {r["_p"] for r in after.select(F.col("_metadata.file_path").alias("_p")).distinct().collect()}
    tables.compact(spark, path, schema, "p")
    again = spark.read.schema(schema).parquet(path).select(F.col("_metadata.file_path").alias("_p")).distinct()
    assert {r["_p"] for r in again.collect()} == first  # nothing left to do


def test_compaction_deals_a_large_partition_over_files(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "id bigint, p string"
    spark.range(20000).select("id", F.lit("x").alias("p")).repartition(12).write.partitionBy("p").parquet(path)
    size = tables.table_detail(spark.read.schema(schema).parquet(path)).first()["size_in_bytes"]
    tables.compact(spark, path, schema, "p", target_bytes=size // 4)
    after = spark.read.schema(schema).parquet(path)
    assert after.select("id").distinct().count() == 20000


def test_compact_table_leaves_other_partitions(spark, database):
    name = f"{database}.t"
    df = spark.range(300).select("id", (F.col("id") % 3).cast("string").alias("p"))
    tables.create_partitioned(df.repartition(6), name, ["p"])
    tables.compact_table(spark, name, "p", ["1"])
    files = {r["p"]: r["num_files"] for r in tables.table_detail(spark.table(name), ["p"]).collect()}
    assert files["1"] == 1 and files["0"] > 1 and files["2"] > 1
    assert spark.table(name).exceptAll(df).count() == 0 and spark.table(name).count() == 300


def test_catalog_helpers(spark, database):
    spark.sql(f"USE {database}")
    try:
        tables.replace_table(spark.range(3), f"{database}.bronze_patient")
        tables.replace_table(spark.range(3), f"{database}.silver_patient")
        listed = tables.list_tables(spark, "bronze_", database)
        assert [r[0] for r in listed.collect()] == ["bronze_patient"]
        assert tables.tolerant_counts(spark, [f"{database}.bronze_patient", f"{database}.absent"]) == {
            f"{database}.bronze_patient": 3,
            f"{database}.absent": None,
        }
    finally:
        spark.sql("USE default")


def test_run_log_rules(spark):
    now = dt.datetime(2024, 1, 1)
    row = tables.run_log_row(spark, run_id="r", pipeline_name="p", status="SUCCESS", log_timestamp=now)
    assert row.first()["records_processed"] is None and len(row.columns) == 12
    with pytest.raises(ValueError):
        tables.run_log_row(spark, run_id="r", pipeline_name="p", status="DONE", log_timestamp=now)
    with pytest.raises(Exception, match="(?i)null"):
        tables.run_log_row(spark, pipeline_name="p", status="SUCCESS", log_timestamp=now).collect()


def test_active_resources(spark):
    config = tables.resource_config(spark)
    assert [r["resource_type"] for r in tables.active_resources(config).collect()] == [
        "Patient",
        "Encounter",
        "Observation",
        "Condition",
    ]
    off = config.withColumn("active_flag", F.col("load_order") != 2)
    assert tables.active_resources(off).count() == 3


def test_views_equal_the_dataframe_plans(spark, sf_dir, database):
    from carestrata.plans.lakehouse import open_lakehouse

    lake = open_lakehouse(spark, sf_dir)
    for name in ("fact_encounter", "fact_observation", "gold_dim_patient", "gold_dim_condition", "dim_date"):
        lake.table(name).createOrReplaceTempView("_src")
        tables.replace_table(lake.table(name), f"{database}.{name}")
    for view in create_views(spark, database):
        want = lake.derive(view.split(".")[1])
        assert spark.table(view).exceptAll(want).count() == 0
        assert want.exceptAll(spark.table(view)).count() == 0


@pytest.mark.parametrize("stop", ["DROP TABLE IF EXISTS", "RENAME TO {}__prev", "RENAME TO {}", "never"])
def test_an_interrupted_swap_loses_nothing(spark, database, monkeypatch, stop):
    """Stop a replacement before each of its catalog steps; the next run finds a complete table, and a later swap works."""
    name = f"{database}.t"
    tables.replace_table(spark.range(3), name)
    real, stop = spark.sql, stop.format(name)

    def sql(text, *args, **kw):
        if text.endswith(stop) or text == f"{stop} {name}__prev":
            raise RuntimeError("stopped")
        return real(text, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(spark, "sql", sql, raising=False)
        if stop == "never":
            tables.replace_table(spark.range(5), name)
        else:
            with pytest.raises(RuntimeError):
                tables.replace_table(spark.range(5), name)
    tables.finish_swap(spark, name)
    assert spark.table(name).count() in (3, 5)
    tables.drop_old_versions(spark, name, 0)
    assert spark.table(name).count() in (3, 5)
    tables.replace_table(spark.range(7), name)
    assert spark.table(name).count() == 7


def test_a_wider_batch_leaves_stored_files_alone(spark, database, rows):
    """New fields at the top, in a struct and in an array of structs; a second append needs no further change."""
    name = f"{database}.wide"
    first = spark.sql("SELECT 1 AS id, named_struct('a', 1, 'end', 'x') AS s, array(named_struct('k', 1)) AS l, 'd1' AS p")
    tables.create_partitioned(first, name, ["p"])
    held = {r[0] for r in spark.table(name).select("_metadata.file_path").collect()}
    more = spark.sql("SELECT 2 AS id, named_struct('end', 'y', 'b', 2.5D) AS s, array(named_struct('k', 3, 'm', 'z')) AS l, 7 AS n, 'd2' AS p")
    for _ in range(2):
        tables.evolve_and_append(more, name)
    got = spark.table(name)
    assert held < {r[0] for r in got.select("_metadata.file_path").collect()}
    old = ("d1", 1, 1, "x", None, 1, None, None)
    new = ("d2", 2, None, "y", 2.5, 3, "z", 7)
    assert rows(got.selectExpr("p", "id", "s.a", "s.end", "s.b", "l[0].k", "l[0].m", "n")) == [old, new, new]
    assert tables.partition_columns(spark, name) == ["p"] and not tables.table_exists(spark, f"{name}__prev")
    with pytest.raises(ValueError, match="l\\[\\].k is int in the table and string in the batch"):
        tables.evolve_and_append(spark.sql("SELECT array(named_struct('k', 'text')) AS l, 'd3' AS p"), name)
    assert tables.drop_old_versions(spark, name, 0) == 0 and spark.table(name).count() == 3


def test_census_of_missing_tables(spark, database, rows):
    tables.replace_table(spark.range(3), f"{database}.held")
    names = [f"{database}.held", f"{database}.absent"]
    assert rows(tables.tolerant_census(spark, names)) == [(names[1], None), (names[0], 3)] or rows(
        tables.tolerant_census(spark, names)
    ) == [(names[0], 3), (names[1], None)]
    assert rows(tables.tolerant_census(spark, names[1:])) == [(names[1], None)]


def test_compaction_writes_each_file_in_a_task_of_its_own(spark, tmp_path):
    path, day = str(tmp_path / "t"), F.concat(F.lit("d"), F.col("id") % 12)
    spark.range(0, 1200, 1, 3).withColumn("day", day).write.partitionBy("day").parquet(path)
    packed = tables._packed(spark.read.schema("id bigint, day string").parquet(path), "day", tables.TARGET_BYTES, 2)
    per_task = packed.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("day").alias("days"), F.count("*").alias("n"))
    assert [(r["days"], r["n"]) for r in per_task.collect()] == [(1, 100)] * 12


def test_writers_of_small_files_follow_the_rows(spark):
    from carestrata.registry import _ROWS_PER_WRITER, _writers

    assert [_writers(spark.range(n)) for n in (0, 10, 6 * _ROWS_PER_WRITER + 1)] == [6, 6, 7]


def test_split_limit_bounds_what_a_map_task_reads_and_is_undone(spark):
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).repartition(1)
    stored = stage(rows, "wide", compression="zstd", **{"parquet.block.size": str(1 << 20)})
    assert all(".zstd." in f for f in stored.inputFiles())
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)

    def most():
        per_task = stored.select("h", F.spark_partition_id().alias("p")).groupBy("p").count()
        return per_task.agg(F.max("count")).first()[0]

    with split_limit(spark, 1 << 20):
        assert most() < 50_000
        with split_limit(spark, 1 << 40):
            assert spark.conf.get(key) == str(1 << 20)
    assert spark.conf.get(key) == before


def test_stored_views_store_each_fact_once(spark, sf_dir):
    from carestrata import registry
    from carestrata.plans.lakehouse import Lakehouse

    lake = Lakehouse(spark, sf_dir)
    database = registry._stored_star(lake)
    assert "gold_dim_patient" in lake._stored and not {"fact_encounter", "fact_observation"} & set(lake._stored)
    for name in ("fact_encounter", "fact_observation", "gold_dim_condition"):
        stored, want = spark.table(f"{database}.{name}"), lake.derive(name)
        assert stored.exceptAll(want).count() == 0 and want.exceptAll(stored).count() == 0
    lake.table("fact_encounter")
    assert lake.rows("fact_encounter") is lake.table("fact_encounter")
    spark.sql(f"DROP DATABASE {database} CASCADE")
