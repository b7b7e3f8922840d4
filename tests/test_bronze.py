import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.operators import bronze, checks
from carestrata.schemas import page_schema, resource_schema
from carestrata.sources import landing

DAY = "2024-03-01"


def patients(spark, n, prefix="p"):
    data = [(f"{prefix}{i}", "male", "1990-01-01", [], [], None, True) for i in range(n)]
    whole = spark.createDataFrame(data, resource_schema("patient"))
    return whole.select(F.struct("*").alias("resource"))


def land(spark, root, n, batch="b1", **more):
    return landing.land_batch(
        patients(spark, n),
        root,
        "patient",
        batch_id=batch,
        ingestion_date=DAY,
        extraction_timestamp="2024-03-01T00:00:00+00:00",
        api_url="http://x",
        **more,
    )


def write_foreign(root, batch, pages, files=None, manifest=True):
    """A batch folder as another tool writes it, with _manifest.json inside."""
    folder = f"{root}/patient/ingestion_date={DAY}/batch_id={batch}"
    os.makedirs(folder)
    names = []
    for i, entries in enumerate(pages, 1):
        names.append(f"page_{i:04d}.json")
        meta = {
            "extraction_timestamp": "2024-03-01T00:00:00+00:00",
            "api_url": "http://x",
            "resource_type": "Patient",
            "batch_id": batch,
            "page_number": i,
        }
        bundle = {} if entries is None else {"entry": entries}
        with open(f"{folder}/{names[-1]}", "w") as f:
            json.dump({"_extraction_metadata": meta, "fhir_bundle": bundle}, f, indent=2)
    if manifest:
        body = {"batch_id": batch, "resource_type": "Patient", "page_count": len(pages)}
        body["total_records"] = sum(len(entries or []) for entries in pages)
        body["files"] = names if files is None else files
        with open(f"{folder}/_manifest.json", "w") as f:
            f.write(json.dumps(body) if manifest is True else manifest)


def entry(ident, **body):
    return {"fullUrl": f"http://x/Patient/{ident}", "resource": {"id": ident, **body}}


def test_land_and_read_back(spark, tmp_path):
    root = str(tmp_path)
    manifest = land(spark, root, 120).first()
    assert (manifest["page_count"], manifest["total_records"], len(manifest["files"])) == (3, 120, 3)
    pages = landing.read_pages(spark, root, "patient", ingestion_date=DAY)
    exploded = bronze.explode_pages(pages)
    assert exploded.count() == 120
    assert exploded.select("entry.resource.id").distinct().count() == 120
    sizes = sorted(r[0] for r in pages.select(F.size("fhir_bundle.entry")).collect())
    assert sizes == [20, 50, 50]


def test_relanding_a_batch_replaces_it(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, 120)
    land(spark, root, 60)
    pages = landing.read_pages(spark, root, "patient", ingestion_date=DAY)
    assert bronze.explode_pages(pages).count() == 60
    assert landing.read_manifests(spark, root, "patient").count() == 1


def test_other_days_are_pruned(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, 10)
    pages = landing.read_pages(spark, root, "patient", ingestion_date="2024-03-02")
    assert pages.count() == 0
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_manifest_rules(spark, tmp_path):
    root = str(tmp_path)
    one = [entry("p1")]
    write_foreign(root, "good", [one, one])
    write_foreign(root, "missing", [one], files=["page_0001.json", "page_0002.json"])
    write_foreign(root, "extra", [one, one], files=["page_0001.json"])
    write_foreign(root, "bad", [one], manifest="{oops")
    write_foreign(root, "none", [one], manifest=False)
    manifests = landing.folder_manifests(spark, root, "patient", DAY)
    files = landing.list_files(spark, f"{root}/patient")
    valid = landing.valid_batches(manifests, files)
    assert [r["batch_id"] for r in valid.collect()] == ["good"]
    status = {r["batch_id"]: r["is_valid"] for r in landing.batch_status(manifests, files).collect()}
    assert status == {"good": True, "missing": False, "extra": False, "bad": False, "none": False}


def test_no_valid_batch_is_an_error(spark, tmp_path):
    root = str(tmp_path)
    write_foreign(root, "bad", [[entry("p1")]], manifest="{oops")
    valid = landing.valid_batches(
        landing.folder_manifests(spark, root, "patient", DAY), landing.list_files(spark, f"{root}/patient")
    )
    with pytest.raises(ValueError, match="no valid batches"):
        landing.require_batches(valid, "patient", DAY)


def test_indented_pages_and_missing_entry(spark, tmp_path):
    root = str(tmp_path)
    write_foreign(root, "b1", [[entry("p1", gender="male"), entry("p2")], [], None])
    pages = landing.read_pages(spark, root, "patient", ingestion_date=DAY, multi_line=True)
    assert pages.count() == 3
    got = bronze.explode_pages(pages)
    assert sorted(r[0] for r in got.select("entry.resource.id").collect()) == ["p1", "p2"]
    assert "page_0001.json" in got.first()["file_name"]


def test_census_shows_zero_for_missing(spark, tmp_path):
    land(spark, str(tmp_path), 5)
    found = {r[0]: r[1] for r in landing.folder_census(spark, str(tmp_path), ["Patient", "Encounter"]).collect()}
    assert found == {"patient": 1, "encounter": 0}


def bronze_of(spark, data):
    return spark.createDataFrame(data, "resource_id string, batch_id string, v int")


def test_merge_is_idempotent(spark, rows):
    target = bronze_of(spark, [("a", "1", 1), ("b", "1", 2)])
    source = bronze_of(spark, [("a", "1", 9), ("a", "2", 3), ("c", "1", 4)])
    once = bronze.merge_insert_new(target, source)
    assert rows(once) == [("a", "1", 1), ("a", "2", 3), ("b", "1", 2), ("c", "1", 4)]
    assert rows(bronze.merge_insert_new(once, source)) == rows(once)


def test_null_keys_insert_and_can_be_split_off(spark):
    target = bronze_of(spark, [(None, "1", 1)])
    source = bronze_of(spark, [(None, "1", 1), ("a", "1", 2)])
    assert bronze.merge_insert_new(target, source).count() == 3
    keyed, missing = bronze.split_null_keys(source)
    assert (keyed.count(), missing.count()) == (1, 1)


def test_merge_adds_nested_and_top_level_fields(spark):
    old = spark.createDataFrame([("a", "1", (1,))], "resource_id string, batch_id string, d struct<x:int>")
    new = spark.createDataFrame([("b", "1", (1, 2), 3)], "resource_id string, batch_id string, d struct<x:int,y:int>, z int")
    merged = bronze.merge_insert_new(old, new)
    assert merged.schema["d"].dataType.fieldNames() == ["x", "y"]
    assert {r["resource_id"]: (r["d"]["y"], r["z"]) for r in merged.collect()} == {"a": (None, None), "b": (2, 3)}


def test_drift_paths():
    old = T.StructType(
        [
            T.StructField("a", T.ArrayType(T.StructType([T.StructField("x", T.IntegerType())]))),
            T.StructField("gone", T.StringType()),
            T.StructField("t", T.IntegerType()),
        ]
    )
    new = T.StructType(
        [
            T.StructField(
                "a",
                T.ArrayType(
                    T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.ArrayType(T.StringType()))])
                ),
            ),
            T.StructField("t", T.StringType()),
        ]
    )
    assert bronze.schema_drift(old, new) == [
        ("a[].y[]", "NEW", "string"),
        ("gone", "MISSING", "string"),
        ("t", "TYPE_CHANGED", "int -> string"),
    ]


def test_drift_report_counts_rows_with_a_value(spark, rows):
    old = spark.createDataFrame([("k",)], "id string")
    new = spark.createDataFrame(
        [("a", [([("q",)],)], ["s"]), ("b", [], []), ("c", None, None), ("d", [([(None,)],)], ["t"])],
        "id string, deep array<struct<in:array<struct<leaf:string>>>>, tags array<string>",
    )
    got = rows(bronze.drift_report(old, new))
    assert got == [("deep[].in[].leaf", "NEW", "string", 1), ("tags[]", "NEW", "string", 2)]
    assert bronze.drift_report(old, old).count() == 0


def test_lifecycle_events():
    one = T.StructType([T.StructField("a", T.StringType())])
    two = T.StructType([T.StructField("b", T.StringType())])
    assert bronze.lifecycle_events("t", "r", "b1", None, one)[0][0] == "TABLE_CREATED"
    names = [e for e, _ in bronze.lifecycle_events("t", "r", "b1", one, two)]
    assert names == ["SCHEMA_DRIFT_NEW_COLUMNS", "SCHEMA_DRIFT_MISSING_COLUMNS"]
    assert bronze.lifecycle_events("t", "r", "b1", one, one) == []


def test_lookback_is_inclusive(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 11)], "day date")
    got = [r[0].day for r in bronze.lookback(df, "day", dt.date(2024, 1, 10)).collect()]
    assert got == [7, 8, 9, 10]


def test_checks_find_planted_rows(spark, rows):
    df = spark.createDataFrame(
        [("a", "1", None), ("a", "1", "s"), ("b", "1", "s")], "resource_id string, batch_id string, source_system string"
    )
    assert rows(checks.duplicate_keys(df)) == [("a", "1", 2)]
    assert checks.rows_missing_lineage(df, ["batch_id", "source_system"]).first()[0] == 1


def test_page_schema_accepts_a_struct():
    assert page_schema(T.StructType([T.StructField("id", T.StringType())])).fieldNames()[0] == "_extraction_metadata"


def test_an_empty_extraction_leaves_a_manifest_without_files(spark, tmp_path):
    land(spark, f"{tmp_path}/raw", 0)
    manifest = landing.read_manifests(spark, f"{tmp_path}/raw", "patient").first()
    assert (manifest["page_count"], manifest["total_records"], manifest["files"]) == (0, 0, [])


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_landed_text_is_the_json_of_the_entries(spark, tmp_path, compression):
    """Any text survives the page files, each line of which is one JSON document."""
    import glob
    import gzip

    texts = ["a,b", 'q"u\\o\'te', "tab\tline\r\nend", "\x00\x01\x7f", "ü€𝄞", '{"a":1}', " sp ", "", None]
    data = [(f"p{i}", t, t, [(t, [t])], [], (t,), None) for i, t in enumerate(texts)]
    rows = spark.createDataFrame(data, resource_schema("patient")).select(F.struct("*").alias("resource")).coalesce(1)
    how = {"batch_id": "b", "ingestion_date": DAY, "extraction_timestamp": "t", "api_url": "http://x", "page_size": 2}
    landing.land_batch(rows, str(tmp_path), "patient", pages_per_file=2, compression=compression, **how)
    files = glob.glob(f"{tmp_path}/patient/*/*/part-*.json{'.gz' if compression == 'gzip' else ''}")
    opened = gzip.open if compression == "gzip" else open
    lines = [json.loads(line) for f in files for line in opened(f, "rt", encoding="utf-8", newline="\n").read().splitlines()]
    assert len(files) == 3 and sorted(p["_extraction_metadata"]["page_number"] for p in lines) == [1, 2, 3, 4, 5]
    held = {e["resource"]["id"]: e for p in lines for e in p["fhir_bundle"]["entry"]}
    assert [held[f"p{i}"]["resource"].get("gender") for i in range(len(texts))] == texts
    assert held["p0"]["fullUrl"] == "http://x/Patient/p0" and "active" not in held["p0"]["resource"]
    back = bronze.explode_pages(landing.read_pages(spark, str(tmp_path), "patient", ingestion_date=DAY))
    got = {r[0]: r[1] for r in back.select("entry.resource.id", F.expr("entry.resource.name[0].family")).collect()}
    assert [got[f"p{i}"] for i in range(len(texts))] == texts
