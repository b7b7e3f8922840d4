import glob
import os
import shutil
import time

from pyspark.sql import functions as F
from test_bronze import DAY, land

from carestrata.operators.bronze import bronze_rows, explode_pages
from carestrata.sources import landing
from carestrata.sources.storage import stage
from carestrata.streaming.bronze_stream import read_reports, stream_bronze, stream_complete_batches
from carestrata.streaming.complete_batches import batch_reports, use_state_store, waiting_batches


def ingest(spark, root, tmp_path, state="state"):
    stream_bronze(
        spark,
        root,
        "patient",
        f"{tmp_path}/bronze",
        f"{tmp_path}/{state}",
        source_system="S",
        api_url="http://x",
        max_files=2,
    )
    return spark.read.parquet(f"{tmp_path}/bronze")


def test_increments_equal_the_batch_result(spark, tmp_path):
    root = f"{tmp_path}/raw"
    land(spark, root, 120, "b1")
    assert ingest(spark, root, tmp_path).count() == 120
    land(spark, root, 70, "b2")
    got = ingest(spark, root, tmp_path)
    pages = landing.read_pages(spark, root, "patient", ingestion_date=DAY)
    want = bronze_rows(explode_pages(pages), source_system="S", api_url="http://x", ingestion_date=DAY)
    keys = ["resource_id", "batch_id", "resource_json", "ingestion_date"]
    assert got.select(keys).exceptAll(want.select(keys)).count() == 0
    assert want.select(keys).exceptAll(got.select(keys)).count() == 0


def test_replay_from_a_lost_checkpoint_adds_nothing(spark, tmp_path):
    root = f"{tmp_path}/raw"
    land(spark, root, 60, "b1")
    assert ingest(spark, root, tmp_path, "first").count() == 60
    assert ingest(spark, root, tmp_path, "second").count() == 60



def complete(spark, root, tmp_path, max_files=2):
    places = [f"{tmp_path}/{name}" for name in ("bronze", "state", "reports")]
    stream_complete_batches(spark, root, "patient", *places, source_system="S", api_url="http://x", max_files=max_files)
    told = sorted((r["status"], r["batch_id"], r["files_listed"], r["files_found"]) for r in read_reports(spark, places[2]).collect())
    waiting = {r["batch_id"]: (r["files_listed"], r["files_found"]) for r in waiting_batches(spark, places[1]).collect()}
    rows = spark.read.parquet(places[0]) if os.path.exists(places[0]) else None
    return rows, told, waiting


def hide(source, target, name=""):
    """Move what ``name`` selects out of a landing folder and return how to bring it back."""
    moved = []
    for path in glob.glob(f"{source}/**/*{name}*.json", recursive=True):
        aside = path.replace(source, target)
        os.makedirs(os.path.dirname(aside), exist_ok=True)
        shutil.move(path, aside)
        moved.append((aside, path))
    return lambda: [shutil.move(a, b) for a, b in moved]


def test_incomplete_batches_wait(spark, tmp_path):
    """A missing page, a late manifest, and a restart of the stream between every step."""
    root = f"{tmp_path}/raw"
    land(spark, root, 120, "b1")
    page = sorted(glob.glob(f"{root}/patient/*/batch_id=b1/*.json"))[1]
    bring_page = hide(root, f"{tmp_path}/aside", os.path.basename(page)[:-5])
    land(spark, root, 60, "b2")
    bring_manifest = hide(f"{root}/manifests/patient/for_date={DAY}/for_batch=b2", f"{tmp_path}/aside2")
    rows, told, waiting = complete(spark, root, tmp_path)
    assert rows is None and told == [] and waiting == {"b1": (3, 2), "b2": (0, 2)}
    bring_manifest()
    rows, told, waiting = complete(spark, root, tmp_path)
    assert rows.count() == 60 and told == [("COMPLETE", "b2", 2, 2)] and waiting == {"b1": (3, 2)}
    bring_page()
    rows, told, waiting = complete(spark, root, tmp_path)
    assert told == [("COMPLETE", "b1", 3, 3), ("COMPLETE", "b2", 2, 2)] and waiting == {}
    pages = landing.read_pages(spark, root, "patient", ingestion_date=DAY)
    want = bronze_rows(explode_pages(pages), source_system="S", api_url="http://x", ingestion_date=DAY)
    keys = ["resource_id", "batch_id", "resource_json", "ingestion_date"]
    assert rows.count() == want.count() == 180
    assert want.select(keys).exceptAll(rows.select(keys)).count() == 0


def test_extra_files_unreadable_pages_and_new_manifests(spark, tmp_path):
    root = f"{tmp_path}/raw"
    land(spark, root, 60, "b1")
    folder = f"{root}/patient/ingestion_date={DAY}"
    shutil.copy(glob.glob(f"{folder}/batch_id=b1/*.json")[0], f"{folder}/batch_id=b1/extra.json")
    land(spark, root, 60, "b2")
    broken = glob.glob(f"{folder}/batch_id=b2/*.json")[0]
    with open(broken, "r+") as f:
        f.truncate(40)
    os.remove(f"{os.path.dirname(broken)}/.{os.path.basename(broken)}.crc")
    rows, told, waiting = complete(spark, root, tmp_path, 100)
    assert rows is None and told == [("COMPLETE", "b2", 2, 2), ("REFUSED", "b2", 2, 2)] and waiting == {"b1": (2, 3)}
    # a manifest that lists the extra file replaces the first one
    listed = landing.read_manifests(spark, root, "patient").filter("batch_id = 'b1'")
    listed = listed.withColumns({"files": F.array_append("files", F.lit("extra.json")), "total_records": F.lit(110).cast("bigint")})
    landing.write_manifest(stage(listed, "manifest"), root, "patient")
    rows, told, waiting = complete(spark, root, tmp_path, 100)
    assert ("COMPLETE", "b1", 3, 3) in told and waiting == {} and rows.select("resource_id").distinct().count() == 60
    shutil.copy(f"{folder}/batch_id=b1/extra.json", f"{folder}/batch_id=b1/later.json")
    rows, told, waiting = complete(spark, root, tmp_path, 100)
    assert ("CHANGED_AFTER_COMPLETION", "b1", 3, 4) in told and rows.select("resource_id").distinct().count() == 60


def test_a_running_stream_reports_batches_that_wait(spark, tmp_path):
    root = f"{tmp_path}/raw"
    land(spark, root, 60, "b1")
    os.remove(glob.glob(f"{root}/patient/*/batch_id=b1/*.json")[0])
    use_state_store(spark)
    reports = batch_reports(spark, root, "patient", patience_seconds=0.5)
    query = reports.writeStream.format("memory").queryName("waiting").option("checkpointLocation", f"{tmp_path}/s").trigger(processingTime="0 seconds").start()
    try:
        for _ in range(60):
            time.sleep(0.5)
            if told := spark.table("waiting").collect():
                break
    finally:
        query.stop()
    assert (told[0]["status"], told[0]["files_listed"], told[0]["files_found"]) == ("WAITING", 2, 1)


def test_packed_pages_are_read_and_numbering_leaves_no_copy(spark, tmp_path):
    root = str(tmp_path / "raw")
    people = spark.range(120).select(F.struct(F.concat(F.lit("p"), "id").alias("id"), F.lit("male").alias("gender")).alias("resource"))
    kept = f"{spark.conf.get('spark.checkpoint.dir')}/carestrata/{spark.sparkContext.applicationId}"
    before = set(glob.glob(f"{kept}/key-_n-*"))
    landing.land_batch(
        people, root, "patient", batch_id="b1", ingestion_date="2024-01-01", extraction_timestamp="2024-01-01T06:00:00+00:00", api_url="u", compression="gzip"
    )
    assert set(glob.glob(f"{kept}/key-_n-*")) == before
    packed = glob.glob(f"{root}/patient/**/*.json.gz", recursive=True)
    assert len(packed) == 3
    entries = landing.page_entries(landing.read_pages(spark, root, "patient", ingestion_date="2024-01-01", raw=True))
    assert entries.filter("entry IS NOT NULL AND NOT _unreadable").count() == 120
    manifests, files = landing.read_manifests(spark, root, "patient"), landing.list_files(spark, landing.resource_root(root, "patient"))
    assert landing.valid_batches(manifests, files).count() == 1


def test_arriving_folders_move_whole(spark, tmp_path):
    from types import SimpleNamespace

    from carestrata.registry import _arrive

    for place in ("patient/ingestion_date=1/batch_id=a", "patient/ingestion_date=1/batch_id=b", "manifests/patient/for_date=1/for_batch=a"):
        os.makedirs(f"{tmp_path}/from/{place}")
        for i in range(3):
            open(f"{tmp_path}/from/{place}/{i}.json", "w").close()
    _arrive(SimpleNamespace(spark=spark), f"{tmp_path}/from", f"{tmp_path}/to", "batch_id=a/|for_batch=a/")
    moved = {p.split("/to/", 1)[1] for p in glob.glob(f"{tmp_path}/to/**/*.json", recursive=True)}
    assert moved == {f"{d}/{i}.json" for d in ("patient/ingestion_date=1/batch_id=a", "manifests/patient/for_date=1/for_batch=a") for i in range(3)}
    assert not glob.glob(f"{tmp_path}/from/patient/ingestion_date=1/batch_id=a")


def test_names_of_many_files_share_a_micro_batch():
    import inspect

    from carestrata.streaming.bronze_stream import stream_complete_batches

    assert inspect.signature(stream_complete_batches).parameters["max_files"].default >= 100_000
