from __future__ import annotations

import hashlib
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidefold.functions.names import batch_name
from tidefold.operators.checkpoints import latest_checkpoints, resume_checkpoint
from tidefold.operators.fold import fold_log
from tidefold.plans.monitoring import count_tables, lag_minutes
from tidefold.schemas import CHECKPOINT_FILE_SCHEMA, RAW_LOG_SCHEMA
from tidefold.session import broadcast_if_bounded, scratch_path, shared_dir
from tidefold.sources.catalog import catalog_from_payload, catalog_hash, read_catalog, read_schema_file, write_catalog
from tidefold.sources.changelog import read_change_files, read_log, write_load
from tidefold.sources.control import append_checkpoints, read_history
from tidefold.sources.export import append_json_lines
from tidefold.sources.manifest import file_inventory, latest_manifest, read_manifest, read_manifest_document
from tidefold.sources.pages import DELTA, page_summary, pages_after, read_pages, with_checkpoint


def test_foreign_log_files_in_name_order(spark, tmp_path):
    folder = str(tmp_path / "log")
    os.makedirs(folder)
    names = {"delta_tail-100-aa.parquet": ("late?", None), "delta_tail-99-bb.parquet": ("winner", "abc")}
    for name, (text, fingerprint) in names.items():
        part = str(tmp_path / f"part-{name}")
        row = [("", "users", "u1", 7, "upsert", fingerprint, json.dumps({"name": text}))]
        spark.createDataFrame(row, RAW_LOG_SCHEMA).coalesce(1).write.parquet(part)
        [file] = [f for f in os.listdir(part) if f.endswith(".parquet")]
        with open(f"{part}/{file}", "rb") as source, open(f"{folder}/{name}", "wb") as target:
            target.write(source.read())
    with open(f"{folder}/ignore.txt", "w", encoding="utf-8") as handle:
        handle.write("x")
    log = read_change_files(spark, folder)
    assert log.count() == 2
    # Equal timestamps: names decide, as text, so 99 comes after 100.
    winner = fold_log(log).first()
    assert (json.loads(winner["document"])["name"], winner["schema_fingerprint"]) == ("winner", "abc")
    inventory = {r["relative_path"]: r for r in file_inventory(spark, folder).collect()}
    assert sorted(inventory) == sorted(names)
    for name in names:
        with open(f"{folder}/{name}", "rb") as handle:
            content = handle.read()
        assert (inventory[name]["sha256"], inventory[name]["bytes"]) == (hashlib.sha256(content).hexdigest(), len(content))
    with pytest.raises(FileNotFoundError):
        file_inventory(spark, f"{folder}-missing")


def test_unknown_operation_is_an_error(spark, tmp_path):
    path = str(tmp_path / "bad")
    spark.createDataFrame([("", "t", "d", 1, "merge", None, None)], RAW_LOG_SCHEMA).write.parquet(path)
    with pytest.raises(Exception, match="unexpected op value merge"):
        read_change_files(spark, path).collect()


def test_table_filter_prunes_directories(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = [("", t, "d", 1, "upsert", None, "{}", "b", n) for n, t in enumerate(["users", "2024", "Users"])]
    from tidefold.functions.names import directory_key_text
    from tidefold.schemas import LOG_FILE_SCHEMA

    write_load(spark.createDataFrame(rows, LOG_FILE_SCHEMA), log, "one")
    picked = read_log(spark, log).where(F.col("table_key") == directory_key_text("2024"))
    assert [r["table_name"] for r in picked.collect()] == ["2024"]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table_key" in plan


def test_batch_names_follow_the_checkpoint(spark):
    frame = spark.createDataFrame(
        [("initial_snapshot", 17, "at:b/3", None), ("delta_tail", None, None, 905)],
        "phase string, snapshot bigint, cursor string, delta bigint",
    )
    got = [r[0] for r in frame.select(batch_name(F.col("phase"), F.col("snapshot"), F.col("cursor"), F.col("delta"))).collect()]
    first = '{"version":1,"sync_state":{"phase":"initial_snapshot","snapshot":17,"cursor":"at:b/3"}}'
    second = '{"version":1,"sync_state":{"phase":"delta_tail","cursor":905}}'
    assert got == [
        f"initial_snapshot-17-{hashlib.sha256(first.encode()).hexdigest()[:16]}",
        f"delta_tail-905-{hashlib.sha256(second.encode()).hexdigest()[:16]}",
    ]


def test_schema_catalog_round_trip(spark, tmp_path):
    schema = {"type": "object", "properties": {"_creationTime": {"type": "number"}, "age": {"minimum": 1.0, "type": "number"}}}
    landed, stored = str(tmp_path / "schemas.json"), str(tmp_path / "catalog")
    with open(landed, "w", encoding="utf-8") as handle:
        json.dump({"users": schema, "$meta": {}, "empty": {}}, handle, indent=2)
    catalog = read_schema_file(spark, landed)
    assert read_catalog(spark, stored) is None and catalog_hash(None) is None
    write_catalog(catalog, stored)
    rows = {r["table_name"]: r["fingerprint"] for r in read_catalog(spark, stored).collect()}
    text = json.dumps(schema, sort_keys=True, separators=(",", ":"))
    assert rows == {"users": hashlib.sha256(text.encode()).hexdigest(), "empty": hashlib.sha256(b"{}").hexdigest()}
    assert catalog_hash(read_catalog(spark, stored)) == catalog_hash(catalog.repartition(3))
    other = catalog_from_payload(spark.createDataFrame([('{"users":{}}',)], "value string"))
    assert catalog_hash(other) != catalog_hash(catalog)
    assert catalog_from_payload(spark.createDataFrame([("[1]",), ("oops",)], "value string")).isEmpty()


def test_checkpoint_history(spark, tmp_path):
    path = str(tmp_path / "control")
    assert read_history(spark, path).isEmpty()
    steps = spark.createDataFrame(
        [("initial_snapshot", 31, "page/7", None, 0), ("delta_tail", None, None, 64, 1)],
        "phase string, snapshot_ts bigint, snapshot_cursor string, delta_cursor bigint, write_seq bigint",
    )
    append_checkpoints(steps, path, "s", "r", "h")
    newest = resume_checkpoint(read_history(spark, path), "s").first()
    assert (newest["phase"], newest["delta_cursor"], newest["schema_hash"]) == ("delta_tail", 64, "h")
    assert resume_checkpoint(read_history(spark, path), "other").first() is None
    with pytest.raises(Exception, match="unknown checkpoint phase"):
        append_checkpoints(steps.withColumn("phase", F.lit("later")), path, "s", "r")


def test_equal_times_resolve_by_run_and_write(spark):
    at = datetime(2024, 1, 1)
    rows = [
        ("a", "delta_tail", None, None, 1, None, "9", at, 5),
        ("a", "delta_tail", None, None, 2, None, "10", at, 9),
        ("b", "delta_tail", None, None, 3, None, "1", at, 1),
        ("b", "delta_tail", None, None, 4, None, "1", at, 2),
    ]
    history = spark.createDataFrame(rows, CHECKPOINT_FILE_SCHEMA)
    assert {r["source_id"]: r["delta_cursor"] for r in latest_checkpoints(history).collect()} == {"a": 1, "b": 4}


def test_page_bounds(spark, tmp_path):
    folder = str(tmp_path / "deltas")
    os.makedirs(folder)
    with open(f"{folder}/p.json", "w", encoding="utf-8") as handle:
        for cursor in range(1, 7):
            handle.write(json.dumps({"values": [{"n": cursor}] * cursor, "hasMore": cursor not in (4, 6), "cursor": cursor}) + "\n")
    pages = read_pages(spark, folder, DELTA)
    assert tuple(page_summary(pages_after(pages, "cursor", 1, 2), "cursor").first()) == (2, 5, 3, True)
    assert tuple(page_summary(pages_after(pages, "cursor", 1), "cursor").first()) == (3, 9, 4, False)
    assert tuple(page_summary(pages_after(pages, "cursor", 4), "cursor").first()) == (2, 11, 6, False)
    assert tuple(page_summary(pages_after(pages, "cursor", 6), "cursor").first()) == (0, 0, None, False)
    assert tuple(page_summary(pages_after(pages, "cursor", 1, past_ends=True), "cursor").first()) == (5, 20, 6, False)
    with pytest.raises(ValueError):
        pages_after(pages, "cursor", 1, 0)
    snapshot = spark.createDataFrame([(True, 5, None)], "has_more boolean, snapshot bigint, cursor string")
    with pytest.raises(Exception, match="no cursor"):
        with_checkpoint(snapshot, "snapshot").collect()


def test_manifest_document(spark, tmp_path):
    path = str(tmp_path / "latest.json")
    entry = {"relative_path": "_root/a.parquet", "current_key": "c", "versioned_key": "v", "sha256": "s", "bytes": 3}
    with open(path, "w", encoding="utf-8") as handle:
        json.dump({"version": 1, "publish_id": "9", "published_at_epoch_ms": 9, "bucket": "b", "prefix": "p", "tables": {"_root/a.parquet": entry}}, handle, indent=2)
    assert read_manifest_document(spark, path).first().asDict() == {
        "version": 1, "publish_id": "9", "published_at_epoch_ms": 9, "bucket": "b", "prefix": "p", **entry,
    }
    assert read_manifest(spark, str(tmp_path / "none.json")).isEmpty()
    assert latest_manifest(spark, str(tmp_path / "none")).isEmpty()


def test_empty_append_is_a_no_op(spark, tmp_path):
    path = str(tmp_path / "lines")
    empty = spark.createDataFrame([], "a int, b string")
    assert not append_json_lines(empty, path) and not os.path.exists(path)
    assert append_json_lines(spark.createDataFrame([(1, None)], "a int, b string"), path)
    assert [r["value"] for r in spark.read.text(path).collect()] == ['{"a":1}']


def test_lag_and_counts(spark):
    frame = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0),)], "updated_at timestamp")
    assert float(frame.select(lag_minutes("updated_at", datetime(2024, 1, 1, 0, 1, 40))).first()[0]) == 1.67
    assert count_tables(spark, {}).dtypes == [("table_name", "string"), ("row_count", "bigint")]
    counts = count_tables(spark, {"b": spark.range(3), "a": spark.range(0)})
    assert sorted(map(tuple, counts.collect())) == [("a", 0), ("b", 3)]


def test_shared_folder_and_bounded_broadcast(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    small = broadcast_if_bounded(spark.range(5), max_bytes=1000)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    large = broadcast_if_bounded(spark.range(1000), max_bytes=1000)
    assert "broadcast" not in large._jdf.queryExecution().logical().toString().lower()
