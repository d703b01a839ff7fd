from __future__ import annotations

import glob
import json
import os

from pyspark.sql import functions as F

from tidefold.plans.staging import (
    MAX_BUCKETS,
    buckets_for,
    drop_old_versions,
    materialise,
    read_staging,
    schema_catalog_path,
    staging_inventory,
    staging_tables,
)
from tidefold.schemas import LOG_FILE_SCHEMA
from tidefold.sources.catalog import catalog_from_payload, write_catalog
from tidefold.sources.changelog import load_ids, read_log, write_load


def event(component, table, document_id, timestamp, document, op=None, batch="b", position=0, fingerprint="abc"):
    text = None if document is None else json.dumps(document, sort_keys=True, separators=(",", ":"))
    operation = op or ("delete" if document is None else "upsert")
    return (component, table, document_id, timestamp, operation, fingerprint, text, batch, position)


def frame(spark, rows):
    return spark.createDataFrame(rows, LOG_FILE_SCHEMA)


def first_batch():
    return [
        event("", "boats", "b7", 3, {"port": "Lund"}, batch="s-1", position=0),
        event("", "boats", "b8", 4, {"port": "Oslo", "draft": 4}, batch="s-1", position=1),
        event("", "boats", "b9", 4, {"port": "Kiel", "draft": 2}, batch="s-1", position=2),
        event("yard/dock", "repairs", "r1", 5, {"done": False}, batch="s-1", position=3),
    ]


def second_batch():
    return [
        event("", "boats", "b9", 8, None, batch="t-2", position=0),
        event("", "boats", "b7", 9, {"draft": 3.25, "crew": ["Mia", 2], "port": "Umeå"}, batch="t-2", position=1),
    ]


def test_current_state_tables(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "staging")
    write_load(frame(spark, first_batch()), log, "one")
    write_load(frame(spark, second_batch()), log, "two")
    summary = materialise(spark, log, root)
    assert summary.mode == "full_rebuild"
    assert (summary.files_read, summary.events_read) == (2, 6)
    assert (summary.tables_materialized, summary.rows_materialized) == (2, 3)

    boats = read_staging(spark, root, "", "boats")
    assert boats.columns[5:] == ["crew", "draft", "port", "_document_json"]
    assert [(r["_document_id"], r["crew"], r["draft"], r["port"]) for r in boats.orderBy("_document_id").collect()] == [
        ("b7", '["Mia",2]', 3.25, "Umeå"), ("b8", None, 4.0, "Oslo"),
    ]
    assert [t["relative_path"] for t in staging_tables(spark, root)] == ["_root/boats.parquet", "yard/dock/repairs.parquet"]


def test_replaced_load_is_staged_again(spark, tmp_path):
    """A run that died, was staged, and is repeated under its name with more pages."""
    log, root = str(tmp_path / "log"), str(tmp_path / "staging")
    write_load(frame(spark, first_batch()[:2]), log, "one")
    assert materialise(spark, log, root).rows_materialized == 2
    write_load(frame(spark, first_batch()[1:]), log, "one")
    again = materialise(spark, log, root)
    assert (again.mode, again.events_read, again.rows_materialized) == ("full_rebuild", 3, 3)
    assert materialise(spark, log, root).affected_tables == 0


def test_names_that_differ_in_case_have_columns_of_their_own(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "staging")
    write_load(frame(spark, [
        event("", "odd", "d", 1, {"Name": 1, "name": "x", "NAME": True, "name__2": 5, "_Timestamp": 9}),
        event("", "plain", "d", 1, {"a": 1}),
    ]), log, "one")
    assert materialise(spark, log, root).tables_materialized == 2
    row = read_staging(spark, root, "", "odd").first().asDict()
    assert (row["NAME"], row["Name__3"], row["name__4"], row["name__2"], row["_Timestamp__2"]) == (True, 1, "x", 5, 9)


def test_incremental_touches_only_affected_tables(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "staging")
    payload = json.dumps({
        "boats": {"properties": {"port": {"type": "string"}}},
        "repairs": {"type": "object", "properties": {"_creationTime": {"type": "number"}, "part": {"type": "string"}}},
    })
    catalog = catalog_from_payload(spark.createDataFrame([(payload,)], "value string"))
    write_catalog(catalog, schema_catalog_path(log))
    write_load(frame(spark, [event("", "boats", "b7", 3, {"port": "Lund"}, batch="b1")]), log, "one")
    assert load_ids(spark, log) == ["one"]
    first = materialise(spark, log, root)
    assert (first.mode, first.tables_materialized) == ("full_rebuild", 1)
    before = staging_tables(spark, root)[0]

    write_load(frame(spark, [event("yard", "repairs", "r1", 5, {"part": "keel"}, batch="b2")]), log, "two")
    second = materialise(spark, log, root)
    assert second.mode == "incremental"
    assert (second.files_read, second.events_read, second.new_raw_files) == (2, 2, 1)
    assert (second.affected_tables, second.tables_materialized, second.rows_materialized) == (1, 1, 1)
    assert staging_tables(spark, root)[0] == before
    repairs = read_staging(spark, root, "yard", "repairs")
    assert repairs.columns[5:] == ["_creationTime", "part", "_document_json"]
    assert dict(repairs.dtypes)["_creationTime"] == "double"

    idle = materialise(spark, log, root)
    assert (idle.mode, idle.files_read, idle.affected_tables) == ("incremental", 0, 0)

    extended = payload.replace('"part": {"type": "string"}', '"part": {"type": "string"}, "n": {"type": "integer"}')
    write_catalog(catalog_from_payload(spark.createDataFrame([(extended,)], "value string")), schema_catalog_path(log))
    rebuilt = materialise(spark, log, root)
    assert (rebuilt.mode, rebuilt.tables_materialized) == ("full_rebuild", 2)
    assert dict(read_staging(spark, root, "yard", "repairs").dtypes)["n"] == "bigint"
    assert drop_old_versions(spark, root) > 0
    assert read_staging(spark, root, "", "boats").count() == 1


def test_emptied_table_and_late_upsert(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "staging")
    write_load(frame(spark, [event("", "t", "d", 10, {"a": 1}, batch="b1"), event("", "u", "d", 10, {"a": 1}, batch="b1")]), log, "1")
    materialise(spark, log, root)
    write_load(frame(spark, [event("", "t", "d", 30, None, batch="b2")]), log, "2")
    summary = materialise(spark, log, root)
    assert (summary.affected_tables, summary.tables_materialized, summary.rows_materialized) == (1, 1, 0)
    assert [t["table_name"] for t in staging_tables(spark, root)] == ["u"]
    # An older upsert that arrives later must not bring the document back.
    write_load(frame(spark, [event("", "t", "d", 20, {"a": 2}, batch="b3")]), log, "3")
    materialise(spark, log, root)
    assert [t["table_name"] for t in staging_tables(spark, root)] == ["u"]


def test_incremental_equals_full(spark, tmp_path, sf_dir):
    log, step, full = (str(tmp_path / name) for name in ("log", "step", "full"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    doc = F.to_json(F.struct("l_partkey", "l_quantity", "l_shipdate"))
    events = lines.select(
        F.lit("").alias("component_path"),
        F.when(F.col("l_linestatus") == "F", "filled").otherwise("open").alias("table_name"),
        F.col("l_orderkey").cast("string").alias("document_id"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        F.when(F.col("l_returnflag") == "R", "delete").otherwise("upsert").alias("op"),
        F.lit(None).cast("string").alias("schema_fingerprint"),
        F.when(F.col("l_returnflag") != "R", doc).alias("document"),
        F.year("l_shipdate").cast("string").alias("batch"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("position"),
    )
    years = sorted(row["batch"] for row in events.select("batch").distinct().collect())
    for year in reversed(years):
        write_load(events.where(F.col("batch") == year), log, year)
        materialise(spark, log, step)
    materialise(spark, log, full, incremental=False)
    keys = ["relative_path", "sha256", "bytes"]
    stepwise = staging_inventory(spark, step).select(keys).orderBy("relative_path").collect()
    at_once = staging_inventory(spark, full).select(keys).orderBy("relative_path").collect()
    assert stepwise == at_once and len(at_once) == 2


def test_replay_replaces_a_load(spark, tmp_path):
    log = str(tmp_path / "log")
    assert write_load(frame(spark, first_batch()), log, "one")
    assert write_load(frame(spark, first_batch()), log, "one")
    assert read_log(spark, log).count() == 4
    assert not write_load(frame(spark, []), log, "empty")
    assert load_ids(spark, log) == ["one"]


def _state_files(root):
    return {p for p in glob.glob(f"{root}/state/**/*.parquet", recursive=True)}


def _typed_files(root):
    return {p for p in glob.glob(f"{root}/tables/**/part-*.parquet", recursive=True)}


def _many(n, **more):
    return [event("", "boats", f"b{i}", i + 1, {"draft": i, **more}, batch="m", position=i) for i in range(n)]


def test_one_changed_document_rewrites_one_bucket(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "staging")
    write_load(frame(spark, _many(200) + [event("", "other", "o", 1, {"x": 1})]), log, "one")
    materialise(spark, log, root, bucket_bytes=200)
    state, typed = _state_files(root), _typed_files(root)
    assert len(state) > 8
    write_load(frame(spark, [event("", "boats", "b17", 900, {"draft": 5000}, batch="n")]), log, "two")
    summary = materialise(spark, log, root, bucket_bytes=200)
    assert (summary.mode, summary.affected_tables, summary.rows_materialized) == ("incremental", 1, 200)
    new_state, new_typed = _state_files(root) - state, _typed_files(root) - typed
    assert len({os.path.dirname(p) for p in new_state}) == 1 and len({os.path.dirname(p) for p in new_typed}) == 1
    rows = {r["_document_id"]: r["draft"] for r in read_staging(spark, root, "", "boats").collect()}
    assert rows == {f"b{i}": 5000 if i == 17 else i for i in range(200)}


def test_columns_of_untouched_buckets(spark, tmp_path):
    """An added column touches one bucket, another type or a column that goes the whole table; no state is rewritten for it."""
    log, root, full = (str(tmp_path / name) for name in ("log", "staging", "full"))
    write_load(frame(spark, _many(100, name="x")), log, "0")
    materialise(spark, log, root, bucket_bytes=200)
    n_buckets = len({os.path.dirname(p) for p in _state_files(root)})
    changes = [{"draft": 1, "name": "y", "crew": 3}, {"draft": 1.5, "name": "y", "crew": 3}, {"draft": 1.5, "name": "y"}, None]
    written = []
    for at, document in enumerate(changes, 1):
        state, typed = _state_files(root), _typed_files(root)
        write_load(frame(spark, [event("", "boats", "b3", 500 + at, document, batch="n")]), log, str(at))
        materialise(spark, log, root, bucket_bytes=200)
        assert len({os.path.dirname(p) for p in _state_files(root) - state}) == 1
        written.append(len({os.path.dirname(p) for p in _typed_files(root) - typed}))
        got = read_staging(spark, root, "", "boats")
        materialise(spark, log, full, incremental=False, bucket_bytes=1000)
        wanted = read_staging(spark, full, "", "boats")
        assert got.dtypes == wanted.dtypes and sorted(got.collect()) == sorted(wanted.collect())
        keys = ["relative_path", "sha256", "bytes"]
        assert staging_inventory(spark, root).select(keys).collect() == staging_inventory(spark, full).select(keys).collect()
    assert n_buckets > 4 and written == [1, n_buckets, n_buckets, n_buckets]


def test_a_table_that_outgrew_its_buckets_is_split(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "staging")
    write_load(frame(spark, _many(4)), log, "one")
    materialise(spark, log, root, bucket_bytes=200)
    assert staging_tables(spark, root)[0]["n_buckets"] == 1
    write_load(frame(spark, _many(300)[4:] + [event("", "boats", "b0", 999, None)]), log, "two")
    materialise(spark, log, root, bucket_bytes=200)
    (table,) = staging_tables(spark, root)
    assert table["n_buckets"] > 4 and table["rows"] == 299 and buckets_for(1 << 60, 200) == MAX_BUCKETS
    assert read_staging(spark, root, "", "boats").count() == 299
    assert drop_old_versions(spark, root) > 0 and read_staging(spark, root, "", "boats").count() == 299
