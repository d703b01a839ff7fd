"""Landed pages through ingest, staging, publish, bronze and silver."""

from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tidefold.operators.checkpoints import resume_checkpoint
from tidefold.operators.infer import project_bronze
from tidefold.operators.select import required_flow_tables
from tidefold.plans import publish as publish_plan
from tidefold.plans.ingest import bronze_sink, load_name, log_sink, save_catalog, sync_once
from tidefold.plans.publish import manifests_path, needs_publish, publish, register_published_views
from tidefold.plans.service import ServicePaths, run_rounds
from tidefold.plans.staging import read_staging, staging_inventory
from tidefold.sources.bronze import append_bronze, bronze_columns, colliding_targets, read_bronze, read_bronze_rows, stream_bronze_rows
from tidefold.sources import landing as landing_index
from tidefold.sources.changelog import read_log
from tidefold.sources.control import read_history
from tidefold.sources.landing import index_path, read_index, refresh_index
from tidefold.sources.manifest import latest_manifest
from tidefold.sources.pages import read_pages, stream_pages
from tidefold.sources.views import list_tables, quoted
from tidefold.streaming import ingest as stream_ingest
from tidefold.streaming import flows, keyed, silver


def doc(identifier, ts, table="users", component="", deleted=False, **fields):
    value = {"_component": component, "_table": table, "_id": identifier, "_ts": ts, **fields}
    if deleted:
        value["_deleted"] = True
    return value


def land(folder, name, values, has_more, cursor, snapshot=None):
    os.makedirs(folder, exist_ok=True)
    page = {"values": values, "hasMore": has_more, "cursor": cursor}
    if snapshot is not None:
        page["snapshot"] = snapshot
    with open(f"{folder}/{name}", "w", encoding="utf-8") as handle:
        handle.write(json.dumps(page) + "\n")


@pytest.fixture
def landing(tmp_path):
    base = str(tmp_path / "landing")
    land(f"{base}/snapshot", "p1.json", [doc("u1", 10, name="Ada", age=1.0), doc("u2", 11, name="Ben")], True, "c1", 100)
    land(f"{base}/snapshot", "p2.json", [doc("e1", 12, "events", "workflow", kind="queued", _x=1)], False, None, 100)
    land(f"{base}/deltas", "d1.json", [doc("u1", 120, name="Ada L", age=2, tags=["b", 1.0])], True, 130)
    land(f"{base}/deltas", "d2.json", [doc("u2", 140, deleted=True)], False, 150)
    with open(f"{base}/schemas.json", "w", encoding="utf-8") as handle:
        json.dump({"users": {"type": "object", "properties": {"name": {"type": "string"}, "zip": {"type": ["string", "null"]}}}, "$x": {}}, handle)
    return base


def test_sync_staging_publish(spark, tmp_path, landing):
    log, control, staging, bucket = (str(tmp_path / n) for n in ("log", "control", "staging", "bucket"))
    paths = ServicePaths(landing, log, control, staging, bucket, "/exports/")
    first, second = run_rounds(spark, paths, "s1", "r1", 2)
    assert (first.sync.snapshot_pages_fetched, first.sync.delta_pages_fetched, first.sync.events_written) == (2, 2, 5)
    assert first.sync.final_checkpoint["delta_cursor"] == 150
    assert (first.publish.tables_total, first.publish.tables_uploaded) == (2, 2)
    assert second.sync.events_written == 0 and second.publish is None

    history = read_history(spark, control, "s1")
    assert [r["phase"] for r in history.orderBy("updated_at", "write_seq").collect()] == ["initial_snapshot"] + ["delta_tail"] * 3
    users = read_staging(spark, staging, "", "users").collect()
    assert len(users) == 1
    assert users[0].asDict() | {"_schema_fingerprint": None} == {
        "_component_path": "", "_table_name": "users", "_document_id": "u1", "_timestamp": 120, "_schema_fingerprint": None,
        "age": 2, "name": "Ada L", "tags": '["b",1.0]', "zip": None,
        "_document_json": '{"age":2,"name":"Ada L","tags":["b",1.0]}',
    }
    assert users[0]["_schema_fingerprint"] is not None

    land(f"{landing}/deltas", "d3.json", [doc("e1", 160, "events", "workflow", deleted=True), doc("j1", 161, "jobs", n=1)], False, 170)
    third = run_rounds(spark, paths, "s1", "r2", 1)[0]
    assert (third.staging.mode, third.staging.affected_tables, third.staging.new_raw_files) == ("incremental", 2, 1)
    assert (third.publish.tables_uploaded, third.publish.tables_deleted, third.publish.tables_unchanged) == (1, 1, 1)
    manifest = latest_manifest(spark, manifests_path(bucket, "exports"))
    entries = {r["relative_path"]: r for r in manifest.collect()}
    assert set(entries) == {"_root/jobs.parquet", "_root/users.parquet"}
    assert first.publish.publish_id in entries["_root/users.parquet"]["versioned_key"]
    assert third.publish.publish_id in entries["_root/jobs.parquet"]["versioned_key"]
    assert not os.path.exists(f"{bucket}/exports/staging/current/workflow/events.parquet")
    assert register_published_views(spark, bucket, "exports") == ["jobs", "users"]
    assert spark.sql("select name from users").collect()[0]["name"] == "Ada L"
    assert [r["ordinal"] for r in spark.table("__source_map").orderBy("ordinal").collect()] == [0, 1]
    assert not needs_publish(spark, staging_inventory(spark, staging), bucket, "exports")
    again = publish(spark, staging_inventory(spark, staging), bucket, "exports")
    assert (again.tables_uploaded, again.tables_unchanged) == (0, 2)


def test_resume_after_partial_snapshot(spark, tmp_path, landing):
    log, control = str(tmp_path / "log"), str(tmp_path / "control")
    catalog = save_catalog(spark, landing, log)
    args = (spark, landing, log_sink(log), catalog, control, "s1", "r1")
    one = sync_once(*args, max_pages=1)
    assert (one.snapshot_pages_fetched, one.final_checkpoint["phase"]) == (1, "initial_snapshot")
    two = sync_once(*args, max_pages=1)
    assert (two.snapshot_pages_fetched, two.delta_pages_fetched) == (1, 1)
    rest = sync_once(*args)
    assert (rest.snapshot_pages_fetched, rest.delta_pages_fetched) == (0, 1)
    assert read_log(spark, log).count() == 5
    with pytest.raises(ValueError):
        sync_once(*args, max_pages=0)


def test_table_filter_and_quarantine(spark, tmp_path, landing):
    log, control, bad = (str(tmp_path / n) for n in ("log", "control", "bad"))
    catalog = save_catalog(spark, landing, log)
    only = sync_once(spark, landing, log_sink(log), catalog, control, "s1", "r1", table="events")
    assert only.events_written == 1
    land(f"{landing}/deltas", "d3.json", [doc("u3", "bad"), {"_table": "users"}, 7], False, 170)
    with pytest.raises(ValueError, match="quarantine mode"):
        sync_once(spark, landing, log_sink(log), catalog, control, "s1", "r1", on_error="quarantine")
    with pytest.raises(Exception, match="bad source document"):
        sync_once(spark, landing, log_sink(log), catalog, control, "s1", "r1")
    done = sync_once(spark, landing, log_sink(log), catalog, control, "s1", "r1", on_error="quarantine", quarantine=bad)
    assert done.events_written == 0
    errors = sorted(r["error"] for r in spark.read.parquet(bad).collect())
    assert errors == ["invalid:_ts", "missing:_component", "not_an_object"]


def test_bronze_and_silver(spark, tmp_path, landing):
    log, control, bronze, store = (str(tmp_path / n) for n in ("log", "control", "bronze", "silver"))
    land(f"{landing}/deltas", "d2.json", [doc("u2", 140, deleted=True, _creationTime=5.5), doc("u9", 141, age=True, name=True, flag=False)], False, 150)
    catalog = save_catalog(spark, landing, log)
    sync_once(spark, landing, bronze_sink(bronze, "s1", "r1"), catalog, control, "s1", "r1")
    columns = {name: kind for name, kind, _ in bronze_columns(spark, bronze, "src__app__users__cdc")}
    assert columns == {"age": "double", "flag": "boolean", "name": "string", "tags": "string"}
    users = read_bronze(spark, bronze, "src__app__users__cdc")
    assert users.columns == sorted(users.columns)
    rows = {(r["_cdc_document_id"], r["_cdc_sequence_num"]): r for r in users.collect()}
    assert rows["u9", 141]["age"] == 1.0 and rows["u9", 141]["name"] == "True"
    deleted = rows["u2", 140]
    assert deleted["_cdc_is_deleted"] and deleted["_cdc_raw_document_json"] is None and deleted["_cdc_creation_time"] == 5.5
    assert colliding_targets(read_bronze_rows(spark, bronze)).isEmpty()

    table = silver.silver_table(store)
    query = silver.start(stream_bronze_rows(spark, bronze, max_files=1), table, str(tmp_path / "cp"))
    query.awaitTermination()
    current = read_silver_rows(spark, table, bronze, "src__app__users__cdc")
    assert current == {"u1": ("Ada L", 2.0), "u9": ("True", 1.0)}
    # An older change that arrives in a later load loses against the tombstone.
    land(f"{landing}/deltas", "d3.json", [doc("u2", 130, name="late")], False, 190)
    sync_once(spark, landing, bronze_sink(bronze, "s1", "r2"), catalog, control, "s1", "r2")
    silver.start(stream_bronze_rows(spark, bronze, max_files=1), table, str(tmp_path / "cp")).awaitTermination()
    assert read_silver_rows(spark, table, bronze, "src__app__users__cdc") == current
    table.compact(spark, force=True)
    assert table.drop_folded(spark) > 0
    assert read_silver_rows(spark, table, bronze, "src__app__users__cdc") == current


_ODD = [
    '{"a":1,"b":1.0,"c":"x","d":true,"e":{"z":1.0,"a":[1,"q"]},"f":null,"it\'s":1,"p.q":"dot","B":7}',
    '{"a":true,"b":2,"c":5,"d":false,"e":[1.50,{}],"f":1,"it\'s":2.5,"p.q":"1","g":12345678901234567890}',
    '{"a":-7,"b":1e300,"c":"True","d":null,"e":"text","f":"t","h":1.5,"k":{"deep":{"x":null}}}',
    '{"c":true,"h":"1.0","e":2.0,"k":"[]"}', '{}', '[1,2]', '"plain"', None,
]


def test_bronze_fields_equal_what_documents_say(spark, tmp_path):
    root, target = str(tmp_path / "bronze"), "src__app__odd__cdc"
    rows = [("", "odd", f"d{i}", i, "delete" if d is None else "upsert", None, d, "b", i, 1.5) for i, d in enumerate(_ODD)]
    events = spark.createDataFrame(rows, "component_path string, table_name string, document_id string, timestamp long, op string, "
                                         "schema_fingerprint string, document string, batch string, position long, creation_time double")
    for load, part in enumerate((events.where("position < 1"), events.where("position >= 1"))):
        append_bronze(part, root, str(load), "s", "r")
    columns = bronze_columns(spark, root, target)
    assert {name: kind for name, kind, _ in columns}["h"] == "string" and len(columns) == 12
    stored = read_bronze_rows(spark, root).where(F.col("target") == target)
    wanted = project_bronze(stored, "_cdc_raw_document_json", columns, ["position"]).orderBy("position")
    got = read_bronze(spark, root, target, with_order=True).select([F.col(quoted(c)) for c in wanted.columns]).orderBy("position")
    assert got.dtypes == wanted.dtypes and got.collect() == wanted.collect()


def test_one_field_is_one_column(spark, tmp_path):
    root = str(tmp_path / "bronze")
    events = spark.range(50).selectExpr(
        "'' as component_path", "'t' as table_name", "cast(id as string) as document_id", "id as timestamp", "'upsert' as op",
        "cast(null as string) as schema_fingerprint", "concat('{\"n\":', id, ',\"o\":{\"a\":', id, '}}') as document", "'b' as batch",
        "id as position", "cast(null as double) as creation_time",
    )
    append_bronze(events, root, "1", "s", "r")
    for field, kind, total in (("n", "bigint", 1225), ("o", "string", None)):
        rows = read_bronze(spark, root, "src__app__t__cdc").select(field)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "parse_json" not in plan and f"ReadSchema: struct<_cdc_fields:struct<0:{kind}>>" in plan
        assert total is None or rows.agg(F.sum(field)).first()[0] == total


def read_silver_rows(spark, table, bronze, target):
    rows = silver.read_silver(spark, table, bronze, target).collect()
    return {r["_cdc_document_id"]: (r["name"], r["age"]) for r in rows}


def test_streaming_ingest_equals_batch(spark, tmp_path, landing):
    log, streamed, control = (str(tmp_path / n) for n in ("log", "streamed", "control"))
    catalog = save_catalog(spark, landing, log)
    for kind in ("snapshot", "delta"):
        pages = stream_pages(spark, f"{landing}/{'snapshot' if kind == 'snapshot' else 'deltas'}", kind, max_files=1)
        stream_ingest.start(pages, kind, log_sink(streamed), catalog, f"{control}2", "s1", "r1", str(tmp_path / f"cp-{kind}")).awaitTermination()
    sync_once(spark, landing, log_sink(log), catalog, control, "s1", "r1")
    drop = ["load_id"]
    batch = sorted(map(str, read_log(spark, log).drop(*drop).collect()))
    stream = sorted(map(str, read_log(spark, streamed).drop(*drop).collect()))
    assert batch == stream and len(batch) == 5
    assert read_history(spark, f"{control}2").count() == 4


def test_backlog_of_polls_is_drained_in_one_run(spark, tmp_path, landing):
    """Every landed poll ends in a page without more; idle polls repeat a cursor."""
    for n in range(12):
        land(f"{landing}/deltas", f"e{n:02d}.json", [doc(f"n{n}", 200 + n)], False, 200 + n)
        land(f"{landing}/deltas", f"e{n:02d}-idle.json", [], False, 200 + n)
    log, control = str(tmp_path / "log"), str(tmp_path / "control")
    args = (spark, landing, log_sink(log), save_catalog(spark, landing, log), control, "s1", "r1")
    done = sync_once(*args)
    assert (done.delta_pages_fetched, done.events_written, done.final_checkpoint["delta_cursor"]) == (26, 17, 211)
    assert sync_once(*args).events_written == 0


def test_a_second_run_opens_new_files_only(spark, tmp_path, landing, monkeypatch):
    opened = []

    def counted(spark, path, kind, *more):
        frame = read_pages(spark, path, kind, *more)
        opened.append((kind, sorted(os.path.basename(f) for f in frame.inputFiles())))
        return frame

    monkeypatch.setattr(landing_index, "read_pages", counted)
    log, control = str(tmp_path / "log"), str(tmp_path / "control")
    args = (spark, landing, log_sink(log), save_catalog(spark, landing, log), control, "s1", "r1")
    first = sync_once(*args)
    assert first.snapshot_pages_fetched == 2 and {kind for kind, _ in opened} == {"snapshot", "delta"}
    opened.clear()
    assert sync_once(*args).events_written == 0 and opened == []
    land(f"{landing}/deltas", "x 1[2].json", [doc("n1", 300)], False, 300)
    land(f"{landing}/deltas", "y%2.json", [doc("n2", 301)], False, 301)
    done = sync_once(*args)
    assert (done.delta_pages_fetched, done.events_written) == (2, 2)
    assert opened == [("delta", ["x%201%5B2%5D.json", "y%252.json"])] * 2
    # Another source reads the same index and all pages.
    opened.clear()
    assert sync_once(*args[:-2], "s2", "r1").events_written == first.events_written + 2
    assert len(opened) == 2


def test_a_refresh_twice_counts_once(spark, tmp_path, landing):
    path = index_path(str(tmp_path / "control"), f"{landing}/deltas", "delta")
    assert refresh_index(spark, f"{landing}/deltas", "delta", path) > 0
    once = sorted(read_index(spark, path, "delta").collect())
    rows = spark.read.parquet(path).withColumn("refresh", F.lit("zz"))
    rows.write.mode("append").parquet(path)
    assert sorted(read_index(spark, path, "delta").collect()) == once
    assert refresh_index(spark, f"{landing}/deltas", "delta", path) == 0


def test_load_names_do_not_collide():
    starts = ("after-1769724309738171280", "after-1784114922098870447")
    names = {load_name("delta", source, start) for source in ("app", "ap") for start in starts}
    assert len(names) == 4 and load_name("delta", "app", starts[0]) in names


def stream_deltas(spark, landing, sink, catalog, control, source, checkpoint, **options):
    pages = stream_pages(spark, f"{landing}/deltas", "delta", max_files=1)
    stream_ingest.start(pages, "delta", sink, catalog, control, source, "r1", checkpoint, **options).awaitTermination()


def test_two_streams_share_a_log(spark, tmp_path, landing):
    log, control = str(tmp_path / "log"), str(tmp_path / "control")
    catalog = save_catalog(spark, landing, log)
    with pytest.raises(Exception, match="wait for its snapshot"):
        stream_deltas(spark, landing, log_sink(log), catalog, control, "a", str(tmp_path / "cp-early"))
    for source in ("a", "b"):
        pages = stream_pages(spark, f"{landing}/snapshot", "snapshot")
        stream_ingest.start(pages, "snapshot", log_sink(log), catalog, control, source, "r1", str(tmp_path / f"cp-s{source}")).awaitTermination()
        stream_deltas(spark, landing, log_sink(log), catalog, control, source, str(tmp_path / f"cp-{source}"))
    assert read_log(spark, log).count() == 10
    # A new checkpoint folder reads the pages again; the checkpoint does not go back.
    before = read_history(spark, control, "a").count()
    stream_deltas(spark, landing, log_sink(log), catalog, control, "a", str(tmp_path / "cp-again"))
    assert read_log(spark, log).count() == 12 and read_history(spark, control, "a").count() == before
    land(f"{landing}/deltas", "d9.json", [doc("u5", 300), 7], False, 300)
    bad = str(tmp_path / "bad")
    stream_deltas(spark, landing, log_sink(log), catalog, control, "a", str(tmp_path / "cp-a"), on_error="quarantine", quarantine=bad)
    assert [r["error"] for r in spark.read.parquet(bad).collect()] == ["not_an_object"]


def test_silver_after_a_checkpoint_reset(spark, tmp_path):
    """A stream that starts over adds its changes, also behind a compacted base."""
    source, table = str(tmp_path / "source"), silver.ChangeTable(str(tmp_path / "silver"), ["target", "k"], ["seq"], "gone")
    schema = "target string, k string, seq bigint, gone boolean"

    def feed(rows, checkpoint):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        silver.start(stream, table, str(tmp_path / checkpoint), compact=False).awaitTermination()

    feed([("t", "k0", 1, False), ("007", "k1", 1, False)], "cp1")
    feed([("t", "k2", 1, False), ("t", "k0", 2, True)], "cp1")
    table.compact(spark, force=True)
    feed([("t", "k9", 3, False), ("007", "k1", 0, True)], "cp2")
    want = {("t", "k2"), ("007", "k1"), ("t", "k9")}
    assert {(r["target"], r["k"]) for r in table.current(spark).collect()} == want
    table.compact(spark, force=True)
    assert table.drop_folded(spark) > 0
    one = table.current(spark, F.col("target") == "007")
    assert [r["k"] for r in one.collect()] == ["k1"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(target" in plan


def test_publish_that_dies_leaves_the_views_whole(spark, tmp_path, landing, monkeypatch):
    names = ("log", "control", "staging", "bucket")
    paths = ServicePaths(landing, *(str(tmp_path / n) for n in names), "x")
    run_rounds(spark, paths, "s1", "r1", 1)
    register_published_views(spark, paths.bucket, "x")
    before = sorted(map(str, spark.table("users").collect()))
    land(f"{landing}/deltas", "d3.json", [doc("u1", 160, name="Zoe")], False, 170)
    real = publish_plan._copy
    calls = []

    def dying(session, origin, target):
        def copy():
            calls.append(target)
            if "/current/" in target:
                session.range(0).selectExpr("id AS broken").write.mode("overwrite").parquet(target)
                raise ConnectionError("lost half way")
            real(session, origin, target)()
        return copy

    monkeypatch.setattr(publish_plan, "_copy", dying)
    with pytest.raises(ConnectionError):
        run_rounds(spark, paths, "s1", "r2", 1)
    assert any("/current/" in target for target in calls)
    assert sorted(map(str, spark.table("users").collect())) == before
    register_published_views(spark, paths.bucket, "x")
    assert [r["name"] for r in spark.table("users").collect()] == ["Zoe"]


def test_views_are_registered_with_their_times(spark, tmp_path, landing):
    paths = ServicePaths(landing, *(str(tmp_path / n) for n in ("log", "control", "staging", "bucket")), "x")
    run_rounds(spark, paths, "s1", "r1", 1)
    registry = str(tmp_path / "registry")
    allowed = spark.createDataFrame([(str(tmp_path),)], "url string")
    for _ in range(2):
        assert register_published_views(spark, paths.bucket, "x", locations=allowed, registry=registry) == ["users", "workflow__events"]
    times = {r["table_name"]: r for r in list_tables(spark, registry=registry).collect()}
    assert times["users"]["created"] < times["users"]["last_altered"]
    with pytest.raises(Exception, match="no location covers"):
        register_published_views(spark, paths.bucket, "x", locations=allowed.withColumn("url", F.lit("s3://elsewhere")))
    with pytest.raises(ValueError, match="no bronze table"):
        required_flow_tables(list_tables(spark))


def test_deltas_that_come_first_are_parked(spark, tmp_path, landing):
    """Deltas land and are streamed before the snapshot, some of them again after a restart; the result equals batch."""
    log, streamed, control, parked = (str(tmp_path / n) for n in ("log", "streamed", "control", "parked"))
    catalog = save_catalog(spark, landing, log)
    early = [log_sink(streamed), catalog, f"{control}2", "s1"]
    for attempt in ("cp-delta", "cp-delta", "cp-other"):
        stream_deltas(spark, landing, *early, str(tmp_path / attempt), parked=parked)
    assert read_history(spark, f"{control}2").count() == 0
    assert len(glob.glob(f"{parked}/*/batch=*/_SUCCESS")) == 4
    pages = stream_pages(spark, f"{landing}/snapshot", "snapshot", max_files=1)
    stream_ingest.start(pages, "snapshot", *early, "r1", str(tmp_path / "cp-snapshot"), parked=parked).awaitTermination()
    assert glob.glob(f"{parked}/*/batch=*") == []
    sync_once(spark, landing, log_sink(log), catalog, control, "s1", "r1")
    batch = set(map(str, read_log(spark, log).drop("load_id").collect()))
    assert set(map(str, read_log(spark, streamed).drop("load_id").collect())) == batch
    ends = [resume_checkpoint(read_history(spark, c), "s1").first()["delta_cursor"] for c in (control, f"{control}2")]
    assert ends[0] == ends[1]
    # Later deltas are written as they come.
    land(f"{landing}/deltas", "late.json", [doc("n1", 300)], False, 300)
    stream_deltas(spark, landing, *early, str(tmp_path / "cp-delta"), parked=parked)
    assert resume_checkpoint(read_history(spark, f"{control}2"), "s1").first()["delta_cursor"] == 300
    assert glob.glob(f"{parked}/*/batch=*") == []


def test_keyed_state_applies_late_and_repeated_changes(spark, tmp_path):
    def changes(name, rows):
        made = [("t", "", "users", d, ts, batch, at, doc is None, doc) for d, ts, batch, at, doc in rows]
        spark.createDataFrame(made, keyed.CHANGE_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def run():
        stream = spark.readStream.schema(keyed.CHANGE_SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
        keyed.start(stream.parquet(f"{tmp_path}/in"), str(tmp_path / "cp"), str(tmp_path / "feed")).awaitTermination()
        return {r["document_id"]: r["document"] for r in keyed.current(spark, str(tmp_path / "cp")).collect()}

    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    changes("1", [("a", 5, "b", 0, "five"), ("b", 5, "b", 1, "B"), ("c", 1, "b", 2, "C"), ("a", 4, "b", 3, "four")])
    changes("2", [("b", 9, "c", 0, None), ("a", 5, "b", 0, "five")])
    assert run() == {"a": "five", "c": "C"}
    # After a restart: a late change behind a tombstone, ties by batch and position, a document that comes back.
    changes("3", [("b", 7, "d", 0, "late"), ("a", 5, "b", 1, "tie"), ("c", 2, "d", 0, None), ("d", 1, "d", 0, "new")])
    assert run() == {"a": "tie", "d": "new"}
    changes("4", [("b", 10, "e", 0, "again")])
    assert run() == {"a": "tie", "b": "again", "d": "new"}
    feed = spark.read.parquet(str(tmp_path / "feed"))
    assert feed.where("document_id = 'b'").count() == 3 and feed.where("document = 'late'").count() == 0
    assert keyed.entries(spark, str(tmp_path / "cp")).where("deleted").count() == 1
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_queries_follow_the_selection(spark, tmp_path):
    bronze, root = str(tmp_path / "bronze"), str(tmp_path / "flows")
    kinds = "component_path string, table_name string, document_id string, timestamp long, op string, schema_fingerprint string, " \
            "document string, batch string, position long, creation_time double"

    def load(name, *rows):
        made = [("", table, d, ts, "upsert" if doc else "delete", None, doc, "b", i, None) for i, (table, d, ts, doc) in enumerate(rows)]
        append_bronze(spark.createDataFrame(made, kinds), bronze, name, "s", "r")

    def select(*tables):
        names = [(f"src__app__{t}__cdc", f"autocdc_{t}") for t in tables]
        return spark.createDataFrame(names, "table_name string, flow_name string")

    def have(table):
        rows = flows.flow_table(root, f"autocdc_{table}").current(spark)
        return {} if rows is None else {r["_cdc_document_id"]: r["_cdc_raw_document_json"] for r in rows.collect()}

    load("1", ("a", "x", 1, "one"), ("b", "x", 1, "one"))
    live = flows.sync_flows(spark, select("a", "b"), bronze, root, continuous_every="1 second")
    assert sorted(live) == ["autocdc_a", "autocdc_b"] == sorted(flows.running(spark, root))
    for query in live.values():
        query.processAllAvailable()
    assert have("a") == have("b") == {"x": "one"}
    # Not selected any more: its query stops, the other one stays the same query.
    assert flows.sync_flows(spark, select("a"), bronze, root, continuous_every="1 second") == {}
    assert list(flows.running(spark, root)) == ["autocdc_a"] and not live["autocdc_b"].isActive and live["autocdc_a"].isActive
    load("2", ("a", "y", 2, "two"), ("b", "x", 3, None), ("b", "y", 2, "two"))
    live["autocdc_a"].processAllAvailable()
    assert have("a") == {"x": "one", "y": "two"} and have("b") == {"x": "one"}
    flows.sync_flows(spark, select(), bronze, root)
    assert flows.running(spark, root) == {}
    # Selected again, it goes on where it stopped.
    (again,) = flows.sync_flows(spark, select("b"), bronze, root).values()
    again.awaitTermination()
    assert have("b") == {"y": "two"} and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
