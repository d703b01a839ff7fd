"""Whole flows: landed pages, stored layers, incremental and streaming runs.

Everything is written below the session's shared folder and read back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.functions.names import logical_name
from tidefold.operators.fold import fold_log, live
from tidefold.operators.select import required_flow_tables, unprocessed
from tidefold.plans.ingest import Sink, bronze_sink, log_sink, sync_once
from tidefold.plans.monitoring import count_tables, table_row_counts
from tidefold.plans.publish import manifests_path, publish, register_published_views
from tidefold.plans.service import ServicePaths, run_round
from tidefold.plans.staging import drop_old_versions, materialise, read_staging, read_table, staging_inventory, staging_tables
from tidefold.queries.inputs import LOG_E, LOG_L, RAW_VALID, live_sql, log_rows, raw_events, table
from tidefold.queries.registry import query
from tidefold.schemas import CATALOG_SCHEMA, CDC_DOCUMENT_ID, LOG_FILE_SCHEMA, RAW_LOG_COLUMNS, RAW_LOG_SCHEMA, UPSERT
from tidefold.session import scratch_path, shuffles_removed
from tidefold.sources.bronze import (
    append_bronze,
    bronze_columns,
    read_bronze,
    read_bronze_rows,
    routed_counts,
    stream_bronze_rows,
)
from tidefold.sources.changelog import load_ids, read_log, write_load
from tidefold.sources.control import read_history
from tidefold.sources.export import append_json_lines, write_json_lines
from tidefold.sources.landing import due_headers, index_path, read_due
from tidefold.sources.manifest import latest_manifest
from tidefold.sources.pages import DELTA, SNAPSHOT, documents, page_summary, read_pages, stream_pages
from tidefold.sources.views import list_tables, register_parquet_view
from tidefold.streaming import ingest as stream_ingest
from tidefold.streaming import flows, keyed, silver

# --- landed pages -------------------------------------------------------------------------
# Views and sign-ups are the initial snapshot, everything else arrives as deltas; a page
# holds the events of 200 consecutive ids of its phase.
_KIND = "case when event_type in ('view', 'signup') then 'snapshot' else 'delta' end"
_DOC_SPARK = """concat('{"_component":"', case user_id % 3 when 0 then 'workflow' when 1 then 'r2/cache' else '' end,
    '","_table":"', case user_id % 2 when 0 then 'users' else 'accounts' end, '","_id":"doc:', cast(user_id as string),
    '","_ts":', cast(unix_micros(cast(ts as timestamp)) as string), case when event_type = 'error' then ',"_deleted":true' else '' end,
    ',"_index":1,', substr(props, 2))"""
_DOC_DUCK = _DOC_SPARK.replace("unix_micros(cast(ts as timestamp))", "epoch_us(ts)")
_PAGED = f"""(select event_id, event_type, user_id, {_KIND} as kind, event_id // 200 as page,
    event_id // 200 = max(event_id // 200) over (partition by {_KIND}) as last,
    row_number() over (partition by {_KIND}, event_id // 200 order by event_id) - 1 as position, {_DOC_DUCK} as value from events)"""
_FIRST_DELTA = 1001
_PAGES_A_FILE = 512


def land_pages(spark, sf_dir, path: str) -> str:
    """Write the events as pages, up to `_PAGES_A_FILE` consecutive ones a file, so files grow with the bytes."""
    docs = table(spark, sf_dir, "events").selectExpr(
        f"{_KIND} as kind", "event_id div 200 as page", "event_id", f"{_DOC_SPARK} as value"
    )
    # A page is at most 200 documents by construction.
    pages = docs.groupBy("kind", "page").agg(F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("docs"))
    last = docs.groupBy("kind").agg(F.max("page").alias("last"))
    more = F.when(F.col("page") < F.col("last"), "true").otherwise("false")
    values = F.concat(F.lit('{"values":['), F.array_join("docs.value", ","), F.lit('],"hasMore":'), more)
    closing = F.when(
        F.col("kind") == SNAPSHOT,
        F.concat(
            F.lit(',"snapshot":1000,"sequence":'), F.col("page").cast("string"), F.lit(',"cursor":'),
            F.when(more == "true", F.concat(F.lit('"c'), F.col("page").cast("string"), F.lit('"'))).otherwise("null"),
        ),
    ).otherwise(F.concat(F.lit(',"cursor":'), (F.col("page") + _FIRST_DELTA).cast("string")))
    text = pages.join(last, "kind").select("kind", "page", F.concat(values, closing, F.lit("}")).alias("value"))
    for kind, folder in ((SNAPSHOT, "snapshot"), (DELTA, "deltas")):
        ordered = text.where(F.col("kind") == kind).repartitionByRange("page").sortWithinPartitions("page")
        ordered.select("value").write.option("maxRecordsPerFile", _PAGES_A_FILE).text(f"{path}/{folder}")
    return path


def _landing(spark, sf_dir) -> str:
    return land_pages(spark, sf_dir, scratch_path(spark, "landing"))


@query(
    "src1_snapshot_pages",
    f"""select 1000 as snapshot, case when not last then concat('c', cast(page as varchar)) end as cursor, not last as has_more, position, value
        from {_PAGED} where kind = 'snapshot'""",
)
def snapshot_pages(spark, sf_dir):
    pages = read_pages(spark, f"{_landing(spark, sf_dir)}/snapshot", SNAPSHOT)
    return documents(pages).select(F.col("snapshot").cast("int"), "cursor", "has_more", "position", "value")


@query(
    "src2_delta_pages",
    f"select page + {_FIRST_DELTA} as cursor, not last as has_more, position, value from {_PAGED} where kind = 'delta'",
)
def delta_pages(spark, sf_dir):
    pages = read_pages(spark, f"{_landing(spark, sf_dir)}/deltas", DELTA)
    return documents(pages).select("cursor", "has_more", "position", "value")


@query(
    "src3_table_scoped_read",
    f"select page + {_FIRST_DELTA} as cursor, position, value from {_PAGED} where kind = 'delta' and user_id % 2 = 0",
)
def table_scoped_read(spark, sf_dir):
    pages = read_pages(spark, f"{_landing(spark, sf_dir)}/deltas", DELTA)
    return documents(pages, table="users").select("cursor", "position", "value")


@query(
    "src4_cursor_bounded_read",
    f"""with p as (select page + {_FIRST_DELTA} as cursor, bool_and(not last) as has_more, count(*) as events from {_PAGED} where kind = 'delta' group by 1)
        select count(*) as pages_fetched, cast(sum(events) as bigint) as events, max(cursor) as cursor, arg_max(has_more, cursor) as has_more
        from (select * from p where cursor > {_FIRST_DELTA + 3} order by cursor limit 7)""",
)
def cursor_bounded_read(spark, sf_dir):
    """What is due is found in the index of the landed pages; only its files are read."""
    folder, control = f"{_landing(spark, sf_dir)}/deltas", scratch_path(spark, "control")
    headers = due_headers(spark, folder, DELTA, index_path(control, folder, DELTA), _FIRST_DELTA + 3, 7)
    return page_summary(read_due(spark, folder, DELTA, headers), "cursor")


# --- sync: phases, resume, checkpoints -------------------------------------------------------


def _sync(spark, landing: str, sink, control: str, **options):
    catalog = spark.createDataFrame([], CATALOG_SCHEMA)
    return sync_once(spark, landing, sink, catalog, control, "s1", options.pop("run_id", "r1"), **options)


_LOGGED = f"select component_path, table_name, document_id, timestamp, op, document from {LOG_E.sql}"


def _logged(spark, log: str) -> DataFrame:
    return read_log(spark, log).select("component_path", "table_name", "document_id", "timestamp", "op", "document")


@query("str4_snapshot_delta_handoff", _LOGGED)
def handoff(spark, sf_dir):
    log = scratch_path(spark, "log")
    _sync(spark, _landing(spark, sf_dir), log_sink(log), scratch_path(spark, "control"))
    return _logged(spark, log)


@query("str5_resume", _LOGGED)
def resume(spark, sf_dir):
    """The same result when the pages arrive in runs that stop half way."""
    landing, log, control = _landing(spark, sf_dir), scratch_path(spark, "log"), scratch_path(spark, "control")
    first = _sync(spark, landing, log_sink(log), control, max_pages=2)
    assert first.final_checkpoint["phase"] in ("initial_snapshot", "delta_tail")
    _sync(spark, landing, log_sink(log), control, run_id="r2")
    return _logged(spark, log)


@query("str6_write_then_checkpoint", _LOGGED)
def write_then_checkpoint(spark, sf_dir):
    """A run that dies after writing and before its checkpoint is repeated without duplicates."""
    landing, log, control = _landing(spark, sf_dir), scratch_path(spark, "log"), scratch_path(spark, "control")
    inner = log_sink(log)

    def dying(events, load_id):
        inner.write(events, load_id)
        raise ConnectionError("lost before the checkpoint")

    try:
        _sync(spark, landing, Sink(dying), control)
    except ConnectionError:
        pass
    _sync(spark, landing, inner, control)
    return _logged(spark, log)


@query(
    "str7_delta_tail_loop",
    f"""select phase, count(*) as checkpoints, max(cursor) as delta_cursor from (
        select distinct case when kind = 'snapshot' and not last then 'initial_snapshot' else 'delta_tail' end as phase,
        kind, page, case when kind = 'delta' then page + {_FIRST_DELTA} when last then 1000 end as cursor from {_PAGED}) group by phase""",
)
def delta_tail_loop(spark, sf_dir):
    control = scratch_path(spark, "control")
    _sync(spark, _landing(spark, sf_dir), log_sink(scratch_path(spark, "log")), control)
    history = read_history(spark, control, "s1")
    return history.groupBy("phase").agg(F.count("*").alias("checkpoints"), F.max("delta_cursor").alias("delta_cursor"))


@query(
    "agg7_sync_summary",
    f"""select count(distinct page) filter (kind = 'snapshot') as snapshot_pages_fetched, count(distinct page) filter (kind = 'delta') as delta_pages_fetched,
        count(*) as events_written, max(case when kind = 'delta' then page + {_FIRST_DELTA} end) as final_cursor from {_PAGED}""",
)
def sync_counts(spark, sf_dir):
    done = _sync(spark, _landing(spark, sf_dir), log_sink(scratch_path(spark, "log")), scratch_path(spark, "control"))
    row = (done.snapshot_pages_fetched, done.delta_pages_fetched, done.events_written, done.final_checkpoint["delta_cursor"])
    return spark.createDataFrame(
        [row], "snapshot_pages_fetched bigint, delta_pages_fetched bigint, events_written bigint, final_cursor bigint"
    )


@query("snk1_two_sources_one_log", f"select source, count(*) as events from (values ('s1'), ('s2')) t(source), {LOG_E.sql} e group by 1")
def two_sources(spark, sf_dir):
    """Two sources sync the same pages into one log, each with its own checkpoints."""
    landing, log, control = _landing(spark, sf_dir), scratch_path(spark, "log"), scratch_path(spark, "control")
    catalog, before, counts = spark.createDataFrame([], CATALOG_SCHEMA), set(), []
    for source in ("s1", "s2"):
        sync_once(spark, landing, log_sink(log), catalog, control, source, "r1")
        loads = [load for load in load_ids(spark, log) if load not in before]
        before.update(loads)
        counts.append(read_log(spark, log, loads).agg(F.count("*").alias("events")).select(F.lit(source).alias("source"), "events"))
    return counts[0].union(counts[1])


@query("str6_replaced_load_restaged", f"select table_name, count(*) as rows from {live_sql(LOG_E.sql)} group by 1")
def replaced_load(spark, sf_dir):
    """A load is staged, then replaced under its name by a larger one, and staged again."""
    log, root = scratch_path(spark, "log"), scratch_path(spark, "staging")
    events = log_rows(LOG_E, spark, sf_dir)
    for part in (events.where("position % 2 = 0"), events):
        write_load(part, log, "one")
        materialise(spark, log, root)
    return _all_tables(spark, root).groupBy(F.col("_table_name").alias("table_name")).agg(F.count("*").alias("rows"))


_ORDERS_A_PAGE = 1000


@query(
    "str7_backlog",
    f"""select document_id, timestamp, document, batch_pages, cursor from (select cast(o_orderkey as varchar) as document_id, o_orderkey as timestamp,
        concat('{{"total":', cast(o_totalprice as varchar), '}}') as document, o_orderkey // {_ORDERS_A_PAGE} as page from orders)
        cross join (select count(distinct o_orderkey // {_ORDERS_A_PAGE}) as batch_pages, max(o_orderkey // {_ORDERS_A_PAGE}) + 1000 as cursor from orders)""",
)
def backlog(spark, sf_dir):
    """All orders as a backlog of polls, each of which ends with its page: one run takes them all, the next nothing."""
    landing, log, control = (scratch_path(spark, name) for name in ("landing", "log", "control"))
    document = """concat('{"_component":"","_table":"orders","_id":"', cast(o_orderkey as string), '","_ts":', cast(o_orderkey as string),
        ',"total":', cast(o_totalprice as string), '}')"""
    docs = table(spark, sf_dir, "orders").selectExpr(f"o_orderkey div {_ORDERS_A_PAGE} as page", f"{document} as value")
    # A page is at most so many orders by construction.
    pages = docs.groupBy("page").agg(F.array_join(F.collect_list("value"), ",").alias("values"))
    pages.selectExpr(
        """concat('{"values":[', values, '],"hasMore":false,"cursor":', cast(page + 1000 as string), '}') as value"""
    ).write.text(f"{landing}/deltas")
    last = spark.createDataFrame([('{"values":[],"hasMore":false,"snapshot":1,"cursor":null}',)], "value string")
    last.coalesce(1).write.text(f"{landing}/snapshot")
    _sync(spark, landing, log_sink(log), control)
    assert _sync(spark, landing, log_sink(log), control, run_id="r2").delta_pages_fetched == 0
    logged, history = read_log(spark, log), read_history(spark, control, "s1")
    return logged.select(
        "document_id", "timestamp", "document", logged.agg(F.count_distinct("batch")).scalar().alias("batch_pages"),
        history.agg(F.max("delta_cursor")).scalar().alias("cursor"),
    )


@query("str3_two_streams_one_log", f"select 2 * count(*) as events, 4 as loads from {LOG_E.sql}")
def two_streams(spark, sf_dir):
    """Two sources streamed into one log keep their batches apart."""
    landing, log, control = _landing(spark, sf_dir), scratch_path(spark, "log"), scratch_path(spark, "control")
    catalog = spark.createDataFrame([], CATALOG_SCHEMA)
    for source in ("s1", "s2"):
        for kind, folder in ((SNAPSHOT, "snapshot"), (DELTA, "deltas")):
            pages = stream_pages(spark, f"{landing}/{folder}", kind, max_files=100_000)
            checkpoint = scratch_path(spark, "stream")
            stream_ingest.start(pages, kind, log_sink(log), catalog, control, source, "r1", checkpoint).awaitTermination()
    counted = read_log(spark, log).agg(F.count("*").alias("events"), F.count_distinct("load_id").cast("int").alias("loads"))
    return counted


@query("str3_streaming_ingest", _LOGGED)
def streaming_ingest(spark, sf_dir):
    landing, log, control = _landing(spark, sf_dir), scratch_path(spark, "log"), scratch_path(spark, "control")
    catalog = spark.createDataFrame([], CATALOG_SCHEMA)
    for kind, folder in ((SNAPSHOT, "snapshot"), (DELTA, "deltas")):
        pages = stream_pages(spark, f"{landing}/{folder}", kind, max_files=1000)
        checkpoint = scratch_path(spark, "stream")
        stream_ingest.start(pages, kind, log_sink(log), catalog, control, "s1", "r1", checkpoint).awaitTermination()
    return _logged(spark, log)


@query("str3_deltas_before_snapshot", _LOGGED)
def deltas_before_snapshot(spark, sf_dir):
    """The stream of deltas runs first; its batches are parked until the snapshot is complete."""
    landing, log, control = _landing(spark, sf_dir), scratch_path(spark, "log"), scratch_path(spark, "control")
    catalog, parked = spark.createDataFrame([], CATALOG_SCHEMA), scratch_path(spark, "parked")
    for kind, folder in ((DELTA, "deltas"), (SNAPSHOT, "snapshot")):
        pages = stream_pages(spark, f"{landing}/{folder}", kind, max_files=12)
        checkpoint = scratch_path(spark, "stream")
        stream_ingest.start(pages, kind, log_sink(log), catalog, control, "s1", "r1", checkpoint, parked=parked).awaitTermination()
    return _logged(spark, log)


# --- change log -------------------------------------------------------------------------------


@query("snk1_log_append_idempotent", f"select ship_year as load_id, table_name, count(*) as events from {LOG_L.sql} group by 1, 2")
def log_append(spark, sf_dir):
    """Loads are written, and one of them is written again."""
    log = scratch_path(spark, "log")
    events = LOG_L.frame(spark, sf_dir)
    years = sorted(row["ship_year"] for row in events.select("ship_year").distinct().collect())
    for year in [*years, years[0]]:
        write_load(events.where(F.col("ship_year") == year), log, year)
    return read_log(spark, log).groupBy("load_id", "table_name").agg(F.count("*").alias("events"))


def _loads_by_kind(spark, sf_dir) -> str:
    log = scratch_path(spark, "log")
    events = LOG_L.frame(spark, sf_dir)
    for name, op in (("deletes", "delete"), ("upserts", "upsert")):
        write_load(events.where(F.col("op") == op), log, name)
    return log


@query("src6_log_subset", f"select {', '.join(RAW_LOG_COLUMNS)} from {LOG_L.sql} where op = 'upsert'")
def log_subset(spark, sf_dir):
    log = _loads_by_kind(spark, sf_dir)
    listed = spark.createDataFrame([(load,) for load in load_ids(spark, log)], "load_id string")
    fresh = unprocessed(listed, spark.createDataFrame([("deletes",)], "load_id string"), "load_id")
    return read_log(spark, log, [row["load_id"] for row in fresh.collect()]).select(*RAW_LOG_COLUMNS)


# --- staging ----------------------------------------------------------------------------------

_TYPED_E = f"""select component_path as _component_path, table_name as _table_name, document_id as _document_id, timestamp as _timestamp,
    schema_fingerprint as _schema_fingerprint, cast(json_extract(document, '$.k') as bigint) as k, document as _document_json
    from {live_sql(LOG_E.sql)}"""


def _all_tables(spark, root: str) -> DataFrame:
    frames = [read_table(spark, entry) for entry in staging_tables(spark, root)]
    rows = frames[0]
    for other in frames[1:]:
        rows = rows.unionByName(other)
    return rows


@query("str8_full_rebuild", _TYPED_E)
def full_rebuild(spark, sf_dir):
    log, root = scratch_path(spark, "log"), scratch_path(spark, "staging")
    write_load(log_rows(LOG_E, spark, sf_dir), log, "all")
    materialise(spark, log, root, incremental=False)
    return _all_tables(spark, root)


@query("snk2_staging_table_write", _TYPED_E)
def staging_table_write(spark, sf_dir):
    log, root = scratch_path(spark, "log"), scratch_path(spark, "staging")
    write_load(log_rows(LOG_E, spark, sf_dir), log, "all")
    materialise(spark, log, root)
    keys = [(entry["component_path"], entry["table_name"]) for entry in staging_tables(spark, root)]
    return reduce(DataFrame.unionByName, [read_staging(spark, root, *key) for key in keys])


_CASE_DOC = """concat('{"Name":', cast(user_id as string), ',"name":"', event_type, '","NAME":', cast(event_id as string), '.5}')"""


@query(
    "snk2_case_names",
    """select event_id as "_timestamp", cast(event_id + 0.5 as double) as "NAME", user_id as "Name__2", event_type as "name__3" from events""",
)
def case_names(spark, sf_dir):
    """Fields that differ in case only each get a column, and other tables are not disturbed."""
    log, root = scratch_path(spark, "log"), scratch_path(spark, "staging")
    events = table(spark, sf_dir, "events").selectExpr(
        "'' as component_path", "'odd' as table_name", "cast(event_id as string) as document_id", "event_id as timestamp",
        "'upsert' as op", "cast(null as string) as schema_fingerprint", f"{_CASE_DOC} as document", "'b' as batch", "event_id as position",
    )
    write_load(events.union(events.withColumn("table_name", F.lit("other"))), log, "all")
    assert materialise(spark, log, root).tables_materialized == 2
    return read_staging(spark, root, "", "odd").select("_timestamp", "NAME", "Name__2", "name__3")


@query(
    "str9_incremental_staging",
    f"""select table_name as _table_name, document_id as _document_id, timestamp as _timestamp,
        cast(json_extract(document, '$.part') as bigint) as part, cast(json_extract(document, '$.cents') as bigint) as cents,
        document as _document_json from {live_sql(LOG_L.sql)}""",
)
def incremental_staging(spark, sf_dir):
    """A load per ship year, the latest first, staged one by one; equal to folding everything at once.

    Versions that a load has replaced are deleted after it, as a service round does, so disk holds two of them at most.
    """
    log, root = scratch_path(spark, "log"), scratch_path(spark, "staging")
    events = LOG_L.frame(spark, sf_dir)
    with shuffles_removed(spark):
        for year in sorted((row["ship_year"] for row in events.select("ship_year").distinct().collect()), reverse=True):
            write_load(events.where(F.col("ship_year") == year), log, year)
            materialise(spark, log, root)
            drop_old_versions(spark, root)
    return _all_tables(spark, root).select("_table_name", "_document_id", "_timestamp", "part", "cents", "_document_json")


_FIRST_ID = f"(select min(document_id) from {live_sql(LOG_L.sql)} where table_name = 'filled')"


@query(
    "str9_one_changed_document",
    f"""select table_name as _table_name, count(*) as documents,
        sum(case when document_id = {_FIRST_ID} then 7 else cast(json_extract(document, '$.cents') as bigint) end)::bigint as cents,
        count(distinct case when document_id = {_FIRST_ID} then 1 end) as rewritten
        from {live_sql(LOG_L.sql)} group by 1""",
)
def one_changed_document(spark, sf_dir):
    """The whole log is staged, then one document changes: the buckets of each table that its run wrote."""
    log, root = scratch_path(spark, "log"), scratch_path(spark, "staging")
    write_load(log_rows(LOG_L, spark, sf_dir), log, "all")
    materialise(spark, log, root)
    named = [F.col(f"_{name}").alias(name) for name in RAW_LOG_COLUMNS if name not in ("op", "document")]
    filled = read_staging(spark, root, "", "filled").select(*named)
    first = filled.agg(F.min_by(F.struct("*"), "document_id").alias("r")).select("r.*")
    change = {"timestamp": F.col("timestamp") + 1, "op": F.lit(UPSERT), "document": F.lit('{"cents":7}'), "batch": F.lit("one"), "position": F.lit(0)}
    write_load(first.withColumns(change), log, "one")
    materialise(spark, log, root)
    tables = reduce(DataFrame.unionByName, [
        read_table(spark, entry).select("_table_name", "cents", F.input_file_name().alias("file")) for entry in staging_tables(spark, root)
    ])
    folder = F.when(F.col("file").contains("/version=0000000002/"), F.regexp_replace("file", "/[^/]*$", ""))
    return tables.groupBy("_table_name").agg(
        F.count("*").alias("documents"), F.sum("cents").alias("cents"), F.count_distinct(folder).alias("rewritten")
    )


@query(
    "agg6_materialise_summary",
    f"""select 'incremental' as mode, 2 as files_read, count(*) as events_read, 1 as new_raw_files,
        count(distinct table_name) filter (op = 'upsert') as affected_tables,
        count(distinct table_name) filter (op = 'upsert') as tables_materialized,
        (select count(*) from {live_sql(LOG_L.sql)}) as rows_materialized from {LOG_L.sql}""",
)
def materialise_summary(spark, sf_dir):
    log, root = scratch_path(spark, "log"), scratch_path(spark, "staging")
    # One batch a load; of changes at the same time the delete comes last, as in the log.
    events = LOG_L.frame(spark, sf_dir).withColumn("batch", F.when(F.col("op") == "delete", "R").otherwise("N"))
    ordered = events.withColumn("position", F.xxhash64("document", "position"))
    for op in ("delete", "upsert"):
        write_load(ordered.where(F.col("op") == op), log, op)
        summary = materialise(spark, log, root)
    row = (
        summary.mode, summary.files_read, summary.events_read, summary.new_raw_files,
        summary.affected_tables, summary.tables_materialized, summary.rows_materialized,
    )
    return spark.createDataFrame(
        [row],
        "mode string, files_read int, events_read bigint, new_raw_files int, affected_tables bigint, tables_materialized bigint, rows_materialized bigint",
    )


# --- publishing and views -----------------------------------------------------------------------

_STAGED_COUNTS = f"""(select case component_path when '' then '_root' else component_path end as c, table_name as t, count(*) as row_count
    from {live_sql(LOG_E.sql)} group by 1, 2)"""


def _published(spark, sf_dir) -> tuple[str, str]:
    log, root, bucket = scratch_path(spark, "log"), scratch_path(spark, "staging"), scratch_path(spark, "bucket")
    write_load(log_rows(LOG_E, spark, sf_dir), log, "all")
    materialise(spark, log, root)
    publish(spark, staging_inventory(spark, root), bucket, "exports")
    return bucket, root


@query("snk7_publish_write", f"select concat(c, '/', t, '.parquet') as relative_path, row_count from {_STAGED_COUNTS}")
def publish_write(spark, sf_dir):
    bucket, _ = _published(spark, sf_dir)
    entries = latest_manifest(spark, manifests_path(bucket, "exports")).select("relative_path", "versioned_key").collect()
    counts = None
    for entry in entries:
        rows = spark.read.parquet(f"{bucket}/{entry['versioned_key']}")
        one = rows.agg(F.count("*").alias("row_count")).select(F.lit(entry["relative_path"]).alias("relative_path"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("snk7_republish", f"select concat(c, '/', t, '.parquet') as relative_path, row_count from {_STAGED_COUNTS}")
def republish(spark, sf_dir):
    """Half of the log is published, then all of it; versions of both publishes stay, the manifest names the second."""
    log, root, bucket = scratch_path(spark, "log"), scratch_path(spark, "staging"), scratch_path(spark, "bucket")
    events = log_rows(LOG_E, spark, sf_dir)
    for number, part in enumerate((events.where("position % 2 = 0"), events.where("position % 2 = 1")), 1):
        write_load(part, log, str(number))
        materialise(spark, log, root)
        publish(spark, staging_inventory(spark, root), bucket, "exports", publish_id=str(number))
    entries = latest_manifest(spark, manifests_path(bucket, "exports")).select("relative_path", "versioned_key").collect()
    return count_tables(
        spark, {entry["relative_path"]: spark.read.parquet(f"{bucket}/{entry['versioned_key']}") for entry in entries}
    ).withColumnRenamed("table_name", "relative_path")


def _view_rows(spark, names: list[str]) -> DataFrame:
    rows = None
    for name in names:
        one = spark.table(name).select(F.lit(name).alias("view_name"), "_document_id", "k")
        rows = one if rows is None else rows.unionByName(one)
    return rows


_VIEW = "concat(case component_path when '' then '' when 'r2/cache' then 'r2__cache__' else 'workflow__' end, table_name)"
_VIEW_ROWS = f"""select {_VIEW} as view_name, document_id as _document_id, cast(json_extract(document, '$.k') as bigint) as k from {live_sql(LOG_E.sql)}"""


@query("mon7_published_views", _VIEW_ROWS)
def published_views(spark, sf_dir):
    bucket, _ = _published(spark, sf_dir)
    return _view_rows(spark, register_published_views(spark, bucket, "exports"))


@query("src13_catalog_listing", f"select distinct {_VIEW} as table_name, 'TEMPORARY' as table_type from {live_sql(LOG_E.sql)}")
def catalog_listing(spark, sf_dir):
    bucket, _ = _published(spark, sf_dir)
    names = register_published_views(spark, bucket, "exports")
    return list_tables(spark).where(F.col("table_name").isin(names))


@query("src12_parquet_view", "select o_orderkey, o_custkey, o_totalprice from orders")
def parquet_view(spark, sf_dir):
    register_parquet_view(spark, "orders_file", f"{sf_dir}/orders.parquet")
    return spark.sql("select o_orderkey, o_custkey, o_totalprice from orders_file")


@query("snk10_view_registration", "select o_orderstatus, count(*) as orders from orders group by 1")
def view_registration(spark, sf_dir):
    """Registering again under the same name replaces the view."""
    register_parquet_view(spark, "registered", f"{sf_dir}/customer.parquet")
    register_parquet_view(spark, "registered", f"{sf_dir}/orders.parquet")
    return spark.sql("select o_orderstatus, count(*) as orders from registered group by 1")


@query("str10_service_round", f"select concat(c, '/', t, '.parquet') as relative_path, row_count from {_STAGED_COUNTS}")
def service_round(spark, sf_dir):
    """Two rounds over landed pages: the second one finds nothing to do."""
    names = ("log", "control", "staging", "bucket")
    paths = ServicePaths(_landing(spark, sf_dir), *[scratch_path(spark, name) for name in names], "exports")
    run_round(spark, paths, "s1", "r1")
    again = run_round(spark, paths, "s1", "r2", 2)
    assert again.publish is None and again.sync.events_written == 0
    tables = {entry["relative_path"]: read_table(spark, entry) for entry in staging_tables(spark, paths.staging)}
    return count_tables(spark, tables).withColumnRenamed("table_name", "relative_path")


# --- bronze and silver ------------------------------------------------------------------------

_TARGET = "concat('src__', case component_path when '' then 'app' when 'r2/cache' then 'r2_cache' else component_path end, '__', table_name, '__cdc')"


def _bronze(spark, sf_dir) -> str:
    """Two loads: the second one brings text and booleans into a column of integers."""
    root = scratch_path(spark, "bronze")
    events = raw_events(spark, sf_dir)
    plain = F.col("position") % 5 == 0
    append_bronze(events.where(plain), root, "1", "s1", "r1")
    append_bronze(events.where(~plain), root, "2", "s1", "r2")
    return root


_RAW_TARGETS = ["src__app__accounts__cdc", "src__app__users__cdc", "src__workflow__accounts__cdc", "src__workflow__users__cdc"]
_MIX = "case when table_name = 'users' then cast(users_mix as varchar) when ord % 5 = 1 then 'True' else accounts_mix end"


@query(
    "snk4_bronze_schema_evolution",
    f"""with rows as (select {_TARGET} as target, table_name = 'users' as numbers, * from {RAW_VALID} where document is not null)
        select target, 'cents' as field, 'bigint' as type, count(cents) as filled from rows group by 1
        union all select target, 'mix', case when numbers then 'double' else 'string' end, count({_MIX}) from rows group by target, numbers
        union all select target, 'props', 'string', count(props_text) from rows group by 1
        union all select target, 'whole', 'double', count(whole) from rows group by 1""",
)
def bronze_schema_evolution(spark, sf_dir):
    """Columns of both loads together, of every target, with the values that each holds."""
    root = _bronze(spark, sf_dir)
    targets = [row["target"] for row in routed_counts(read_bronze_rows(spark, root)).collect()]

    def described(target: str) -> DataFrame:
        rows = read_bronze(spark, root, target)
        types = dict(rows.dtypes)
        fields = [name for name, _, _ in bronze_columns(spark, root, target)]
        counted = rows.agg(*[F.count(name).alias(name) for name in fields])
        columns = [F.struct(F.lit(target).alias("target"), F.lit(n).alias("field"), F.lit(types[n]).alias("type"), F.col(n).alias("filled")) for n in fields]
        return counted.select(F.inline(F.array(*columns)))

    return reduce(DataFrame.unionByName, [described(target) for target in sorted(targets)])


@query(
    "src8_bronze_scan",
    f"""select {_TARGET} as target, ord, v.* from (select *, case when document is not null then
        {{'cents': cents, 'mix': {_MIX}, 'props': props_text, 'whole': whole}} end as v from {RAW_VALID})""",
)
def bronze_scan(spark, sf_dir):
    """All bronze tables, the column that promotes as text."""
    root = _bronze(spark, sf_dir)
    tables = [read_bronze(spark, root, t, with_order=True).withColumn("target", F.lit(t)) for t in _RAW_TARGETS]
    named = [F.col("position").alias("ord"), "cents", F.col("mix").cast("string").alias("mix"), "props", "whole"]
    return reduce(DataFrame.unionByName, [rows.select("target", *named) for rows in tables])


@query(
    "src8_one_field",
    f"select {_TARGET} as target, count(cents) as filled, sum(cents)::bigint as cents from {RAW_VALID} where document is not null group by 1",
)
def one_field(spark, sf_dir):
    """One field of every table: read from its shredded column, no document is parsed."""
    root = _bronze(spark, sf_dir)
    tables = [read_bronze(spark, root, t).select(F.lit(t).alias("target"), "cents") for t in _RAW_TARGETS]
    rows = reduce(DataFrame.unionByName, tables)
    return rows.groupBy("target").agg(F.count("cents").alias("filled"), F.sum("cents").alias("cents"))


@query("snk5_multi_target_routing", f"select {_TARGET} as target, count(*) as row_count from {LOG_E.sql} group by 1")
def multi_target_routing(spark, sf_dir):
    events = log_rows(LOG_E, spark, sf_dir).withColumn("creation_time", F.lit(None).cast("double"))
    return append_bronze(events, scratch_path(spark, "bronze"), "1", "s1", "r1")


def _streamed_silver(spark, sf_dir):
    """Bronze from ten loads, streamed a few files at a time, so changes come out of order."""
    root, store = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    events = log_rows(LOG_E, spark, sf_dir).withColumn("creation_time", F.lit(None).cast("double"))
    ids = table(spark, sf_dir, "events").selectExpr("event_id", "event_type")
    typed = events.join(ids, events["position"] == ids["event_id"])
    parts = [(kind, odd) for kind in ("purchase", "error", "view", "signup", "click") for odd in (1, 0)]
    for load, (kind, odd) in enumerate(parts):
        append_bronze(typed.where((F.col("event_type") == kind) & (F.col("event_id") % 2 == odd)), root, str(load), "s1", "r1")
    current = silver.silver_table(store)
    silver.start(stream_bronze_rows(spark, root, max_files=12), current, scratch_path(spark, "stream")).awaitTermination()
    return current, root


@query(
    "str1_streaming_apply_changes",
    f"select {_TARGET} as target, document_id as _cdc_document_id, document from {live_sql(LOG_E.sql)}",
)
def streaming_apply_changes(spark, sf_dir):
    current, _ = _streamed_silver(spark, sf_dir)
    rows = current.current(spark)
    return rows.select("target", CDC_DOCUMENT_ID, F.col("_cdc_raw_document_json").alias("document"))


@query(
    "str1_keyed_state",
    f"select {_TARGET} as target, document_id as _cdc_document_id, document from {live_sql(LOG_E.sql)}",
)
def keyed_state(spark, sf_dir):
    """The same changes applied to a state store, several files at a time and over a restart."""
    root, checkpoint, feed = (scratch_path(spark, name) for name in ("bronze", "stream", "feed"))
    events = log_rows(LOG_E, spark, sf_dir).withColumn("creation_time", F.lit(None).cast("double"))
    for odd in (1, 0):
        append_bronze(events.where(F.col("position") % 2 == odd), root, str(odd), "s1", "r1")
        changes = keyed.keyed_changes(stream_bronze_rows(spark, root, max_files=4))
        keyed.start(changes, checkpoint, feed).awaitTermination()
    return keyed.current(spark, checkpoint).select("target", F.col("document_id").alias(CDC_DOCUMENT_ID), "document")


@query(
    "snk11_silver_table",
    f"""select {_TARGET} as target, document_id as _cdc_document_id, cast(json_extract(document, '$.k') as bigint) as k
        from {live_sql(LOG_E.sql)}""",
)
def silver_target(spark, sf_dir):
    """All silver tables, each read from its own partition of the store."""
    current, root = _streamed_silver(spark, sf_dir)
    targets = [row["target"] for row in routed_counts(read_bronze_rows(spark, root)).collect()]
    tables = [
        silver.read_silver(spark, current, root, name).select(F.lit(name).alias("target"), CDC_DOCUMENT_ID, "k") for name in sorted(targets)
    ]
    return reduce(DataFrame.unionByName, tables)


@query(
    "str1_stream_restart",
    f"select {_TARGET} as target, document_id as _cdc_document_id, document from {live_sql(LOG_E.sql)}",
)
def stream_restart(spark, sf_dir):
    """The stream starts over with a new checkpoint folder, behind a compacted base."""
    root, store = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    events = log_rows(LOG_E, spark, sf_dir).withColumn("creation_time", F.lit(None).cast("double"))
    current = silver.silver_table(store)
    for load, odd in enumerate((1, 0)):
        # The second stream sees the second load only, as after a clean-up of old files.
        part = f"{root}/{load}"
        append_bronze(events.where(F.col("position") % 2 == odd), part, str(load), "s1", "r1")
        silver.start(stream_bronze_rows(spark, part), current, scratch_path(spark, "stream")).awaitTermination()
        current.compact(spark, force=odd == 1)
    return current.current(spark).select("target", CDC_DOCUMENT_ID, F.col("_cdc_raw_document_json").alias("document"))


@query(
    "str11_flows_per_table",
    f"""select regexp_replace({_TARGET}, '__cdc$', '') as target_table, count(*) as row_count from {live_sql(LOG_E.sql)}
        where {_TARGET} <> 'src__workflow__users__cdc' group by 1""",
)
def flows_per_table(spark, sf_dir):
    """One stored state serves every selected flow; each silver table is its slice."""
    current, root = _streamed_silver(spark, sf_dir)
    rows = current.current(spark)
    listing = rows.select(F.col("target").alias("table_name")).distinct().withColumn("table_type", F.lit("MANAGED"))
    excluded = spark.createDataFrame([("src__workflow__users__cdc",)], "table_name string")
    selected = required_flow_tables(listing, exclude=excluded).select("table_name", "target_table")
    counted = silver.silver_counts(rows).join(selected, "table_name")
    return counted.select("target_table", "row_count")


@query(
    "str11_one_query_per_flow",
    f"""select regexp_replace({_TARGET}, '__cdc$', '') as target_table, document_id as _cdc_document_id, document from {live_sql(LOG_E.sql)}""",
)
def one_query_per_flow(spark, sf_dir):
    """A query for each selected table; one table is excluded at first and catches up when it is selected."""
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "flows")
    events = log_rows(LOG_E, spark, sf_dir).withColumn("creation_time", F.lit(None).cast("double"))
    excluded = spark.createDataFrame([("src__workflow__users__cdc",)], "table_name string")
    for odd, exclude in ((1, excluded), (0, None)):
        append_bronze(events.where(F.col("position") % 2 == odd), bronze, str(odd), "s1", "r1")
        listing = routed_counts(read_bronze_rows(spark, bronze)).select(F.col("target").alias("table_name"), F.lit("MANAGED").alias("table_type"))
        selected = required_flow_tables(listing, exclude=exclude)
        for flow in flows.sync_flows(spark, selected, bronze, root).values():
            flow.awaitTermination()
    tables = [
        flows.flow_table(root, row["flow_name"]).current(spark).select(
            F.lit(row["target_table"]).alias("target_table"), CDC_DOCUMENT_ID, F.col("_cdc_raw_document_json").alias("document")
        )
        for row in selected.orderBy("table_name").collect()
    ]
    return reduce(DataFrame.unionByName, tables)


@query(
    "mon5_layer_row_counts",
    f"""select b.logical_table, bronze_row_count, silver_row_count from
        (select regexp_replace({_TARGET}, '__cdc$', '') as logical_table, count(*) as bronze_row_count from {LOG_E.sql} group by 1) b
        full join (select regexp_replace({_TARGET}, '__cdc$', '') as logical_table, count(*) as silver_row_count
        from {live_sql(LOG_E.sql)} group by 1) s on b.logical_table = s.logical_table""",
)
def layer_row_counts(spark, sf_dir):
    """Rows of the stored bronze layer next to those of the streamed silver layer."""
    current, root = _streamed_silver(spark, sf_dir)
    bronze = routed_counts(read_bronze_rows(spark, root)).withColumnRenamed("target", "table_name")
    rows = silver.silver_counts(current.current(spark), logical_name("target"))
    return table_row_counts(bronze, rows).select("logical_table", "bronze_row_count", "silver_row_count")


# --- JSON lines -------------------------------------------------------------------------------


@query(
    "snk8_json_lines",
    f"select {', '.join(RAW_LOG_COLUMNS)}, document is not null as has_document_key from {LOG_E.sql}",
)
def json_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    write_json_lines(LOG_E.frame(spark, sf_dir).select(*RAW_LOG_COLUMNS), path)
    lines = spark.read.text(path)
    parsed = lines.select(F.from_json("value", RAW_LOG_SCHEMA).alias("r"), F.col("value").contains('"document":').alias("k"))
    return parsed.select("r.*", F.col("k").alias("has_document_key"))


@query("snk9_json_lines_append", f"select op, 2 * count(*) as events from {LOG_E.sql} group by op")
def json_lines_append(spark, sf_dir):
    path = scratch_path(spark, "lines")
    rows = LOG_E.frame(spark, sf_dir).select(*RAW_LOG_COLUMNS)
    append_json_lines(rows, path)
    append_json_lines(rows, path)
    append_json_lines(rows.where("op = 'unknown'"), path)
    return spark.read.schema(RAW_LOG_SCHEMA).json(path).groupBy("op").agg(F.count("*").alias("events"))


@query(
    "str6_bronze_sink",
    f"""select {_TARGET} as target, count(*) as row_count from {LOG_E.sql} group by 1""",
)
def bronze_from_pages(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    _sync(spark, _landing(spark, sf_dir), bronze_sink(root, "s1", "r1"), scratch_path(spark, "control"))
    return routed_counts(read_bronze_rows(spark, root))
