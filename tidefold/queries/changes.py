"""Folding, inference, typed projection, set operations and aggregations over change logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidefold.functions.events import bronze_rows, normalise, read_metadata, with_fingerprint
from tidefold.functions.kinds import BOOL, TEXT, bronze_type, explode_fields, flag_kind, schema_field_flags
from tidefold.functions.names import bronze_table_name
from tidefold.operators.fold import apply_changes, current_state, fold_log, live
from tidefold.operators.infer import observed_flags, project_bronze, project_staging, staging_columns
from tidefold.operators.select import affected_tables, only_affected, unprocessed
from tidefold.plans.staging import load_counts
from tidefold.queries.inputs import (
    LOG_E,
    LOG_L,
    RAW_EXPECTED,
    RAW_VALID,
    RAWDOC,
    folded_sql,
    live_sql,
    log_rows,
    raw_events,
    table,
)
from tidefold.queries.registry import query
from tidefold.schemas import (
    CDC_DOCUMENT_ID,
    CDC_INGESTED_AT,
    CDC_IS_DELETED,
    CDC_RAW_DOCUMENT_JSON,
    CDC_SEQUENCE_NUM,
    CDC_SOURCE_COMPONENT,
    CDC_SOURCE_TABLE,
    RAW_LOG_COLUMNS,
    RESERVED_STAGING_COLUMNS,
    SILVER_DROPPED_COLUMNS,
)
from tidefold.session import broadcast_if_bounded
from tidefold.sources.bronze import routed_counts
from tidefold.sources.catalog import with_fingerprints

LOG_NAMES = ", ".join(RAW_LOG_COLUMNS)


# --- fold ---------------------------------------------------------------------------------


@query("agg1_latest_wins_fold", f"select {LOG_NAMES} from {folded_sql(LOG_L.sql)}")
def latest_wins_fold(spark, sf_dir):
    return fold_log(log_rows(LOG_L, spark, sf_dir)).select(*RAW_LOG_COLUMNS)


@query("agg1_fold_hot_documents", f"select {LOG_NAMES} from {folded_sql(LOG_E.sql)}")
def fold_hot_documents(spark, sf_dir):
    return fold_log(log_rows(LOG_E, spark, sf_dir)).select(*RAW_LOG_COLUMNS)


@query("agg1_current_state", f"select {LOG_NAMES} from {live_sql(LOG_E.sql)}")
def current_documents(spark, sf_dir):
    return current_state(log_rows(LOG_E, spark, sf_dir)).select(*RAW_LOG_COLUMNS)


@query(
    "str2_tombstones",
    f"select component_path, table_name, document_id, timestamp from {folded_sql(LOG_L.sql)} where op = 'delete'",
)
def tombstones(spark, sf_dir):
    folded = fold_log(log_rows(LOG_L, spark, sf_dir))
    return folded.where("op = 'delete'").select("component_path", "table_name", "document_id", "timestamp")


@query(
    "srt1_staging_row_order",
    f"select component_path, table_name, document_id, timestamp from {live_sql(LOG_L.sql)} order by 1, 2, 3, 4",
)
def staging_row_order(spark, sf_dir):
    """Sorted by ranges of (table, document), so one big table is spread over many tasks."""
    columns = ["component_path", "table_name", "document_id", "timestamp"]
    return current_state(log_rows(LOG_L, spark, sf_dir)).select(*columns).orderBy(*columns)


@query("srt2_table_order", f"select distinct component_path, table_name from {LOG_E.sql} order by 1, 2")
def table_order(spark, sf_dir):
    return affected_tables(log_rows(LOG_E, spark, sf_dir))


# --- normalisation ------------------------------------------------------------------------


@query(
    "prj1_normalise_events",
    f"select ord, component_path, table_name, document_id, timestamp, op, document from {RAW_VALID}",
)
def normalise_events(spark, sf_dir):
    events = normalise(RAWDOC.frame(spark, sf_dir), on_error="quarantine")
    return events.select("ord", "component_path", "table_name", "document_id", "timestamp", "op", "document")


@query("prj2_metadata_validation", f"select ord, coalesce(error, 'ok') as status from {RAW_EXPECTED}")
def metadata_validation(spark, sf_dir):
    checked = read_metadata(RAWDOC.frame(spark, sf_dir))
    return checked.select("ord", F.coalesce("error", F.lit("ok")).alias("status"))


@query("prj3_operation", f"select ord, op from {RAW_VALID}")
def operation(spark, sf_dir):
    return normalise(RAWDOC.frame(spark, sf_dir), on_error="quarantine", fields=["op"])


@query(
    "prj4_reserved_field_strip",
    f"select ord, document, false as has_index from {RAW_VALID} where op = 'upsert'",
)
def reserved_field_strip(spark, sf_dir):
    events = normalise(RAWDOC.frame(spark, sf_dir), on_error="quarantine").where("op = 'upsert'")
    return events.select("ord", "document", F.col("document").contains('"_index"').alias("has_index"))


@query(
    "prj5_delete_payload_nulling",
    f"select op, count(*) as events, count(document) as with_document from {RAW_VALID} group by op",
)
def delete_payload_nulling(spark, sf_dir):
    events = normalise(RAWDOC.frame(spark, sf_dir), on_error="quarantine")
    return events.groupBy("op").agg(F.count("*").alias("events"), F.count("document").alias("with_document"))


_BRONZE = """'s1' as _cdc_source_id, component_path as _cdc_source_component, table_name as _cdc_source_table,
    document_id as _cdc_document_id, timestamp as _cdc_sequence_num, op = 'delete' as _cdc_is_deleted,
    cast(null as varchar) as _cdc_schema_fingerprint, document as _cdc_raw_document_json, 'r1' as _cdc_run_id,
    creation_time::double as _cdc_creation_time"""


@query("prj6_bronze_rows", f"select ord as position, {_BRONZE} from {RAW_VALID}")
def bronze_form(spark, sf_dir):
    rows = bronze_rows(raw_events(spark, sf_dir), "s1", "r1")
    return rows.drop("batch", CDC_INGESTED_AT)


@query(
    "prj25_ingest_stamping",
    f"select 'r1' as _cdc_run_id, count(*) as events, count(*) as stamped from {RAW_VALID}",
)
def ingest_stamping(spark, sf_dir):
    rows = bronze_rows(raw_events(spark, sf_dir), "s1", "r1")
    return rows.groupBy("_cdc_run_id").agg(F.count("*").alias("events"), F.count(CDC_INGESTED_AT).alias("stamped"))


@query(
    "jn1_event_fingerprint",
    """select e.event_id, case e.user_id % 3 when 0 then 'type:view' when 1 then concat('type:', e.event_type) else 'none' end as table_name,
       case when e.user_id % 3 = 2 then null
            else sha256(concat('{"title":"', case e.user_id % 3 when 0 then 'view' else e.event_type end, '"}')) end as schema_fingerprint
       from events e""",
)
def event_fingerprint(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    schemas = events.select("event_type").distinct().select(
        F.concat(F.lit("type:"), "event_type").alias("table_name"),
        F.concat(F.lit('{"title": "'), "event_type", F.lit('"}')).alias("schema_json"),
    )
    named = events.selectExpr(
        "event_id",
        """case user_id % 3 when 0 then 'type:view' when 1 then concat('type:', event_type) else 'none' end as table_name""",
    )
    return with_fingerprint(named, broadcast_if_bounded(with_fingerprints(schemas)))


# --- inference and typed projections --------------------------------------------------------


@query(
    "prj27_value_kinds",
    f"""select table_name, field, kind, count(*) as n from (
        select ord, table_name, '_creationTime' as field, 'Float64' as kind from {RAW_VALID} where document is not null
        union all select ord, table_name, 'cents', 'Int64' from {RAW_VALID} where document is not null
        union all select ord, table_name, 'whole', 'Float64' from {RAW_VALID} where document is not null
        union all select ord, table_name, 'props', 'JsonUtf8' from {RAW_VALID} where document is not null
        union all select ord, table_name, 'mix',
            case when table_name = 'users' then case ord % 2 when 0 then 'Int64' else 'Float64' end
                 else case ord % 5 when 0 then 'Int64' when 1 then 'Boolean' when 2 then 'Utf8' when 3 then 'JsonUtf8' else 'null' end end
            from {RAW_VALID} where document is not null
        ) group by all""",
)
def value_kinds(spark, sf_dir):
    fields = explode_fields(raw_events(spark, sf_dir), "document", ["table_name"])
    kind = F.coalesce(flag_kind("flag"), F.lit("null")).alias("kind")
    return fields.select("table_name", "field", kind).groupBy("table_name", "field", "kind").agg(F.count("*").alias("n"))


@query(
    "agg2_column_kinds",
    f"""select distinct component_path, table_name, unnest(['_creationTime', 'cents', 'mix', 'props', 'whole']) as field,
        unnest(['Float64', 'Int64', case when table_name = 'users' then 'Float64' else 'JsonUtf8' end, 'JsonUtf8', 'Float64']) as kind
        from {RAW_VALID} where document is not null""",
)
def column_kinds(spark, sf_dir):
    return staging_columns(live(raw_events(spark, sf_dir)))


@query(
    "jn2_schema_seeded_columns",
    f"""select distinct component_path, table_name,
        unnest(['_creationTime', 'cents', 'extra', 'mix', 'props', 'whole']) as field,
        unnest(['Float64', case when table_name = 'users' then 'Float64' else 'JsonUtf8' end, 'Utf8',
                case when table_name = 'users' then 'Float64' else 'JsonUtf8' end, 'JsonUtf8', 'Float64']) as kind
        from {RAW_VALID} where document is not null""",
)
def schema_seeded_columns(spark, sf_dir):
    events = raw_events(spark, sf_dir)
    catalog = events.select("table_name").distinct().select(
        "table_name",
        F.concat(
            F.lit('{"properties":{"extra":{"type":"string"},"cents":{"type":"'),
            F.when(F.col("table_name") == "users", "number").otherwise("string"),
            F.lit('"},"_ts":{"type":"string"}}}'),
        ).alias("schema_json"),
    )
    return staging_columns(live(events), schema_field_flags(catalog))


_STAGED = """component_path as _component_path, table_name as _table_name, document_id as _document_id,
    timestamp as _timestamp, cast(null as varchar) as _schema_fingerprint"""


@query(
    "prj8_typed_projection",
    f"""select {_STAGED}, creation_time::double as "_creationTime", cents, users_mix as mix, props_text as props, whole,
        document as _document_json from {RAW_VALID} where table_name = 'users' and document is not null""",
)
def typed_projection(spark, sf_dir):
    users = live(raw_events(spark, sf_dir)).where("table_name = 'users'")
    kinds = [("_creationTime", "Float64"), ("cents", "Int64"), ("mix", "Float64"), ("props", "JsonUtf8"), ("whole", "Float64")]
    return project_staging(users, kinds)


@query(
    "prj8_typed_projection_mixed",
    f"""select {_STAGED}, cast(creation_time as double) as "_creationTime", cents, accounts_mix as mix, props_text as props, whole, document as _document_json
        from {RAW_VALID} where table_name = 'accounts' and document is not null""",
)
def typed_projection_mixed(spark, sf_dir):
    accounts = live(raw_events(spark, sf_dir)).where("table_name = 'accounts'")
    inferred = staging_columns(accounts).select("field", "kind").distinct().collect()
    return project_staging(accounts, [(row["field"], row["kind"]) for row in inferred])


@query(
    "agg3_bronze_types",
    f"""select distinct table_name, unnest(['_creationTime', 'cents', 'mix', 'props', 'whole']) as field,
        unnest(['double', 'bigint', case when table_name = 'users' then 'double' else 'string' end, 'string', 'double']) as type
        from {RAW_VALID} where document is not null""",
)
def bronze_types(spark, sf_dir):
    flags = observed_flags(raw_events(spark, sf_dir), "document", ["table_name"])
    return flags.select("table_name", "field", bronze_type("flags").alias("type"))


@query(
    "agg4_union_column_set",
    f"""select distinct table_name, '_creationTime,cents,mix,props,whole' as fields
        from {RAW_VALID} where document is not null""",
)
def union_column_set(spark, sf_dir):
    flags = observed_flags(raw_events(spark, sf_dir), "document", ["table_name"])
    # One row per table and field is left here, so the set is as small as a table is wide.
    return flags.groupBy("table_name").agg(F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields"))


@query(
    "prj9_bronze_cast",
    f"""select document_id, ord as position, v.cents, v.mix, v.props, v.whole from (
        select *, case when document is not null then {{'cents': cents, 'props': props_text, 'whole': whole,
            'mix': case ord % 5 when 1 then 'True' else accounts_mix end}} end as v
        from {RAW_VALID} where table_name = 'accounts')""",
)
def bronze_cast(spark, sf_dir):
    accounts = raw_events(spark, sf_dir).where("table_name = 'accounts'")
    mixed = 1 | 2 | 8 | 16
    columns = [("cents", "bigint", 2), ("mix", "string", mixed), ("props", "string", 16), ("whole", "double", 4)]
    return project_bronze(accounts, "document", columns, ["document_id", "position"])


@query(
    "prj28_reserved_columns",
    """select 'kept' as field, count(*) as n from events
       union all select '_extra', count(*) from events""",
)
def reserved_columns(spark, sf_dir):
    document = F.concat(
        F.lit('{"_timestamp":1,"_document_json":"x","_table_name":2,"_component_path":3,"_document_id":4,'
              '"_schema_fingerprint":5,"_extra":6,"kept":'), F.col("event_id").cast("string"), F.lit("}"),
    )
    fields = explode_fields(table(spark, sf_dir, "events").select(document.alias("document")), "document", [])
    kept = fields.where(~F.col("field").isin(RESERVED_STAGING_COLUMNS))
    return kept.groupBy("field").agg(F.count("*").alias("n"))


@query(
    "prj24_column_exclusion",
    f"select document_id as _cdc_document_id, props_text as props from {RAW_VALID} where document is not null",
)
def column_exclusion(spark, sf_dir):
    rows = bronze_rows(live(raw_events(spark, sf_dir)), "s1", "r1")
    props = F.from_json(CDC_RAW_DOCUMENT_JSON, "props string").getField("props")
    return rows.withColumn("props", props).drop(*SILVER_DROPPED_COLUMNS, "batch", "position")


# --- set operations and file sets -------------------------------------------------------------


@query(
    "jn3_new_loads",
    """select distinct strftime(l_shipdate, '%Y-%m-%d') as load_id from lineitem where l_shipdate not in
       (select o_orderdate from orders where o_orderpriority = '1-URGENT')""",
)
def new_loads(spark, sf_dir):
    def day(name):
        return F.date_format(name, "yyyy-MM-dd").alias("load_id")

    listed = table(spark, sf_dir, "lineitem").select(day("l_shipdate")).distinct()
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return unprocessed(listed, urgent.select(day("o_orderdate")).distinct(), "load_id")


@query(
    "set3_file_set_difference",
    "select concat('o-', cast(o_orderkey as varchar)) as file_name from orders where o_orderkey not in (select l_orderkey from lineitem)",
)
def file_set_difference(spark, sf_dir):
    named = lambda key: F.concat(F.lit("o-"), F.col(key).cast("string")).alias("file_name")
    listed = table(spark, sf_dir, "orders").select(named("o_orderkey"))
    return unprocessed(listed, table(spark, sf_dir, "lineitem").select(named("l_orderkey")), "file_name")


_AFFECTED = f"(select distinct component_path, table_name from {LOG_E.sql} where op = 'delete' and component_path <> 'workflow')"


@query("agg5_affected_tables", f"select * from {_AFFECTED}")
def tables_affected(spark, sf_dir):
    return affected_tables(log_rows(LOG_E, spark, sf_dir).where("op = 'delete' and component_path <> 'workflow'"))


@query(
    "jn4_affected_rows",
    f"""select {LOG_NAMES} from {live_sql(LOG_E.sql)} s
        where exists (select 1 from {_AFFECTED} a where a.component_path = s.component_path and a.table_name = s.table_name)""",
)
def affected_rows(spark, sf_dir):
    log = log_rows(LOG_E, spark, sf_dir)
    touched = affected_tables(log.where("op = 'delete' and component_path <> 'workflow'"))
    return only_affected(current_state(log), touched).select(*RAW_LOG_COLUMNS)


@query(
    "set5_snapshot_delta_union",
    f"""select phase, table_name, count(*) as events from (
        select 'initial_snapshot' as phase, table_name from {LOG_L.sql}
        union all select 'delta_tail', table_name from {LOG_E.sql}) group by all""",
)
def snapshot_delta_union(spark, sf_dir):
    snapshot = log_rows(LOG_L, spark, sf_dir).withColumn("phase", F.lit("initial_snapshot"))
    deltas = log_rows(LOG_E, spark, sf_dir).withColumn("phase", F.lit("delta_tail"))
    return snapshot.unionByName(deltas).groupBy("phase", "table_name").agg(F.count("*").alias("events"))


@query(
    "agg6_load_counts",
    f"select ship_year as load_id, count(distinct batch) as batches, count(*) as events from {LOG_L.sql} group by 1",
)
def counts_of_loads(spark, sf_dir):
    return load_counts(LOG_L.frame(spark, sf_dir).withColumn("load_id", F.col("ship_year")))


@query(
    "agg14_routed_counts",
    f"""select concat('src__', case component_path when '' then 'app' else component_path end, '__', table_name, '__cdc') as target,
        count(*) as row_count from {RAW_VALID} group by 1""",
)
def routed_event_counts(spark, sf_dir):
    named = normalise(RAWDOC.frame(spark, sf_dir), on_error="quarantine", fields=["component_path", "table_name"])
    return routed_counts(named.select(bronze_table_name("component_path", "table_name").alias("target")))


# --- type-1 apply ---------------------------------------------------------------------------


@query(
    "str1_apply_changes_batch",
    f"""select component_path as _cdc_source_component, table_name as _cdc_source_table, document_id as _cdc_document_id, k from (
        select *, cast(json_extract(document, '$.k') as bigint) as k from {folded_sql(LOG_E.sql)}) where op <> 'delete'""",
)
def apply_changes_batch(spark, sf_dir):
    events = log_rows(LOG_E, spark, sf_dir).withColumn("creation_time", F.lit(None).cast("double"))
    rows = bronze_rows(events, "s1", "r1").withColumn("k", F.from_json(CDC_RAW_DOCUMENT_JSON, "k bigint").getField("k"))
    keep = [CDC_SOURCE_COMPONENT, CDC_SOURCE_TABLE, CDC_DOCUMENT_ID, "k"]
    current = apply_changes(
        rows, keep[:3], [CDC_SEQUENCE_NUM, "batch", "position"], CDC_IS_DELETED,
    )
    return current.select(*keep)


@query(
    "str1_apply_changes_by_document",
    f"""select _cdc_document_id, _cdc_raw_document_json as document from (
        select document_id as _cdc_document_id, document as _cdc_raw_document_json, op from {LOG_L.sql}
        qualify row_number() over (partition by document_id order by timestamp desc, batch desc, position desc) = 1) where op <> 'delete'""",
)
def apply_changes_by_document(spark, sf_dir):
    events = log_rows(LOG_L, spark, sf_dir).withColumn("creation_time", F.lit(None).cast("double"))
    rows = bronze_rows(events, "s1", "r1").withColumn("document", F.col(CDC_RAW_DOCUMENT_JSON))
    return apply_changes(
        rows, [CDC_DOCUMENT_ID], [CDC_SEQUENCE_NUM, "batch", "position"], CDC_IS_DELETED,
        [*SILVER_DROPPED_COLUMNS, "batch", "position"],
    )


# --- documents with unusual keys ----------------------------------------------------------


@query(
    "prj2_repeated_keys",
    "select event_id as ord, case when event_id % 3 = 0 then 'repeated_key' else 'ok' end as status from events",
)
def repeated_keys(spark, sf_dir):
    """A document that names a key twice is told apart from one that is no object."""
    value = """concat('{"_component":"","_table":"t","_id":"i","_ts":', cast(event_id as string),
        case when event_id % 3 = 0 then ',"k":1,"k":2' else ',"k":1' end, '}')"""
    rows = table(spark, sf_dir, "events").selectExpr("event_id as ord", f"{value} as value")
    return read_metadata(rows).select("ord", F.coalesce("error", F.lit("ok")).alias("status"))


@query(
    "prj9_quoted_names",
    "select event_id as ord, case when event_id % 2 = 0 then 'True' else event_type end as odd from events",
)
def quoted_names(spark, sf_dir):
    """A field whose name holds both kinds of quotes, with booleans and text in it."""
    name = """it's "odd" name"""
    text = F.to_json(F.struct(F.col("event_type").alias(name)))
    flag = F.to_json(F.struct(F.lit(True).alias(name)))
    value = F.when(F.col("event_id") % 2 == 0, flag).otherwise(text)
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), value.alias("document"))
    typed = project_bronze(rows, "document", [(name, "string", BOOL | TEXT)], ["ord"])
    return typed.toDF("ord", "odd")
