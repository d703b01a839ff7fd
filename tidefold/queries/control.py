"""Checkpoint history and monitoring."""

from __future__ import annotations


from pyspark.sql import functions as F

from tidefold.functions.names import bronze_table_name, logical_name
from tidefold.operators.checkpoints import (
    checkpoint_writes,
    latest_checkpoints,
    recent_checkpoints,
    resume_checkpoint,
    smoke_check,
)
from tidefold.operators.fold import current_state
from tidefold.plans.monitoring import (
    bronze_roll_up,
    count_tables,
    dashboard_measures,
    lag_minutes,
    logical_table_names,
    sync_summary,
    table_count,
    table_inventory,
    table_row_counts,
)
from tidefold.plans.monitoring import rows_per_table as rows_per_table_of
from tidefold.queries.inputs import CAT_B, CAT_S, CKPT, LOG_E, live_sql, log_rows, table
from tidefold.queries.registry import query
from tidefold.schemas import CHECKPOINT_COLUMNS, INITIAL_SNAPSHOT
from tidefold.session import scratch_path
from tidefold.sources.control import append_checkpoints, read_history

_NAMES = ", ".join(CHECKPOINT_COLUMNS)
_LATEST = f"(select * from {CKPT.sql} qualify row_number() over (partition by source_id order by updated_at desc, run_id desc) = 1)"
# A fixed clock makes lags comparable; the data ends before it.
_NOW = "timestamp '2002-01-01 00:00:00'"
_LAG = "round((epoch(timestamp '2002-01-01 00:00:00') - epoch(updated_at)) / 60.0, 2)::double"


@query("win1_latest_checkpoint", f"select {_NAMES} from {_LATEST}")
def latest_checkpoint(spark, sf_dir):
    return latest_checkpoints(CKPT.frame(spark, sf_dir))


@query("mon1_checkpoint_latest_view", f"select {_NAMES} from {_LATEST}")
def checkpoint_latest_view(spark, sf_dir):
    latest_checkpoints(CKPT.frame(spark, sf_dir)).createOrReplaceTempView("connector_checkpoint_latest")
    return spark.table("connector_checkpoint_latest")


def _stored_history(spark, sf_dir) -> str:
    """The history as a control table on disk."""
    path = scratch_path(spark, "control")
    rows = CKPT.frame(spark, sf_dir).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    rows.withColumn("write_seq", F.monotonically_increasing_id()).write.parquet(path)
    return path


@query("src9_checkpoint_history", f"select {_NAMES} from {CKPT.sql} where source_id = 'src7'")
def checkpoint_history(spark, sf_dir):
    return read_history(spark, _stored_history(spark, sf_dir), "src7").select(*CHECKPOINT_COLUMNS).withColumn(
        "updated_at", F.col("updated_at").cast(dict(CKPT.frame(spark, sf_dir).dtypes)["updated_at"])
    )


@query(
    "srt3_resume_checkpoint",
    f"select {_NAMES} from {CKPT.sql} where source_id = 'src7' order by updated_at desc, run_id desc limit 1",
)
def resume(spark, sf_dir):
    return resume_checkpoint(CKPT.frame(spark, sf_dir), "src7")


_RECENT = f"""select source_id, phase, snapshot_ts, delta_cursor, run_id, updated_at from {CKPT.sql}
    order by updated_at desc, run_id desc limit 50"""


@query("srt4_recent_checkpoints", _RECENT)
def recent(spark, sf_dir):
    return recent_checkpoints(CKPT.frame(spark, sf_dir))


@query("mon3_recent_checkpoints", _RECENT)
def recent_view(spark, sf_dir):
    recent_checkpoints(read_history(spark, _stored_history(spark, sf_dir))).createOrReplaceTempView("recent_checkpoints")
    kind = dict(CKPT.frame(spark, sf_dir).dtypes)["updated_at"]
    return spark.table("recent_checkpoints").withColumn("updated_at", F.col("updated_at").cast(kind))


@query("srt5_smoke_check", f"select source_id, phase, updated_at from {_LATEST} order by updated_at desc, source_id limit 5")
def smoke(spark, sf_dir):
    return smoke_check(CKPT.frame(spark, sf_dir))


@query("agg8_checkpoint_writes", f"select source_id, count(*) as checkpoint_write_count from {CKPT.sql} group by 1")
def writes(spark, sf_dir):
    return checkpoint_writes(CKPT.frame(spark, sf_dir))


@query("prj23_checkpoint_lag", f"select run_id, {_LAG} as lag from {CKPT.sql}")
def lag(spark, sf_dir):
    minutes = lag_minutes(F.col("updated_at").cast("timestamp"), F.expr(_NOW)).cast("double")
    return CKPT.frame(spark, sf_dir).select("run_id", minutes.alias("lag"))


_COUNT_B = f"(select count(distinct table_name) from {CAT_B.sql} where left(table_name, 2) <> '__' and not starts_with(table_name, 'event_log_') and table_type <> 'VIEW')"
_COUNT_S = f"(select count(distinct table_name) from {CAT_S.sql})"


@query("agg9_layer_table_count", f"select {_COUNT_B} as bronze_table_count")
def layer_count(spark, sf_dir):
    return table_count(CAT_B.frame(spark, sf_dir), "bronze_table_count")


_SUMMARY = f"""(select l.source_id, l.phase, l.updated_at, {_LAG} as checkpoint_lag_minutes,
    coalesce(c.n, 0) as checkpoint_write_count, {_COUNT_B} as bronze_table_count, {_COUNT_S} as silver_table_count
    from {_LATEST} l left join (select source_id, count(*) as n from {CKPT.sql} group by 1) c on c.source_id = l.source_id)"""


def _summary(spark, sf_dir):
    history = CKPT.frame(spark, sf_dir).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    summary = sync_summary(history, CAT_B.frame(spark, sf_dir), CAT_S.frame(spark, sf_dir), F.expr(_NOW))
    return summary.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")).withColumn(
        "checkpoint_lag_minutes", F.col("checkpoint_lag_minutes").cast("double")
    )


@query("mon2_sync_summary", f"select * from {_SUMMARY}")
def summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query("jn6_latest_with_counts", f"select source_id, phase, checkpoint_write_count from {_SUMMARY}")
def latest_with_counts(spark, sf_dir):
    return _summary(spark, sf_dir).select("source_id", "phase", "checkpoint_write_count")


@query("jn7_counts_on_every_source", f"select source_id, bronze_table_count, silver_table_count from {_SUMMARY}")
def counts_on_every_source(spark, sf_dir):
    return _summary(spark, sf_dir).select("source_id", "bronze_table_count", "silver_table_count")


@query(
    "agg12_dashboard_measures",
    f"""select max(bronze_table_count) as bronze_table_count, max(silver_table_count) as silver_table_count,
        max(checkpoint_lag_minutes) as checkpoint_lag_minutes, max(checkpoint_write_count) as checkpoint_write_count from {_SUMMARY}""",
)
def measures(spark, sf_dir):
    return dashboard_measures(_summary(spark, sf_dir))


def _layer_sql(listing: str, layer: str, logical: str) -> str:
    return f"""(select {logical} as logical_table, table_name as {layer}_table,
        string_agg(distinct table_type, ', ' order by table_type) as {layer}_type, min(created) as {layer}_created,
        max(last_altered) as {layer}_last_altered from {listing}
        where left(table_name, 2) <> '__' and not starts_with(table_name, 'event_log_') and table_type <> 'VIEW' group by 1, 2)"""


_BRONZE_LAYER = _layer_sql(CAT_B.sql, "bronze", "regexp_replace(table_name, '__cdc$', '')")
_SILVER_LAYER = _layer_sql(CAT_S.sql, "silver", "table_name")
_INVENTORY = f"""select coalesce(b.logical_table, s.logical_table) as logical_table, bronze_table, silver_table, bronze_type, silver_type,
    bronze_last_altered, silver_last_altered from {_BRONZE_LAYER} b full join {_SILVER_LAYER} s on b.logical_table = s.logical_table order by 1"""


def _ntz(df):
    changed = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in changed})


@query("mon4_table_inventory", _INVENTORY)
def inventory(spark, sf_dir):
    return _ntz(table_inventory(CAT_B.frame(spark, sf_dir), CAT_S.frame(spark, sf_dir)))


@query("agg10_inventory_roll_up", f"select * from {_BRONZE_LAYER}")
def roll_up(spark, sf_dir):
    return _ntz(bronze_roll_up(CAT_B.frame(spark, sf_dir)))


@query("srt6_inventory_order", f"select logical_table from ({_INVENTORY}) order by 1")
def inventory_order(spark, sf_dir):
    return table_inventory(CAT_B.frame(spark, sf_dir), CAT_S.frame(spark, sf_dir)).select("logical_table")


@query(
    "jn8_bronze_silver_outer",
    f"select logical_table, bronze_table is not null as in_bronze, silver_table is not null as in_silver from ({_INVENTORY})",
)
def bronze_silver_outer(spark, sf_dir):
    rows = table_inventory(CAT_B.frame(spark, sf_dir), CAT_S.frame(spark, sf_dir))
    return rows.select(
        "logical_table",
        F.col("bronze_table").isNotNull().alias("in_bronze"),
        F.col("silver_table").isNotNull().alias("in_silver"),
    )


@query(
    "set2_logical_names",
    f"select regexp_replace(table_name, '__cdc$', '') as logical_table from {CAT_B.sql} union select table_name from {CAT_S.sql}",
)
def logical_names(spark, sf_dir):
    return logical_table_names(CAT_B.frame(spark, sf_dir), CAT_S.frame(spark, sf_dir))


_TARGET = "concat('src__', case component_path when '' then 'app' when 'r2/cache' then 'r2_cache' else component_path end, '__', table_name, '__cdc')"


def _layers(spark, sf_dir):
    log = log_rows(LOG_E, spark, sf_dir)
    name = bronze_table_name("component_path", "table_name")
    bronze = log.select(name.alias("table_name"))
    silver = current_state(log).where("component_path <> 'workflow'").select(logical_name(name).alias("table_name"))
    return bronze, silver


_ROW_COUNTS = f"""select coalesce(b.l, s.l) as logical_table, b.t as bronze_table, b.n as bronze_row_count, s.l as silver_table, s.n as silver_row_count from
    (select {_TARGET} as t, regexp_replace({_TARGET}, '__cdc$', '') as l, count(*) as n from {LOG_E.sql} group by 1, 2) b full join
    (select regexp_replace({_TARGET}, '__cdc$', '') as l, count(*) as n from {live_sql(LOG_E.sql)} where component_path <> 'workflow' group by 1) s
    on b.l = s.l"""


@query("mon5_table_row_counts", _ROW_COUNTS)
def row_counts(spark, sf_dir):
    return table_row_counts(*_layers(spark, sf_dir))


@query("agg11_rows_per_table", f"select {_TARGET} as table_name, count(*) as row_count from {LOG_E.sql} group by 1")
def rows_per_table(spark, sf_dir):
    bronze, _ = _layers(spark, sf_dir)
    return rows_per_table_of(bronze)


_COUNTED = ["customer", "orders", "lineitem", "events", "documents"]


@query(
    "set1_union_of_counts",
    " union all ".join(f"select '{name}' as table_name, count(*) as row_count from {name}" for name in _COUNTED),
)
def union_of_counts(spark, sf_dir):
    return count_tables(spark, {name: table(spark, sf_dir, name) for name in _COUNTED})


@query(
    "snk6_checkpoint_append",
    """select 'src' as source_id, case when o_orderstatus = 'P' then 'initial_snapshot' else 'delta_tail' end as phase,
        case when o_orderstatus = 'P' then o_orderkey end as snapshot_ts, case when o_orderstatus <> 'P' then o_orderkey end as delta_cursor,
        case when o_orderstatus = 'P' then 'r1' else 'r2' end as run_id, 'h' as schema_hash, true as stamped from orders""",
)
def checkpoint_append(spark, sf_dir):
    path = scratch_path(spark, "control")
    history = CKPT.frame(spark, sf_dir).withColumn("write_seq", F.monotonically_increasing_id())
    in_snapshot = F.col("phase") == INITIAL_SNAPSHOT
    append_checkpoints(history.where(in_snapshot), path, "src", "r1", "h")
    append_checkpoints(history.where(~in_snapshot), path, "src", "r2", "h")
    return read_history(spark, path, "src").select(
        "source_id", "phase", "snapshot_ts", "delta_cursor", "run_id", "schema_hash",
        F.col("updated_at").isNotNull().alias("stamped"),
    )


