"""One streaming query per selected bronze table.

    <root>/<flow>/state/       the silver table of the flow
    <root>/<flow>/checkpoint/  how far its query has come

The selection says which flows there are. Comparing it with the queries that run gives what to do:
selected flows without a query are started, and go on where their checkpoint ends; queries whose
flow is not selected any more are stopped and keep their folder, so a flow that is selected again
catches up on what it missed. Each flow has a scheduler pool of its own: under the fair scheduler a
large table does not hold up the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidefold.functions.names import directory_key_text
from tidefold.sources.bronze import stream_bronze_rows
from tidefold.streaming.silver import ChangeTable, silver_table, start

_POOL = "spark.scheduler.pool"


def _folder(root: str, flow: str) -> str:
    return f"{root}/{directory_key_text(flow)}"


def _query_name(root: str, flow: str) -> str:
    return f"{flow} in {root}"


def flow_table(root: str, flow: str) -> ChangeTable:
    """The silver table that a flow keeps."""
    return silver_table(f"{_folder(root, flow)}/state")


def running(spark: SparkSession, root: str) -> dict[str, StreamingQuery]:
    """Queries of the flows below `root`, by flow."""
    ending = _query_name(root, "")
    return {q.name[: -len(ending)]: q for q in spark.streams.active if q.name and q.name.endswith(ending)}


def sync_flows(
    spark: SparkSession, flows: DataFrame, bronze_root: str, root: str, continuous_every: str | None = None, max_files: int = 1000
) -> dict[str, StreamingQuery]:
    """Make the running queries those of `flows(table_name, flow_name)`; returns the queries that were started.

    Without an interval each query takes what is there and ends. There is one short row per flow.
    """
    wanted = {row["flow_name"]: row["table_name"] for row in flows.select("table_name", "flow_name").collect()}
    active = running(spark, root)
    for flow in sorted(set(active) - set(wanted)):
        active[flow].stop()
    started = {}
    for flow in sorted(set(wanted) - set(active)):
        changes = stream_bronze_rows(spark, bronze_root, max_files).where(F.col("target") == wanted[flow])
        spark.sparkContext.setLocalProperty(_POOL, flow)
        try:
            started[flow] = start(
                changes, flow_table(root, flow), f"{_folder(root, flow)}/checkpoint", continuous_every, name=_query_name(root, flow)
            )
        finally:
            spark.sparkContext.setLocalProperty(_POOL, None)
    return started
