"""The summary of a materialise run where changes of a document have the same time."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from tidefold.queries import ORACLES, QUERIES


def test_materialise_summary_with_a_delete_and_an_upsert_at_the_same_time(spark, tmp_path):
    rows = [(1, "R"), (1, "A"), (2, "N"), (3, "A")]
    lines = spark.createDataFrame(rows, "l_orderkey bigint, l_returnflag string").select(
        "*", F.lit(1).alias("l_linenumber"), F.lit(7).cast("bigint").alias("l_partkey"), F.lit(3).cast("bigint").alias("l_suppkey"),
        F.lit(2.0).alias("l_quantity"), F.lit(10.0).alias("l_extendedprice"), F.lit("F").alias("l_linestatus"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("l_shipdate"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = [tuple(r) for r in QUERIES["agg6_materialise_summary"](spark, str(tmp_path)).collect()]
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    connection.execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert got == connection.execute(ORACLES["agg6_materialise_summary"]).fetchall()
