"""The write of staged buckets sorts its rows once."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidefold.plans import staging
from tidefold.schemas import LOG_FILE_SCHEMA

_BUCKETS = {("a/b", "boats"): 4, ("", "boats"): 2}


def _events(spark, timestamp, document):
    keys = [(*key, f"d{i}") for key in _BUCKETS for i in range(20)]
    return spark.createDataFrame([(*key, timestamp, "upsert", None, document, "b", i) for i, key in enumerate(keys)], LOG_FILE_SCHEMA)


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_rows_leave_the_fold_in_the_order_of_their_folders(spark, tmp_path):
    path, keys = str(tmp_path / "state"), staging._KEYS
    first = staging.state_rows(None, _events(spark, 1, '{"n":1}'), _BUCKETS, 6)
    first.write.partitionBy(*keys).parquet(path)
    stored = spark.read.schema(staging.STATE_SCHEMA).parquet(path).select(*staging.STATE_SCHEMA.fieldNames())
    again = staging.state_rows(stored, _events(spark, 2, '{"n":2}').where("position % 4 = 0"), _BUCKETS, 6)
    for rows in (first, again):
        # Two sorts to fold the events, before and after their exchange, and one for the buckets; the order of the write adds none.
        plan = _plan(rows.sortWithinPartitions(*keys))
        assert plan.count("Sort [") == 3 and "regexp_replace" not in plan, plan
        # Text that may be null would be wrapped by the write, which loses its order.
        assert not any(rows.schema[name].nullable for name in keys[:2])
    found = again.groupBy("component_path", "document").agg(F.count("*").alias("n")).collect()
    assert {(r["component_path"], r["document"]): r["n"] for r in found} == {
        (component, document): n for component in ("a/b", "") for document, n in (('{"n":1}', 15), ('{"n":2}', 5))
    }
