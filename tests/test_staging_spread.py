"""Events that spread over the buckets are folded where they are written; crowded ones before."""

from __future__ import annotations

import pytest

from tidefold.plans import staging
from tidefold.schemas import DELETE, LOG_FILE_SCHEMA, UPSERT
from tidefold.sources.changelog import write_load

_BUCKETS = {("a/b", "boats"): 4, ("", "boats"): 2}


def _events(spark, hot=0):
    rows = [
        (*key, f"d{i}", time, DELETE if i % 5 == 4 and time == 3 else UPSERT, None, None if i % 5 == 4 and time == 3 else f'{{"n":{time}}}', "b", i)
        for key in _BUCKETS for i in range(20) for time in (2, 3, 1)
    ]
    rows += [("", "boats", "d0", 10 + n, UPSERT, None, f'{{"n":{n}}}', "b", n) for n in range(hot)]
    return spark.createDataFrame(rows, LOG_FILE_SCHEMA)


def _rows(frame):
    return sorted(map(str, frame.collect()))


def test_spread_events_are_folded_in_one_exchange(spark, tmp_path):
    events, keys = _events(spark), staging._KEYS
    spread = staging.state_rows(None, events, _BUCKETS, 6, fold_first=False)
    plan = spread.sortWithinPartitions(*keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1, plan
    assert not any(spread.schema[name].nullable for name in keys[:2])
    first = staging.state_rows(None, events, _BUCKETS, 6)
    assert _rows(spread) == _rows(first) and len(_rows(first)) == 40
    path = str(tmp_path / "state")
    first.write.partitionBy(*keys).parquet(path)
    stored = spark.read.schema(staging.STATE_SCHEMA).parquet(path).select(*staging.STATE_SCHEMA.fieldNames())
    later = events.selectExpr(*[f"timestamp + position % 2 as {n}" if n == "timestamp" else n for n in events.columns])
    assert _rows(staging.state_rows(stored, later, _BUCKETS, 6, fold_first=False)) == _rows(staging.state_rows(stored, later, _BUCKETS, 6))


@pytest.mark.parametrize("hot", [0, 500])
def test_a_crowded_bucket_is_folded_before(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(staging, "CROWDED_EVENTS", 100)
    seen, real = [], staging.state_rows
    monkeypatch.setattr(staging, "state_rows", lambda *args: seen.append(args[4]) or real(*args))
    log, root = str(tmp_path / "log"), str(tmp_path / "staging")
    write_load(_events(spark, hot), log, "all")
    # Some eight buckets a table, so that one of them can be crowded.
    staging.materialise(spark, log, root, bucket_bytes=64 if not hot else 1024)
    assert seen == [bool(hot)]
    found = {r["_document_id"]: r["n"] for r in staging.read_staging(spark, root, "", "boats").collect()}
    assert found == {f"d{i}": 3 for i in range(20) if i % 5 != 4} | ({"d0": hot - 1} if hot else {})
