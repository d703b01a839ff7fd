from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidefold.functions.events import bronze_rows, normalise, quarantined, read_metadata
from tidefold.functions.jsontext import canonical_json


def rows(spark, texts):
    return spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, value string")


def test_upsert_keeps_user_fields_and_creation_time(spark):
    text = '{"wind":3.50,"_ts":9001,"_table":"gauges","_seen":[1],"_id":"g/5","_creationTime":88.25,"_component":"north/sea"}'
    event = normalise(rows(spark, [text]), creation_time=True).first()
    assert (event["component_path"], event["table_name"], event["document_id"]) == ("north/sea", "gauges", "g/5")
    assert (event["timestamp"], event["op"], event["creation_time"]) == (9001, "upsert", 88.25)
    assert event["document"] == '{"_creationTime":88.25,"wind":3.5}'


def test_delete_has_no_document(spark):
    text = '{"_deleted":true,"_table":"tides","_id":"low","_component":"","tag":"gone","_ts":-4,"_creationTime":3}'
    event = normalise(rows(spark, [text]), creation_time=True).first()
    assert (event["op"], event["document"], event["creation_time"]) == ("delete", None, 3.0)
    bronze = bronze_rows(
        normalise(rows(spark, [text]), creation_time=True).withColumn("schema_fingerprint", F.lit("f")), "s", "r"
    ).first()
    assert bronze["_cdc_is_deleted"] and bronze["_cdc_raw_document_json"] is None


def test_problems_are_told_apart(spark):
    good = {"_component": "", "_table": "t", "_id": "i", "_ts": 1}

    def changed(**fields):
        return json.dumps({k: v for k, v in {**good, **fields}.items() if v != "drop"})

    cases = {
        changed(): None,
        changed(_component="drop"): "missing:_component",
        changed(_component=None): "invalid:_component",
        changed(_table=5): "invalid:_table",
        changed(_id=1.0): "invalid:_id",
        changed(_id="1.0"): None,
        changed(_ts="drop"): "missing:_ts",
        changed(_ts="7"): "invalid:_ts",
        changed(_ts=7.0): "invalid:_ts",
        changed(_ts=7.5): "invalid:_ts",
        changed(_ts=True): "invalid:_ts",
        changed(_ts=2**63): "invalid:_ts",
        changed(_ts=2**63 - 1): None,
        changed(_deleted="yes"): None,
        " \n" + changed(): None,
        "[1]": "not_an_object",
        "7": "not_an_object",
        '{"_id":': "not_an_object",
        '{"_component":"","_table":"t","_id":"i","_ts":1,"x":1,"x":2}': "repeated_key",
        changed(_id="\ue0005.0"): None,
    }
    frame = rows(spark, list(cases))
    checked = {r["value"]: r for r in read_metadata(frame).collect()}
    assert {text: checked[text]["error"] for text in cases} == cases
    assert checked[changed(_deleted="yes")]["op"] == "upsert"
    bad = sum(error is not None for error in cases.values())
    assert quarantined(frame).count() == bad
    assert normalise(frame, on_error="quarantine").count() == len(cases) - bad
    with pytest.raises(Exception, match="bad source document"):
        normalise(frame).collect()


def _value(rng, depth):
    kind = rng.randrange(9 if depth else 7)
    if kind == 0:
        return None
    if kind == 1:
        return rng.random() < 0.5
    if kind == 2:
        return rng.randrange(-(10**12), 10**12)
    if kind == 3:
        return float(rng.randrange(-(10**6), 10**6))
    if kind == 4:
        return rng.randrange(-(10**6), 10**6) / 64
    if kind == 5:
        return rng.choice(["", "a 1.0 b", ": 1.0,", '[2.0]"', "\\ 3.0, \\\"", "é😀\n\t", "{\"a\": 1.0}", "-0.0"])
    if kind == 6:
        return rng.randrange(100)
    if kind == 7:
        return [_value(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["b", "a", "1.0", "é", "x y", 'q"q']): _value(rng, depth - 1) for _ in range(rng.randrange(4))}


def test_canonical_json_equals_a_json_library(spark):
    rng = random.Random(7)
    documents = [{"k": _value(rng, 3), "a": _value(rng, 2)} for _ in range(1500)]
    loose = [json.dumps(d, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5) for d in documents]
    wanted = [json.dumps(d, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for d in documents]
    got = rows(spark, loose).select("n", canonical_json("value").alias("c")).orderBy("n").collect()
    assert [r["c"] for r in got] == wanted


def test_canonical_json_edges(spark):
    long_text = "x\\n" * 50_000
    cases = {
        '{"a":1.00,"b":1.50,"c":100}': '{"a":1.0,"b":1.5,"c":100}',
        '{"a":-5.0}': '{"a":-5.0}',
        "not json": None,
        '{"a":1.0': None,
        '{"u":18446744073709551615}': '{"u":18446744073709551615}',
        f'{{"t":"{long_text}","n":2.0}}': f'{{"n":2.0,"t":"{long_text}"}}',
    }
    got = rows(spark, list(cases)).select("n", canonical_json("value").alias("c")).orderBy("n").collect()
    assert [r["c"] for r in got] == list(cases.values())


def test_marks_in_documents_stay_text(spark):
    """Characters the parser uses as marks, raw or escaped, change neither numbers nor strings."""
    cases = {
        '{"a": 1.0, "b": "\ue000"}': '{"a":1.0,"b":"\ue000"}',
        '{"a": "\ue0005.0"}': '{"a":"\ue0005.0"}',
        '{"a": "\\ue0005.0", "b": [2.0]}': '{"a":"\ue0005.0","b":[2.0]}',
        '{"a": "\\uE000\\ue0017.0"}': '{"a":"\ue000\ue0017.0"}',
        '{"a": "\\\\ue0005.0", "n": 3.0}': '{"a":"\\\\ue0005.0","n":3.0}',
        '{"\ue000k": 4.00}': '{"\ue000k":4.0}',
    }
    got = rows(spark, list(cases)).orderBy("n").select(canonical_json("value").alias("c")).collect()
    assert [r["c"] for r in got] == list(cases.values())
    event = normalise(rows(spark, ['{"_component":"","_table":"t","_id":"\ue0001.0","_ts":1,"v":"\ue0002.0"}'])).first()
    assert (event["document_id"], event["document"]) == ("\ue0001.0", '{"v":"\ue0002.0"}')
