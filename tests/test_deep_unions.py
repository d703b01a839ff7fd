"""Unions are unfolded where they are parsed, and once for equal schemas."""

from __future__ import annotations

import json

from tidefold.functions.kinds import FLOAT, INT, NESTED, TEXT, schema_field_flags


def _below(node, levels):
    for level in range(levels):
        node = {"anyOf" if level % 2 else "oneOf": [{"type": "null"}, node]}
    return node


def test_levels_of_unions_start_no_jobs_and_equal_schemas_are_unfolded_once(spark):
    deep = {"properties": {"f": _below({"type": ["integer", "string"]}, 40), "g": {"anyOf": [{"type": "number"}, {"oneOf": []}]}}}
    odd = {"properties": {"h": {"anyOf": "x", "oneOf": [{"type": "object"}]}, "_creationTime": _below({"type": "string"}, 2), "n": None}}
    rows = [(f"t{n}", json.dumps(deep)) for n in range(30)] + [("odd", json.dumps(odd)), ("none", None), ("list", "[1]")]
    spark.sparkContext.setJobGroup("deep-unions", "")
    flags = schema_field_flags(spark.createDataFrame(rows, "table_name string, schema_json string"))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("deep-unions")) == []
    spark.sparkContext.setJobGroup("", "")
    found = {(r["table_name"], r["field"]): r["flags"] for r in flags.collect()}
    wanted = {(f"t{n}", field): value for n in range(30) for field, value in (("f", INT | TEXT), ("g", FLOAT))}
    assert found == {**wanted, ("odd", "h"): NESTED, ("odd", "_creationTime"): FLOAT, ("odd", "n"): 0}
