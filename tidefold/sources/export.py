"""JSON lines: one compact object per row, absent fields left out."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def append_json_lines(rows: DataFrame, path: str) -> bool:
    """Append rows; nothing at all happens for an empty input. Returns whether rows were written."""
    if rows.isEmpty():
        return False
    rows.write.mode("append").json(path)
    return True
