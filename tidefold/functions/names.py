"""Names, paths and keys as column expressions.

Three sanitisers exist on purpose: bronze names fold case and collapse, flow names do
neither, view names know about paths. They give different results and are not merged.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidefold.schemas import CHECKPOINT_VERSION, DELTA_TAIL, INITIAL_SNAPSHOT

# --- Fixed values: formats of names and keys --------------------------------------------
ROOT_DIRECTORY = "_root"
EMPTY_NAME = "root"
DEFAULT_COMPONENT = "app"
CDC_SUFFIX = "__cdc"
FLOW_PREFIX = "autocdc_"
PARQUET_SUFFIX = ".parquet"
# --- end of fixed values ----------------------------------------------------------------

# First part of a bronze table name; a deployment picks its own.
BRONZE_PREFIX = "src"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _prefix_digit(name: Column, prefix: str) -> Column:
    return F.when(name.rlike("^[0-9]"), F.concat(F.lit(prefix), name)).otherwise(name)


def bronze_identifier(value: Column | str) -> Column:
    """Lower-case identifier; runs of other characters become one underscore."""
    trimmed = F.btrim(F.regexp_replace(_col(value), "[^A-Za-z0-9_]+", "_"), F.lit("_"))
    return F.lower(_prefix_digit(F.when(trimmed == "", EMPTY_NAME).otherwise(trimmed), "t_"))


def bronze_table_name(component: Column | str, table: Column | str, prefix: str = BRONZE_PREFIX) -> Column:
    component = _col(component)
    named = F.when((component == "") | component.isNull(), DEFAULT_COMPONENT).otherwise(component)
    return F.concat_ws("__", F.lit(prefix), bronze_identifier(named), bronze_identifier(table), F.lit("cdc"))


def flow_identifier(value: Column | str) -> Column:
    """Case-keeping identifier; every other character becomes an underscore of its own."""
    return _prefix_digit(F.regexp_replace(_col(value), "[^A-Za-z0-9_]", "_"), "t_")


def view_name(relative_path: Column | str) -> Column:
    """View name of a published table path."""
    stem = F.regexp_replace(_col(relative_path), r"\.parquet$", "")
    stem = F.regexp_replace(stem, f"^{ROOT_DIRECTORY}/", "")
    stem = F.replace(stem, F.lit("/"), F.lit("__"))
    return _prefix_digit(F.regexp_replace(stem, "[^A-Za-z0-9_]+", "_"), "t__")


def logical_name(table: Column | str, override: Column | str | None = None) -> Column:
    """Name without the bronze suffix, unless an override is given."""
    stripped = F.regexp_replace(_col(table), f"{CDC_SUFFIX}$", "")
    return stripped if override is None else F.coalesce(_col(override), stripped)


def flow_name(target: Column | str, override: Column | str | None = None) -> Column:
    derived = F.concat(F.lit(FLOW_PREFIX), flow_identifier(target))
    return flow_identifier(derived if override is None else F.coalesce(_col(override), derived))


def staging_path(component: Column | str, table: Column | str) -> Column:
    """Relative path of a staging table: component segments, then the table file."""
    component = _col(component)
    segments = F.array_join(F.filter(F.split(component, "/"), lambda part: part != ""), "/")
    directory = F.when(component == "", ROOT_DIRECTORY).otherwise(segments)
    return F.concat(directory, F.lit("/"), _col(table), F.lit(PARQUET_SUFFIX))


def staging_path_text(component: str, table: str) -> str:
    """The same path for names that are known on the driver."""
    directory = "/".join(part for part in component.split("/") if part) if component else ROOT_DIRECTORY
    return f"{directory}/{table}{PARQUET_SUFFIX}"


def directory_key(value: Column | str) -> Column:
    """Partition directory value: readable, free of characters that need escaping, never empty.

    The checksum keeps apart names that differ in case or in special characters only.
    """
    value = _col(value)
    checksum = F.lpad(F.lower(F.hex(F.crc32(value))), 8, "0")
    return F.concat(F.regexp_replace(value, "[^A-Za-z0-9_]", "_"), F.lit("-"), checksum)


def directory_key_text(value: str) -> str:
    """The same key for a name that is known on the driver."""
    return f"{re.sub('[^A-Za-z0-9_]', '_', value)}-{zlib.crc32(value.encode()):08x}"


def checkpoint_json(phase: Column, snapshot: Column, snapshot_cursor: Column, delta_cursor: Column) -> Column:
    """Compact JSON of the checkpoint that a page leads to."""
    version = F.lit(CHECKPOINT_VERSION).alias("version")
    in_snapshot = F.struct(
        F.lit(INITIAL_SNAPSHOT).alias("phase"), snapshot.alias("snapshot"), snapshot_cursor.alias("cursor")
    )
    in_tail = F.struct(F.lit(DELTA_TAIL).alias("phase"), delta_cursor.alias("cursor"))
    return F.when(phase == INITIAL_SNAPSHOT, F.to_json(F.struct(version, in_snapshot.alias("sync_state")))).when(
        phase == DELTA_TAIL, F.to_json(F.struct(version, in_tail.alias("sync_state")))
    )


def batch_name(phase: Column, snapshot: Column, snapshot_cursor: Column, delta_cursor: Column) -> Column:
    """Name of the batch written for a checkpoint; equal checkpoints give equal names."""
    digest = F.substring(F.sha2(checkpoint_json(phase, snapshot, snapshot_cursor, delta_cursor), 256), 1, 16)
    marker = F.when(phase == INITIAL_SNAPSHOT, snapshot).otherwise(delta_cursor).cast("string")
    return F.concat(phase, F.lit("-"), marker, F.lit("-"), digest)


def key_prefix(prefix: Column | str) -> Column:
    """Prefix without blanks and slashes at its ends; NULL becomes empty."""
    return F.btrim(F.trim(F.coalesce(_col(prefix), F.lit(""))), F.lit("/"))


def join_key(prefix: Column, *parts: Column) -> Column:
    """Slash-joined key; empty parts are skipped."""
    cleaned = [F.nullif(F.btrim(part, F.lit("/")), F.lit("")) for part in (prefix, *parts)]
    return F.concat_ws("/", *cleaned)


def current_key(prefix: Column, relative_path: Column) -> Column:
    return join_key(prefix, F.lit("staging"), F.lit("current"), relative_path)


def versioned_key(prefix: Column, publish_id: Column, relative_path: Column) -> Column:
    return join_key(prefix, F.lit("staging"), F.lit("versions"), publish_id, relative_path)


def manifest_key(prefix: Column, publish_id: Column) -> Column:
    return join_key(prefix, F.lit("staging"), F.lit("manifests"), F.concat(publish_id, F.lit(".json")))


def latest_manifest_key(prefix: Column) -> Column:
    return manifest_key(prefix, F.lit("latest"))
