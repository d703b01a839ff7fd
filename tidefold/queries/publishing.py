"""Manifests: what changed, what comes next, and how the result is listed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidefold.operators.diff import DELETED, manifest_diff, next_manifest_entries, publish_summary
from tidefold.operators.select import with_ordinal
from tidefold.plans.publish import source_map
from tidefold.queries.inputs import MANI_CUR, MANI_PREV, current_inventory, previous_inventory
from tidefold.queries.registry import query
from tidefold.schemas import MANIFEST_ENTRY_COLUMNS
from tidefold.session import scratch_path
from tidefold.sources.manifest import latest_manifest, write_manifest

_DIFF = f"""(select coalesce(c.relative_path, p.relative_path) as relative_path, c.sha256, c.bytes,
    p.sha256 as previous_sha256, p.bytes as previous_bytes,
    case when p.relative_path is null then 'new' when c.relative_path is null then 'deleted'
         when c.sha256 = p.sha256 and c.bytes = p.bytes then 'unchanged' else 'changed' end as status
    from {MANI_CUR} c full join {MANI_PREV} p on c.relative_path = p.relative_path)"""

_ENTRIES = f"""(select relative_path, concat('exports/staging/current/', relative_path) as current_key,
    concat('exports/staging/versions/', case when status = 'unchanged' then '100' else '200' end, '/', relative_path) as versioned_key,
    sha256, bytes from {_DIFF} where status <> 'deleted')"""


def _previous(spark, sf_dir):
    path = F.col("relative_path")
    return previous_inventory(spark, sf_dir).select(
        "relative_path",
        F.concat(F.lit("exports/staging/current/"), path).alias("current_key"),
        F.concat(F.lit("exports/staging/versions/100/"), path).alias("versioned_key"),
        "sha256",
        "bytes",
    )


def _diff(spark, sf_dir):
    return manifest_diff(current_inventory(spark, sf_dir), _previous(spark, sf_dir))


@query("jn5_manifest_diff", f"select relative_path, sha256, bytes, previous_sha256, previous_bytes, status from {_DIFF}")
def diff(spark, sf_dir):
    return _diff(spark, sf_dir).drop("current_key", "versioned_key")


@query("jn5_next_manifest", f"select * from {_ENTRIES}")
def next_manifest(spark, sf_dir):
    return next_manifest_entries(_diff(spark, sf_dir), "/exports/", "200")


@query(
    "agg13_publish_summary",
    f"""select count(*) filter (status <> 'deleted') as tables_total, count(*) filter (status in ('new', 'changed')) as tables_uploaded,
        count(*) filter (status = 'deleted') as tables_deleted, count(*) filter (status = 'unchanged') as tables_unchanged,
        count(*) filter (status <> 'unchanged') > 0 as needs_publish from {_DIFF}""",
)
def summary(spark, sf_dir):
    return publish_summary(_diff(spark, sf_dir))


@query("set4_deleted_tables", f"select relative_path from {MANI_PREV} except select relative_path from {MANI_CUR}")
def deleted_tables(spark, sf_dir):
    return _diff(spark, sf_dir).where(F.col("status") == DELETED).select("relative_path")


@query("win2_manifest_ordinal", f"select relative_path, row_number() over (order by relative_path) - 1 as ordinal from {MANI_CUR}")
def ordinal(spark, sf_dir):
    return with_ordinal(current_inventory(spark, sf_dir).select("relative_path"))


_STORED = f"select *, row_number() over (order by relative_path) - 1 as ordinal from {_ENTRIES}"


def _stored(spark, sf_dir):
    manifests = scratch_path(spark, "manifests")
    entries = next_manifest_entries(_diff(spark, sf_dir), "exports", "200")
    write_manifest(entries, f"{manifests}/200.json", "200", 200, "bucket", "exports")
    return latest_manifest(spark, manifests)


@query("mon6_source_map", _STORED)
def stored_source_map(spark, sf_dir):
    return source_map(_stored(spark, sf_dir))


@query("src10_manifest_reader", f"select '200' as publish_id, 'exports' as prefix, e.* from {_ENTRIES} e")
def manifest_reader(spark, sf_dir):
    return _stored(spark, sf_dir).select("publish_id", "prefix", *MANIFEST_ENTRY_COLUMNS)
