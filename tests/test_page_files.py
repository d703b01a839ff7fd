"""Pages that share files: order, resume, and files that grow with the bytes and not with the pages."""

from __future__ import annotations

import glob
import json

from tidefold.plans.ingest import log_sink, sync_once
from tidefold.queries.flows import land_pages
from tidefold.schemas import CATALOG_SCHEMA
from tidefold.sources.changelog import read_log


def _page(sequence, last):
    values = [{"_component": "", "_table": "t", "_id": f"d{sequence}", "_ts": sequence + 1}]
    cursor = None if last else f"c{sequence}"
    return json.dumps({"values": values, "hasMore": not last, "snapshot": 50, "sequence": sequence, "cursor": cursor})


def test_snapshot_pages_of_one_file_are_read_in_order_and_resumed(spark, tmp_path):
    folder = tmp_path / "landing" / "snapshot"
    folder.mkdir(parents=True)
    # Neither the names of files nor the lines in them are in order of landing time.
    (folder / "b.json").write_text("\n".join(_page(n, n == 11) for n in (11, 9, 10)))
    (folder / "a.json").write_text("\n".join(_page(n, False) for n in range(8, -1, -1)))
    log, control = str(tmp_path / "log"), str(tmp_path / "control")
    args = (spark, str(tmp_path / "landing"), log_sink(log), spark.createDataFrame([], CATALOG_SCHEMA), control, "s1", "r1")
    first = sync_once(*args, max_pages=4)
    assert (first.snapshot_pages_fetched, first.final_checkpoint["snapshot_cursor"]) == (4, "c3")
    assert sorted(r["document_id"] for r in read_log(spark, log).collect()) == ["d0", "d1", "d2", "d3"]
    second = sync_once(*args)
    assert (second.snapshot_pages_fetched, second.final_checkpoint["delta_cursor"]) == (8, 50)
    assert sorted(r["document_id"] for r in read_log(spark, log).collect()) == sorted(f"d{n}" for n in range(12))


def test_landed_files_do_not_grow_with_the_pages(spark, tmp_path):
    events = spark.range(60_000).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id % 50 as user_id",
        "case id % 2 when 0 then 'view' else 'click' end as event_type", "'{\"k\": 1}' as props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    path = land_pages(spark, str(tmp_path), str(tmp_path / "landing"))
    for folder in ("snapshot", "deltas"):
        assert len(glob.glob(f"{path}/{folder}/**/*.txt", recursive=True)) < 30
        assert spark.read.option("recursiveFileLookup", True).text(f"{path}/{folder}").count() == 300
