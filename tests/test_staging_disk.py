"""Loads staged one by one leave no version behind that a later one has replaced, and no shuffle files."""

from __future__ import annotations

import datetime

import pytest

from tidefold.plans.staging import read_ledger
from tidefold.queries import flows
from tidefold.session import SHUFFLE_CLEANUP_KEY, list_names, shuffles_removed

_LINE = (
    "l_orderkey long, l_linenumber int, l_linestatus string, l_returnflag string, l_shipdate date, "
    "l_extendedprice double, l_partkey long, l_quantity double, l_suppkey long"
)


def test_replaced_versions_are_deleted_after_each_load(spark, tmp_path, monkeypatch):
    rows = [
        (year * 10 + i, 1, "F", "R" if i == 3 else "N", datetime.date(year, 1, 2), 1.5 + i, i, 2.0, 7)
        for year in (1995, 1996, 1997) for i in range(4)
    ]
    spark.createDataFrame(rows, _LINE).write.parquet(str(tmp_path / "in" / "lineitem.parquet"))
    monkeypatch.setattr(flows, "scratch_path", lambda spark, label: str(tmp_path / label))
    most, staged = [], flows.materialise

    def counted(spark, log, root):
        summary = staged(spark, log, root)
        most.append(len(list_names(spark, f"{root}/state")))
        assert spark.conf.get(SHUFFLE_CLEANUP_KEY) == "true"
        return summary

    monkeypatch.setattr(flows, "materialise", counted)
    found = flows.incremental_staging(spark, str(tmp_path / "in")).collect()
    assert sorted(r["_document_id"] for r in found) == sorted(f"{r[0]}-1" for r in rows if r[3] == "N")
    assert {r["_document_id"]: (r["part"], r["cents"]) for r in found}["19952-1"] == (2, 350)
    root = str(tmp_path / "staging")
    assert most == [1, 2, 2] and read_ledger(spark, root).version == 3
    for folder in ("state", "fields", "tables"):
        assert [n for n in list_names(spark, f"{root}/{folder}") if n.startswith("version=")] == ["version=0000000003"]
    assert spark.conf.get(SHUFFLE_CLEANUP_KEY, None) != "true"


def test_the_setting_is_put_back(spark, tmp_path):
    before = spark.conf.get(SHUFFLE_CLEANUP_KEY, None)
    rows = spark.range(1000).selectExpr("id", "id % 7 as k").repartition(4, "k")
    with pytest.raises(ValueError), shuffles_removed(spark):
        rows.write.parquet(str(tmp_path / "out"))
        assert spark.conf.get(SHUFFLE_CLEANUP_KEY) == "true"
        raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP_KEY, None) == before
    # What is executed again repeats its shuffle.
    with shuffles_removed(spark):
        assert len(rows.collect()) == len(rows.collect()) == 1000
