"""Change-data inputs derived from the given tables, for Spark and as SQL text.

Each input is one select list over one table. The two engines differ in a few function
names only, so one definition serves both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.events import QUARANTINE, normalise
from tidefold.operators.digest import content_digest, sha_number
from tidefold.schemas import LOG_FILE_SCHEMA


@dataclass(frozen=True)
class Dialect:
    micros: Callable[[str], str]
    sha: Callable[[str], str]


SPARK = Dialect(lambda c: f"unix_micros(cast({c} as timestamp))", lambda x: f"sha2({x}, 256)")
DUCK = Dialect(lambda c: f"epoch_us({c})", lambda x: f"sha256({x})")


@dataclass(frozen=True)
class Derived:
    table: str
    columns: Callable[[Dialect], dict[str, str]]
    where: str | None = None

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        if self.where:
            rows = rows.where(self.where)
        return rows.selectExpr(*[f"{expr} as {name}" for name, expr in self.columns(SPARK).items()])

    @property
    def sql(self) -> str:
        listed = ", ".join(f"{expr} as {name}" for name, expr in self.columns(DUCK).items())
        return f"(select {listed} from {self.table}{' where ' + self.where if self.where else ''})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Small change log: 3 components, 2 tables, many events per document.
LOG_E = Derived(
    "events",
    lambda d: {
        "component_path": "case user_id % 3 when 0 then 'workflow' when 1 then 'r2/cache' else '' end",
        "table_name": "case user_id % 2 when 0 then 'users' else 'accounts' end",
        "document_id": "concat('doc:', cast(user_id as string))",
        "timestamp": d.micros("ts"),
        "op": "case when event_type = 'error' then 'delete' else 'upsert' end",
        "schema_fingerprint": f"case when user_id % 2 = 0 then {d.sha(chr(39) + 'users' + chr(39))} end",
        "document": "case when event_type <> 'error' then replace(props, ' ', '') end",
        "batch": "concat('delta_tail-', cast(event_id % 10 as string))",
        "position": "event_id",
    },
)

_LINE = (
    "concat('{\"cents\":', cast(cast(round(l_extendedprice * 100) as bigint) as string), "
    "',\"part\":', cast(l_partkey as string), ',\"qty\":', cast(cast(l_quantity as bigint) as string), "
    "',\"supp\":', cast(l_suppkey as string), '}')"
)
# Large change log: mostly one event per document, returned lines are deletes. The batch
# orders equal timestamps by content, which makes every fold of it well defined.
LOG_L = Derived(
    "lineitem",
    lambda d: {
        "component_path": "''",
        "table_name": "case l_linestatus when 'F' then 'filled' else 'open' end",
        "document_id": "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))",
        "timestamp": d.micros("l_shipdate"),
        "op": "case when l_returnflag = 'R' then 'delete' else 'upsert' end",
        "schema_fingerprint": "cast(null as string)",
        "document": f"case when l_returnflag <> 'R' then {_LINE} end",
        "batch": f"concat(l_returnflag, {_LINE})",
        "position": "l_partkey",
        "ship_year": "cast(year(l_shipdate) as string)",
    },
)

_TABLE = "case user_id % 2 when 0 then 'users' else 'accounts' end"
_COMPONENT = "case user_id % 3 when 0 then 'workflow' else '' end"
_CENTS = "cast(cast(round(value * 100) as bigint) as string)"
_USERS_MIX = "case event_id % 2 when 0 then '1' else '1.5' end"
# Raw source documents. `mix` mixes int and float in one table, everything in the other;
# `whole` is a float without a fraction; some rows lack `_ts` or have it as a string.
RAWDOC = Derived(
    "events",
    lambda d: {
        "ord": "event_id",
        "value": f"""concat('{{"_component":"', {_COMPONENT}, '","_table":"', {_TABLE}, '","_id":"doc:', cast(user_id as string), '"',
            case when event_id % 97 = 0 then '' when event_id % 89 = 0 then ',"_ts":"bad"'
                 else concat(',"_ts":', cast({d.micros('ts')} as string)) end,
            case when event_type = 'error' then ',"_deleted":true' else '' end,
            ',"_index":7,"_creationTime":', cast(event_id as string), '.5,"cents":', {_CENTS}, ',"mix":',
            case when user_id % 2 = 0 then {_USERS_MIX}
                 else case event_id % 5 when 0 then '1' when 1 then 'true' when 2 then '"s"'
                      when 3 then '{{"b":2,"a":1}}' else 'null' end end,
            ',"whole":', cast(user_id as string), '.0,"props":', props, '}}')""",
    },
)
# What those documents must become, worked out from the source columns.
RAW_EXPECTED = f"""(select event_id as ord,
    {_COMPONENT} as component_path, {_TABLE} as table_name, concat('doc:', cast(user_id as string)) as document_id,
    {DUCK.micros('ts')} as timestamp,
    case when event_id % 97 = 0 then 'missing:_ts' when event_id % 89 = 0 then 'invalid:_ts' end as error,
    case when event_type = 'error' then 'delete' else 'upsert' end as op,
    concat('{{"_creationTime":', cast(event_id as string), '.5,"cents":', {_CENTS}, ',"mix":',
           case when user_id % 2 = 0 then {_USERS_MIX}
                else case event_id % 5 when 0 then '1' when 1 then 'true' when 2 then '"s"'
                     when 3 then '{{"a":1,"b":2}}' else 'null' end end,
           ',"props":', replace(props, ' ', ''), ',"whole":', cast(user_id as string), '.0}}') as whole_document,
    case when event_type <> 'error' then whole_document end as document,
    event_id + 0.5 as creation_time, cast(round(value * 100) as bigint) as cents,
    case when user_id % 2 = 0 then case event_id % 2 when 0 then 1.0 else 1.5 end end::double as users_mix,
    case when user_id % 2 = 1 then case event_id % 5 when 0 then '1' when 1 then 'true' when 2 then 's'
         when 3 then '{{"a":1,"b":2}}' end end as accounts_mix,
    replace(props, ' ', '') as props_text, cast(user_id as double) as whole
    from events)"""
RAW_VALID = f"(select * from {RAW_EXPECTED} where error is null)"


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events of the raw documents, as log rows with their creation time."""
    events = normalise(RAWDOC.frame(spark, sf_dir), on_error=QUARANTINE, creation_time=True)
    return events.select(
        "component_path", "table_name", "document_id", "timestamp", "op",
        F.lit(None).cast("string").alias("schema_fingerprint"),
        "document",
        F.lit("delta_tail-1").alias("batch"),
        F.col("ord").alias("position"),
        "creation_time",
    )


CKPT = Derived(
    "orders",
    lambda d: {
        "source_id": "concat('src', cast(o_custkey % 50 as string))",
        "phase": "case when o_orderstatus = 'P' then 'initial_snapshot' else 'delta_tail' end",
        "snapshot_ts": "case when o_orderstatus = 'P' then o_orderkey end",
        "snapshot_cursor": "case when o_orderstatus = 'P' then concat('c', cast(o_orderkey as string)) end",
        "delta_cursor": "case when o_orderstatus <> 'P' then o_orderkey end",
        "schema_hash": "o_orderpriority",
        "run_id": "cast(o_orderkey as string)",
        "updated_at": "o_orderdate",
    },
)

_SHARED_NAME = "'supplier_', cast(cast(floor(s_suppkey / 3) as bigint) as string)"
_LISTED = f"""case when s_nationkey = 1 then concat('__internal_', cast(s_suppkey as string))
    when s_nationkey = 2 then concat('event_log_', cast(s_suppkey as string))
    else concat({_SHARED_NAME}, '__cdc') end"""
_DATE = """case s_suppkey % 3 when 0 then timestamp '2024-{month}-01 00:00:00' when 1 then timestamp '2024-{month}-17 08:30:00'
    else timestamp '2024-{month}-09 21:00:00' end"""
# Bronze and silver table listings, with internal tables, event logs and views among them.
CAT_B = Derived(
    "supplier",
    lambda d: {
        "table_name": _LISTED,
        "table_type": "case when s_nationkey in (5, 10, 15) then 'VIEW' when s_nationkey in (6, 7) then 'EXTERNAL' else 'MANAGED' end",
        "created": _DATE.format(month="01"),
        "last_altered": _DATE.format(month="02"),
        "suppkey": "s_suppkey",
        "nationkey": "s_nationkey",
    },
    "s_nationkey <> 3",
)
# The same listing with one row per table.
CAT_ONE = Derived(
    "supplier",
    lambda d: {**CAT_B.columns(d), "table_name": _LISTED.replace(_SHARED_NAME, "lower(replace(s_name, '#', '_'))")},
    "s_nationkey <> 3",
)
CAT_S = Derived(
    "supplier",
    lambda d: {
        "table_name": f"concat({_SHARED_NAME})",
        "table_type": "'MANAGED'",
        "created": _DATE.format(month="01"),
        "last_altered": _DATE.format(month="03"),
        "suppkey": "s_suppkey",
    },
    "s_nationkey <> 4",
)

_CURRENT = "source <> 'src5'"
_PREVIOUS = "source <> 'src3' and not (source in ('src1', 'src2') and n_chars < 400)"


def _inventory_sql(where: str) -> str:
    return f"""(select concat(lang, '/', source, '.parquet') as relative_path,
        sha256(concat_ws(':', cast(count(*) as varchar), cast(sum(('0x' || substr(sha256(text), 1, 15))::bigint) as varchar))) as sha256,
        cast(sum(n_chars) as bigint) as bytes
        from documents where {where} group by lang, source)"""


MANI_CUR = _inventory_sql(_CURRENT)
MANI_PREV = _inventory_sql(_PREVIOUS)


def _inventory(spark: SparkSession, sf_dir: str, where: str) -> DataFrame:
    """Inventory of tables that hold the documents of one language and source."""
    rows = table(spark, sf_dir, "documents").where(where).withColumn(
        "relative_path", F.concat("lang", F.lit("/"), "source", F.lit(".parquet"))
    )
    digests = content_digest(rows, ["relative_path"], sha_number("text"), [F.sum("n_chars").alias("bytes")])
    return digests.select("relative_path", "sha256", "bytes")


def current_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inventory(spark, sf_dir, _CURRENT)


def previous_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inventory(spark, sf_dir, _PREVIOUS)


def log_rows(derived: Derived, spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.frame(spark, sf_dir).select(*LOG_FILE_SCHEMA.fieldNames())


FOLD_ORDER = "timestamp desc, batch desc, position desc"
FOLD_BY = f"row_number() over (partition by component_path, table_name, document_id order by {FOLD_ORDER})"


def folded_sql(log: str) -> str:
    """Latest event of each document, deletes included."""
    return f"(select * from {log} qualify {FOLD_BY} = 1)"


def live_sql(log: str) -> str:
    return f"(select * from {folded_sql(log)} where op <> 'delete' and document is not null)"
