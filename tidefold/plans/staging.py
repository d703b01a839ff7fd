"""Current-state tables from the change log, rebuilt or maintained.

Layout below one root:

    state/version=<v>/component_key=…/table_key=…/_bucket=<b>  last event of every document, with tombstones
    fields/version=<v>/                                        kinds of the fields of each rewritten bucket
    tables/version=<v>/<component>/<table>.parquet/_bucket=<b> typed live documents
    ledger/version=<v>/                                        what was processed, where each bucket lives

A table is split into buckets by a hash of the document. A run writes a new version of the buckets
that its loads touch and commits by writing the ledger last; readers go through the ledger, so a
run that dies leaves the previous version untouched and is simply repeated. Because folding is
associative, a run reads the stored state of the touched buckets plus the new loads, never the old
log. What describes a table is the sum of what describes its buckets: live rows, content digests and
sizes add up, kinds of fields join by `or`, so untouched buckets are not opened. The digest and the kinds
of a document are stored with it, so a bucket is described without parsing its documents again.

Typed files are written anew only for touched buckets as long as columns are added; when a column
goes, or changes its type or name, the whole table is projected again.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.functions.kinds import document_kinds, schema_field_flags
from tidefold.functions.names import directory_key_text, staging_path_text
from tidefold.operators.fold import fold_log, latest_by, live
from tidefold.operators.infer import merged_columns, project_staging, staging_names, staging_schema
from tidefold.schemas import DELETE, IDENTITY, LOG_FILE_SCHEMA, ORDERING
from tidefold.session import list_names, partition_values, remove_path, run_jobs
from tidefold.sources.catalog import catalog_hash, read_catalog
from tidefold.sources.changelog import load_marks, read_log

FULL_REBUILD, INCREMENTAL = "full_rebuild", "incremental"

BUCKET = "_bucket"
# Documents of a bucket, in bytes, and the most buckets of a table; both numbers of buckets are powers of two.
BUCKET_BYTES = 8 << 20
MAX_BUCKETS = 1 << 13
# A bucket is crowded with more new events than this and than four times the mean of its table.
CROWDED_EVENTS = 1 << 16

STATE_SCHEMA = T.StructType(
    LOG_FILE_SCHEMA.fields + [T.StructField("kinds", T.StringType()), T.StructField("row_hash", T.LongType())]
)
_KEYS = ["component_key", "table_key", BUCKET]
_WRITTEN_STATE = T.StructType([
    *STATE_SCHEMA.fields, *[T.StructField(k, T.StringType()) for k in _KEYS[:2]], T.StructField(BUCKET, T.LongType())
])

_ENTRY = {
    "component_path": "string",
    "table_name": "string",
    "relative_path": "string",
    "n_buckets": "bigint",
    "rows": "bigint",
    "sha256": "string",
    "bytes": "bigint",
    "columns": "string",
}
_PART = {
    "component_path": "string",
    "table_name": "string",
    "bucket": "bigint",
    "state_version": "string",
    "table_version": "string",
    "rows": "bigint",
    "hash_sum": "decimal(38,0)",
    "bytes": "bigint",
}


def _struct(columns: dict[str, str]) -> str:
    return f"struct<{', '.join(f'{name}: {kind}' for name, kind in columns.items())}>"


_LEDGER = (
    "schema_hash string, mode string, load struct<load_id: string, batches: bigint, events: bigint, mark: bigint>, "
    f"entry {_struct(_ENTRY)}, part {_struct(_PART)}"
)
_FIELDS = "component_path string, table_name string, bucket bigint, field string, flags int"


@dataclass
class StagingSummary:
    mode: str
    files_read: int = 0
    events_read: int = 0
    new_raw_files: int = 0
    affected_tables: int = 0
    tables_materialized: int = 0
    rows_materialized: int = 0


@dataclass
class Ledger:
    """What earlier runs left: one entry per load, table and bucket, no documents."""

    version: int
    schema_hash: str | None
    loads: dict[str, tuple[int, int, int]] = field(default_factory=dict)  # batches, events, mark
    tables: dict[tuple[str, str], dict] = field(default_factory=dict)
    parts: dict[tuple[str, str], dict[int, dict]] = field(default_factory=lambda: defaultdict(dict))


def schema_catalog_path(log: str) -> str:
    return f"{log}/_schemas"


def _ledger_path(root: str, version: int) -> str:
    return f"{root}/ledger/version={version:010d}"


def read_ledger(spark: SparkSession, root: str) -> Ledger | None:
    """The newest committed ledger, or None before the first run."""
    committed = partition_values(spark, f"{root}/ledger", "version")
    if not committed:
        return None
    version = int(max(committed))
    rows = spark.read.schema(_LEDGER).parquet(_ledger_path(root, version)).collect()
    ledger = Ledger(version, None)
    for row in rows:
        if row["load"] is not None:
            ledger.loads[row["load"]["load_id"]] = (row["load"]["batches"], row["load"]["events"], row["load"]["mark"])
        elif row["entry"] is not None:
            entry = row["entry"].asDict()
            ledger.tables[entry["component_path"], entry["table_name"]] = entry
        elif row["part"] is not None:
            part = row["part"].asDict()
            ledger.parts[part["component_path"], part["table_name"]][part["bucket"]] = part
        else:
            ledger.schema_hash = row["schema_hash"]
    return ledger


def _write_ledger(spark: SparkSession, root: str, ledger: Ledger, mode: str) -> None:
    """One write of one small file; it exists completely or it does not count."""
    rows: list[tuple] = [(ledger.schema_hash, mode, None, None, None)]
    rows += [(None, None, (load, *counts), None, None) for load, counts in sorted(ledger.loads.items())]
    rows += [(None, None, None, tuple(entry[n] for n in _ENTRY), None) for _, entry in sorted(ledger.tables.items())]
    rows += [
        (None, None, None, None, tuple(part[n] for n in _PART))
        for _, parts in sorted(ledger.parts.items()) for _, part in sorted(parts.items())
    ]
    frame = spark.createDataFrame(rows, _LEDGER).coalesce(1)
    frame.write.mode("overwrite").parquet(_ledger_path(root, ledger.version))


def load_counts(log_rows: DataFrame) -> DataFrame:
    """Batches and events of each load."""
    per_batch = log_rows.groupBy("load_id", "batch").agg(F.count("*").alias("events"))
    return per_batch.groupBy("load_id").agg(F.count("*").alias("batches"), F.sum("events").alias("events"))


def _slot() -> Column:
    """Bucket of a document in a table of MAX_BUCKETS; modulo a smaller power of two it is the bucket there."""
    return F.pmod(F.xxhash64("document_id"), F.lit(MAX_BUCKETS))


def buckets_for(n_bytes: int, bucket_bytes: int) -> int:
    """How many buckets a table of that size gets."""
    return min(MAX_BUCKETS, 1 << max(0, -(-n_bytes // bucket_bytes) - 1).bit_length())


def _directory(version: str, key: tuple[str, str], bucket: int) -> str:
    keys = f"component_key={directory_key_text(key[0])}/table_key={directory_key_text(key[1])}"
    return f"state/version={version}/{keys}/{BUCKET}={bucket}"


def _read_state(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(STATE_SCHEMA).parquet(*paths)


def _described(state: DataFrame) -> DataFrame:
    """A folded state in which new documents, too, have what they add to the description of their bucket."""
    new = (F.col("op") != DELETE) & F.col("document").isNotNull() & F.col("row_hash").isNull()
    row_hash = F.xxhash64("document_id", "timestamp", "schema_fingerprint", "document")
    return state.withColumns({
        "kinds": F.when(new, document_kinds("document")).otherwise(F.col("kinds")),
        "row_hash": F.when(new, row_hash).otherwise(F.col("row_hash")),
    })


def _with_buckets(rows: DataFrame, n_buckets: dict[tuple[str, str], int]) -> DataFrame:
    """Rows of the given tables with their folder and bucket; one short row per table is broadcast."""
    sizes = [(*key, *map(directory_key_text, key), n) for key, n in sorted(n_buckets.items())]
    names = "component_path string, table_name string, component_key string not null, table_key string not null"
    known = rows.sparkSession.createDataFrame(sizes, f"{names}, n_buckets bigint")
    return rows.join(F.broadcast(known), ["component_path", "table_name"]).withColumn(BUCKET, F.pmod(_slot(), F.col("n_buckets")))


def state_rows(
    stored: DataFrame | None, events: DataFrame, n_buckets: dict[tuple[str, str], int], n_touched: int, fold_first: bool = True
) -> DataFrame:
    """Events folded onto the stored rows of the touched buckets, in the order in which the buckets are written.

    With `fold_first` the events are folded by themselves first, so a hot document is one row by then;
    events that are known to spread over the buckets are not, which saves an exchange and two sorts. All rows of a
    bucket then meet in one exchange, which serves the fold and the write. It is dealt to several
    partitions a bucket, so few buckets seldom share one; adaptive execution leaves the number alone.
    The fold orders by folder first, as the write does, so rows are sorted once; without stored rows
    nothing is left to fold after the first fold.
    """
    fresh = (fold_log(events) if fold_first else events).withColumns({"kinds": F.lit(None).cast("string"), "row_hash": F.lit(None).cast("long")})
    n_partitions = max(n_touched, min(4 * n_touched, 256))
    rows = _with_buckets(fresh if stored is None else stored.unionByName(fresh), n_buckets).repartition(n_partitions, *_KEYS)
    if stored is None and fold_first:
        folded = rows.sortWithinPartitions(*_KEYS, "document_id")
    else:
        folded = latest_by(rows, [*_KEYS, "document_id", "component_path", "table_name"], ORDERING)
    return _described(folded).select(*STATE_SCHEMA.fieldNames(), *_KEYS)


def _crowded(events: dict[tuple[str, str], dict[int, int]], n_buckets: dict[tuple[str, str], int]) -> bool:
    """Whether some bucket has far more new events than others of its table, by the events of each slot."""
    for key, slots in events.items():
        in_bucket: dict[int, int] = defaultdict(int)
        for slot, n in slots.items():
            in_bucket[slot % n_buckets[key]] += n
        if max(in_bucket.values()) > max(CROWDED_EVENTS, 4 * sum(in_bucket.values()) // n_buckets[key]):
            return True
    return False


def _summaries(state: DataFrame) -> DataFrame:
    """Per bucket of a written state: live rows, sum of their hashes, bytes of their documents."""
    alive = F.col("row_hash").isNotNull()
    return state.groupBy("component_path", "table_name", F.col(BUCKET).alias("bucket")).agg(
        F.count("row_hash").alias("rows"),
        F.coalesce(F.sum(F.col("row_hash").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.sum(F.when(alive, F.octet_length("document"))), F.lit(0)).alias("bytes"),
    )


def _write_fields(state: DataFrame, path: str) -> None:
    """Kinds of the fields in each bucket. Documents of like form have equal texts of kinds; each is read once."""
    keys = ["component_path", "table_name", "bucket"]
    forms = state.where("kinds IS NOT NULL").select(*keys[:2], F.col(BUCKET).alias("bucket"), "kinds").distinct()
    fields = forms.select(*keys, F.explode(F.from_json("kinds", "map<string,int>")).alias("field", "flag"))
    fields.groupBy(*keys, "field").agg(F.bit_or("flag").alias("flags")).coalesce(1).write.mode("overwrite").parquet(path)


def _table_columns(spark: SparkSession, root: str, ledger: Ledger, keys: Iterable[tuple[str, str]], catalog: DataFrame | None) -> dict:
    """Columns (field, kind) of the given tables, merged from their buckets and the catalog's seeds."""
    parts = [(*key, b, p["state_version"]) for key in keys for b, p in ledger.parts[key].items() if p["rows"]]
    versions = sorted({p[-1] for p in parts})
    if not parts:
        return {}
    used = spark.createDataFrame(parts, "component_path string, table_name string, bucket bigint, version string")
    # The folder names the version; read as text, whatever it looks like.
    reader = spark.read.schema(f"{_FIELDS}, version string").option("basePath", f"{root}/fields")
    fields = reader.parquet(*[f"{root}/fields/version={v}" for v in versions])
    observed = fields.join(F.broadcast(used), ["component_path", "table_name", "bucket", "version"], "left_semi")
    tables = used.select("component_path", "table_name").distinct()
    seeds = None if catalog is None else schema_field_flags(catalog)
    columns: dict[tuple[str, str], list[tuple[str, str]]] = defaultdict(list)
    for row in merged_columns(observed, tables, seeds).collect():
        columns[row["component_path"], row["table_name"]].append((row["field"], row["kind"]))
    return columns


def materialise(
    spark: SparkSession, log: str, root: str, incremental: bool = True, threads: int = 8, bucket_bytes: int = BUCKET_BYTES
) -> StagingSummary:
    """Bring the staging tables up to date with the log.

    Everything is rebuilt when asked for, when there is no earlier state, when the schema
    catalog changed, or when a load that was already processed has been replaced. Otherwise only
    buckets with documents of new loads are touched, and without new loads nothing is. A table
    that has outgrown its buckets is split into more of them when a run touches it.
    """
    catalog = read_catalog(spark, schema_catalog_path(log))
    schema_hash = catalog_hash(catalog)
    previous = read_ledger(spark, root)
    marks = load_marks(spark, log)
    version = previous.version + 1 if previous else 1
    name = f"{version:010d}"

    reusable = incremental and previous is not None and previous.schema_hash == schema_hash
    if reusable:
        # What a replaced load held before is part of the stored state and cannot be taken out.
        reusable = all(marks.get(load, mark) == mark for load, (_, _, mark) in previous.loads.items())
    old = previous if reusable else Ledger(version, schema_hash)
    new_loads = sorted(set(marks) - set(old.loads))
    if reusable and not new_loads:
        return StagingSummary(mode=INCREMENTAL)
    fresh = read_log(spark, log, new_loads)

    # At most MAX_BUCKETS rows a touched table.
    slots = fresh.groupBy("component_path", "table_name", _slot().alias("slot")).agg(
        F.sum(F.octet_length("document")).alias("bytes"), F.count("*").alias("events")
    )
    found, counts = run_jobs(spark, [slots.collect, load_counts(fresh).collect], threads)
    touched: dict[tuple[str, str], dict[int, int]] = defaultdict(dict)
    new_bytes: dict[tuple[str, str], int] = defaultdict(int)
    for row in found:
        touched[row["component_path"], row["table_name"]][row["slot"]] = row["events"]
        new_bytes[row["component_path"], row["table_name"]] += row["bytes"] or 0

    n_buckets, stored, ledger = {}, [], Ledger(version, schema_hash, dict(old.loads), dict(old.tables))
    ledger.parts.update({key: dict(parts) for key, parts in old.parts.items()})
    for key, slots in touched.items():
        known = old.tables.get(key)
        wanted = buckets_for((known["bytes"] if known else 0) + new_bytes[key], bucket_bytes)
        split = known is None or wanted > 4 * known["n_buckets"]
        n_buckets[key] = wanted if split else known["n_buckets"]
        parts = old.parts[key] if split else {b: p for b, p in old.parts[key].items() if b in {slot % n_buckets[key] for slot in slots}}
        stored += [f"{root}/{_directory(p['state_version'], key, b)}" for b, p in parts.items()]
        if split:
            ledger.parts[key] = {}

    state_path, fields_path = f"{root}/state/version={name}", f"{root}/fields/version={name}"
    n_touched = sum(len({slot % n_buckets[key] for slot in slots}) for key, slots in touched.items())
    before = _read_state(spark, stored) if stored else None
    rows = state_rows(before, fresh.select(*LOG_FILE_SCHEMA.fieldNames()), n_buckets, n_touched, _crowded(touched, n_buckets))
    # A version of the state lies beside the one before it; zstandard makes both smaller.
    rows.write.mode("overwrite").partitionBy(*_KEYS).parquet(state_path, compression="zstd")
    state = spark.read.schema(_WRITTEN_STATE).parquet(state_path)
    summaries, _ = run_jobs(spark, [_summaries(state).collect, lambda: _write_fields(state, fields_path)], threads)
    rewritten: dict[tuple[str, str], set[int]] = defaultdict(set)
    for row in summaries:
        part = {**row.asDict(), "state_version": name, "table_version": name if row["rows"] else None}
        key = (row["component_path"], row["table_name"])
        ledger.parts[key][row["bucket"]] = part
        rewritten[key].add(row["bucket"])

    columns = _table_columns(spark, root, ledger, rewritten, catalog)
    writes = []
    for key, buckets in rewritten.items():
        typed, parts = sorted(columns.get(key, [])), ledger.parts[key]
        signature = json.dumps(typed)
        n_rows, hash_sum = sum(p["rows"] for p in parts.values()), sum(int(p["hash_sum"]) for p in parts.values())
        if not _extends(spark, typed, old.tables.get(key)):
            buckets = set(parts)
        for bucket in buckets:
            parts[bucket] = {**parts[bucket], "table_version": name if parts[bucket]["rows"] else None}
        digest = hashlib.sha256(f"{n_rows}:{hash_sum}".encode()).hexdigest()
        ledger.tables[key] = entry = {
            "component_path": key[0],
            "table_name": key[1],
            "relative_path": staging_path_text(*key),
            "n_buckets": n_buckets[key],
            "rows": n_rows,
            "sha256": hashlib.sha256(f"{signature}|{digest}".encode()).hexdigest(),
            "bytes": sum(p["bytes"] for p in parts.values()),
            "columns": signature,
        }
        paths = [f"{root}/{_directory(parts[b]['state_version'], key, b)}" for b in sorted(buckets) if parts[b]["rows"]]
        if paths:
            writes.append(_table_writer(spark, paths, key, entry, f"{root}/tables/version={name}/{entry['relative_path']}"))
    run_jobs(spark, writes, threads)

    loads = {row["load_id"]: (row["batches"], row["events"], marks[row["load_id"]]) for row in counts}
    for load in new_loads:
        ledger.loads[load] = loads.get(load, (0, 0, marks[load]))
    mode = INCREMENTAL if reusable else FULL_REBUILD
    _write_ledger(spark, root, ledger, mode)
    n_tables = len(rewritten) if reusable else sum(ledger.tables[key]["rows"] > 0 for key in rewritten)
    return StagingSummary(
        mode=mode,
        files_read=sum(batches for batches, _, _ in ledger.loads.values()),
        events_read=sum(events for _, events, _ in ledger.loads.values()),
        new_raw_files=sum(batches for batches, _, _ in loads.values()),
        affected_tables=n_tables,
        tables_materialized=n_tables,
        rows_materialized=sum(ledger.tables[key]["rows"] for key in rewritten),
    )


def _extends(spark: SparkSession, columns: Sequence[tuple[str, str]], known: dict | None) -> bool:
    """Whether files with the known columns can be read with the new ones: all are there under their name and type."""
    if known is None:
        return False
    before = [tuple(c) for c in json.loads(known["columns"])]
    old, new = (
        {f: (name, kind) for (f, kind), name in zip(each, staging_names(spark, each))} for each in (before, columns)
    )
    return old.items() <= new.items()


def _table_writer(spark: SparkSession, paths: Sequence[str], key: tuple[str, str], entry: dict, target: str):
    def write() -> None:
        mine = live(_read_state(spark, paths)).where((F.col("component_path") == key[0]) & (F.col("table_name") == key[1]))
        typed = project_staging(mine, json.loads(entry["columns"]))
        bucket = F.pmod(F.xxhash64("_document_id"), F.lit(MAX_BUCKETS)) % entry["n_buckets"]
        ordered = typed.withColumn(BUCKET, bucket).sortWithinPartitions(BUCKET, "_document_id", "_timestamp")
        ordered.write.mode("overwrite").partitionBy(BUCKET).parquet(target)

    return write


def staging_tables(spark: SparkSession, root: str) -> list[dict]:
    """Current tables with the folders of their buckets and their schema; tables that became empty are gone."""
    ledger = read_ledger(spark, root)
    if ledger is None:
        raise FileNotFoundError(f"no staging state below {root}")
    found = []
    for key, entry in sorted(ledger.tables.items()):
        if entry["rows"]:
            parts = sorted(ledger.parts[key].items())
            uris = [
                f"{root}/tables/version={p['table_version']}/{entry['relative_path']}/{BUCKET}={b}" for b, p in parts if p["rows"]
            ]
            found.append({**entry, "uris": uris, "schema": staging_schema(spark, json.loads(entry["columns"])).json()})
    return found


def read_table(spark: SparkSession, entry) -> DataFrame:
    """One current table, typed, from its folders; files older than a column have none of it."""
    return spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"]))).parquet(*entry["uris"])


def read_staging(spark: SparkSession, root: str, component: str, table: str) -> DataFrame:
    """One current table, typed."""
    for entry in staging_tables(spark, root):
        if (entry["component_path"], entry["table_name"]) == (component, table):
            return read_table(spark, entry)
    raise KeyError(f"no staging table {table!r} in component {component!r}")


def staging_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Current tables as (relative_path, sha256, bytes, uris, schema), straight from the ledger."""
    rows = [(e["relative_path"], e["sha256"], e["bytes"], e["uris"], e["schema"]) for e in staging_tables(spark, root)]
    return spark.createDataFrame(rows, "relative_path string, sha256 string, bytes bigint, uris array<string>, schema string")


def drop_old_versions(spark: SparkSession, root: str) -> int:
    """Delete versions of state and tables that no bucket of the current ledger is kept in any more."""
    ledger = read_ledger(spark, root)
    if ledger is None:
        return 0
    parts = [(key, b, p) for key, buckets in ledger.parts.items() for b, p in buckets.items()]
    used = {
        "state": {p["state_version"] for _, _, p in parts},
        "fields": {p["state_version"] for _, _, p in parts},
        "tables": {p["table_version"] for _, _, p in parts},
    }
    removed = 0
    for folder, versions in used.items():
        for name in _committed_before(spark, f"{root}/{folder}", ledger.version):
            if name not in versions:
                remove_path(spark, f"{root}/{folder}/version={name}")
                removed += 1
    return removed


def _committed_before(spark: SparkSession, path: str, version: int) -> list[str]:
    names = [n.split("=", 1)[1] for n in list_names(spark, path) if n.startswith("version=")]
    return [name for name in names if int(name) <= version]
