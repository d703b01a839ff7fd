"""Fixed schemas and the constants that define the data model."""

from __future__ import annotations

from pyspark.sql import types as T

UPSERT = "upsert"
DELETE = "delete"

INITIAL_SNAPSHOT = "initial_snapshot"
DELTA_TAIL = "delta_tail"

CHECKPOINT_VERSION = 1
MANIFEST_VERSION = 1

# Identity of a document, and the total order of its events. `batch` is the name of
# the page a change arrived in and `position` its place in that page, so two events
# with equal timestamps always resolve the same way, however the job is partitioned.
IDENTITY = ["component_path", "table_name", "document_id"]
ORDERING = ["timestamp", "batch", "position"]

# The seven public columns of the change log.
RAW_LOG_SCHEMA = T.StructType(
    [
        T.StructField("component_path", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("document_id", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("op", T.StringType(), False),
        T.StructField("schema_fingerprint", T.StringType(), True),
        T.StructField("document", T.StringType(), True),
    ]
)
RAW_LOG_COLUMNS = RAW_LOG_SCHEMA.fieldNames()

# What a stored log file holds: the public columns plus the tie-break columns.
LOG_FILE_SCHEMA = T.StructType(
    RAW_LOG_SCHEMA.fields
    + [
        T.StructField("batch", T.StringType(), False),
        T.StructField("position", T.LongType(), False),
    ]
)
# Directory columns. Keys are always text, so a table called "2024" stays a string.
LOG_PARTITIONS = ["load_id", "component_key", "table_key"]
LOG_SCHEMA = T.StructType(
    LOG_FILE_SCHEMA.fields + [T.StructField(c, T.StringType(), False) for c in LOG_PARTITIONS]
)

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("schema_json", T.StringType(), False),
        T.StructField("fingerprint", T.StringType(), False),
    ]
)

CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType(), False),
        T.StructField("phase", T.StringType(), False),
        T.StructField("snapshot_ts", T.LongType(), True),
        T.StructField("snapshot_cursor", T.StringType(), True),
        T.StructField("delta_cursor", T.LongType(), True),
        T.StructField("schema_hash", T.StringType(), True),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)
CHECKPOINT_COLUMNS = CHECKPOINT_SCHEMA.fieldNames()
# Stored history also carries a per-write sequence: all pages of one run share run_id and
# may share updated_at, and this column keeps the latest row well defined.
CHECKPOINT_FILE_SCHEMA = T.StructType(
    CHECKPOINT_SCHEMA.fields + [T.StructField("write_seq", T.LongType(), True)]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        T.StructField("publish_id", T.StringType(), False),
        T.StructField("published_at_epoch_ms", T.LongType(), False),
        T.StructField("bucket", T.StringType(), False),
        T.StructField("prefix", T.StringType(), False),
        T.StructField("relative_path", T.StringType(), False),
        T.StructField("current_key", T.StringType(), False),
        T.StructField("versioned_key", T.StringType(), False),
        T.StructField("sha256", T.StringType(), False),
        T.StructField("bytes", T.LongType(), False),
    ]
)
MANIFEST_ENTRY_COLUMNS = ["relative_path", "current_key", "versioned_key", "sha256", "bytes"]

# --- Fixed values: names that must match the data model exactly -------------------
# Metadata keys of a source document.
META_COMPONENT = "_component"
META_TABLE = "_table"
META_ID = "_id"
META_TS = "_ts"
META_DELETED = "_deleted"
META_CREATION_TIME = "_creationTime"

# Staging columns around the inferred ones; none of them may be a user column.
STAGING_LEADING = [
    "_component_path",
    "_table_name",
    "_document_id",
    "_timestamp",
    "_schema_fingerprint",
]
STAGING_TRAILING = ["_document_json"]
RESERVED_STAGING_COLUMNS = STAGING_LEADING + STAGING_TRAILING

# Schema properties that never seed a column.
SCHEMA_METADATA_FIELDS = ["_component", "_deleted", "_id", "_table", "_ts"]

# Bronze metadata columns.
CDC_SOURCE_ID = "_cdc_source_id"
CDC_SOURCE_COMPONENT = "_cdc_source_component"
CDC_SOURCE_TABLE = "_cdc_source_table"
CDC_DOCUMENT_ID = "_cdc_document_id"
CDC_SEQUENCE_NUM = "_cdc_sequence_num"
CDC_IS_DELETED = "_cdc_is_deleted"
CDC_SCHEMA_FINGERPRINT = "_cdc_schema_fingerprint"
CDC_RAW_DOCUMENT_JSON = "_cdc_raw_document_json"
CDC_INGESTED_AT = "_cdc_ingested_at"
CDC_RUN_ID = "_cdc_run_id"
CDC_CREATION_TIME = "_cdc_creation_time"

# Bronze columns that silver tables do not carry.
SILVER_DROPPED_COLUMNS = [
    CDC_IS_DELETED,
    CDC_SEQUENCE_NUM,
    CDC_SCHEMA_FINGERPRINT,
    CDC_SOURCE_COMPONENT,
    CDC_SOURCE_TABLE,
    CDC_RAW_DOCUMENT_JSON,
    CDC_INGESTED_AT,
    CDC_RUN_ID,
    CDC_SOURCE_ID,
    CDC_CREATION_TIME,
]
# --- end of fixed values ------------------------------------------------------------

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField(CDC_SOURCE_ID, T.StringType(), True),
        T.StructField(CDC_SOURCE_COMPONENT, T.StringType(), True),
        T.StructField(CDC_SOURCE_TABLE, T.StringType(), True),
        T.StructField(CDC_DOCUMENT_ID, T.StringType(), True),
        T.StructField(CDC_SEQUENCE_NUM, T.LongType(), True),
        T.StructField(CDC_IS_DELETED, T.BooleanType(), True),
        T.StructField(CDC_SCHEMA_FINGERPRINT, T.StringType(), True),
        T.StructField(CDC_RAW_DOCUMENT_JSON, T.StringType(), True),
        T.StructField(CDC_INGESTED_AT, T.TimestampType(), True),
        T.StructField(CDC_RUN_ID, T.StringType(), True),
        T.StructField(CDC_CREATION_TIME, T.DoubleType(), True),
    ]
)
BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()

# Stored bronze rows keep the tie-break columns next to the public ones.
BRONZE_FILE_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields
    + [
        T.StructField("batch", T.StringType(), True),
        T.StructField("position", T.LongType(), True),
    ]
)
BRONZE_PARTITIONS = ["load_id", "target"]
BRONZE_STORED_SCHEMA = T.StructType(
    BRONZE_FILE_SCHEMA.fields + [T.StructField(c, T.StringType(), True) for c in BRONZE_PARTITIONS]
)
# What stored rows hold besides: the user fields as a variant, which Spark shreds into typed columns.
CDC_FIELDS = "_cdc_fields"
BRONZE_TABLE_SCHEMA = T.StructType(BRONZE_STORED_SCHEMA.fields + [T.StructField(CDC_FIELDS, T.VariantType(), True)])
