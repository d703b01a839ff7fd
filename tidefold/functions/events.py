"""From source documents (JSON text) to change events and bronze rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.functions.jsontext import MARK, is_wrapped, object_entries, parse_marked, shape, unmark_decimals, unmark_text
from tidefold.schemas import (
    BRONZE_COLUMNS,
    CDC_CREATION_TIME,
    CDC_DOCUMENT_ID,
    CDC_INGESTED_AT,
    CDC_IS_DELETED,
    CDC_RAW_DOCUMENT_JSON,
    CDC_RUN_ID,
    CDC_SCHEMA_FINGERPRINT,
    CDC_SEQUENCE_NUM,
    CDC_SOURCE_COMPONENT,
    CDC_SOURCE_ID,
    CDC_SOURCE_TABLE,
    DELETE,
    META_COMPONENT,
    META_CREATION_TIME,
    META_DELETED,
    META_ID,
    META_TABLE,
    META_TS,
    UPSERT,
)

EVENT_COLUMNS = ["component_path", "table_name", "document_id", "timestamp", "op", "document"]
FAIL, QUARANTINE = "fail", "quarantine"


def _text_problem(name: str) -> Column:
    """Missing and wrong-typed metadata are told apart; a wrapped number is not a string."""
    value, kind = F.col(f"_value{name}"), F.col(f"_shape{name}")
    is_text = (kind == "STRING") & ~is_wrapped(value)
    return F.when(kind.isNull(), f"missing:{name}").when(~is_text, f"invalid:{name}")


def _integer_problem(name: str) -> Column:
    kind = F.col(f"_shape{name}")
    return F.when(kind.isNull(), f"missing:{name}").when(kind != "BIGINT", f"invalid:{name}")


def read_metadata(df: DataFrame, value: str = "value", creation_time: bool = False) -> DataFrame:
    """Add the event columns and `error`, on request also `creation_time`, to rows of raw document text.

    `error` is NULL for a valid document, else the first problem in the order
    not-an-object, repeated-key, component, table, id, timestamp. Nothing is dropped here.

    The steps are separate projections: each parsed piece is used several times after it
    is computed, and kept apart it is computed once and the generated code stays small.
    """
    metadata = {
        META_COMPONENT: "string",
        META_TABLE: "string",
        META_ID: "string",
        META_TS: "bigint",
        META_DELETED: "boolean",
    }
    if creation_time:
        metadata[META_CREATION_TIME] = "string"
    is_object = F.ltrim(F.col(value), F.lit(" \t\r\n")).startswith("{")
    parsed = df.withColumn("_parsed", F.when(is_object, parse_marked(value)))
    typed = parsed.withColumns(
        {f"_shape{name}": shape(F.try_variant_get("_parsed", f"$.{name}", "variant")) for name in metadata}
        | {f"_value{name}": F.try_variant_get("_parsed", f"$.{name}", kind) for name, kind in metadata.items()}
    )
    error = F.coalesce(
        # An object that is JSON and yet not parsed names a key twice.
        F.when(F.col("_parsed").isNull() & is_object & F.get_json_object(value, "$").isNotNull(), "repeated_key"),
        F.when(F.col("_parsed").isNull(), "not_an_object"),
        _text_problem(META_COMPONENT),
        _text_problem(META_TABLE),
        _text_problem(META_ID),
        _integer_problem(META_TS),
    )
    is_delete = (F.col(f"_shape{META_DELETED}") == "BOOLEAN") & F.col(f"_value{META_DELETED}")
    checked = typed.withColumns({"error": error, "_delete": F.coalesce(is_delete, F.lit(False))})

    valid = F.col("error").isNull()
    kept = F.map_filter(object_entries("_parsed"), lambda key, _: ~key.startswith("_") | (key == META_CREATION_TIME))
    produced = {
        "component_path": F.when(valid, unmark_text(F.col(f"_value{META_COMPONENT}"))),
        "table_name": F.when(valid, unmark_text(F.col(f"_value{META_TABLE}"))),
        "document_id": F.when(valid, unmark_text(F.col(f"_value{META_ID}"))),
        "timestamp": F.when(valid, F.col(f"_value{META_TS}")),
        "op": F.when(valid, F.when(F.col("_delete"), DELETE).otherwise(UPSERT)),
        "document": F.when(valid & ~F.col("_delete"), F.to_json(kept)),
    }
    if creation_time:
        text, kind = F.col(f"_value{META_CREATION_TIME}"), F.col(f"_shape{META_CREATION_TIME}")
        is_number = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL") | is_wrapped(text)
        number = F.replace(text, F.lit(MARK), F.lit("")).try_cast("double")
        produced["creation_time"] = F.when(valid & is_number, number)
    events = checked.withColumns(produced)
    helpers = ["_parsed", "_delete", *(f"{part}{name}" for name in metadata for part in ("_shape", "_value"))]
    return events.withColumn("document", unmark_decimals("document")).drop(*helpers)


def normalise(
    df: DataFrame,
    value: str = "value",
    on_error: str = FAIL,
    creation_time: bool = False,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Valid change events; the raw text is dropped, other columns are kept.

    `fields` names the event columns that are needed; the others are not worked out, and
    without `document` no document is rebuilt.

    `fail` stops the job at the first bad document, `quarantine` leaves bad documents out
    of this result; `quarantined` gives exactly those.

    Events leave through a generator. A plain filter on them would be pushed below the
    projections that parse, and every document would be parsed again for the filter alone.
    """
    checked = read_metadata(df, value, creation_time)
    if on_error == FAIL:
        message = F.concat(F.lit("bad source document: "), F.col("error"))
        keep = F.col("error").isNull() | F.raise_error(message).cast("boolean")
    else:
        keep = F.col("error").isNull()
    produced = list(fields or ([*EVENT_COLUMNS, "creation_time"] if creation_time else EVENT_COLUMNS))
    carried = [name for name in df.columns if name != value]
    return checked.select(*carried, F.inline(F.when(keep, F.array(F.struct(*produced)))))


def quarantined(df: DataFrame, value: str = "value") -> DataFrame:
    """Documents that are not valid changes, whole, with their `error`."""
    checked = read_metadata(df, value)
    bad = F.when(F.col("error").isNotNull(), F.array(F.struct(value, "error")))
    return checked.select(*[name for name in df.columns if name != value], F.inline(bad))


def with_fingerprint(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Attach the schema fingerprint by table name; unknown tables get NULL.

    The catalog has one short row per table. Callers that know its size pass it through
    `broadcast_if_bounded`; otherwise Spark decides by statistics.
    """
    prints = catalog.select("table_name", F.col("fingerprint").alias("schema_fingerprint"))
    return events.join(prints, "table_name", "left")


def bronze_rows(
    events: DataFrame, source_id: str, run_id: str | None = None, ingested_at: Column | None = None
) -> DataFrame:
    """Events as bronze metadata rows; `batch` and `position` ride along when present."""
    mapped = {
        CDC_SOURCE_ID: F.lit(source_id),
        CDC_SOURCE_COMPONENT: F.col("component_path"),
        CDC_SOURCE_TABLE: F.col("table_name"),
        CDC_DOCUMENT_ID: F.col("document_id"),
        CDC_SEQUENCE_NUM: F.col("timestamp"),
        CDC_IS_DELETED: F.col("op") == DELETE,
        CDC_SCHEMA_FINGERPRINT: F.col("schema_fingerprint"),
        CDC_RAW_DOCUMENT_JSON: F.col("document"),
        CDC_INGESTED_AT: F.current_timestamp() if ingested_at is None else ingested_at,
        CDC_RUN_ID: F.lit(run_id).cast("string"),
        CDC_CREATION_TIME: F.col("creation_time"),
    }
    extra = [name for name in ("batch", "position") if name in events.columns]
    return events.select(*[mapped[name].alias(name) for name in BRONZE_COLUMNS], *extra)
