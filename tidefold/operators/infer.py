"""Column inference over documents, and the typed projections that follow from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.functions.jsontext import member, member_as, shape
from tidefold.functions.kinds import (
    BOOL,
    FLOAT,
    SPARK_TYPE_OF_KIND,
    explode_fields,
    staging_kind,
)
from tidefold.schemas import META_CREATION_TIME, RESERVED_STAGING_COLUMNS, STAGING_LEADING, STAGING_TRAILING

_TYPES = {"boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def observed_flags(df: DataFrame, document: str, keys: Sequence[str]) -> DataFrame:
    """Kind flags per key and field over all documents: (keys..., field, flags).

    Fields are exploded and aggregated in the same stage; what gets shuffled is one small
    row per task, key and field.
    """
    return explode_fields(df, document, list(keys)).groupBy(*keys, "field").agg(F.bit_or("flag").alias("flags"))


def staging_columns(current: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Columns of each staging table: (component_path, table_name, field, kind).

    `current` holds live documents. `seeds` (table_name, field, flags) come from the schema
    catalog; they apply to every component with a table of that name. Columns that saw only
    nulls and have no seed are left out.
    """
    observed = observed_flags(current, "document", ["component_path", "table_name"])
    return merged_columns(observed, current.select("component_path", "table_name").distinct(), seeds)


def merged_columns(observed: DataFrame, tables: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """The same from flags (component_path, table_name, field, flags) of any parts of the tables."""
    keys = ["component_path", "table_name", "field"]
    observed = observed.where(~F.col("field").isin(RESERVED_STAGING_COLUMNS)).select(*keys, "flags")
    if seeds is not None:
        observed = observed.unionByName(tables.join(seeds, "table_name").select(*keys, "flags"))
    merged = observed.groupBy(*keys).agg(F.bit_or("flags").alias("flags"))
    return merged.select(*keys, staging_kind("flags").alias("kind")).where(F.col("kind").isNotNull())


def column_names(fields: Sequence[str], taken: Sequence[str], case_sensitive: bool) -> dict[str, str]:
    """Column name of each field.

    Spark may not tell names apart that differ in case only. The first in name order keeps its
    name, the others get the suffix `__2`, `__3` and so on, so every field has its column.
    """
    def folded(name: str) -> str:
        return name if case_sensitive else name.lower()

    used = {folded(name) for name in taken}
    named: dict[str, str] = {}
    reserved = {folded(field) for field in fields}
    for field in sorted(fields):
        name, number = field, 2
        while folded(name) in used or (name != field and folded(name) in reserved):
            name, number = f"{field}__{number}", number + 1
        used.add(folded(name))
        named[field] = name
    return named


def _parsed_fields(document: str, schema: T.StructType) -> Column:
    """Fields of a document by position: f0, f1, … Values are matched by the exact names in `schema`."""
    numbered = T.StructType([T.StructField(f"f{i}", f.dataType) for i, f in enumerate(schema.fields)])
    return F.from_json(document, schema).cast(numbered)


def staging_names(spark: SparkSession, columns: Sequence[tuple[str, str]]) -> list[str]:
    """Column names of the fields of a staging table, in the order of `columns`."""
    named = column_names(
        [name for name, _ in columns], [*STAGING_LEADING, *STAGING_TRAILING], spark.conf.get("spark.sql.caseSensitive") == "true"
    )
    return [named[name] for name, _ in columns]


def staging_schema(spark: SparkSession, columns: Sequence[tuple[str, str]]) -> T.StructType:
    """Schema of what `project_staging` gives."""
    ordered = sorted(tuple(c) for c in columns)
    leading = [T.StructField(name, T.LongType() if name == "_timestamp" else T.StringType()) for name in STAGING_LEADING]
    typed = [
        T.StructField(name, _TYPES[SPARK_TYPE_OF_KIND[kind]]) for name, (_, kind) in zip(staging_names(spark, ordered), ordered)
    ]
    return T.StructType([*leading, *typed, *[T.StructField(name, T.StringType()) for name in STAGING_TRAILING]])


def project_staging(current: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Typed staging rows of one table.

    `columns` are (name, kind), in any order; the output has them in name order. One
    `from_json` parses each document once. It takes a value only if its JSON type fits,
    widens integers to DOUBLE, and gives strings unquoted and nested values as JSON text.
    """
    ordered = sorted(tuple(c) for c in columns)
    names = staging_names(current.sparkSession, ordered)
    base = current.select(
        F.col("component_path").alias("_component_path"),
        F.col("table_name").alias("_table_name"),
        F.col("document_id").alias("_document_id"),
        F.col("timestamp").alias("_timestamp"),
        F.col("schema_fingerprint").alias("_schema_fingerprint"),
        F.col("document").alias("_document_json"),
    )
    if not ordered:
        return base
    schema = T.StructType([T.StructField(name, _TYPES[SPARK_TYPE_OF_KIND[kind]]) for name, kind in ordered])
    parsed = base.withColumn("_fields", _parsed_fields("_document_json", schema))
    return parsed.select(
        *STAGING_LEADING,
        *[F.col("_fields").getField(f"f{i}").alias(name) for i, name in enumerate(names)],
        *STAGING_TRAILING,
    )


def project_bronze(
    rows: DataFrame, document: str, columns: Sequence[tuple[str, str, int]], keep: Sequence[str], fields: str | None = None
) -> DataFrame:
    """`keep` columns followed by the typed user columns of one bronze table.

    `columns` are (name, type, flags). Only columns that really mix booleans with something
    else pay for it: as numbers they become 1 and 0, as text `True` and `False`.

    `fields` names a variant with the scalar members of the document, see `flat_fields`. Values come
    from there, one shredded column each, and the document is not parsed; only text columns that saw
    numbers with a fraction still need it, because a variant does not tell `1.0` from `1`.
    """
    ordered = sorted(columns)
    named = column_names(
        [name for name, _, _ in ordered], keep, rows.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    )
    if not ordered:
        return rows.select(*keep)
    from_text = [c for c in ordered if fields is None or (c[1] == "string" and c[2] & FLOAT)]
    mixed = {name for name, type_name, flags in ordered if flags & BOOL and type_name != "boolean"}
    schema = T.StructType(
        [T.StructField(name, _TYPES["string" if name in mixed else type_name]) for name, type_name, _ in from_text]
    )
    parsed = rows.withColumn("_fields", _parsed_fields(document, schema)) if from_text else rows
    if any(name in mixed and type_name == "string" for name, type_name, _ in from_text):
        parsed = parsed.withColumn("_variant", F.try_parse_json(document))
    place = {name: i for i, (name, _, _) in enumerate(from_text)}

    def column(name: str, type_name: str) -> Column:
        if name not in place:
            value = member_as(fields, name, type_name)
            if name in mixed and type_name == "string":
                return F.when(shape(member(fields, name)) == "BOOLEAN", F.initcap(value)).otherwise(value)
            return value
        value = F.col("_fields").getField(f"f{place[name]}")
        if name not in mixed:
            return value
        if type_name == "string":
            return F.when(shape(member("_variant", name)) == "BOOLEAN", F.initcap(value)).otherwise(value)
        return F.when(value == "true", "1").when(value == "false", "0").otherwise(value).try_cast(type_name)

    return parsed.select(*keep, *[column(name, type_name).alias(named[name]) for name, type_name, _ in ordered])


def bronze_fields(df: DataFrame, document: str, keys: Sequence[str]) -> DataFrame:
    """Flags of the user fields of bronze rows; the creation time has a column of its own."""
    return observed_flags(df, document, keys).where(F.col("field") != META_CREATION_TIME)
