"""Value kinds as bit flags, and the two lattices that turn flags into column types.

A flag per kind makes inference a `bit_or`: the buffer is one integer, Spark hash-aggregates
it on the map side, and the outcome cannot depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.functions.jsontext import object_entries, shape
from tidefold.schemas import (
    META_CREATION_TIME,
    RESERVED_STAGING_COLUMNS,
    SCHEMA_METADATA_FIELDS,
)

BOOL, INT, FLOAT, TEXT, NESTED = 1, 2, 4, 8, 16

# --- Fixed values: names of the column kinds and of the JSON-schema types -------------
BOOLEAN_KIND = "Boolean"
INT64_KIND = "Int64"
FLOAT64_KIND = "Float64"
UTF8_KIND = "Utf8"
JSON_KIND = "JsonUtf8"

SCHEMA_TYPE_FLAGS = {
    "boolean": BOOL,
    "integer": INT,
    "number": FLOAT,
    "string": TEXT,
    "null": 0,
}
# --- end of fixed values ----------------------------------------------------------------

SPARK_TYPE_OF_KIND = {
    BOOLEAN_KIND: "boolean",
    INT64_KIND: "bigint",
    FLOAT64_KIND: "double",
    UTF8_KIND: "string",
    JSON_KIND: "string",
}


def shape_flag(text: Column | str) -> Column:
    """Flag of a value by its `shape`; 0 for JSON null. Integers beyond 64 bits count as floats."""
    text = F.col(text) if isinstance(text, str) else text
    return (
        F.when(text == "STRING", TEXT)
        .when(text == "BIGINT", INT)
        .when((text == "DOUBLE") | text.startswith("DECIMAL"), FLOAT)
        .when(text == "BOOLEAN", BOOL)
        .when(text.startswith("OBJECT") | text.startswith("ARRAY"), NESTED)
        .otherwise(0)
    )


def flag_kind(flag: Column | str) -> Column:
    """Name of a single value's kind; NULL for JSON null."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return (
        F.when(flag == BOOL, BOOLEAN_KIND)
        .when(flag == INT, INT64_KIND)
        .when(flag == FLOAT, FLOAT64_KIND)
        .when(flag == TEXT, UTF8_KIND)
        .when(flag == NESTED, JSON_KIND)
    )


def staging_kind(flags: Column | str) -> Column:
    """Column kind of everything seen: one kind stays, int with float widens, the rest is JSON."""
    flags = F.col(flags) if isinstance(flags, str) else flags
    return (
        F.when(flags == 0, F.lit(None).cast("string"))
        .when(flags == BOOL, BOOLEAN_KIND)
        .when(flags == INT, INT64_KIND)
        .when(flags.isin(FLOAT, INT | FLOAT), FLOAT64_KIND)
        .when(flags == TEXT, UTF8_KIND)
        .otherwise(JSON_KIND)
    )


def bronze_type(flags: Column | str) -> Column:
    """Bronze column type: numbers absorb booleans, a column of nulls is text."""
    flags = F.col(flags) if isinstance(flags, str) else flags
    return (
        F.when(flags == 0, "string")
        .when(flags == BOOL, "boolean")
        .when(flags.bitwiseAND(F.lit(~(BOOL | INT))) == 0, "bigint")
        .when(flags.bitwiseAND(F.lit(~(BOOL | INT | FLOAT))) == 0, "double")
        .otherwise("string")
    )


def explode_fields(df: DataFrame, document: str, keep: list[str]) -> DataFrame:
    """One row per member of each JSON object: `keep` columns, `field`, `value`, `flag`.

    Documents that are not objects contribute nothing.
    """
    members = df.select(*keep, F.explode(object_entries(F.try_parse_json(document))).alias("field", "value"))
    return members.withColumn("_shape", shape("value")).withColumn("flag", shape_flag("_shape")).drop("_shape")


def document_kinds(document: Column | str) -> Column:
    """The fields of a JSON object and the flags of their values as JSON text, equal for documents of like form.

    NULL for documents that are not objects.
    """
    shapes = F.transform_values(object_entries(F.try_parse_json(document)), lambda _, value: shape(value))
    return F.to_json(F.transform_values(shapes, lambda _, text: shape_flag(text)))


def schema_field_flags(catalog: DataFrame) -> DataFrame:
    """Flags that a JSON-schema catalog seeds: (table_name, field, flags).

    Kinds join as a lattice, so a union is the `or` of its branches however they nest. A node
    says what it is by its `type`, else by its union branches. All levels of a field are unfolded
    where its schema is parsed; a field has no more levels than its text names unions. Tables
    with equal schemas share the outcome: each text is parsed once.
    """
    texts = catalog.select("table_name", "schema_json", F.sha2("schema_json", 256).alias("schema"))
    forms = texts.select("schema", "schema_json").distinct()
    properties = F.expr("try_variant_get(try_parse_json(schema_json), '$.properties', 'variant')")
    fields = forms.select("schema", F.explode(object_entries(properties)).alias("field", "node")).where(
        ~F.col("field").isin(SCHEMA_METADATA_FIELDS + RESERVED_STAGING_COLUMNS)
    )
    levels = F.coalesce(F.regexp_count(F.to_json("node"), F.lit("anyOf|oneOf")), F.lit(0))
    start = F.struct(F.lit(0).alias("flags"), F.array("node").alias("nodes"))
    unfolded = F.aggregate(F.sequence(F.lit(0), levels), start, lambda state, _: _unfold(state), lambda state: state["flags"])
    own = F.when(F.col("field") == META_CREATION_TIME, FLOAT).otherwise(unfolded)
    seeded = texts.select("table_name", "schema").join(fields.select("schema", "field", own.alias("flags")), "schema")
    return seeded.groupBy("table_name", "field").agg(F.bit_or("flags").alias("flags"))


def _unfold(state: Column) -> Column:
    """One level of unions: the flags so far with those of the nodes that have a type, and the branches of the others."""
    def named(node: Column) -> Column:
        return F.try_variant_get(node, "$.type", "variant")

    def own(node: Column) -> Column:
        return F.when(named(node).isNotNull(), _type_flags(named(node))).otherwise(0)

    def branches(node: Column) -> Column:
        found = [F.try_variant_get(node, f"$.{union}", "array<variant>") for union in ("anyOf", "oneOf")]
        nothing = F.array().cast("array<variant>")
        return F.when(named(node).isNull(), F.coalesce(*found, nothing)).otherwise(nothing)

    flags = F.aggregate(state["nodes"], state["flags"], lambda seen, node: seen.bitwiseOR(own(node)))
    return F.struct(flags.alias("flags"), F.flatten(F.transform(state["nodes"], branches)).alias("nodes"))


def _type_flags(named: Column) -> Column:
    """Flags of a `type`: a word or a list of words. Anything else names nothing."""
    words = F.coalesce(
        F.try_variant_get(named, "$", "array<variant>"),
        F.when(shape(named) == "STRING", F.array(named)),
        F.array().cast("array<variant>"),
    )
    texts = F.filter(words, lambda word: shape(word) == "STRING")
    return F.aggregate(
        texts, F.lit(0), lambda seen, word: seen.bitwiseOR(_word_flag(F.try_variant_get(word, "$", "string")))
    )


def _word_flag(word: Column) -> Column:
    flag = F.lit(NESTED)
    for name, value in SCHEMA_TYPE_FLAGS.items():
        flag = F.when(word == name, value).otherwise(flag)
    return flag
