"""JSON text, fingerprints, schema classification and content digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidefold.functions.jsontext import canonical_json
from tidefold.functions.kinds import schema_field_flags, staging_kind
from tidefold.operators.digest import content_digest, sha_number
from tidefold.queries.inputs import table
from tidefold.queries.registry import query
from tidefold.session import scratch_path
from tidefold.sources.catalog import catalog_from_payload, payload_hash, read_catalog, with_fingerprints, write_catalog
from tidefold.sources.changelog import read_change_files


@query(
    "prj7_canonical_json",
    """select event_id, concat('{"a":[1.5,', cast(user_id as varchar), '.0,"x: 1.0"],"k":', replace(props, ' ', ''),
        ',"z":', cast(event_id as varchar), '.0}') as canonical from events""",
)
def canonical_text(spark, sf_dir):
    loose = F.concat(
        F.lit('{ "z" : '), F.col("event_id").cast("string"), F.lit('.00, "k":'), "props",
        F.lit(', "a": [ 1.50, '), F.col("user_id").cast("string"), F.lit('.0, "x: 1.0" ] }'),
    )
    return table(spark, sf_dir, "events").select("event_id", canonical_json(loose).alias("canonical"))


@query(
    "prj7_canonical_text_documents",
    "select doc_id, sha256(concat('{\"n\":', cast(n_chars as varchar), ',\"t\":', cast(to_json(text) as varchar), '}')) as digest from documents",
)
def canonical_documents(spark, sf_dir):
    """Whole texts: quotes, line ends, letters of all languages."""
    text = "substr(to_json(struct(text as t)), 6, length(to_json(struct(text as t))) - 6)"
    loose = F.concat(
        F.lit('{ "t" :  '), F.expr(text), F.lit(', "n" : '), F.col("n_chars").cast("string"), F.lit(" }")
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(canonical_json(loose), 256).alias("digest"))


_SCHEMA = """concat('{"properties":{"size":{"maximum":', cast(p_size as varchar), ',"type":"integer"},"title":{"type":"string"}},"type":"object"}')"""
_PART_SCHEMA = """concat('{"type": "object", "properties": {"title": {"type": "string"}, "size": {"type": "integer", "maximum": ',
    cast(p_size as string), '}}}')"""


@query("prj10_schema_fingerprint", f"select concat('part_', cast(p_partkey as varchar)) as table_name, sha256({_SCHEMA}) as fingerprint from part")
def schema_fingerprint(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("table_name"), F.expr(_PART_SCHEMA).alias("schema_json")
    )
    return with_fingerprints(parts).select("table_name", "fingerprint")


_CATALOG_SQL = f"""select concat('part_', cast(p_partkey as varchar)) as table_name, {_SCHEMA} as schema_json,
    sha256({_SCHEMA}) as fingerprint from part where p_size <> 10"""


def _payloads(spark, sf_dir):
    """One payload per part; for one part size it is not an object and names no table."""
    named = F.concat(F.lit('{"$internal": {}, "part_'), F.col("p_partkey").cast("string"), F.lit('": '))
    whole = F.concat(named, F.expr(_PART_SCHEMA), F.lit("}"))
    payload = F.when(F.col("p_size") == 10, "[1]").otherwise(whole)
    return table(spark, sf_dir, "part").select(payload.alias("value"))


@query("src7_schema_catalog", _CATALOG_SQL)
def schema_catalog(spark, sf_dir):
    return catalog_from_payload(_payloads(spark, sf_dir))


@query("snk3_schema_catalog_write", _CATALOG_SQL)
def schema_catalog_write(spark, sf_dir):
    path = scratch_path(spark, "catalog")
    write_catalog(catalog_from_payload(_payloads(spark, sf_dir)), path)
    return read_catalog(spark, path)


@query(
    "prj11_payload_hash",
    f"""select sha256(case when p_size = 10 then '[1]'
        else concat('{{"$internal":{{}},"part_', cast(p_partkey as varchar), '":', {_SCHEMA}, '}}') end) as schema_hash from part""",
)
def schema_hash(spark, sf_dir):
    return payload_hash(_payloads(spark, sf_dir))


# Field schemas in all shapes, one per part, chosen by its size.
_SHAPES = [
    ('{"type":"boolean"}', "Boolean"),
    ('{"type":"integer"}', "Int64"),
    ('{"type":"number"}', "Float64"),
    ('{"type":"string"}', "Utf8"),
    ('{"type":"array"}', "JsonUtf8"),
    ('{"type":"object"}', "JsonUtf8"),
    ('{"type":"bigint"}', "JsonUtf8"),
    ('{"type":"null"}', None),
    ('{"type":["string","null"]}', "Utf8"),
    ('{"type":["integer","number"]}', "Float64"),
    ('{"type":["integer","string"]}', "JsonUtf8"),
    ('{"anyOf":[{"type":"null"},{"type":"integer"}]}', "Int64"),
    ('{"anyOf":[{"type":"number"},{"anyOf":[{"type":"integer"},{"type":"null"}]}]}', "Float64"),
    ('{"oneOf":[{"type":"boolean"},{"type":"string"}]}', "JsonUtf8"),
    ('{"oneOf":[{"const":1},{"type":"string"}]}', "Utf8"),
    ('{"type":"string","anyOf":[{"type":"integer"}]}', "Utf8"),
    ('{"$ref":"x"}', None),
    ('{"enum":["a"]}', None),
    ('{"anyOf":[{"$ref":"x"}]}', None),
]


def _shape_case(position: int) -> str:
    arms = []
    for number, shape in enumerate(_SHAPES):
        value = shape[position]
        arms.append(f"when {number} then " + ("null" if value is None else f"'{value}'"))
    return f"case p_size % {len(_SHAPES)} {' '.join(arms)} end"


@query(
    "prj26_schema_kinds",
    f"""select concat('part_', cast(p_partkey as varchar)) as table_name, 'f' as field, {_shape_case(1)} as kind
        from part where ({_shape_case(1)}) is not null
        union all select concat('part_', cast(p_partkey as varchar)), '_creationTime', 'Float64' from part""",
)
def schema_kinds(spark, sf_dir):
    schema = F.concat(
        F.lit('{"type":"object","properties":{"_id":{"type":"string"},"_creationTime":{"type":"string"},"f":'),
        F.expr(_shape_case(0)),
        F.lit("}}"),
    )
    catalog = table(spark, sf_dir, "part").select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("table_name"), schema.alias("schema_json")
    )
    flags = schema_field_flags(catalog)
    return flags.select("table_name", "field", staging_kind("flags").alias("kind")).where(F.col("kind").isNotNull())


@query(
    "src11_content_inventory",
    """select lang, source, count(*) as row_count, sha256(concat_ws(':', cast(count(*) as varchar),
        cast(sum(('0x' || substr(sha256(text), 1, 15))::bigint) as varchar))) as sha256 from documents group by lang, source""",
)
def content_inventory(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("lang", "source", "text")
    return content_digest(rows, ["lang", "source"], sha_number("text"))


@query("src11_layout_free_digest", "select count(*) as row_count, true as same from lineitem")
def layout_free_digest(spark, sf_dir):
    """The digest of a table does not depend on how its rows are split or ordered."""
    lines = table(spark, sf_dir, "lineitem")
    both = [
        content_digest(rows.withColumn("k", F.lit(1)), ["k"])
        for rows in (lines, lines.repartition(7, "l_partkey").sortWithinPartitions("l_tax"))
    ]
    other = both[1].select("k", F.col("sha256").alias("other"))
    return both[0].join(other, "k").select("row_count", (F.col("sha256") == F.col("other")).alias("same"))


@query(
    "src11_file_inventory",
    """select o_orderpriority as priority, count(*) as row_count from orders group by 1""",
)
def binary_inventory(spark, sf_dir):
    """Foreign parquet files, listed with their hash, then read back by that list."""
    from tidefold.sources.manifest import file_inventory

    path = scratch_path(spark, "foreign")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    orders.write.parquet(path)
    files = file_inventory(spark, path).select("relative_path", "sha256", "bytes")
    stored = spark.read.parquet(path).withColumn("relative_path", F.col("_metadata.file_name"))
    listed = stored.join(files.where((F.length("sha256") == 64) & (F.col("bytes") > 0)), "relative_path", "left_semi")
    return listed.groupBy("priority").agg(F.count("*").alias("row_count"))


@query(
    "src5_change_log_files",
    """select 'app' as component_path, event_type as table_name, cast(user_id as varchar) as document_id, epoch_us(ts) as timestamp,
        case when event_type = 'error' then 'delete' else 'upsert' end as op, cast(null as varchar) as schema_fingerprint,
        case when event_type <> 'error' then props end as document from events""",
)
def change_log_files(spark, sf_dir):
    path = scratch_path(spark, "log-files")
    events = table(spark, sf_dir, "events").selectExpr(
        "'app' as component_path", "event_type as table_name", "cast(user_id as string) as document_id",
        "unix_micros(cast(ts as timestamp)) as timestamp",
        "case when event_type = 'error' then 'delete' else 'upsert' end as op",
        "cast(null as string) as schema_fingerprint", "case when event_type <> 'error' then props end as document",
    )
    events.write.parquet(path)
    return read_change_files(spark, path).drop("batch", "position")


@query(
    "prj26_deep_unions",
    """select concat('part_', cast(p_partkey as varchar)) as table_name, 'f' as field,
        case p_size % 3 when 0 then 'Int64' when 1 then 'Utf8' else 'Float64' end as kind from part""",
)
def deep_unions(spark, sf_dir):
    """A type below twelve levels of unions, in turn anyOf and oneOf."""
    node = F.expr("concat('{\"type\":\"', case p_size % 3 when 0 then 'integer' when 1 then 'string' else 'number' end, '\"}')")
    for level in range(12):
        union = "anyOf" if level % 2 else "oneOf"
        node = F.concat(F.lit(f'{{"{union}":[{{"type":"null"}},'), node, F.lit("]}"))
    schema = F.concat(F.lit('{"properties":{"f":'), node, F.lit("}}"))
    catalog = table(spark, sf_dir, "part").select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("table_name"), schema.alias("schema_json")
    )
    return schema_field_flags(catalog).select("table_name", "field", staging_kind("flags").alias("kind"))


@query(
    "src11_null_positions",
    "select c_mktsegment as segment, 2 as digests from customer group by 1",
)
def null_positions(spark, sf_dir):
    """Values that move between columns of which the other is NULL change the digest."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    nothing = F.lit(None).cast("string")
    sides = [
        content_digest(rows.select("segment", *[v.alias(n) for n, v in zip("ab", pair)]), ["segment"])
        for pair in ((F.col("name"), nothing), (nothing, F.col("name")))
    ]
    both = sides[0].union(sides[1])
    return both.groupBy("segment").agg(F.count_distinct("sha256").cast("int").alias("digests"))
