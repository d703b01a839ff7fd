"""Names, paths, keys and table selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidefold.functions import names
from tidefold.operators.select import is_listed_table, longest_prefix, select_flow_tables
from tidefold.queries.inputs import CAT_B, CAT_ONE, CKPT, table
from tidefold.queries.registry import query

_BRONZE_ID = """(select {key}, case when t = '' then 'root' else t end as s from
    (select {key}, trim(regexp_replace({text}, '[^A-Za-z0-9_]+', '_', 'g'), '_') as t from {source}))"""
_DIGIT = "case when regexp_matches({s}, '^[0-9]') then concat('{prefix}', {s}) else {s} end"


def _bronze_sql(key: str, text: str, source: str) -> str:
    inner = _BRONZE_ID.format(key=key, text=text, source=source)
    return f"select {key}, lower({_DIGIT.format(s='s', prefix='t_')}) as identifier from {inner}"


@query("prj12_bronze_identifier", _bronze_sql("page_id", "regexp_replace(url, '^http[s]?://', '')", "pages"))
def bronze_identifier(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^http[s]?://", "").alias("u"))
    return pages.select("page_id", names.bronze_identifier("u").alias("identifier"))


@query(
    "prj12_bronze_identifier_edges",
    _bronze_sql("l", "raw", """(select distinct l_shipdate as d, l_linenumber as n, concat(cast(l_linenumber as varchar), '|', strftime(l_shipdate, '%Y-%m-%d')) as l,
        case l_linenumber when 1 then '' when 2 then '---' when 3 then '__A  b__' when 4 then concat('9', cast(l_linenumber as varchar))
             else strftime(l_shipdate, '%Y-%m-%d') end as raw from lineitem)"""),
)
def bronze_identifier_edges(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "concat(cast(l_linenumber as string), '|', date_format(l_shipdate, 'yyyy-MM-dd')) as l",
        """case l_linenumber when 1 then '' when 2 then '---' when 3 then '__A  b__' when 4 then concat('9', cast(l_linenumber as string))
           else date_format(l_shipdate, 'yyyy-MM-dd') end as raw""",
    ).distinct()
    return lines.select("l", names.bronze_identifier("raw").alias("identifier"))


@query(
    "prj13_bronze_table_name",
    """select c_custkey, concat('src__', case when c_custkey % 3 = 0 then 'app' else lower(c_mktsegment) end, '__',
        lower(replace(c_name, '#', '_')), '__cdc') as table_name from customer""",
)
def bronze_table(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn(
        "component", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment"))
    )
    return customers.select("c_custkey", names.bronze_table_name("component", "c_name").alias("table_name"))


@query(
    "prj14_flow_identifier",
    f"select page_id, {_DIGIT.format(s='s', prefix='t_')} as identifier from "
    "(select page_id, regexp_replace(regexp_replace(url, '^.*[.]com/', ''), '[^A-Za-z0-9_]', '_', 'g') as s from pages)",
)
def flow_identifier(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^.*[.]com/", "").alias("u"))
    return pages.select("page_id", names.flow_identifier("u").alias("identifier"))


@query(
    "prj15_view_name",
    f"""select c_custkey, {_DIGIT.format(s='s', prefix='t__')} as view_name from (select c_custkey,
        regexp_replace(replace(regexp_replace(regexp_replace(p, '[.]parquet$', ''), '^_root/', ''), '/', '__'), '[^A-Za-z0-9_]+', '_', 'g') as s
        from (select c_custkey, concat(case c_custkey % 3 when 0 then '_root/' when 1 then 'a-b/c d/' else '7/' end, c_name, '.parquet') as p from customer))""",
)
def view_name(spark, sf_dir):
    path = "concat(case c_custkey % 3 when 0 then '_root/' when 1 then 'a-b/c d/' else '7/' end, c_name, '.parquet') as p"
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey", path)
    return customers.select("c_custkey", names.view_name("p").alias("view_name"))


@query(
    "prj16_logical_name",
    f"""select suppkey, coalesce(case when nationkey = 8 then concat('own_', cast(suppkey as varchar)) end,
        regexp_replace(table_name, '__cdc$', '')) as logical from {CAT_B.sql}""",
)
def logical(spark, sf_dir):
    override = F.when(F.col("nationkey") == 8, F.concat(F.lit("own_"), F.col("suppkey").cast("string")))
    listing = CAT_B.frame(spark, sf_dir).withColumn("override", override)
    return listing.select("suppkey", names.logical_name("table_name", "override").alias("logical"))


@query(
    "prj17_flow_name",
    """select p_partkey, case when p_size = 7 then 'my_flow' else concat('autocdc_',
        case when p_partkey % 2 = 0 then concat('t_', cast(p_partkey as varchar)) else regexp_replace(p_name, '[^A-Za-z0-9_]', '_', 'g') end) end as flow from part""",
)
def flow_name(spark, sf_dir):
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "case when p_partkey % 2 = 0 then cast(p_partkey as string) else p_name end as target",
        "case when p_size = 7 then 'my-flow' end as override",
    )
    return parts.select("p_partkey", names.flow_name("target", "override").alias("flow"))


@query(
    "prj18_staging_path",
    """select c_custkey, concat(case c_custkey % 3 when 0 then '_root' when 1 then c_mktsegment else concat('a/', c_mktsegment) end, '/', c_name, '.parquet') as path
       from customer""",
)
def staging_path(spark, sf_dir):
    component = "case c_custkey % 3 when 0 then '' when 1 then c_mktsegment else concat('a/', c_mktsegment) end as component"
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", component)
    return customers.select("c_custkey", names.staging_path("component", "c_name").alias("path"))


@query(
    "prj19_batch_name",
    f"""select run_id, case phase when 'initial_snapshot' then concat(phase, '-', cast(snapshot_ts as varchar), '-', substr(sha256(concat(
            '{{"version":1,"sync_state":{{"phase":"initial_snapshot","snapshot":', cast(snapshot_ts as varchar), ',"cursor":"', snapshot_cursor, '"}}}}')), 1, 16))
        else concat(phase, '-', cast(delta_cursor as varchar), '-', substr(sha256(concat(
            '{{"version":1,"sync_state":{{"phase":"delta_tail","cursor":', cast(delta_cursor as varchar), '}}}}')), 1, 16)) end as batch from {CKPT.sql}""",
)
def batch_name(spark, sf_dir):
    name = names.batch_name(F.col("phase"), F.col("snapshot_ts"), F.col("snapshot_cursor"), F.col("delta_cursor"))
    return CKPT.frame(spark, sf_dir).select("run_id", name.alias("batch"))


@query(
    "prj20_object_keys",
    """select c_custkey, concat(x, 'staging/current/', r) as current_key, concat(x, 'staging/versions/', cast(c_custkey as varchar), '/', r) as versioned_key,
        concat(x, 'staging/manifests/', cast(c_custkey as varchar), '.json') as manifest_key, concat(x, 'staging/manifests/latest.json') as latest_key
       from (select c_custkey, case c_custkey % 4 when 0 then '' when 1 then 'exports/' when 2 then '' else concat(c_mktsegment, '/x/') end as x,
             concat(c_name, '.parquet') as r from customer)""",
)
def object_keys(spark, sf_dir):
    raw = "case c_custkey % 4 when 0 then '  ' when 1 then ' /exports/ ' when 2 then null else concat('/', c_mktsegment, '/x') end as raw"
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", raw, "concat(c_name, '.parquet') as r", "cast(c_custkey as string) as id"
    )
    prefix = names.key_prefix("raw")
    return customers.select(
        "c_custkey",
        names.current_key(prefix, F.col("r")).alias("current_key"),
        names.versioned_key(prefix, F.col("id"), F.col("r")).alias("versioned_key"),
        names.manifest_key(prefix, F.col("id")).alias("manifest_key"),
        names.latest_manifest_key(prefix).alias("latest_key"),
    )


_LISTED_SQL = f"select table_name, table_type from {CAT_B.sql} where left(table_name, 2) <> '__' and not starts_with(table_name, 'event_log_') and table_type <> 'VIEW' and table_name <> ''"


@query("prj21_listed_tables", _LISTED_SQL)
def listed_tables(spark, sf_dir):
    return CAT_B.frame(spark, sf_dir).where(is_listed_table()).select("table_name", "table_type")


_CHOSEN = f"""(select *, case when nationkey = 8 then concat('own_', cast(suppkey as varchar)) else regexp_replace(table_name, '__cdc$', '') end as target_table
    from {CAT_ONE.sql} where table_type <> 'VIEW' and table_name like '%\\_\\_cdc' escape '\\'
    and table_name in (select concat(lower(replace(s_name, '#', '_')), '__cdc') from supplier where s_acctbal > 0)
    and table_name not in (select concat(lower(replace(s_name, '#', '_')), '__cdc') from supplier where s_nationkey = 7))"""


@query("prj22_flow_tables", f"select table_name, target_table, concat('autocdc_', target_table) as flow_name from {_CHOSEN}")
def flow_tables(spark, sf_dir):
    return _flow_tables(spark, sf_dir)


@query("jn10_include_exclude", f"select table_name from {_CHOSEN}")
def include_exclude(spark, sf_dir):
    return _flow_tables(spark, sf_dir).select("table_name")


def _flow_tables(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").withColumn(
        "table_name", F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("_"))), F.lit("__cdc"))
    )
    overrides = suppliers.where("s_nationkey = 8").select(
        "table_name",
        F.concat(F.lit("own_"), F.col("s_suppkey").cast("string")).alias("target_override"),
        F.lit(None).cast("string").alias("flow_override"),
    )
    return select_flow_tables(
        CAT_ONE.frame(spark, sf_dir),
        include=suppliers.where("s_acctbal > 0"),
        exclude=suppliers.where("s_nationkey = 7"),
        overrides=overrides,
    )


_LOCATIONS = """(select distinct regexp_replace(u, '/+$', '') as loc from (
    select regexp_extract(url, '^https?://[^/]+/') as u from pages
    union all select regexp_extract(url, '^https?://[^/]+/[^/]*') from pages where url like '%/fr/%'
    union all select 'http' ) where u <> '')"""


@query(
    "jn9_longest_prefix",
    f"""select root, (select loc from {_LOCATIONS} l where starts_with(p.root, l.loc) order by length(loc) desc limit 1) as matched_url
        from (select distinct url as root from pages) p""",
)
def prefix_match(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    hosts = pages.select(F.regexp_extract("url", "^https?://[^/]+/", 0).alias("url"))
    folders = pages.where("url like '%/fr/%'").select(F.regexp_extract("url", "^https?://[^/]+/[^/]*", 0).alias("url"))
    everything = spark.createDataFrame([("http",)], "url string")
    locations = hosts.unionByName(folders).unionByName(everything).where("url <> ''")
    return longest_prefix(pages.select(F.col("url").alias("root")), locations)
