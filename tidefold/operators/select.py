"""Selections over lists of tables and files, and the longest-prefix match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefold.functions.names import CDC_SUFFIX, flow_name, logical_name
from tidefold.session import fits_broadcast


def is_listed_table(name: str = "table_name", kind: str = "table_type") -> Column:
    """Tables that monitoring counts: named, no view, no internal and no event-log table."""
    name_column = F.col(name)
    return (
        (F.coalesce(name_column, F.lit("")) != "")
        & ~name_column.startswith("__")
        & ~name_column.startswith("event_log_")
        & (F.coalesce(F.col(kind), F.lit("")) != "VIEW")
    )


def select_flow_tables(
    listing: DataFrame,
    include: DataFrame | None = None,
    exclude: DataFrame | None = None,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """Bronze tables that feed a silver flow, with target and flow names.

    `include` and `exclude` hold `table_name`; an empty include list means every table.
    `overrides` holds `table_name`, `target_override`, `flow_override`.
    """
    chosen = listing.where((F.col("table_type") != "VIEW") & F.col("table_name").endswith(CDC_SUFFIX))
    if include is not None and not include.isEmpty():
        chosen = chosen.join(include.select("table_name").distinct(), "table_name", "left_semi")
    if exclude is not None:
        chosen = chosen.join(exclude.select("table_name").distinct(), "table_name", "left_anti")
    if overrides is None:
        chosen = chosen.withColumn("target_override", F.lit(None).cast("string")).withColumn(
            "flow_override", F.lit(None).cast("string")
        )
    else:
        chosen = chosen.join(overrides, "table_name", "left")
    target = logical_name("table_name", F.col("target_override"))
    return chosen.select(
        "table_name",
        target.alias("target_table"),
        flow_name(target, F.col("flow_override")).alias("flow_name"),
    )


def required_flow_tables(listing: DataFrame, **choices: DataFrame | None) -> DataFrame:
    """The selection a pipeline is made from; selecting nothing is an error."""
    return require_rows(select_flow_tables(listing, **choices), "no bronze table is selected for a flow")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The same rows; an error when there are none."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def unprocessed(listed: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Listed items that were not processed yet."""
    return listed.join(processed.select(key), key, "left_anti")


def affected_tables(new_events: DataFrame) -> DataFrame:
    """Tables that new events touch, in table order."""
    return new_events.select("component_path", "table_name").distinct().orderBy("component_path", "table_name")


def only_affected(rows: DataFrame, affected: DataFrame) -> DataFrame:
    """Rows of affected tables; one short row per table on the other side."""
    return rows.join(affected, ["component_path", "table_name"], "left_semi")


def with_ordinal(entries: DataFrame, order: str = "relative_path") -> DataFrame:
    """0-based position by path. The input has one row per published table."""
    return entries.withColumn("ordinal", (F.row_number().over(Window.orderBy(order)) - 1).cast("bigint"))


def longest_prefix(roots: DataFrame, locations: DataFrame, root: str = "root", url: str = "url") -> DataFrame:
    """For every root the longest location that it starts with, or NULL: (root, matched_url).

    Prefixes are compared as plain text, without regard to path segments. Each root looks up
    its own prefixes of the lengths that occur among the locations, so this is an equi-join
    on text instead of comparing every root with every location.
    """
    cleaned = locations.where(F.col(url).isNotNull()).select(
        F.regexp_replace(url, "/+$", "").alias("matched_url")
    ).distinct()
    sizes = cleaned.agg(F.collect_set(F.length("matched_url")).alias("sizes"))
    # Text of which the root is too short stays NULL and matches nothing; the root itself stays.
    prefix = F.when(F.col("size") <= F.length(root), F.substring(F.col(root), F.lit(1), F.col("size")))
    candidates = (
        roots.select(root)
        .distinct()
        .withColumn("sizes", sizes.scalar())
        .select(root, F.explode_outer("sizes").alias("size"))
        .select(root, prefix.alias("prefix"))
    )
    lookup = F.broadcast(cleaned) if fits_broadcast(cleaned) else cleaned.hint("merge")
    matched = candidates.join(lookup, F.col("prefix") == F.col("matched_url"), "left")
    return matched.groupBy(root).agg(F.max_by("matched_url", F.length("matched_url")).alias("matched_url"))


def require_covered(matches: DataFrame, root: str = "root") -> DataFrame:
    """The same matches; reading a root that no location covers is an error."""
    message = F.concat(F.lit("no location covers "), F.col(root))
    covered = F.when(F.col("matched_url").isNull(), F.raise_error(message).cast("string"))
    return matches.withColumn("matched_url", F.coalesce(covered, F.col("matched_url")))
