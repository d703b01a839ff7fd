"""Latest-wins fold: the operator that turns a change log into current state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefold.schemas import DELETE, IDENTITY, ORDERING
from tidefold.session import BROADCAST_BYTES, fits_broadcast


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the greatest by `order`, compared left to right.

    `row_number() = 1` makes Spark keep one row per key in every map task before the
    shuffle, so a single hot key sends at most one row per task to its reducer.
    """
    descending = [(F.col(column) if isinstance(column, str) else column).desc() for column in order]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*descending)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def fold_onto(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The fold of `base` and `changes`, where `base` already has one row per key."""
    untouched, folded = split_fold(base, changes, keys, order, max_bytes)
    return folded if untouched is None else untouched.unionByName(folded)


def split_fold(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame | None, DataFrame]:
    """The same fold in two parts: base rows that no change touches, and the others folded.

    With few changes only the touched rows of the base are folded: the changed keys are
    measured, broadcast, and the rest of the base passes through without a shuffle. With many
    changes everything is folded at once and there is no first part.
    """
    columns = base.columns
    changes = changes.select(*columns)
    changed_keys = changes.select(*[F.col(key).alias(f"_{key}") for key in keys])
    # Measured with repeats, so that measuring is one narrow scan without a shuffle.
    if not fits_broadcast(changed_keys, max_bytes):
        return None, latest_by(base.unionByName(changes), keys, order)
    changed_keys = F.broadcast(changed_keys.distinct())
    match = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    untouched = base.join(changed_keys, match, "left_anti")
    touched = base.join(changed_keys, match, "left_semi")
    return untouched, latest_by(touched.unionByName(changes), keys, order)


def fold_log(log: DataFrame, order: Sequence[str] = ORDERING) -> DataFrame:
    """Last event of every document, deletes included.

    Deletes must take part here and stay as tombstones: dropped earlier, they would let an
    older upsert come back, now or in a later run.
    """
    return latest_by(log, IDENTITY, order)


def live(folded: DataFrame) -> DataFrame:
    """Documents that exist: not deleted, and carrying a payload."""
    return folded.where((F.col("op") != DELETE) & F.col("document").isNotNull())


def current_state(log: DataFrame, order: Sequence[str] = ORDERING) -> DataFrame:
    return live(fold_log(log, order))


def apply_changes(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: Column | str,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """Slowly changing dimension type 1: the current row of every key that is not deleted.

    Rows may arrive in any order; only `sequence_by` counts.
    """
    condition = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    latest = latest_by(changes, keys, sequence_by)
    return latest.where(~F.coalesce(condition, F.lit(False))).drop(*except_columns)
