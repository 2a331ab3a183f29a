"""Change classification and completeness rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, NO_ACTION = "insert", "update", "no_action"


def classify(
    matched: Column,
    incoming_at: Column,
    stored_at: Column,
    complete: Column,
    null_incoming: str = "compare",
) -> Column:
    """Action of an incoming row.

    No stored row: insert. Otherwise update when the stored date is missing,
    the incoming one is newer, or the stored data is not ``complete``; else
    no_action. With ``null_incoming="skip"`` a missing incoming date is
    no_action at once; with ``"compare"`` it merely is not newer.
    """
    newer = F.coalesce(incoming_at > stored_at, F.lit(False))
    update = stored_at.isNull() | newer | ~F.coalesce(complete, F.lit(False))
    action = F.when(~matched, F.lit(INSERT))
    if null_incoming == "skip":
        action = action.when(incoming_at.isNull(), F.lit(NO_ACTION))
    elif null_incoming != "compare":
        raise ValueError(f"null_incoming: {null_incoming}")
    return action.when(update, F.lit(UPDATE)).otherwise(F.lit(NO_ACTION))


def classify_always_update(matched: Column) -> Column:
    return F.when(matched, F.lit(UPDATE)).otherwise(F.lit(INSERT))


def complete_unless_false(flag: Column) -> Column:
    """A missing flag counts as complete."""
    return ~flag.eqNullSafe(F.lit(False))


def complete_if_all(*flags: Column) -> Column:
    """Complete only when every parent says so; missing counts as not."""
    out = F.lit(True)
    for flag in flags:
        out = out & F.coalesce(flag, F.lit(False))
    return out


def split_by_action(df: DataFrame, action: str = "action") -> tuple[DataFrame, DataFrame]:
    """The (insert, update) rows of one classified frame."""
    return df.where(F.col(action) == INSERT), df.where(F.col(action) == UPDATE)


def action_counts(df: DataFrame, action: str = "action") -> DataFrame:
    return df.groupBy(action).agg(F.count(F.lit(1)).alias("n_rows"))
