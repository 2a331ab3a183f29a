"""Keep-first, keep-last and key-set operators.

``row_number() = 1`` lets the optimizer put a group limit before the shuffle:
every map task forwards one row per key, so a key that holds a third of the
rows costs its reducer one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermill.schemas import ORDINAL


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def keep_first(df: DataFrame, keys: list[str], order: list[str] = ORDINAL) -> DataFrame:
    """First row of each key in ``order``; null keys are equal."""
    return _one_per_key(df, keys, [F.col(c).asc_nulls_first() for c in order])


def keep_last(df: DataFrame, keys: list[str], order: list[str] = ORDINAL) -> DataFrame:
    """Last row of each key in ``order``."""
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_newest(df: DataFrame, keys: list[str], date: Column) -> DataFrame:
    """One row per key from an input of several files.

    Within a file the first row counts, as always; between files the newest
    ``date`` (none is oldest; of equals the earlier file). That is what
    loading the files one after another ends with when every row updates only
    an older one.
    """
    per_file = keep_first(df, [*keys, "_file"])
    return _one_per_key(per_file, keys, [date.desc_nulls_last(), *[F.col(c) for c in ORDINAL]])


def keep_from_last_file(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the first of the last file that has the key."""
    return keep_last(keep_first(df, [*keys, "_file"]), keys, ["_file"])


def distinct_keys(df: DataFrame, key: str, drop_empty: bool = True) -> DataFrame:
    """Distinct non-null (and non-empty) values of one key."""
    keys = df.select(key).where(F.col(key).isNotNull())
    if drop_empty:
        keys = keys.where(F.col(key).cast("string") != "")
    return keys.distinct()
