"""Checks whose failures are data: duplicates, orphans, bad values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key tuples that occur more than once, with their row count."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def with_reject_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``_reason``: the first rule that holds, null for good rows."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(list(rules.items())):
        reason = F.when(broken, F.lit(name)).otherwise(reason)
    return df.withColumn("_reason", reason)


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("_reason").isNull()).drop("_reason")


def rejected(df: DataFrame, step: str, key: Column) -> DataFrame:
    """Bad rows as (file, step, key, reason)."""
    return df.where(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"),
        F.lit(step).alias("step"),
        key.alias("row_key"),
        F.col("_reason").alias("reason"),
    )


def fail_on_rejects(df: DataFrame) -> DataFrame:
    """Fail-fast form: the job stops at the first bad row."""
    bad = F.raise_error(F.concat(F.lit("rejected row: "), F.col("_reason")))
    return df.where(
        F.when(F.col("_reason").isNull(), F.lit(True)).otherwise(bad.cast("boolean"))
    ).drop("_reason")
