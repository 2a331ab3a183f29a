"""Help for keys that hold a large share of all rows.

A lookup shuffles the looking side on its key. When one key holds a third
of the rows, one task gets a third of the data. ``hot_keys`` finds such keys
exactly (one count per key, combined before the shuffle) and
``salted_left_join`` spreads only their rows over several tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: keys with fewer rows than this are left to the ordinary shuffle
HOT_ROWS = 1_000_000
#: tasks a hot key is spread over
SALTS = 64


def by_shuffle(side: DataFrame) -> DataFrame:
    """A join side that grows with the data; the join sorts both sides.

    Left alone, the engine judges a side by the size of its compressed files
    and the share of its columns that are read. Of wide, mostly empty rows
    that is a hundredth of what they take in memory, so whole tables would be
    gathered by the driver and broadcast.
    """
    return side.hint("merge")


def null_safe_equal(pairs: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a & b, [left.eqNullSafe(right) for left, right in pairs])


def hot_keys(df: DataFrame, keys: list[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """All keys of ``df`` with at least ``min_rows`` rows.

    There are at most ``rows / min_rows`` of them.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= min_rows)
        .select(*keys)
    )


def _set_columns(sets: list[list[str]]) -> list[str]:
    return list(dict.fromkeys(c for keys in sets for c in keys))


def heavy_key_sets(df: DataFrame, sets: list[list[str]], min_rows: int = HOT_ROWS) -> DataFrame:
    """(columns of all sets, _set): :func:`hot_keys` of several key sets, counted
    in one pass over ``df``; ``_set`` tells the key set."""
    columns = _set_columns(sets)
    distinct = {frozenset(keys): keys for keys in sets}.values()
    counted = df.groupingSets([[F.col(c) for c in keys] for keys in distinct], *columns)
    return (
        counted.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= min_rows)
        .drop("_rows")
    )


def split_sets(found: DataFrame, sets: list[list[str]]) -> dict[tuple[str, ...], DataFrame]:
    """The heavy keys of each set."""
    columns = _set_columns(sets)
    out = {}
    for keys in sets:
        # a column that is not in the set has its bit set, the last one is 1
        number = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        out[tuple(keys)] = found.where(F.col("_set") == number).select(*keys)
    return out


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    pairs: list[tuple[str, str]],
    hot: DataFrame,
    salts: int = SALTS,
    how: str = "left",
    spread: list[str] | None = None,
) -> DataFrame:
    """``left`` ⟕ ``right`` on null-safe keys with hot keys spread out.

    ``hot`` holds key tuples under the left names (from :func:`hot_keys`).
    Left rows of a hot key get one of ``salts`` numbers, by a hash of their
    ``spread`` columns (a hash, not a random number: a repeated task must send
    each row to the same place again); the matching right rows are repeated
    once per number. All other rows have salt 0 on both sides, so nothing is
    multiplied for them and the result is the same as without salt. Column names of both sides must differ.
    """
    names = [f"_hot{i}" for i in range(len(pairs))]
    # not forced to be broadcast: the engine does that if the list is small
    flags = hot.select(*[F.col(lk).alias(n) for (lk, _), n in zip(pairs, names)]).withColumn(
        "_hot", F.lit(True)
    )

    def flagged(df: DataFrame, keys: list[str]) -> DataFrame:
        on = null_safe_equal([(df[k], flags[n]) for k, n in zip(keys, names)])
        return df.join(flags, on, "left").drop(*names)

    by = [F.col(f"`{c}`") for c in (spread or left.columns)]
    salt = F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")
    one_side = (
        flagged(left, [lk for lk, _ in pairs])
        .withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0)))
        .drop("_hot")
    )
    other_side = (
        flagged(right, [rk for _, rk in pairs])
        .withColumn(
            "_salt2",
            F.explode(
                F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                    F.array(F.lit(0))
                )
            ),
        )
        .drop("_hot")
    )
    on = null_safe_equal(
        [(one_side[lk], other_side[rk]) for lk, rk in pairs]
        + [(one_side["_salt"], other_side["_salt2"])]
    )
    return one_side.join(by_shuffle(other_side), on, how).drop("_salt", "_salt2")
