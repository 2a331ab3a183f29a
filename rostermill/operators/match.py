"""Lookups against stored tables: null-safe equi-joins, at most one match."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostermill.operators.dedup import distinct_keys, keep_first
from rostermill.schemas import ORDINAL
from rostermill.skew import by_shuffle, null_safe_equal, salted_left_join

Expr = str | Column | Callable[[], Column]
Fields = Mapping[str, Expr]


def _expr(value: Expr) -> Column:
    if isinstance(value, str):
        return F.col(value)
    return value if isinstance(value, Column) else value()


def _fields(fields: Fields) -> Column:
    """Struct of the wanted fields; all-path lists go over as one text."""
    if all(isinstance(e, str) for e in fields.values()):
        return F.expr("named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")")
    return F.struct(*[_expr(e).alias(n) for n, e in fields.items()])


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str | Column],
    fields: Fields,
    alias: str,
    first_by: list[str] | None = None,
    how: str = "left",
    hot: DataFrame | None = None,
    spread: list[str] | None = None,
    null_safe: bool = True,
    tuple_key: str | None = None,
) -> DataFrame:
    """Add the matching right row to each left row as struct ``alias``.

    ``on`` maps left columns to right expressions (dotted paths allowed);
    null equals null. ``fields`` names what to take over, so only those
    columns of the right side are read and shuffled. The struct is null when
    nothing matches. ``first_by`` orders several right rows of one key and
    keeps the first; leave it out when the keys are unique by construction,
    which saves that shuffle. ``hot`` (see :mod:`rostermill.skew`) spreads
    left keys that hold a large share of the rows, by the ``spread`` columns
    (default: all). ``null_safe=False`` is for keys without nulls: plain
    equality can use a partitioning that the left side already has.
    ``tuple_key`` names a left column with :func:`tuple_hash` of the keys: the
    whole tuple is then one join key, and the optimizer can build a Bloom
    filter from the left side's tuples and apply it to the right side before
    that is shuffled.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    order = [f"_o{i}" for i in range(len(first_by or []))]
    side = right.select(
        *[_expr(r).alias(k) for r, k in zip(on.values(), keys)],
        _fields(fields).alias(alias),
        *[_expr(c).alias(o) for c, o in zip(first_by or [], order)],
    )
    if order:
        side = keep_first(side, keys, order).drop(*order)
    pairs = list(zip(on.keys(), keys))
    if hot is not None:
        return salted_left_join(left, side, pairs, hot, how=how, spread=spread).drop(*keys)
    if tuple_key is not None:
        same = null_safe_equal([(left[lk], side[k]) for lk, k in pairs])
        condition = (left[tuple_key] == tuple_hash([side[k] for k in keys])) & same
    elif null_safe:
        condition = null_safe_equal([(left[lk], side[k]) for lk, k in pairs])
    else:
        condition = reduce(and_, [left[lk] == side[k] for lk, k in pairs])
    return left.join(by_shuffle(side), condition, how).drop(*keys)


def tuple_hash(keys: list[str] | list[Column]) -> Column:
    """One number for a key tuple. Nulls count; different tuples may share it."""
    return F.xxhash64(*keys)


def with_tuple(rows: DataFrame, keys: list[str], name: str = "_tuple") -> DataFrame:
    """Add the hash of a key tuple to numbered rows, for :func:`lookup`.

    Row numbers are never negative; the comparison tells the optimizer that
    this side is filtered, without which it builds no runtime filter.
    """
    return rows.where(F.col("_line") >= 0).withColumn(name, tuple_hash(keys))


def _semi(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str) -> DataFrame:
    keys = [f"_k{i}" for i in range(len(on))]
    side = right.select(*[F.col(r).alias(k) for r, k in zip(on.values(), keys)])
    condition = null_safe_equal([(_path(left, lk), side[k]) for lk, k in zip(on.keys(), keys)])
    return left.join(by_shuffle(side), condition, how)


def _path(df: DataFrame, dotted: str) -> Column:
    root, *rest = dotted.split(".")
    out = df[root]
    for name in rest:
        out = out[name]
    return out


def with_match(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``left`` whose key tuple occurs in ``right`` (prefetch)."""
    return _semi(left, right.select(*on.values()), dict(on), "left_semi")


def without_match(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``left`` whose key tuple does not occur in ``right``."""
    return _semi(left, right.select(*on.values()), dict(on), "left_anti")


def missing_parents(children: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """One row per child key that has no parent: ``key`` and, if the children
    carry it, the scan position of the first child that wants it.

    The children are reduced to one row per key before the join, so a parent
    wanted by a third of all children is one row by then. A null key wants a
    parent as well.
    """
    if set(ORDINAL) <= set(children.columns):
        wanted = keep_first(children.select(key, *ORDINAL), [key])
    else:
        wanted = children.select(key).distinct()
    return without_match(wanted, parents.select(F.col(parent_key).alias("_p")), {key: "_p"})


def union_with_precedence(
    first: DataFrame, second: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Both sides, one row per key; rows of ``first`` win."""
    both = first.withColumn("_side", F.lit(0)).unionByName(second.withColumn("_side", F.lit(1)))
    return keep_first(both, keys, ["_side", *order]).drop("_side")


def detect_changes(
    stored: DataFrame, incoming: DataFrame, key: str, stored_value: str, incoming_value: str,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Stored rows whose value differs from the incoming row of the same key.

    The result is ``stored`` plus the column ``_new``.
    """
    matched = lookup(
        stored, incoming, {key: key}, {"value": incoming_value}, "_in", how="inner", hot=hot
    )
    return (
        matched.where(~_expr(stored_value).eqNullSafe(F.col("_in.value")))
        .withColumn("_new", F.col("_in.value"))
        .drop("_in")
    )


def code_lookup(df: DataFrame, codes: DataFrame, code: str, label: str) -> DataFrame:
    """Add ``label`` from a (code, label) list; unknown codes give "".

    ``codes`` must be a fixed list (the relationship list has 154 rows):
    it is broadcast.
    """
    side = codes.select(F.col("code").alias("_code"), F.col("label").alias("_label"))
    return (
        df.join(F.broadcast(side), df[code] == side["_code"], "left")
        .withColumn(label, F.coalesce(F.col("_label"), F.lit("")))
        .drop("_code", "_label")
    )


__all__ = [
    "code_lookup", "detect_changes", "distinct_keys", "lookup", "missing_parents",
    "tuple_hash", "union_with_precedence", "with_match", "with_tuple", "without_match",
]
