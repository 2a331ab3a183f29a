"""Array and struct column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostermill.functions.scalars import ColumnOrName, col

_NULL_KEY = "\u0000null"


def _key_text(element: Column, field: str) -> Column:
    return F.coalesce(element[field].cast("string"), F.lit(_NULL_KEY))


def array_drop_nulls(*values: ColumnOrName) -> Column:
    return F.array_compact(F.array(*[col(v) for v in values]))


def array_concat(old: ColumnOrName, new: ColumnOrName) -> Column:
    """Append ``new`` to ``old``; a missing array counts as empty."""
    left, right = col(old), col(new)
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(
        F.concat(left, right)
    )


def array_append_if_new(array: ColumnOrName, element: Column, key: str) -> Column:
    """Append a struct unless one with an equal key (null = null) is there."""
    existing = col(array)
    return (
        F.when(existing.isNull(), F.array(element))
        .when(F.exists(existing, lambda e: e[key].eqNullSafe(element[key])), existing)
        .otherwise(F.array_append(existing, element))
    )


def array_first_per_key(array: ColumnOrName, key: str) -> Column:
    """Keep the first element of each key, in order.

    Sorted by (key, place), an element whose left neighbour has another key is
    the first of its key; so two sorts do, whatever the length. Elements must
    be of a type that can be ordered.
    """
    marked = F.transform(
        col(array), lambda e, i: F.struct(_key_text(e, key).alias("k"), i.alias("i"), e.alias("e"))
    )
    order = F.array_sort(marked)
    left = F.concat(F.array(F.lit(None)), F.transform(order, lambda x: x["k"]))
    pairs = F.filter(
        F.arrays_zip(order.alias("x"), left.alias("l")),
        lambda p: p["x"].isNotNull() & (p["l"].isNull() | (p["l"] != p["x"]["k"])),
    )
    firsts = F.array_sort(F.transform(pairs, lambda p: F.struct(p["x"]["i"].alias("i"), p["x"]["e"].alias("e"))))
    return F.transform(firsts, lambda x: x["e"])


def array_union_by_key(first: ColumnOrName, second: ColumnOrName, key: str) -> Column:
    """``first`` then ``second``, one element per key, first seen wins."""
    return array_first_per_key(array_concat(first, second), key)


def set_nested_fields(root: str, values: Mapping[str, Column]) -> Column:
    """Replace dotted fields inside a struct column."""
    out = F.col(root)
    for path, value in values.items():
        out = out.withField(path, value)
    return out
