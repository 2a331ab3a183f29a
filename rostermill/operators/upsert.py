"""Apply classified changes to a stored table: frame in, frame out.

Nothing here writes; :mod:`rostermill.storage` keeps the results.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostermill.functions.arrays import array_concat, set_nested_fields
from rostermill.operators.match import without_match
from rostermill.skew import by_shuffle, null_safe_equal

KEEP_OLD = ("created", "histories")
APPEND = ("ardbDocuments",)


def upsert_apply(
    state: DataFrame,
    changes: DataFrame,
    key: str = "_id",
    keep_old: Iterable[str] = KEEP_OLD,
    append: Iterable[str] = APPEND,
) -> DataFrame:
    """State after the changes, both unique on ``key``.

    A changed row takes every field of the change, its nulls included,
    except that ``keep_old`` fields stay and ``append`` arrays grow. One
    full outer join; rows of both sides are unique, so no key is heavy.
    """
    kept, grown = set(keep_old), set(append)
    old = state.select(F.col(key).alias("_old_key"), F.struct(*state.columns).alias("_old"))
    new = changes.select(F.col(key).alias("_new_key"), F.struct(*state.columns).alias("_new"))
    joined = old.join(new, old["_old_key"] == new["_new_key"], "full_outer")
    is_new, is_old = F.col("_new_key").isNotNull(), F.col("_old_key").isNotNull()

    def merged(name: str) -> Column:
        before, after = F.col(f"_old.{name}"), F.col(f"_new.{name}")
        if name in grown:
            return array_concat(before, after)
        if name in kept:
            return F.when(is_old, before).otherwise(after)
        return F.when(is_new, after).otherwise(before)

    return joined.select(*[merged(c).alias(c) for c in state.columns])


def upsert_replace(state: DataFrame, changes: DataFrame, key: str = "_id") -> DataFrame:
    """State with every row of a changed key replaced by the change's rows."""
    rest = without_match(state, changes, {key: key})
    return rest.unionByName(changes.select(*state.columns))


def update_many_nested(
    state: DataFrame,
    changes: DataFrame,
    key: str,
    root: str,
    values: Mapping[str, str],
    lineage: str | None = None,
) -> DataFrame:
    """Set nested fields on all rows of each changed key.

    ``changes`` is unique on ``key``; ``values`` maps fields below ``root``
    to its columns. With ``lineage`` (a struct column of the changes) the
    lineage array grows and the two source fields are set.
    """
    extra = [lineage] if lineage else []
    side = changes.select(
        F.col(key).alias("_ck"),
        F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_c_{c}") for c in [*values.values(), *extra]],
    )
    joined = state.join(by_shuffle(side), null_safe_equal([(state[key], side["_ck"])]), "left")
    hit = F.col("_hit")
    new_root = set_nested_fields(root, {p: F.col(f"_c_{c}") for p, c in values.items()})
    out = {root: F.when(hit, new_root).otherwise(F.col(root))}
    if lineage:
        entry = F.col(f"_c_{lineage}")
        out["ardbDocuments"] = F.when(
            hit, array_concat("ardbDocuments", F.array(entry))
        ).otherwise(F.col("ardbDocuments"))
        out["ardbSourceDocument"] = F.when(hit, entry["fileName"]).otherwise(
            F.col("ardbSourceDocument")
        )
        out["ardbLastModifiedDate"] = F.when(hit, entry["updatedAt"]).otherwise(
            F.col("ardbLastModifiedDate")
        )
    return joined.withColumns(out).select(*state.columns)


def patch_nested_fields(
    state: DataFrame, patch: DataFrame, key: str, fields: Mapping[str, str]
) -> DataFrame:
    """Set dotted fields from the patch's columns; a null leaves the field."""
    side = patch.select(
        F.col(key).alias("_pk"), *[F.col(c).alias(f"_p_{c}") for c in fields.values()]
    )
    joined = state.join(by_shuffle(side), state[key] == side["_pk"], "left")
    by_root: dict[str, dict[str, Column]] = {}
    for path, column in fields.items():
        root, _, rest = path.partition(".")
        by_root.setdefault(root, {})[rest] = F.coalesce(F.col(f"_p_{column}"), F.col(path))
    updates = {root: set_nested_fields(root, values) for root, values in by_root.items()}
    return joined.withColumns(updates).select(*state.columns)
