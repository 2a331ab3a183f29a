"""Child rows of a parent: ordered arrays, matching and merging.

At rest, children are flat rows keyed by (parent, child key), so a parent
with a third of all children is spread like any other data. Arrays are built
on demand by :func:`collect_ordered`, in parts of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermill.operators.dedup import keep_first
from rostermill.operators.match import lookup
from rostermill.schemas import FALLBACK_FIELDS, LINE_MATCH_KEYS, ORDINAL
from rostermill.skew import HOT_ROWS, by_shuffle, hot_keys, null_safe_equal
from rostermill.workdir import release

#: longest array put into one row
PART_ROWS = 10_000
#: slots that are added up in one group
SLOTS = 4_096
#: a parent with fewer children than this is ordered by one task
HEAVY_ROWS = HOT_ROWS

#: one frame of parent keys, or none
Heavy = tuple[DataFrame, ...]


def ordinal_slot(order: list[str], part_rows: int = PART_ROWS) -> list[Column]:
    """Slots that rise with ``order`` and hold at most ``part_rows`` rows each.

    The last column is the row number in a split. Row numbers are distinct
    integers, so ``part_rows`` consecutive ones cannot hold more rows.
    """
    return [*map(F.col, order[:-1]), F.floor(F.col(order[-1]) / part_rows).cast("bigint")]


def with_part(
    children: DataFrame,
    keys: list[str],
    order: list[str],
    slot: list[Column] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Add ``part``: the place of a child among its parent's, over ``part_rows``.

    Children are numbered within bounded slots, and slots start at the sum of
    the counts of those before them, so no task orders a whole parent. The
    counts, one row per (parent, slot), are added up in two levels: within
    stretches of at most ``SLOTS`` slots of one split, and over stretches. A
    parent's own window holds one row per stretch, that is per split or per
    ``SLOTS * part_rows`` rows of one. The last slot column is a whole number.
    """
    slots = ordinal_slot(order, part_rows) if slot is None else slot
    stretch = [*slots[:-1], F.floor(slots[-1] / SLOTS)]
    place = F.struct(
        F.struct(*keys).alias("parent"),
        F.struct(*[c.alias(f"s{i}") for i, c in enumerate(stretch)]).alias("stretch"),
        F.struct(*[c.alias(f"s{i}") for i, c in enumerate(slots)]).alias("slot"),
    )
    placed = children.withColumn("_place", place)
    counts = placed.groupBy("_place").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_long", F.struct("_place.parent", "_place.stretch"))

    def ahead(key: str, by: str) -> Column:
        before = Window.partitionBy(key).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(before), F.lit(0))

    long = counts.groupBy("_long").agg(F.sum("_n").alias("_n"))
    long = long.select("_long", ahead("_long.parent", "_long.stretch").alias("_base"))
    starts = (
        counts.withColumn("_inside", ahead("_long", "_place.slot"))
        .join(by_shuffle(long), "_long")
        .select("_place", (F.col("_base") + F.col("_inside")).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy("_place").orderBy(*order))
    return (
        placed.join(by_shuffle(starts), "_place")
        .withColumn("part", F.floor((F.col("_start") + within - 1) / part_rows).cast("bigint"))
        .drop("_place", "_start")
    )


def heavy_parents(children: DataFrame, keys: list[str]) -> Heavy:
    """The parents of at least ``HEAVY_ROWS`` children, counted at once.

    There is no frame when no parent has as many. Counts are combined before
    their shuffle, so a heavy parent costs one row per map task.
    """
    found = hot_keys(children, keys, HEAVY_ROWS)
    none = found.isEmpty()
    release(children.sparkSession)
    return () if none else (found,)


def number_parts(
    children: DataFrame,
    keys: list[str],
    order: list[str],
    slot: list[Column] | None = None,
    part_rows: int = PART_ROWS,
    heavy: Heavy | None = None,
) -> DataFrame:
    """:func:`with_part` for ``heavy`` parents (:func:`heavy_parents`, counted
    here unless given); children of all others are shuffled by parent once and
    numbered there, so a task orders less than ``HEAVY_ROWS`` of one parent.
    """
    if heavy is None:
        heavy = heavy_parents(children, keys)

    def by_parent(some: DataFrame) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return some.withColumn("part", F.floor((number - 1) / part_rows).cast("bigint"))

    if not heavy:
        return by_parent(children)
    # at most one key for every HEAVY_ROWS children
    names = [f"_heavy{i}" for i in range(len(keys))]
    found = F.broadcast(heavy[0].select(*[F.col(k).alias(n) for k, n in zip(keys, names)]))
    same = null_safe_equal([(children[k], found[n]) for k, n in zip(keys, names)])
    large = with_part(children.join(found, same, "left_semi"), keys, order, slot, part_rows)
    return by_parent(children.join(found, same, "left_anti")).unionByName(large)


def collect_ordered(
    children: DataFrame,
    keys: list[str],
    fields: list[str],
    order: list[str],
    alias: str,
    slot: list[Column] | None = None,
    part_rows: int = PART_ROWS,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Children of each parent as ordered arrays of at most ``part_rows`` structs.

    One row per (parent, ``part``); parts count from 0, all but a parent's
    last are full, and most parents have one. ``slot`` must rise with
    ``order`` and hold at most a bounded number of rows. Without ``heavy``
    parents the arrays are built where the children were numbered, so children
    are shuffled once and the result lies by ``keys``.
    """
    item = F.expr(
        f"named_struct('o', struct({', '.join(order)}), 'v', struct({', '.join(fields)}))"
    )
    needed = [*dict.fromkeys([*keys, *fields, *order])] if slot is None else children.columns
    return (
        number_parts(children.select(*needed), keys, order, slot, part_rows, heavy)
        .groupBy(*keys, "part")
        .agg(F.array_sort(F.collect_list(item)).alias("_items"))
        .select(*keys, "part", F.transform("_items", lambda i: i["v"]).alias(alias))
    )


def collect_distinct_ordered(
    children: DataFrame,
    keys: list[str],
    distinct: list[str],
    fields: list[str],
    order: list[str],
    alias: str,
    slot: list[Column] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """:func:`collect_ordered` of the first child of each distinct key.

    Heavy parents are those with many children of any kind: that is found
    without looking for the first ones.
    """
    heavy = heavy_parents(children, keys)
    first = keep_first(children, [*keys, *distinct], order)
    return collect_ordered(first, keys, fields, order, alias, slot, part_rows, heavy)


def match_child_rows(
    incoming: DataFrame, stored: DataFrame, parent: str, keys: list[str], fields: list[str]
) -> DataFrame:
    """Add struct ``_old`` with the stored child of the same (parent, keys)."""
    on = {k: k for k in [parent, *keys]}
    return lookup(incoming, stored, on, {f: f for f in fields}, "_old")


def coalesce_with_previous(df: DataFrame, fields: list[str], old: str = "_old") -> DataFrame:
    """Each field, or the previous row's value where it is null."""
    return df.withColumns({f: F.coalesce(F.col(f), F.col(f"{old}.{f}")) for f in fields})


def merge_lines(
    incoming: DataFrame,
    stored: DataFrame,
    single_file: bool = False,
    hot: Callable[[DataFrame, list[str]], DataFrame | None] = lambda rows, keys: None,
) -> DataFrame:
    """Incoming service lines, one per (claim, code, date), first row wins.

    Modifiers and diagnosis indexes missing in the input are taken from the
    stored line of the same claim, code and date. Keeping the first row per
    (claim, code, date) makes a prior pass over the longer 14-column key
    unnecessary: the first of the short key is the first of its long key.

    In an input of several files a later file replaces a claim's lines, as if
    the files were loaded one after another; ``single_file`` saves that step.
    """
    keys = ["CLAIM_ID", *LINE_MATCH_KEYS]
    if single_file:
        current = keep_first(incoming, keys).withColumn("_linked", F.lit(True))
    else:
        current = _lines_of_last_file(incoming, keys, hot)
    matched = match_child_rows(current, stored, "CLAIM_ID", LINE_MATCH_KEYS, FALLBACK_FIELDS)
    linked = matched.withColumn("_old", F.when(F.col("_linked"), F.col("_old")))
    return coalesce_with_previous(linked, FALLBACK_FIELDS).drop("_old", "_linked")


def _lines_of_last_file(incoming: DataFrame, keys: list[str], hot) -> DataFrame:
    """Lines of each claim's last file, missing codes filled from the files
    before it.

    A file without the line breaks the chain: it removed the line. ``_linked``
    tells whether the chain reaches back to the stored line. Files of a claim
    are numbered on one row per (claim, file).
    """
    by_claim = Window.partitionBy("CLAIM_ID")
    files = (
        incoming.select("CLAIM_ID", "_file")
        .distinct()
        .withColumn("r", F.row_number().over(by_claim.orderBy("_file")))
        .withColumn("n", F.count(F.lit(1)).over(by_claim))
    )
    first = keep_first(incoming, [*keys, "_file"])
    place = ["CLAIM_ID", "_file"]
    ranked = lookup(
        first, files, {c: c for c in place}, {"r": "r", "n": "n"}, "_f",
        hot=hot(first, place), spread=[*keys, *ORDINAL],
    )
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("_f.r"))
    whole = newest_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chained = ranked.withColumn("_rn", F.row_number().over(newest_first)).withColumn(
        "_in_chain", F.col("_f.n") - F.col("_f.r") == F.col("_rn") - 1
    )
    filled = {
        f: F.first(F.when(F.col("_in_chain"), F.col(f)), ignorenulls=True).over(whole)
        for f in FALLBACK_FIELDS
    }
    depth = F.sum(F.col("_in_chain").cast("int")).over(whole)
    return (
        chained.withColumns({**filled, "_linked": depth == F.col("_f.n")})
        .where("_rn = 1 AND _in_chain")
        .drop("_f", "_rn", "_in_chain")
    )
