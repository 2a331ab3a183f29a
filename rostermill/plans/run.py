"""Where a plan's intermediate tables go.

The plans only compose DataFrames. A *run* tells them how to read stored
tables, keep changes and cut lineage: in memory of the plan (:class:`LazyRun`)
or in a :class:`~rostermill.storage.TableStore` (:class:`StoreRun`).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rostermill.operators.classify import INSERT, NO_ACTION, UPDATE, action_counts
from rostermill.operators.upsert import upsert_replace
from rostermill.skew import heavy_key_sets, hot_keys, split_sets
from rostermill.storage import COMPRESSION, REPLACE_KEY, TableStore
from rostermill.workdir import release


ACTIONS = (INSERT, UPDATE, NO_ACTION)
#: rows with a reject reason, whatever their action
REJECTED = "rejected"


@dataclass
class Result:
    """Changed rows and current view per table, rejected rows, classified rows."""

    changes: dict[str, DataFrame] = field(default_factory=dict)
    current: dict[str, DataFrame] = field(default_factory=dict)
    classified: dict[str, DataFrame] = field(default_factory=dict)
    rejects: DataFrame | None = None
    #: what was counted while a step's rows were written: action → rows
    counted: dict[str, dict[str, int]] = field(default_factory=dict)

    def counts(self) -> DataFrame:
        """(step, action, n_rows) of the classified rows. Rows that were
        counted while they were written are not read again."""
        if self.classified and self.counted.keys() >= self.classified.keys():
            rows = [(s, a, n) for s, found in self.counted.items() for a, n in found.items() if n and a != REJECTED]
            spark = next(iter(self.classified.values())).sparkSession
            return spark.createDataFrame(rows, "step string, action string, n_rows bigint")
        parts = [
            action_counts(rows).select(F.lit(step).alias("step"), "action", "n_rows")
            for step, rows in self.classified.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    def add_rejects(self, rows: DataFrame) -> None:
        self.rejects = rows if self.rejects is None else self.rejects.unionByName(rows)


class LazyRun:
    """Everything stays one lazy plan; nothing is written."""

    def __init__(self, tables: dict[str, DataFrame], number: int = 1, guard_skew: bool = False):
        self.tables = tables
        self.number = number
        self.guard_skew = guard_skew

    def state(self, table: str, keys: DataFrame | None = None) -> DataFrame:
        """The stored rows, with what this run has saved so far.

        ``keys`` (one column, see :data:`~rostermill.storage.BUCKET_KEY`) says
        which are wanted; a run may leave out others.
        """
        return self.tables[table]

    def save(self, table: str, changes: DataFrame) -> DataFrame:
        key = REPLACE_KEY[table]
        old = self.tables[table]
        rows = changes.select(*old.columns)
        now = old.unionByName(rows) if key is None else upsert_replace(old, rows, key)
        self.tables = {**self.tables, table: now}
        return now

    def cut(self, name: str, rows: DataFrame) -> DataFrame:
        return rows

    def cut_counted(self, name: str, rows: DataFrame) -> tuple[DataFrame, dict[str, int] | None]:
        """:meth:`cut` of classified rows; how many have each action, and how
        many a reject reason, if the rows are written by it."""
        return self.cut(name, rows), None

    def hot(self, rows: DataFrame, keys: list[str]) -> DataFrame | None:
        """Heavy lookup keys of ``rows``, when skew is to be looked for."""
        return hot_keys(rows, keys) if self.guard_skew else None

    def hot_sets(
        self, rows: DataFrame, sets: list[list[str]]
    ) -> dict[tuple[str, ...], DataFrame | None]:
        """Heavy keys of several key sets, from one pass over ``rows``."""
        if not self.guard_skew:
            return {tuple(keys): None for keys in sets}
        return split_sets(self.cut("hot_keys", heavy_key_sets(rows, sets)), sets)


class StoreRun(LazyRun):
    """Changes are written as one snapshot of the store and read back."""

    def __init__(self, store: TableStore, number: int, guard_skew: bool = True):
        super().__init__({}, number, guard_skew)
        self.store = store

    def state(self, table: str, keys: DataFrame | None = None) -> DataFrame:
        return self.store.read(table, pending=self.number, keys=keys)

    def save(self, table: str, changes: DataFrame) -> DataFrame:
        self.store.write(table, self.number, changes)
        return self.store.read(table, pending=self.number)

    def cut(self, name: str, rows: DataFrame) -> DataFrame:
        return self.store.stage(name, self.number, rows)

    def cut_counted(self, name: str, rows: DataFrame) -> tuple[DataFrame, dict[str, int] | None]:
        return observed_cut(self, name, rows)


def observed_cut(run: LazyRun, name: str, rows: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Write rows and count them in the tasks that write them."""
    seen = Observation(f"{name}-{run.number}")
    counts = {a: F.count_if(F.col("action") == a) for a in ACTIONS}
    counts[REJECTED] = F.count("_reason")
    kept = run.cut(name, rows.observe(seen, *[c.alias(a) for a, c in counts.items()]))
    return kept, {action: seen.get[action] for action in counts}


def changed(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("action").isin("insert", "update"))


class FolderRun(LazyRun):
    """Stored tables are given frames; what a plan makes goes to a folder.

    Every step is written as parquet below ``folder`` (on a cluster, the
    shared folder) and read back, so a later step starts from files instead
    of the whole plan before it, and survives lost executors.
    """

    def __init__(
        self, tables: dict[str, DataFrame], folder: str, number: int = 1, guard_skew: bool = True
    ):
        super().__init__(tables, number, guard_skew)
        self.folder = folder.rstrip("/")

    def cut(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        rows.write.mode("overwrite").parquet(path, compression=COMPRESSION)
        release(rows.sparkSession)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def cut_counted(self, name: str, rows: DataFrame) -> tuple[DataFrame, dict[str, int] | None]:
        return observed_cut(self, name, rows)

    def save(self, table: str, changes: DataFrame) -> DataFrame:
        return super().save(table, self.cut(f"{table}_changes", changes))
