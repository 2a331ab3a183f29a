"""Versioned tables in a shared folder.

A run writes only the rows it changed, as parquet under ``snapshot=<run>``,
and becomes visible through one commit record. Readers take, for each key,
the rows of its newest committed snapshot. The large base is not rewritten
by a small run, and a run that dies leaves nothing visible.

Within a snapshot rows are dealt over folders by a hash of the key that
lookups know (``BUCKET_KEY``). A run that names the keys it wants reads only
their folders: a join with the few bucket numbers prunes the scan when it
starts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermill.schemas import STORED, stored_schema
from rostermill.skew import by_shuffle
from rostermill.workdir import release

#: column whose rows are replaced together by a later run; None: append only
REPLACE_KEY: dict[str, str | None] = {
    "enrollee": "_id",
    "subscriber": "_id",
    "patient": "_id",
    "eligibility": "_id",
    "claim": "_id",
    "claim_diagnosis": None,
    "claim_line": "CLAIM_ID",
    "product": "_id",
    "registry": "_id",
}

#: column whose hash decides the folder of a row; all versions of a row have the
#: same value there
BUCKET_KEY = {
    "enrollee": "referenceId",
    "subscriber": "subscriberNumber",
    "patient": "enrollee.referenceId",
    "eligibility": "enrollee.referenceId",
    "claim": "CLAIM_ID",
    "claim_diagnosis": "CLAIM_ID",
    "claim_line": "CLAIM_ID",
    "product": "product.referenceId",
    "registry": "originalName",
}

#: keys of later snapshots that are broadcast at most
FEW_KEYS = 100_000
#: of written tables; digests and other long texts take half of what snappy leaves
COMPRESSION = "zstd"

_COMMIT = "run bigint, tables array<string>, is_base boolean, tag string, buckets int"


def _or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None when its folder was never written."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def bucket_of(key: str, buckets: int) -> Column:
    """Folder number of a row by its key; null is a key like any other."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class TableStore:
    """Stored tables below ``root``; one writer at a time.

    ``buckets`` is the number of folders of a snapshot, for a new store; one
    that has commits keeps the number it was begun with.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self._written: dict[int, set[str]] = {}
        commits = self._commits()
        self.buckets = commits[0].buckets if commits else buckets

    # -- commits ----------------------------------------------------------

    def _commits(self) -> list[T.Row]:
        log = self.spark.read.schema(_COMMIT).option("recursiveFileLookup", True)
        rows = _or_none(lambda: log.json(f"{self.root}/commits"))
        return [] if rows is None else sorted(rows.collect(), key=lambda r: r.run)

    def next_run(self) -> int:
        """Number for the next run. A run that died has not used its own up."""
        commits = self._commits()
        return commits[-1].run + 1 if commits else 0

    def has_tag(self, tag: str) -> bool:
        """Whether a committed run carries the tag (a stream's batch)."""
        return any(c.tag == tag for c in self._commits())

    def commit(self, run: int, tag: str | None = None, is_base: bool = False) -> None:
        """Make the tables written by ``run`` visible, all at once.

        The record names them, so files left by a run that died under the
        same number never count.
        """
        tables = sorted(self._written.pop(run, set()))
        record = self.spark.createDataFrame([(run, tables, is_base, tag, self.buckets)], _COMMIT)
        record.coalesce(1).write.mode("overwrite").json(f"{self.root}/commits/run_{run}")

    # -- tables -----------------------------------------------------------

    def write(self, table: str, run: int, rows: DataFrame) -> None:
        """Write a run's rows of a table; invisible until :meth:`commit`.

        The rows of a folder meet before they are written, so a run writes
        few files; a folder with much data is split over several tasks.
        """
        placed = rows.withColumn("bucket", bucket_of(BUCKET_KEY[table], self.buckets))
        whole = placed.hint("rebalance", "bucket").write.partitionBy("bucket").mode("overwrite")
        whole.parquet(f"{self.root}/{table}/snapshot={run}", compression=COMPRESSION)
        release(self.spark)
        self._written.setdefault(run, set()).add(table)

    def _visible(self, table: str, pending: int | None) -> list[int]:
        """Snapshots that make up the table: its last base and what follows."""
        commits = [c for c in self._commits() if table in c.tables]
        start = max((c.run for c in commits if c.is_base), default=-1)
        runs = [c.run for c in commits if c.run >= start]
        if pending is not None and table in self._written.get(pending, set()):
            runs.append(pending)
        return runs

    def _snapshots(self, table: str, schema: T.StructType) -> DataFrame:
        places = [T.StructField("snapshot", T.LongType()), T.StructField("bucket", T.IntegerType())]
        typed = T.StructType([*schema.fields, *places])
        found = _or_none(lambda: self.spark.read.schema(typed).parquet(f"{self.root}/{table}"))
        return self.spark.createDataFrame([], typed) if found is None else found

    def read(
        self, table: str, pending: int | None = None, keys: DataFrame | None = None
    ) -> DataFrame:
        """Current rows; with ``pending`` also those of that open run.

        ``keys`` (one column, values of the table's bucket key) leaves out
        folders that hold none of them. Rows with other keys may remain.
        """
        schema = stored_schema(table)
        visible = self._visible(table, pending)
        rows = self._snapshots(table, schema)
        if not visible:
            return rows.where(F.lit(False)).drop("snapshot", "bucket")
        rows = rows.where(F.col("snapshot").isin(visible))
        if keys is not None:
            # At most `buckets` numbers. That they are not negative is always
            # true; a join is used for pruning only if its side is filtered.
            near = keys.select(bucket_of(keys.columns[0], self.buckets).alias("bucket"))
            near = near.where("bucket >= 0").distinct()
            rows = rows.join(F.broadcast(near), "bucket", "left_semi")
        key = REPLACE_KEY[table]
        if key is None or len(visible) == 1:
            return rows.select(*schema.fieldNames())
        later = rows.where(F.col("snapshot") != min(visible))
        newest = later.groupBy(F.col(key).alias("_key")).agg(F.max("snapshot").alias("_newest"))
        # Counted (from the files' metadata where no key is named), not judged by file size.
        few = later.limit(FEW_KEYS + 1).count() <= FEW_KEYS
        newest = F.broadcast(newest) if few else by_shuffle(newest)
        latest = rows.join(newest, rows[key].eqNullSafe(newest["_key"]), "left").where(
            F.col("_newest").isNull() | (F.col("snapshot") == F.col("_newest"))
        )
        return latest.select(*schema.fieldNames())

    def compact(self, tables: list[str] | None = None) -> None:
        """Write the current rows as the new base, so reads stay cheap."""
        run = self.next_run()
        for table in tables or list(STORED):
            self.write(table, run, self.read(table))
        self.commit(run, is_base=True)

    # -- raw input and history -------------------------------------------

    def stage(self, name: str, run: int, rows: DataFrame) -> DataFrame:
        """Write parsed input once and read it back.

        Row numbers are fixed by this, later steps read only the columns
        they need, and a lost executor costs a re-read, not a re-parse.
        """
        path = f"{self.root}/staged/{name}/run={run}"
        rows.write.mode("overwrite").parquet(path, compression=COMPRESSION)
        release(self.spark)
        return self.spark.read.schema(rows.schema).parquet(path)

    def append(self, name: str, run: int, rows: DataFrame) -> None:
        """Add a run's rows to an append-only table (dumps, rejects, history)."""
        path = f"{self.root}/{name}/run={run}"
        rows.write.mode("overwrite").parquet(path, compression=COMPRESSION)

    def read_appended(self, name: str, schema: str) -> DataFrame:
        """An append-only table with its ``run``; empty if never written.

        Rows of a run count once it is committed.
        """
        typed = f"{schema}, run bigint"
        found = _or_none(lambda: self.spark.read.schema(typed).parquet(f"{self.root}/{name}"))
        if found is None:
            return self.spark.createDataFrame([], typed)
        return found.where(F.col("run").isin([c.run for c in self._commits()]))

