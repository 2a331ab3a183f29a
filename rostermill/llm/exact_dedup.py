"""Exact duplicates by a tree of merged digest runs, in DataFrame operations.

Every input partition is a leaf. Its run holds one row per digest: the
candidate to stay and how many rows it stands for. Rounds then merge runs
``FAN_IN`` at a time: in round k the partitions whose numbers agree above bit
6k hand their runs to one node, which keeps the best candidate per digest.
After the last round one row per digest is left. The result goes back down
the tree: first to each leaf's run, then from the run to the leaf's rows. A
text that makes up a third of all rows is therefore one row per partition in
every shuffle, and its rows come back spread over all partitions.

Two texts are equal when SHA-256, a second 64-bit hash and the byte length
agree. All three are part of the merge key at every level, so a candidate
only ever replaces another one whose text is verified as the same.

Edge cases: null text counts as empty; rows with a null key are ranked below
all others; of rows that agree in key and text the last one read stays; an
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostermill.workdir import staged

#: runs merged at a node, as a power of two
FAN_IN_BITS = 6

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGEST = ["sha", "check", "size"]


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else.

    ``lower`` does the same where all characters are ASCII, and is faster.
    """
    only_ascii = F.octet_length(text) == F.length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def leaf_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, place, leaf and digest; texts stay behind."""
    place = F.monotonically_increasing_id()
    normal = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(key).alias("doc_id"), place.alias("place"), normal.alias("normal")).select(
        "doc_id",
        "place",
        F.shiftright("place", 33).alias("leaf"),
        F.unhex(F.sha2("normal", 256)).alias("sha"),
        F.xxhash64("normal").alias("check"),
        F.octet_length("normal").alias("size"),
    )


def _merged(runs: DataFrame, node: Column) -> DataFrame:
    return runs.groupBy(*_DIGEST, node.alias("node")).agg(
        F.max("best").alias("best"), F.sum("rows").alias("rows")
    )


def mark(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "largest") -> DataFrame:
    """Which row of each group of equal texts stays.

    Returns one row per input row: doc_id, place (of the row in the scan),
    keep_id, group_size, kept, text_sha256. ``keep`` is 'largest' or
    'smallest' key.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is {keep!r}")
    rows = staged(leaf_rows(docs, text, key), "digests")
    order = F.col("doc_id") if keep == "largest" else -F.col("doc_id")
    single = rows.select(
        *_DIGEST, "leaf", F.struct(order.alias("order"), "place", "doc_id").alias("best"), F.lit(1).cast("long").alias("rows")
    )
    leaves = rows.agg(F.max("leaf")).first()[0] or 0
    run = _merged(single, F.col("leaf"))
    top, height = run, 0
    while leaves >> height:
        height += FAN_IN_BITS
        top = _merged(top, F.shiftright("node", FAN_IN_BITS))
    winners = top.select(*_DIGEST, F.col("best").alias("winner"), F.col("rows").alias("group_size"))
    down = run.select(*_DIGEST, F.col("node").alias("leaf")).join(winners, _DIGEST)
    return rows.join(down, [*_DIGEST, "leaf"]).select(
        "doc_id",
        "place",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("place") == F.col("winner.place")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_rows(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    ``docs`` must be read from files, so that both scans see the same places.
    """
    place = "__place"
    stay = mark(docs, text, key, keep).where("kept").select(F.col("place").alias(place))
    return docs.withColumn(place, F.monotonically_increasing_id()).join(stay, place, "left_semi").drop(place)
