"""File registry: registering, lineage, status history, raw dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostermill.functions.scalars import (
    archive_key,
    epoch_millis,
    file_name,
    file_suffix,
    stored_name,
    surrogate_key,
)
from rostermill.operators.clean import filter_not_equal
from rostermill.operators.match import without_match
from rostermill.schemas import LINEAGE_TYPE

SOURCE = "aws_s3"  # fixed value of the stored lineage record


def skip_registered_files(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files whose name is not registered with a status other than Failed."""
    taken = filter_not_equal(registry, "status", "Failed")
    return without_match(files, taken, {"name": "originalName"})


def register_files(
    files: DataFrame,
    module: str,
    environment: str,
    received_at: Column,
    backup: bool = True,
) -> DataFrame:
    """Registry rows (status New) for listed files (path, name, length)."""
    stored = stored_name(epoch_millis(received_at), "name")
    target = archive_key(module, stored, environment) if backup else F.lit(None)
    return files.select(
        "path",
        surrogate_key(F.col("path"), received_at.cast("string")).alias("_id"),
        F.col("name").alias("originalName"),
        F.lit("New").alias("status"),
        received_at.cast("timestamp_ntz").alias("receivedAt"),
        stored.alias("fileName"),
        F.struct(
            target.cast("string").alias("destination"),
            (F.lit(SOURCE) if backup else F.lit(None).cast("string")).alias("source"),
            F.col("length").cast("bigint").alias("size"),
        ).alias("metadata"),
        F.lit(None).cast("string").alias("reason"),
    )


def lineage_struct(registered: DataFrame, file_type: str) -> DataFrame:
    """(path, lineage) of registered files, as stored on every document."""
    record = F.struct(
        F.col("_id").alias("documentId"),
        F.col("originalName"),
        file_suffix("originalName").alias("fileExtension"),
        F.lit(file_type).alias("fileType"),
        F.col("fileName"),
        F.col("metadata.destination").alias("filePath"),
        F.lit(False).alias("isReconciled"),
        F.col("receivedAt").alias("updatedAt"),
        F.struct(F.col("metadata.size").alias("size"), F.lit(SOURCE).alias("source")).alias(
            "metadata"
        ),
    )
    return registered.select("path", record.cast(LINEAGE_TYPE).alias("lineage"))


def with_lineage(rows: DataFrame, lineage: DataFrame) -> DataFrame:
    """Add the lineage record of each row's file.

    Called on deduplicated rows, never on the raw input. Files are few next
    to rows; whether this is a broadcast is left to the size the engine sees.
    """
    return rows.join(lineage, rows["_file"] == lineage["path"], "left").drop("path")


def raw_dump(rows: DataFrame, received_at: Column, more: str = "_more") -> DataFrame:
    """Whole input rows plus the two lineage columns, ready to be appended.

    Columns that the layout does not declare come in ``more`` (a map of texts)
    and are kept as one VARIANT, ``undeclared``; it is null where a row has
    none. The name and time of a file follow from its path and the time the
    run received it, so raw rows are not joined with the registry.
    """
    declared = [c for c in rows.columns if c != more]
    undeclared = F.lit(None).cast("variant")
    if more in rows.columns:
        undeclared = F.when(F.size(more) > 0, F.to_variant_object(more))
    return rows.select(
        *declared,
        undeclared.alias("undeclared"),
        stored_name(epoch_millis(received_at), file_name("_file")).alias("ardbSourceDocument"),
        received_at.cast("timestamp_ntz").alias("ardbLastModifiedDate"),
    )


def status_events(files: DataFrame, status: str | Column, at: Column, reason: Column) -> DataFrame:
    """History rows (document, status, at, reason) to append."""
    state = F.lit(status) if isinstance(status, str) else status
    return files.select(
        F.col("_id").alias("document"),
        state.alias("status"),
        at.cast("timestamp_ntz").alias("at"),
        reason.cast("string").alias("reason"),
    )


def latest_status(history: DataFrame, key: str = "document", at: str = "at") -> DataFrame:
    """Current status and reason per document.

    ``max_by`` is combined before the shuffle, so a document with a long
    history costs one row per map task.
    """
    newest = F.max_by(F.struct("status", "reason"), F.col(at))
    return history.groupBy(key).agg(newest.alias("_s")).select(
        key, F.col("_s.status").alias("status"), F.col("_s.reason").alias("reason")
    )


def outcomes(files: DataFrame, rejects: DataFrame, at: Column) -> DataFrame:
    """Completed or Failed (with the first reason) for each file of a run."""
    why = rejects.groupBy(F.col("file").alias("_f")).agg(F.min("reason").alias("_why"))
    joined = files.join(why, files["path"] == why["_f"], "left")
    status = F.when(F.col("_f").isNull(), F.lit("Completed")).otherwise(F.lit("Failed"))
    return status_events(joined, status, at, F.col("_why"))
