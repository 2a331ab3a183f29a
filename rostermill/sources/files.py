"""Listing input files and adding scan positions."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.functions.scalars import ColumnOrName, col, file_name


def list_input_files(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """Files below ``folder`` with the extension, Office lock files left out.

    The content column is never selected, so no file is opened.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{extension}")
        .load(folder)
        .select("path", file_name("path").alias("name"), "length", "modificationTime")
        .where(~F.col("name").startswith("~$"))
    )


def decoded_path(path: ColumnOrName) -> Column:
    """A scan's file path as the listing writes it: URI escapes undone."""
    return F.url_decode(F.replace(col(path), F.lit("+"), F.lit("%2B")))


def literal_paths(paths: list[str]) -> list[str]:
    """Paths for a reader, with the characters of glob patterns escaped."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def listed_paths(files: DataFrame) -> list[str]:
    """Names of the given files. The driver plans every scan from such a
    list; reading only these spares files that are loaded already."""
    return sorted(r.path for r in files.select("path").collect())


def number_rows(lines: DataFrame) -> DataFrame:
    """Add ``_line``; with ``_file`` and ``_block`` it orders the rows.

    Within a split the ids rise in file order. They are kept by writing the
    rows before anything is shuffled by them.
    """
    return lines.withColumn("_line", F.monotonically_increasing_id())


def scan_new_lines(
    spark: SparkSession, folder: str, extension: str, files: DataFrame, since: datetime
) -> DataFrame:
    """:func:`scan_lines` of those files below ``folder`` that are in ``files``.

    ``files`` (path) are all of a modification time from ``since`` on. Older
    ones are pruned by their metadata before any task starts; the few others
    that are not wanted drop out in a join. The driver holds no list of paths.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{extension}")
        .text(folder)
        .where(F.col("_metadata.file_modification_time") >= F.lit(since))
        .select(
            "value",
            decoded_path("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
    )
    wanted = files.select(F.col("path").alias("_file"))
    return number_rows(lines.join(wanted, "_file", "left_semi"))


def scan_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text lines (column ``value``) of the files with their position."""
    return number_rows(
        spark.read.text(literal_paths(paths)).select(
            "value",
            decoded_path("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
    )
