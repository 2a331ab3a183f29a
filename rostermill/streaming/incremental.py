"""Incremental ingest: each file is taken once, each batch is one run.

The stream's checkpoint remembers which files were taken. A committed run
carries the batch it came from, so a batch that is replayed after a failure
is loaded exactly once: skipped when committed, written again when not.
``files_per_batch=1`` loads file after file. State goes from batch to batch
through the store; a batch reads only the folders of its own keys.

A checkpoint never gives a file twice, not even one that was mended after its
load failed. Such files are the retry set (``Ingest.failed_files``): each start
of a stream first loads those that are still there.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rostermill.functions.scalars import file_name
from rostermill.plans.jobs import Ingest
from rostermill.schemas import CLAIM_COLUMNS, CLAIM_REQUIRED
from rostermill.sources.files import decoded_path, number_rows
from rostermill.sources.fixed_width import (
    FILES_PER_GROUP,
    file_layouts,
    layout_problems,
    parse_lines,
)


def _source(spark: SparkSession, kind: str, extension: str, files_per_batch: int):
    if files_per_batch > FILES_PER_GROUP:
        raise ValueError(f"a batch holds at most {FILES_PER_GROUP} files")
    return (
        spark.readStream.format(kind)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{extension}")
        .option("maxFilesPerTrigger", files_per_batch)
    )


class Parsed(NamedTuple):
    """Claim rows of a batch, and files that cannot be read (_file, _problem)."""

    rows: DataFrame
    problems: DataFrame | None = None


def _not_lock_file(path: str):
    return ~F.col(path).rlike(r"/~\$[^/]*$")


def stream_claim_rows(
    ingest: Ingest,
    source: DataFrame,
    parse: Callable[[DataFrame, int], Parsed],
    checkpoint: str,
    module: str = "claim_rpt",
    file_type: str = "rpt",
) -> StreamingQuery:
    """Load a stream of files as claim rows; ends when all present are taken.

    ``parse`` turns a batch (the source's columns plus position) and its run
    number into claim rows. Row numbers are added inside the batch (they cannot
    be on a stream) and fixed by writing the batch before it is parsed.
    """
    placed = source.select(
        "*",
        decoded_path("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_size").alias("_size"),
    ).where(_not_lock_file("_file"))

    def take(batch: DataFrame, number: int) -> None:
        tag = f"{checkpoint}#{number}"
        if ingest.store.has_tag(tag) or batch.isEmpty():
            return
        run = ingest.store.next_run()
        numbered = ingest.store.stage("lines", run, number_rows(batch))
        files = ingest.new_files(
            numbered.groupBy(F.col("_file").alias("path"))
            .agg(F.max("_size").alias("length"))
            .withColumn("name", file_name("path"))
        )
        fresh = numbered.join(files.select(F.col("path").alias("_file")), "_file", "left_semi")
        rows, problems = parse(fresh, run)
        ingest.claim_rows_into(
            run, rows, files, module, file_type, dump=False, backup=False,
            problems=problems, tag=tag,
        )

    return (
        placed.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_claim_reports(
    ingest: Ingest, folder: str, checkpoint: str, files_per_batch: int = 1_000
) -> StreamingQuery:
    """Start taking ``.rpt`` files; ends when all present ones are loaded.

    Files whose last load failed are loaded again first.
    """

    def parse(batch: DataFrame, run: int) -> Parsed:
        layouts = ingest.store.stage("layouts", run, file_layouts(batch, CLAIM_COLUMNS))
        rows = parse_lines(batch, CLAIM_COLUMNS, CLAIM_REQUIRED, layouts, few=True)
        return Parsed(rows, layout_problems(layouts, CLAIM_REQUIRED))

    ingest.claim_reports(folder, only=ingest.failed_files("claim_rpt"))
    lines = _source(ingest.spark, "text", "rpt", files_per_batch).load(folder)
    return stream_claim_rows(ingest, lines, parse, checkpoint)


def stream_eligibility_workbooks(
    ingest: Ingest, folder: str, checkpoint: str, files_per_batch: int = 100
) -> StreamingQuery:
    """Start taking eligibility workbooks; retries and ends like the report stream."""
    ingest.eligibility_workbooks(folder, only=ingest.failed_files("eligibility"))
    books = (
        _source(ingest.spark, "binaryFile", "xlsx", files_per_batch)
        .load(folder)
        .where(_not_lock_file("path"))
    )

    def take(batch: DataFrame, number: int) -> None:
        tag = f"{checkpoint}#{number}"
        if ingest.store.has_tag(tag) or batch.isEmpty():
            return
        files = ingest.new_files(
            batch.select("path", "length").withColumn("name", file_name("path"))
        )
        fresh = batch.select("path", "content").join(files.select("path"), "path", "left_semi")
        ingest.eligibility_books_into(ingest.store.next_run(), fresh, files, tag)

    return (
        books.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
