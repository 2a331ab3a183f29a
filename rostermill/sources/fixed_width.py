"""Fixed-width reports: line 0 names, line 1 dash runs, then rows.

A column starts at each dash run and reaches to the start of the next one;
the last reaches to the end of the longer of the two lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostermill.operators.clean import normalize_nulls
from rostermill.schemas import ORDINAL
from rostermill.skew import hot_keys, salted_left_join
from rostermill.sources.files import (
    list_input_files,
    listed_paths,
    literal_paths,
    scan_lines,
)
from rostermill.workdir import staged

#: layouts (about 5 kB each) that are broadcast at most
FILES_PER_GROUP = 5_000


def _heads(lines: DataFrame) -> DataFrame:
    """(_file, _header, _dashes, _last_head): the first two lines of each file.

    ``_last_head`` is the row number of the second one, so heads are told from
    rows by their place; ``lines`` must number its rows the same each time it
    is read (see :func:`read_reports`). Only lines of a file's first split take part, and the group limit lets
    two of them per task into the shuffle.
    """
    order = Window.partitionBy("_file").orderBy("_line")
    first_two = (
        lines.where(F.col("_block") == 0)
        .withColumn("_rn", F.row_number().over(order))
        .where("_rn <= 2")
    )
    return first_two.groupBy("_file").agg(
        F.max(F.when(F.col("_rn") == 1, F.rtrim("value"))).alias("_header"),
        F.max(F.when(F.col("_rn") == 2, F.rtrim("value"))).alias("_dashes"),
        F.max("_line").alias("_last_head"),
    )


def _layout(header: Column, dashes: Column) -> Column:
    """Array of (name, start, length) from the two head lines."""
    width = F.greatest(F.length(header), F.length(dashes))
    places = F.sequence(F.lit(1), F.greatest(width, F.lit(1)))
    starts = F.filter(
        places,
        lambda i: (F.substring(dashes, i, F.lit(1)) == "-")
        & ((i == 1) | (F.substring(dashes, i - 1, F.lit(1)) != "-")),
    )
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(width + 1))
    return F.transform(
        F.arrays_zip(starts.alias("s"), ends.alias("e")),
        lambda c: F.struct(
            F.trim(F.substring(header, c["s"], c["e"] - c["s"])).alias("name"),
            c["s"].alias("start"),
            (c["e"] - c["s"]).alias("length"),
        ),
    )


def fwf_layout(lines: DataFrame) -> DataFrame:
    """One row per (file, column): name, position, start (from 1), length."""
    heads = _heads(lines)
    return heads.select(
        "_file", F.posexplode(_layout(F.col("_header"), F.col("_dashes"))).alias("position", "c")
    ).select("_file", "position", "c.name", "c.start", "c.length")


def file_layouts(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Per file the head lines and a struct column → (start, length).

    The positions are worked out once per file, so a row needs one
    ``substring`` per wanted column and nothing else.
    """
    known = _heads(lines).withColumn("_layout", _layout(F.col("_header"), F.col("_dashes")))
    names = F.transform("_layout", lambda c: c["name"])
    places = ", ".join(
        f"'{c}', try_element_at(_layout, CAST(nullif(array_position(_names, '{c}'), 0) AS INT))"
        for c in columns
    )
    return known.withColumn("_names", names).selectExpr(
        "_file", "_header", "_dashes", "_last_head", f"named_struct({places}) AS _at"
    )


def _is_row() -> Column:
    head = (F.col("_block") == 0) & (F.col("_line") <= F.col("_last_head"))
    return (F.rtrim("value") != "") & ~head


def _cell(start: str | int, length: str | int) -> str:
    return f"nullif(trim(substring(value, {start}, {length})), '')"


def layout_problems(layouts: DataFrame, required: list[str]) -> DataFrame:
    """(_file, _problem) of files whose header lacks a required column."""
    absent = F.expr(
        "filter(array("
        + ", ".join(f"IF(_at.`{c}` IS NULL, '{c}', NULL)" for c in required)
        + "), x -> x IS NOT NULL)"
    )
    text = F.concat(F.lit("missing columns: "), F.concat_ws(", ", absent))
    return layouts.where(F.size(absent) > 0).select("_file", text.alias("_problem"))


def parse_lines(
    lines: DataFrame,
    columns: list[str],
    required: list[str] | None = None,
    layouts: DataFrame | None = None,
    few: bool = False,
) -> DataFrame:
    """Rows of fixed-width lines as null-cleaned strings plus position.

    Files may differ in layout. ``few`` says that the caller has checked that
    there are at most :data:`FILES_PER_GROUP` of them: their layouts are then
    broadcast; else rows meet them by file, those of a large file in many
    tasks. A column that a file lacks is null; a file that lacks a
    ``required`` one gives no rows (see :func:`layout_problems`).
    """
    known = file_layouts(lines, columns) if layouts is None else layouts
    for c in required or []:
        known = known.where(f"_at.`{c}` IS NOT NULL")
    if few:
        rows = lines.join(F.broadcast(known), "_file")
    else:
        known = known.withColumnRenamed("_file", "_f").where("_f IS NOT NULL")
        large = hot_keys(lines, ["_file"])
        rows = salted_left_join(lines, known, [("_file", "_f")], large, how="inner", spread=["_block", "_line"])
    rows = rows.where(_is_row())
    cells = [_cell(f"_at.`{c}`.start", f"_at.`{c}`.length") + f" AS `{c}`" for c in columns]
    return normalize_nulls(rows.selectExpr(*cells, *ORDINAL), columns)


def shared_heads(lines: DataFrame, header: str, dashes: str) -> DataFrame:
    """(_file, _last_head, _same): whether a file has the given head lines.

    One row per file. Write it before :func:`parse_shared_layout`, so that its
    size is known and decides how it is joined.
    """
    same = F.col("_header").eqNullSafe(F.lit(header.rstrip())) & F.col("_dashes").eqNullSafe(F.lit(dashes.rstrip()))
    return _heads(lines).select("_file", "_last_head", same.alias("_same"))


def shared_layout_problems(heads: DataFrame) -> DataFrame:
    """(_file, _problem) of files with other head lines."""
    return heads.where(~F.col("_same")).select("_file", F.lit("other layout").alias("_problem"))


def parse_shared_layout(
    lines: DataFrame,
    columns: list[str],
    header: str,
    dashes: str,
    skip_others: bool = False,
    heads: DataFrame | None = None,
) -> DataFrame:
    """Rows of files that all have the given two head lines.

    Positions are literals. A file with other head lines stops the job, or
    gives no rows with ``skip_others`` (see :func:`shared_layout_problems`).
    ``heads`` are the written :func:`shared_heads`.
    """
    header, dashes = header.rstrip(), dashes.rstrip()
    width = max(len(header), len(dashes))
    starts = [
        i for i, ch in enumerate(dashes) if ch == "-" and (i == 0 or dashes[i - 1] != "-")
    ]
    ends = starts[1:] + [width]
    at: dict[str, tuple[int, int]] = {}
    for start, end in zip(starts, ends):
        at.setdefault(header[start:end].strip(), (start + 1, end - start))
    rows = lines.join(shared_heads(lines, header, dashes) if heads is None else heads, "_file")
    other = F.raise_error(F.concat(F.lit("other layout: "), "_file")).cast("boolean")
    rows = rows.where(F.when(F.col("_same"), _is_row()).otherwise(F.lit(False) if skip_others else other))
    cells = [
        f"{_cell(*at[c]) if c in at else 'CAST(NULL AS STRING)'} AS `{c}`" for c in columns
    ]
    return normalize_nulls(rows.selectExpr(*cells, *ORDINAL), columns)


def read_reports(
    lines: DataFrame,
    files: int,
    columns: list[str],
    required: list[str] | None = None,
    layouts: DataFrame | None = None,
) -> DataFrame:
    """Rows of reports whose numbered lines are given.

    ``lines`` is a written table: row numbers tell the head lines, so they
    must not change between the pass that finds the layouts and the one that
    reads rows, and the first of these then reads little more than the start
    of each file. The layouts of up to :data:`FILES_PER_GROUP` files are
    broadcast.
    """
    return parse_lines(lines, columns, required, layouts, few=files <= FILES_PER_GROUP)


def first_heads(spark: SparkSession, files: list[str]) -> list[str]:
    """The two head lines of the first file."""
    return [r.value for r in spark.read.text(literal_paths(files[:1])).head(2)]


def read_fixed_width(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    shared_layout: bool = False,
    required: list[str] | None = None,
) -> DataFrame:
    """Rows of every report below a folder; a required column may not be absent."""
    files = listed_paths(list_input_files(spark, folder, "rpt"))
    if not files:
        raise FileNotFoundError(f"no .rpt file below {folder}")
    lines = staged(scan_lines(spark, files), "lines")
    if shared_layout:
        both = first_heads(spark, files)
        heads = staged(shared_heads(lines, *both), "heads")
        return parse_shared_layout(lines, columns, *both, heads=heads)
    return read_reports(lines, len(files), columns, required)
