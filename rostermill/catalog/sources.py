"""Scans."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.catalog import query
from rostermill.catalog import sql as S
from rostermill.catalog import tables as B
from rostermill.operators.match import with_match
from rostermill.schemas import SHEET_PRIORITY
from rostermill.sources.files import list_input_files as list_files
from rostermill.sources.fixed_width import FILES_PER_GROUP, file_layouts, parse_lines
from rostermill.sources.fixed_width import fwf_layout as layout_of
from rostermill.sources.workbook import rank_sheets
from rostermill.sources.workbook import read_workbook_sheets as read_sheets
from rostermill.workdir import staged

_FIELDS = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_shipdate"]


def _report(spark: SparkSession, folder: str) -> DataFrame:
    """Line items printed as fixed-width reports, one per return flag.

    The reports differ in layout: the first column is as wide as the flag's
    place in the alphabet says.
    """
    rows = B.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_orderkey").alias("okey"),
        "l_partkey",
        "l_linenumber",
        B.text("l_orderkey").alias("c1"), B.text("l_partkey").alias("c2"),
        B.text("l_linenumber").alias("c3"),
        F.when(F.col("l_linenumber") > 3, F.col("l_returnflag")).otherwise("NULL").alias("c4"),
        B.day("l_shipdate").alias("c5"),
    )
    width = F.when(F.col("flag") == "A", 11).when(F.col("flag") == "N", 14).otherwise(17)
    line = F.concat(
        F.rpad("c1", width, " "), F.rpad("c2", F.lit(10), " "), F.rpad("c3", F.lit(13), " "),
        F.rpad("c4", F.lit(13), " "), F.col("c5"),
    )
    number = F.lit(2) + F.xxhash64("okey", "l_partkey", "l_linenumber", "c5").bitwiseAND(
        F.lit(0x3FFFFFFFFFFFFFFF)
    )
    body = rows.select(
        line.alias("value"),
        F.concat(F.lit("report-"), F.col("flag"), F.lit(".rpt")).alias("_file"),
        F.lit(0).cast("bigint").alias("_block"),
        number.alias("_line"),
    )
    flags = rows.select("flag").distinct()
    names = F.concat(
        F.rpad(F.lit("l_orderkey"), width, " "),
        F.lit("l_partkey l_linenumber l_returnflag l_shipdate"),
    )
    dashes = F.concat(
        F.rpad(F.lit("----------"), width, " "),
        F.lit("--------- ------------ ------------ ----------"),
    )
    heads = [
        flags.select(
            value.alias("value"),
            F.concat(F.lit("report-"), F.col("flag"), F.lit(".rpt")).alias("_file"),
            F.lit(0).cast("bigint").alias("_block"),
            F.lit(i).cast("bigint").alias("_line"),
        )
        for i, value in enumerate([names, dashes])
    ]
    return heads[0].unionByName(heads[1]).unionByName(body)


@query()
def list_input_files(spark: SparkSession, folder: str) -> DataFrame:
    files = list_files(spark, folder, "parquet")
    return files.select("name", F.col("length").alias("n_bytes"))


@query(
    """
WITH flags AS (SELECT DISTINCT l_returnflag AS f FROM lineitem),
w AS (SELECT f, CASE f WHEN 'A' THEN 11 WHEN 'N' THEN 14 ELSE 17 END AS w FROM flags)
SELECT 'report-' || f || '.rpt' AS file, CAST(p AS BIGINT) AS position, n AS name,
  CAST(CASE WHEN p = 0 THEN 1 ELSE s + w END AS BIGINT) AS start_at,
  CAST(CASE WHEN p = 0 THEN w ELSE l END AS BIGINT) AS width
FROM w, (VALUES (0, 'l_orderkey', 1, 0), (1, 'l_partkey', 1, 10), (2, 'l_linenumber', 11, 13),
  (3, 'l_returnflag', 24, 13), (4, 'l_shipdate', 37, 10)) AS t(p, n, s, l)
"""
)
def fwf_layout(spark: SparkSession, folder: str) -> DataFrame:
    found = layout_of(_report(spark, folder))
    return found.select(
        F.col("_file").alias("file"),
        F.col("position").cast("bigint").alias("position"),
        "name",
        F.col("start").cast("bigint").alias("start_at"),
        F.col("length").cast("bigint").alias("width"),
    )


@query(
    """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
  CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CASE WHEN l_linenumber > 3 THEN l_returnflag END AS l_returnflag,
  strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
  'report-' || l_returnflag || '.rpt' AS file
FROM lineitem
"""
)
def read_fixed_width(spark: SparkSession, folder: str) -> DataFrame:
    lines = _report(spark, folder)
    layouts = staged(file_layouts(lines, _FIELDS), "layouts")
    few = layouts.count() <= FILES_PER_GROUP
    rows = parse_lines(lines, _FIELDS, layouts=layouts, few=few)
    return rows.select(*_FIELDS, F.col("_file").alias("file"))


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS "CLAIM_ID", c_name AS "LAST_NAME",
  CAST(c_acctbal > 0 AS VARCHAR) AS "FLAG", c_mktsegment || '-' || (c_custkey // 500) AS file
FROM customer
"""
)
def read_workbook_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """Customers zipped into workbooks of at most 500 rows, then read back."""
    shelf = F.floor(F.col("c_custkey") / 500).cast("string")
    rows = B.table(spark, folder, "customer").select(
        F.concat(F.col("c_mktsegment"), F.lit("-"), shelf).alias("book"),
        F.col("c_custkey").alias("CLAIM_ID"),
        F.col("c_name").alias("LAST_NAME"),
        (F.col("c_acctbal") > 0).alias("FLAG"),
    )
    books = rows.groupBy("book").applyInPandas(_zip_book, "path string, content binary")
    read = read_sheets(books, "CLAIMS", ["CLAIM_ID", "LAST_NAME", "FLAG"])
    return read.select(
        "CLAIM_ID", "LAST_NAME", F.lower("FLAG").alias("FLAG"), F.col("_file").alias("file")
    )


def _zip_book(rows: pd.DataFrame) -> pd.DataFrame:
    cells = ['<row r="1"><c r="A1" t="inlineStr"><is><t>CLAIM_ID</t></is></c>'
             '<c r="B1" t="inlineStr"><is><t>LAST_NAME</t></is></c>'
             '<c r="C1" t="inlineStr"><is><t>FLAG</t></is></c></row>']
    for i, row in enumerate(rows.itertuples(), start=2):
        cells.append(
            f'<row r="{i}"><c r="A{i}"><v>{row.CLAIM_ID}</v></c>'
            f'<c r="B{i}" t="inlineStr"><is><t>{row.LAST_NAME}</t></is></c>'
            f'<c r="C{i}" t="b"><v>{int(row.FLAG)}</v></c></row>'
        )
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
            '<sheet name="CLAIMS" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{main}"><sheetData>{"".join(cells)}</sheetData></worksheet>',
        )
    return pd.DataFrame({"path": [rows["book"].iloc[0]], "content": [out.getvalue()]})


_SHEET_OF = {"1-URGENT": "ELIGIBILITY", "2-HIGH": "ENROLLEES", "3-MEDIUM": "CLAIMS", "5-LOW": "FS"}


@query(
    """
SELECT o_orderkey, s AS sheet, CAST(p AS DOUBLE) AS priority
FROM orders JOIN (VALUES ('1-URGENT', 'ELIGIBILITY', 6), ('2-HIGH', 'ENROLLEES', 5),
  ('3-MEDIUM', 'CLAIMS', 7), ('5-LOW', 'FS', 22)) AS t(k, s, p) ON o_orderpriority = k
"""
)
def filter_rank_by_priority(spark: SparkSession, folder: str) -> DataFrame:
    """Orders' priorities stand for sheets; one of the five is unknown."""
    name = F.col("o_orderpriority")
    for code, sheet in _SHEET_OF.items():
        name = F.when(F.col("o_orderpriority") == code, F.lit(sheet)).otherwise(name)
    sheets = B.table(spark, folder, "orders").select("o_orderkey", name.alias("sheet"))
    assert set(_SHEET_OF.values()) <= set(SHEET_PRIORITY)
    return rank_sheets(sheets).orderBy("priority", "o_orderkey")


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
"""
)
def semi_join_prefetch(spark: SparkSession, folder: str) -> DataFrame:
    orders = B.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    wanted = B.table(spark, folder, "customer").where("c_acctbal > 0")
    return with_match(orders, wanted, {"o_custkey": "c_custkey"})


@query(
    S.with_views(S.COVERAGE, S.SUBSCRIBERS_STORED)
    + """
SELECT id, subscriber_id, insured_id FROM subscribers_stored s
WHERE EXISTS (SELECT 1 FROM coverage_in c WHERE c.subscriber_id = s.subscriber_id
  AND c.insured_id = s.insured_id)
"""
)
def semi_join_composite(spark: SparkSession, folder: str) -> DataFrame:
    stored = B.subscribers_stored(spark, folder).select(
        F.col("_id").alias("id"),
        F.col("subscriberNumber").alias("subscriber_id"),
        F.col("enrollee.referenceId").alias("insured_id"),
    )
    on = {"subscriber_id": "SUBSCRIBER_ID", "insured_id": "INSURED_ENROLLEE_ID"}
    return with_match(stored, B.coverage_in(spark, folder), on)


@query(
    S.with_views(S.ALL_PERSONS_STORED)
    + "SELECT id, last_name, state FROM persons_stored"
)
def nested_projection(spark: SparkSession, folder: str) -> DataFrame:
    return B.persons_stored(spark, folder, whole=True).select(
        F.col("_id").alias("id"),
        F.col("demographic.lastName").alias("last_name"),
        F.col("demographic.address.state").alias("state"),
    )


@query("SELECT count(*) AS n_rows FROM lineitem")
def state_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))
