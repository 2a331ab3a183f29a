"""Deduplication, ordered collection, counts, paging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.catalog import query
from rostermill.catalog import sql as S
from rostermill.catalog import tables as B
from rostermill.operators import children as K
from rostermill.operators import classify as A
from rostermill.operators import dedup as D
from rostermill.operators.clean import page_after
from rostermill.operators.quality import check_unique as duplicates

_LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate"]


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_shipdate) = 1
"""
)
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    lines = B.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"
    )
    return D.keep_first(lines, ["l_orderkey", "l_linenumber"], _LINE_ORDER).drop("l_shipdate")


@query(
    """
SELECT l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus,
  l_orderkey, l_partkey
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_linenumber, l_quantity, l_discount, l_tax,
  l_returnflag, l_linestatus ORDER BY l_orderkey, l_partkey, l_shipdate) = 1
"""
)
def dedup_wide_key(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus"]
    lines = B.table(spark, folder, "lineitem").select(*keys, "l_orderkey", "l_partkey", "l_shipdate")
    return D.keep_first(lines, keys, ["l_orderkey", "l_partkey", "l_shipdate"]).drop("l_shipdate")


@query(
    S.with_views(S.CLAIMS)
    + f""", firsts AS (SELECT * FROM claim_input QUALIFY row_number() OVER (
    PARTITION BY claim_id, code, service_date ORDER BY {S.ORD}) = 1),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY claim_id ORDER BY {S.ORD}) - 1) // {K.PART_ROWS} AS part
  FROM firsts)
SELECT claim_id, part, count(*) AS n_lines,
  string_agg(code || '@' || service_date || '=' || billed, ',' ORDER BY {S.ORD}) AS lines
FROM numbered GROUP BY claim_id, part"""
)
def collect_children_ordered(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.claim_input(spark, folder)
    out = K.collect_distinct_ordered(
        rows, ["CLAIM_ID"], ["CODE", "DATE_OF_SERVICE"],
        ["CODE", "DATE_OF_SERVICE", "BILLED_AMOUNT"], ["_file", "_block", "_line"], "lines",
    )
    shown = F.transform(
        "lines",
        lambda x: F.concat(x["CODE"], F.lit("@"), x["DATE_OF_SERVICE"], F.lit("="), x["BILLED_AMOUNT"]),
    )
    return out.select(
        F.col("CLAIM_ID").alias("claim_id"), "part",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.concat_ws(",", shown).alias("lines"),
    )


@query(
    S.with_views(S.CLAIMS)
    + f""", firsts AS (SELECT * FROM claim_input QUALIFY row_number() OVER (
    PARTITION BY claim_id, diagnosis ORDER BY {S.ORD}) = 1),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY claim_id ORDER BY {S.ORD}) - 1) // {K.PART_ROWS} AS part
  FROM firsts)
SELECT claim_id, part, string_agg(coalesce(diagnosis, '?') || description, ',' ORDER BY {S.ORD}) AS codes
FROM numbered GROUP BY claim_id, part"""
)
def collect_distinct_ordered(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.claim_input(spark, folder)
    out = K.collect_distinct_ordered(
        rows, ["CLAIM_ID"], ["DIAGNOSIS_CODE"], ["DIAGNOSIS_CODE", "DIAGNOSIS_DESCRIPTION"],
        ["_file", "_block", "_line"], "codes",
    )
    shown = F.transform(
        "codes",
        lambda x: F.concat(F.coalesce(x["DIAGNOSIS_CODE"], F.lit("?")), x["DIAGNOSIS_DESCRIPTION"]),
    )
    return out.select(F.col("CLAIM_ID").alias("claim_id"), "part", F.concat_ws(",", shown).alias("codes"))


@query(
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC) = 1
"""
)
def last_row_wins(spark: SparkSession, folder: str) -> DataFrame:
    lines = B.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    return D.keep_last(lines, ["l_orderkey"], ["l_linenumber", *_LINE_ORDER]).drop("l_shipdate")


@query(
    """
SELECT DISTINCT CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_custkey AS VARCHAR) END AS k
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
"""
)
def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Urgent orders have no key and low ones an empty one."""
    priority = F.col("o_orderpriority")
    orders = B.table(spark, folder, "orders").select(
        F.when(priority == "5-LOW", F.lit(""))
        .when(priority != "1-URGENT", B.text("o_custkey"))
        .alias("k")
    )
    return D.distinct_keys(orders, "k")


@query(
    """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""
)
def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates(B.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
SELECT CASE l_returnflag WHEN 'A' THEN 'insert' WHEN 'R' THEN 'update' ELSE 'no_action' END
  AS action, count(*) AS n_rows
FROM lineitem GROUP BY 1
"""
)
def action_counts(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    action = F.when(flag == "A", A.INSERT).when(flag == "R", A.UPDATE).otherwise(A.NO_ACTION)
    return A.action_counts(B.table(spark, folder, "lineitem").select(action.alias("action")))


@query(
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey > 0 ORDER BY o_orderkey LIMIT 1000
"""
)
def top_n_after_id(spark: SparkSession, folder: str) -> DataFrame:
    """One page after an id: the limit is the operator."""
    orders = B.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return page_after(orders, "o_orderkey", 0, 1_000)
