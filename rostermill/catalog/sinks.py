"""Upserts, patches, dumps and the file registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.catalog import query
from rostermill.catalog import sql as S
from rostermill.catalog import tables as B
from rostermill.operators import registry as R
from rostermill.operators import upsert as U
from rostermill.operators.match import without_match
from rostermill.schemas import LINEAGE_TYPE


def _state(spark: SparkSession, folder: str) -> DataFrame:
    """One document per customer with finished orders."""
    orders = B.table(spark, folder, "orders").where("o_orderstatus = 'F'")
    return orders.groupBy(F.col("o_custkey").alias("_id")).agg(
        F.min("o_orderdate").alias("created"),
        F.max("o_orderpriority").alias("note"),
        F.array(F.lit("old")).alias("ardbDocuments"),
    )


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    """One change per customer with open orders; some notes are null."""
    orders = B.table(spark, folder, "orders").where("o_orderstatus <> 'F'")
    return orders.groupBy(F.col("o_custkey").alias("_id")).agg(
        F.max("o_orderdate").alias("created"),
        F.max(F.when(F.col("o_orderpriority") < "4", F.col("o_orderpriority"))).alias("note"),
        F.array(F.lit("new")).alias("ardbDocuments"),
    )


_UPSERT = """
WITH s AS (SELECT o_custkey AS id, min(o_orderdate) AS created, max(o_orderpriority) AS note
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
c AS (SELECT o_custkey AS id, max(o_orderdate) AS created,
    max(CASE WHEN o_orderpriority < '4' THEN o_orderpriority END) AS note
  FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
"""


@query(
    _UPSERT
    + """SELECT id, strftime(created, '%Y-%m-%d') AS created, note FROM c
WHERE id NOT IN (SELECT id FROM s)"""
)
def upsert_inserts(spark: SparkSession, folder: str) -> DataFrame:
    new = without_match(_changes(spark, folder), _state(spark, folder), {"_id": "_id"})
    return new.select(F.col("_id").alias("id"), B.day("created").alias("created"), "note")


@query(
    _UPSERT
    + """SELECT coalesce(s.id, c.id) AS id,
  strftime(coalesce(s.created, c.created), '%Y-%m-%d') AS created,
  CASE WHEN c.id IS NOT NULL THEN c.note ELSE s.note END AS note,
  concat_ws(',', CASE WHEN s.id IS NOT NULL THEN 'old' END,
    CASE WHEN c.id IS NOT NULL THEN 'new' END) AS documents
FROM s FULL OUTER JOIN c ON s.id = c.id"""
)
def upsert_apply(spark: SparkSession, folder: str) -> DataFrame:
    out = U.upsert_apply(_state(spark, folder), _changes(spark, folder), keep_old=["created"])
    return out.select(
        F.col("_id").alias("id"),
        B.day("created").alias("created"),
        "note",
        F.concat_ws(",", "ardbDocuments").alias("documents"),
    )


@query(
    """
SELECT l_orderkey, l_partkey, l_linestatus FROM lineitem l
WHERE l_linestatus = 'O' OR NOT EXISTS
  (SELECT 1 FROM lineitem n WHERE n.l_orderkey = l.l_orderkey AND n.l_linestatus = 'O')
"""
)
def upsert_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Open lines replace all lines of their order."""
    lines = B.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus")
    old, new = lines.where("l_linestatus = 'F'"), lines.where("l_linestatus = 'O'")
    return U.upsert_replace(old, new, "l_orderkey")


@query(
    """
SELECT l_orderkey, l_partkey, CASE WHEN o_orderkey IS NOT NULL THEN o_custkey ELSE l_suppkey END
    AS insured, l_returnflag AS other,
  CASE WHEN o_orderkey IS NOT NULL THEN 2 ELSE 1 END AS n_documents,
  CASE WHEN o_orderkey IS NOT NULL THEN '1-corrections' END AS source
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'P'
"""
)
def update_many_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Pending orders correct the insured id on all of their lines."""
    lineage = B.fixed_lineage(spark, "corrections")
    state = B.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.struct(F.col("l_suppkey").alias("insured"), F.col("l_returnflag").alias("other")).alias(
            "info"
        ),
    )
    empty = F.lit(None)
    old_entry = F.array(empty.cast(LINEAGE_TYPE))
    state = state.withColumns(
        {
            "ardbDocuments": old_entry,
            "ardbSourceDocument": empty.cast("string"),
            "ardbLastModifiedDate": empty.cast("timestamp_ntz"),
        }
    )
    orders = B.table(spark, folder, "orders").where("o_orderstatus = 'P'")
    changes = R.with_lineage(
        orders.select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
            F.lit("corrections").alias("_file"),
        ),
        lineage,
    )
    out = U.update_many_nested(
        state, changes, "l_orderkey", "info", {"insured": "o_custkey"}, "lineage"
    )
    return out.select(
        "l_orderkey", "l_partkey", "info.insured", "info.other",
        F.size("ardbDocuments").cast("int").alias("n_documents"),
        F.col("ardbSourceDocument").alias("source"),
    )


@query(
    """
SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 AND n_name IS NOT NULL THEN n_name
  ELSE c_mktsegment END AS name, c_name AS other
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 1
"""
)
def patch_nested_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Nation names patch the name of customers with a balance."""
    c = B.table(spark, folder, "customer")
    n = B.table(spark, folder, "nation").where("n_regionkey <> 1")
    state = c.select(
        F.col("c_custkey").alias("_id"),
        F.struct(F.col("c_mktsegment").alias("name"), F.col("c_name").alias("other")).alias("who"),
    )
    patch = c.where("c_acctbal > 0").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    out = U.patch_nested_fields(
        state, patch.select(F.col("c_custkey").alias("_id"), "n_name"), "_id", {"who.name": "n_name"}
    )
    return out.select(F.col("_id").alias("id"), "who.name", "who.other")


@query(
    S.with_views(S.ALL_PERSONS_IN)
    + """SELECT p.enrollee_id, p.last_name, p.state, p.modified, '1704067200000-persons' AS source,
  '2024-01-01' AS processed, CASE WHEN c_nationkey > 12 THEN 'n' || c_nationkey END AS nation,
  CASE WHEN c_acctbal > 0 THEN CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) END AS cents,
  c_nationkey > 12 OR c_acctbal > 0 AS has_more
FROM persons_in p JOIN customer ON CAST(c_custkey AS VARCHAR) = p.enrollee_id"""
)
def raw_dump_with_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """All customers as input rows; nation and balance are columns that the
    layout does not declare, and some rows have neither."""
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")
    more = F.map_from_arrays(
        F.array(F.lit("NATION"), F.lit("STATE_2")),
        F.array(
            F.when(F.col("c_nationkey") > 12, F.concat(F.lit("n"), "c_nationkey")),
            F.when(F.col("c_acctbal") > 0, cents),
        ),
    )
    rows = B.persons_in(spark, folder, whole=True, more=F.map_filter(more, lambda _, v: v.isNotNull()))
    dump = R.raw_dump(rows, F.lit("2024-01-01").cast("timestamp_ntz"))
    return dump.select(
        F.col("ENROLLEE_ID").alias("enrollee_id"),
        F.col("LAST_NAME").alias("last_name"),
        F.col("STATE").alias("state"),
        F.col("LAST_MODIFIED_DATE_TIME").alias("modified"),
        F.col("ardbSourceDocument").alias("source"),
        B.day("ardbLastModifiedDate").alias("processed"),
        F.try_variant_get("undeclared", "$.NATION", "string").alias("nation"),
        F.try_variant_get("undeclared", "$.STATE_2", "string").alias("cents"),
        F.col("undeclared").isNotNull().alias("has_more"),
    )


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents stand for files: a path, a name, a size."""
    d = B.table(spark, folder, "documents")
    return d.select(
        F.concat(F.lit("/in/"), "source", F.lit("/"), B.text("doc_id"), F.lit(".rpt")).alias("path"),
        F.concat(B.text("doc_id"), F.lit(".rpt")).alias("name"),
        F.col("n_chars").alias("length"),
    )


@query(
    """
SELECT md5(length('/in/' || source || '/' || doc_id || '.rpt') || ':/in/' || source || '/' || doc_id
    || '.rpt#19:2024-01-01 00:00:00') AS id,
  doc_id || '.rpt' AS name, 'New' AS status, '1704067200000-' || doc_id || '.rpt' AS stored,
  'prod/claim_rpt/1704067200000-' || doc_id || '.rpt' AS destination, n_chars AS size
FROM documents
"""
)
def register_files(spark: SparkSession, folder: str) -> DataFrame:
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    out = R.register_files(_files(spark, folder), "claim_rpt", "prod", at)
    return out.select(
        F.col("_id").alias("id"), F.col("originalName").alias("name"), "status",
        F.col("fileName").alias("stored"), F.col("metadata.destination").alias("destination"),
        F.col("metadata.size").alias("size"),
    )


@query(
    """
SELECT user_id AS document, arg_max(event_type, ts) AS status,
  arg_max(CAST(event_id AS VARCHAR), ts) AS reason
FROM events GROUP BY user_id
"""
)
def latest_status(spark: SparkSession, folder: str) -> DataFrame:
    history = B.table(spark, folder, "events").select(
        F.col("user_id").alias("document"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("at"),
        B.text("event_id").alias("reason"),
    )
    return R.latest_status(history)
