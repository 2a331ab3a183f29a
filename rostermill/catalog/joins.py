"""Lookups and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.catalog import query
from rostermill.catalog import sql as S
from rostermill.catalog import tables as B
from rostermill.catalog.reshaping import LABELS
from rostermill.codes import relationship_table
from rostermill.functions.arrays import array_union_by_key as union_arrays
from rostermill.functions.scalars import name_of
from rostermill.operators import children as K
from rostermill.operators import match as M
from rostermill.operators.clean import filter_changed as changed_rows
from rostermill.operators.clean import filter_not_equal
from rostermill.operators.dedup import keep_first, keep_last
from rostermill.operators.quality import rejected, with_reject_reason
from rostermill.operators.registry import latest_status
from rostermill.operators.registry import skip_registered_files as skip_files
from rostermill.plans.claims import claim_rows, classify_claims
from rostermill.plans.eligibility import stub_persons
from rostermill.skew import by_shuffle, hot_keys


@query(
    "SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag = 'R'"
)
def filter_equals(spark: SparkSession, folder: str) -> DataFrame:
    lines = B.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    return lines.where(F.col("l_returnflag") == "R")


@query(
    """
SELECT event_id, CASE WHEN event_type <> 'signup' THEN event_type END AS status
FROM events WHERE event_type <> 'error'
"""
)
def filter_null_safe_ne(spark: SparkSession, folder: str) -> DataFrame:
    """Errors stand for Failed, sign-ups for a missing status."""
    kind = F.col("event_type")
    events = B.table(spark, folder, "events").select(
        "event_id", F.when(kind != "signup", kind).alias("status")
    )
    return filter_not_equal(events, "status", "error")


@query(
    """
SELECT l_orderkey, l_partkey, l_linestatus, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END
  AS order_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_linestatus IS DISTINCT FROM CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END
"""
)
def filter_changed(spark: SparkSession, folder: str) -> DataFrame:
    lines = B.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus")
    orders = B.table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("order_status")
    )
    joined = lines.join(by_shuffle(orders), lines["l_orderkey"] == orders["o_orderkey"]).drop("o_orderkey")
    return changed_rows(joined, "l_linestatus", "order_status")


# --- lookups ---------------------------------------------------------------


@query(
    S.with_views(S.ALL_COVERAGE, S.ALL_PERSONS_STORED)
    + """SELECT ord AS row_id, enrollee_id, p.id AS ref, p.last_name AS last_name
FROM coverage_in LEFT JOIN persons_stored p ON enrollee_id = p.ref"""
)
def lookup_first_match(spark: SparkSession, folder: str) -> DataFrame:
    """With hot keys spread: every customer with 4 rows counts as hot here."""
    rows = B.coverage_in(spark, folder, whole=True)
    out = M.lookup(
        rows, B.persons_stored(spark, folder, whole=True), {"ENROLLEE_ID": "referenceId"},
        {"id": "_id", "last_name": "demographic.lastName"}, "e",
        hot=hot_keys(rows, ["ENROLLEE_ID"], min_rows=4),
    )
    return out.select(
        F.col("_line").alias("row_id"), F.col("ENROLLEE_ID").alias("enrollee_id"),
        F.col("e.id").alias("ref"), F.col("e.last_name").alias("last_name"),
    )


@query(
    S.with_views(S.COVERAGE, S.SUBSCRIBERS_STORED)
    + """SELECT ord AS row_id, s.id AS ref
FROM coverage_in c LEFT JOIN subscribers_stored s
  ON c.subscriber_id = s.subscriber_id AND c.insured_id = s.insured_id"""
)
def lookup_two_keys(spark: SparkSession, folder: str) -> DataFrame:
    out = M.lookup(
        B.coverage_in(spark, folder), B.subscribers_stored(spark, folder),
        {"SUBSCRIBER_ID": "subscriberNumber", "INSURED_ENROLLEE_ID": "enrollee.referenceId"},
        {"id": "_id"}, "s",
    )
    return out.select(F.col("_line").alias("row_id"), F.col("s.id").alias("ref"))


@query(
    S.with_views(S.COVERAGE, S.SUBSCRIBERS_STORED)
    + """, firsts AS (SELECT subscriber_id, min(id) AS id FROM subscribers_stored GROUP BY 1)
SELECT ord AS row_id, f.id AS ref FROM coverage_in c
LEFT JOIN firsts f ON c.subscriber_id = f.subscriber_id"""
)
def lookup_ambiguous_first(spark: SparkSession, folder: str) -> DataFrame:
    """Five subscriber numbers shared by all customers; the first id wins."""
    rows = B.coverage_in(spark, folder)
    out = M.lookup(
        rows, B.subscribers_stored(spark, folder),
        {"SUBSCRIBER_ID": "subscriberNumber"}, {"id": "_id"}, "s", first_by=["_id"],
        hot=hot_keys(rows, ["SUBSCRIBER_ID"]), spread=["_line"],
    )
    return out.select(F.col("_line").alias("row_id"), F.col("s.id").alias("ref"))


@query(
    S.with_views(S.COVERAGE, S.PATIENTS_STORED)
    + """SELECT ord AS row_id, p.id AS ref FROM coverage_in c LEFT JOIN patients_stored p
  ON c.enrollee_id = p.enrollee_id AND c.subscriber_id = p.subscriber_id
  AND c.member_id = p.member_id"""
)
def lookup_three_keys(spark: SparkSession, folder: str) -> DataFrame:
    out = M.lookup(
        B.coverage_in(spark, folder), B.patients_stored(spark, folder),
        {
            "ENROLLEE_ID": "enrollee.referenceId",
            "SUBSCRIBER_ID": "subscriber.identificationCode",
            "MEMBER_ID": "memberId",
        },
        {"id": "_id"}, "p",
    )
    return out.select(F.col("_line").alias("row_id"), F.col("p.id").alias("ref"))


@query(
    S.with_views(S.COVERAGE, S.ELIGIBILITIES_STORED)
    + """SELECT ord AS row_id, e.id AS ref FROM coverage_in c LEFT JOIN eligibilities_stored e
  ON c.enrollee_id = e.enrollee_id AND c.product_id = e.product_id
  AND c.subscriber_id = e.subscriber_id AND c.member_id = e.member_id
  AND c.effective = e.effective AND c.ends IS NOT DISTINCT FROM e.ends"""
)
def lookup_six_keys_null_safe(spark: SparkSession, folder: str) -> DataFrame:
    out = M.lookup(
        B.coverage_in(spark, folder), B.eligibilities_stored(spark, folder),
        {
            "ENROLLEE_ID": "enrollee.referenceId",
            "PRODUCT_ID": "product.referenceId",
            "SUBSCRIBER_ID": "subscriber.identificationCode",
            "MEMBER_ID": "patient.memberId",
            "EFFECTIVE_DATE": "serviceDate.formattedStartDate",
            "TERMINATION_DATE": "serviceDate.formattedEndDate",
        },
        {"id": "_id"}, "e",
    )
    return out.select(F.col("_line").alias("row_id"), F.col("e.id").alias("ref"))


@query(
    S.with_views(S.CLAIMS)
    + f""", incoming AS (SELECT DISTINCT claim_id FROM claims_in),
stored AS (SELECT DISTINCT claim_id FROM claims_before)
SELECT i.claim_id, CASE WHEN s.claim_id IS NULL THEN {S.key_id('claim', 'i.claim_id')}
  ELSE 'c' || i.claim_id END AS id
FROM incoming i LEFT JOIN stored s ON i.claim_id = s.claim_id"""
)
def match_claim(spark: SparkSession, folder: str) -> DataFrame:
    out = classify_claims(claim_rows(B.claims_in(spark, folder)), B.claims_stored(spark, folder))
    return out.select(F.col("CLAIM_ID").alias("claim_id"), F.col("_id").alias("id"))


_SLOT = ["_file", "_block", "_line"]


@query(
    S.with_views(S.CLAIMS)
    + f""", numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY claim_id ORDER BY {S.ORD}) - 1) // 5 AS part FROM claim_input)
SELECT claim_id, part, count(*) AS n_lines, string_agg(billed, ',' ORDER BY {S.ORD}) AS billed
FROM numbered GROUP BY claim_id, part"""
)
def nest_children(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as arrays of five, part after part."""
    rows = B.claim_input(spark, folder)
    parts = K.collect_ordered(
        rows, ["CLAIM_ID"], ["BILLED_AMOUNT"], _SLOT, "lines",
        slot=[F.floor(F.col("_line") / 2_000_000_000_000_000)], part_rows=5,
    )
    text = F.transform("lines", lambda x: x["BILLED_AMOUNT"])
    return parts.select(
        F.col("CLAIM_ID").alias("claim_id"), "part",
        F.size("lines").cast("bigint").alias("n_lines"), F.concat_ws(",", text).alias("billed"),
    )


_FIRST_LINES = f""", incoming AS (
  SELECT * FROM claims_in QUALIFY row_number() OVER (
    PARTITION BY claim_id, code, service_date ORDER BY {S.ORD}) = 1),
stored AS (
  SELECT * FROM claims_before QUALIFY row_number() OVER (
    PARTITION BY claim_id, code, service_date ORDER BY {S.ORD}) = 1)
"""


def _stored_lines(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["CLAIM_ID", "CODE", "DATE_OF_SERVICE"]
    rows = keep_first(B.claims_before(spark, folder), keys)
    empty = F.lit(None).cast("string")
    return rows.withColumns(
        {f: empty for f in K.FALLBACK_FIELDS if f not in ("MODIFIER1", "MODIFIER2")}
    )


@query(
    S.with_views(S.CLAIMS)
    + _FIRST_LINES
    + """SELECT i.claim_id, i.code, i.service_date, i.billed, s.modifier1 AS old1,
  s.modifier2 AS old2
FROM incoming i LEFT JOIN stored s ON i.claim_id = s.claim_id AND i.code = s.code
  AND i.service_date = s.service_date"""
)
def match_child_rows(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["CODE", "DATE_OF_SERVICE"]
    first = keep_first(B.claims_in(spark, folder), ["CLAIM_ID", *keys])
    out = K.match_child_rows(
        first, _stored_lines(spark, folder), "CLAIM_ID", keys, ["MODIFIER1", "MODIFIER2"]
    )
    return out.select(
        F.col("CLAIM_ID").alias("claim_id"), F.col("CODE").alias("code"),
        F.col("DATE_OF_SERVICE").alias("service_date"), F.col("BILLED_AMOUNT").alias("billed"),
        F.col("_old.MODIFIER1").alias("old1"), F.col("_old.MODIFIER2").alias("old2"),
    )


@query(
    S.with_views(S.CLAIMS)
    + _FIRST_LINES
    + """SELECT i.claim_id, i.code, i.service_date, i.billed,
  coalesce(i.modifier1, s.modifier1) AS modifier1, coalesce(i.modifier2, s.modifier2) AS modifier2
FROM incoming i LEFT JOIN stored s ON i.claim_id = s.claim_id AND i.code = s.code
  AND i.service_date = s.service_date"""
)
def coalesce_with_previous(spark: SparkSession, folder: str) -> DataFrame:
    empty = F.lit(None).cast("string")
    incoming = B.claims_in(spark, folder).withColumns(
        {f: empty for f in K.FALLBACK_FIELDS if f not in ("MODIFIER1", "MODIFIER2")}
    )
    out = K.merge_lines(incoming, _stored_lines(spark, folder), single_file=True)
    return out.select(
        F.col("CLAIM_ID").alias("claim_id"), F.col("CODE").alias("code"),
        F.col("DATE_OF_SERVICE").alias("service_date"), F.col("BILLED_AMOUNT").alias("billed"),
        F.col("MODIFIER1").alias("modifier1"), F.col("MODIFIER2").alias("modifier2"),
    )


@query(
    """
WITH last AS (SELECT p_size, arg_max(p_name, p_partkey) AS name FROM part GROUP BY p_size)
SELECT l_orderkey, l_partkey, l_linenumber, name
FROM lineitem LEFT JOIN last ON p_size = CAST(l_quantity AS INTEGER)
"""
)
def lookup_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    lines = B.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.col("l_quantity").cast("int").cast("string").alias("ref"),
    )
    known = keep_last(
        B.products(spark, folder).select("_id", "name", F.col("product.referenceId").alias("r")),
        ["r"], ["_id"],
    )
    out = M.lookup(
        lines, known, {"ref": "r"}, {"name": "name"}, "p",
        hot=hot_keys(lines, ["ref"]), spread=["l_orderkey", "l_linenumber", "l_partkey"],
    )
    return out.select("l_orderkey", "l_partkey", "l_linenumber", F.col("p.name").alias("name"))


@query(
    S.with_views(S.ALL_COVERAGE, S.SUBSCRIBERS_STORED, S.PATIENTS_STORED)
    + """SELECT p.id, s.name FROM patients_stored p JOIN subscribers_stored s
ON p.subscriber_ref = s.id"""
)
def lookup_by_ref_inner(spark: SparkSession, folder: str) -> DataFrame:
    patients = B.patients_stored(spark, folder, whole=True)
    patients = patients.withColumn("_ref", F.col("subscriber.refId"))
    out = M.lookup(
        patients, B.subscribers_stored(spark, folder, whole=True), {"_ref": "_id"},
        {"name": lambda: name_of("demographic")}, "s", how="inner",
    )
    return out.select(F.col("_id").alias("id"), F.col("s.name").alias("name"))


@query(
    """
WITH last AS (SELECT user_id, arg_max(event_type, ts) AS status FROM events GROUP BY user_id)
SELECT doc_id || '.rpt' AS name, n_chars AS n_bytes FROM documents
WHERE doc_id NOT IN (SELECT user_id FROM last WHERE status <> 'error')
"""
)
def skip_registered_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files are documents; users with a last status are registered files."""
    history = B.table(spark, folder, "events").select(
        F.col("user_id").alias("document"), F.col("event_type").alias("status"),
        F.col("ts").alias("at"), F.lit(None).cast("string").alias("reason"),
    )
    status = F.when(F.col("status") == "error", F.lit("Failed")).otherwise(F.col("status"))
    registry = latest_status(history).select(
        F.concat(B.text("document"), F.lit(".rpt")).alias("originalName"), status.alias("status")
    )
    files = B.table(spark, folder, "documents").select(
        F.concat(B.text("doc_id"), F.lit(".rpt")).alias("name"), F.col("n_chars").alias("n_bytes")
    )
    return skip_files(files, registry)


@query(
    """
WITH incoming AS (SELECT l_orderkey, arg_min(l_suppkey, (l_linenumber, l_partkey, l_suppkey)) AS s
  FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_custkey, s AS new_value FROM orders JOIN incoming ON o_orderkey = l_orderkey
WHERE o_custkey <> s
"""
)
def detect_changes(spark: SparkSession, folder: str) -> DataFrame:
    stored = B.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = B.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_linenumber", "l_partkey"
    )
    first = keep_first(lines, ["o_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
    out = M.detect_changes(stored, first, "o_orderkey", "o_custkey", "l_suppkey")
    return out.withColumnRenamed("_new", "new_value")


@query(
    f"""
WITH labels AS (SELECT * FROM {LABELS})
SELECT event_id, lpad(CAST(floor(value) AS BIGINT)::VARCHAR, 2, '0') AS code,
  coalesce(label, '') AS label
FROM events LEFT JOIN labels ON code = lpad(CAST(floor(value) AS BIGINT)::VARCHAR, 2, '0')
"""
)
def code_lookup(spark: SparkSession, folder: str) -> DataFrame:
    events = B.table(spark, folder, "events").select(
        "event_id", F.lpad(F.floor("value").cast("bigint").cast("string"), 2, "0").alias("code")
    )
    return M.code_lookup(events, relationship_table(spark), "code", "label")


@query(
    S.with_views(S.COVERAGE, S.PERSONS_STORED)
    + f""", wanted AS (SELECT insured_id AS k, min(ord) AS ord FROM coverage_in GROUP BY 1)
SELECT k AS enrollee_id, {S.key_id('enrollee', 'k')} AS id, FALSE AS complete, ord AS first_row
FROM wanted WHERE k NOT IN (SELECT ref FROM persons_stored)"""
)
def insert_missing_parents(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.coverage_in(spark, folder)
    absent = M.missing_parents(
        rows, "INSURED_ENROLLEE_ID", B.persons_stored(spark, folder), "referenceId"
    )
    stubs = stub_persons(absent, "INSURED_ENROLLEE_ID")
    keyed = stubs.join(
        by_shuffle(absent.select(F.col("INSURED_ENROLLEE_ID").alias("k"), "_line")),
        F.col("referenceId") == F.col("k"),
    )
    return keyed.select(
        F.col("referenceId").alias("enrollee_id"), F.col("_id").alias("id"),
        F.col("hasCompleteInfo").alias("complete"), F.col("_line").alias("first_row"),
    )


@query(
    """
SELECT CAST(l_orderkey AS VARCHAR) AS row_key, 'lines' AS step, 'order not found' AS reason,
  l_partkey AS part
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
"""
)
def orphan_rejects(spark: SparkSession, folder: str) -> DataFrame:
    lines = B.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", B.text("l_partkey").alias("_file")
    )
    orders = B.table(spark, folder, "orders").where("o_orderstatus <> 'P'")
    matched = M.lookup(
        lines, orders, {"l_orderkey": "o_orderkey"}, {"k": "o_orderkey"}, "o",
        hot=hot_keys(lines, ["l_orderkey"], min_rows=8),
    )
    bad = rejected(
        with_reject_reason(matched, {"order not found": F.col("o").isNull()}),
        "lines", B.text("l_orderkey"),
    )
    return bad.select("row_key", "step", "reason", F.col("file").cast("bigint").alias("part"))


# --- set operations --------------------------------------------------------


@query(
    """
SELECT k, coalesce(a.c_name, b.s_name) AS name, CASE WHEN a.c_name IS NULL THEN 2 ELSE 1 END AS side
FROM (SELECT c_custkey AS k, c_name FROM customer) a
FULL OUTER JOIN (SELECT s_suppkey AS k, s_name FROM supplier) b USING (k)
"""
)
def union_with_precedence(spark: SparkSession, folder: str) -> DataFrame:
    first = B.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.lit(1).alias("side")
    )
    second = B.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit(2).alias("side")
    )
    return M.union_with_precedence(first, second, ["k"], ["name"])


@query(
    """
SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber = 1 THEN '1:new,2:old'
  WHEN l_linenumber = 2 THEN '2:new,1:new' ELSE l_linenumber || ':new,1:new,2:old' END AS documents
FROM lineitem
"""
)
def array_union_by_key(spark: SparkSession, folder: str) -> DataFrame:
    def doc(key, side: str):
        return F.struct(key.cast("string").alias("documentId"), F.lit(side).alias("side"))

    lines = B.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.array(doc(F.col("l_linenumber"), "new"), doc(F.lit(1), "new")).alias("new"),
        F.array(doc(F.lit(2), "old"), doc(F.lit(1), "old")).alias("old"),
    )
    merged = union_arrays("new", "old", "documentId")
    shown = F.transform(merged, lambda d: F.concat(d["documentId"], F.lit(":"), d["side"]))
    return lines.select("l_orderkey", "l_partkey", F.concat_ws(",", shown).alias("documents"))
