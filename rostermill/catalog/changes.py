"""Change classification and completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.catalog import query
from rostermill.catalog import sql as S
from rostermill.catalog import tables as B
from rostermill.operators import classify as A
from rostermill.operators.dedup import keep_first
from rostermill.plans import claims as PC
from rostermill.plans import eligibility as PE
from rostermill.plans.run import LazyRun

#: insert / update / no_action against a stored row ``s`` with a date
COMPARE = """CASE WHEN s.id IS NULL THEN 'insert'
    WHEN strptime(c.modified, '%Y-%m-%d') > s.updated_at OR NOT {complete} THEN 'update'
    ELSE 'no_action' END"""

PERSON_STEP = f"""person_step AS (
  SELECT c.*, coalesce(s.id, {S.key_id('enrollee', 'c.enrollee_id')}) AS id,
    CASE WHEN s.id IS NULL THEN 'insert' WHEN c.modified IS NULL THEN 'no_action'
      WHEN c.modified > '1998-01-01' OR NOT s.complete THEN 'update' ELSE 'no_action' END AS action
  FROM persons_in c LEFT JOIN persons_stored s ON c.enrollee_id = s.ref)"""


def _views(*more: str) -> str:
    return S.with_views(S.PERSONS_IN, S.PERSONS_STORED, S.COVERAGE, *more)


@query(_views(PERSON_STEP) + "SELECT enrollee_id AS row_key, id, action FROM person_step")
def classify_person_changes(spark: SparkSession, folder: str) -> DataFrame:
    out = PE.classify_persons(B.persons_in(spark, folder), B.persons_stored(spark, folder))
    return out.select(F.col("ENROLLEE_ID").alias("row_key"), F.col("_id").alias("id"), "action")


_FIRST_POLICY = """policy AS (SELECT * FROM coverage_in QUALIFY row_number() OVER (
  PARTITION BY subscriber_id, insured_id ORDER BY ord) = 1)"""
_FIRST_PATIENT = """patient_in AS (SELECT * FROM coverage_in QUALIFY row_number() OVER (
  PARTITION BY enrollee_id, subscriber_id, member_id ORDER BY ord) = 1)"""
_FIRST_ELIGIBILITY = """eligibility_in AS (SELECT * FROM coverage_in QUALIFY row_number() OVER (
  PARTITION BY enrollee_id, product_id, subscriber_id, member_id, effective, ends ORDER BY ord) = 1)"""


@query(
    _views(S.SUBSCRIBERS_STORED, _FIRST_POLICY)
    + f"""SELECT c.subscriber_id || '|' || c.insured_id AS row_key,
  coalesce(s.id, {S.key_id('subscriber', 'c.subscriber_id', 'c.insured_id')}) AS id,
  e.complete IS DISTINCT FROM FALSE AS complete,
  {COMPARE.format(complete='(e.complete IS DISTINCT FROM FALSE)')} AS action
FROM policy c LEFT JOIN persons_stored e ON c.insured_id = e.ref
LEFT JOIN subscribers_stored s ON c.subscriber_id = s.subscriber_id AND c.insured_id = s.insured_id"""
)
def classify_subscriber_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = keep_first(B.coverage_in(spark, folder), PE.SUBSCRIBER_KEYS)
    out = PE.classify_subscribers(
        rows, B.persons_stored(spark, folder), B.subscribers_stored(spark, folder), LazyRun({})
    )
    return out.select(
        F.concat_ws("|", *PE.SUBSCRIBER_KEYS).alias("row_key"), F.col("_id").alias("id"),
        F.col("hasCompleteInfo").alias("complete"), "action",
    )


_FIRST_SUBSCRIBER = """first_subscriber AS (
  SELECT subscriber_id, min(id) AS id FROM subscribers_stored GROUP BY 1)"""


@query(
    _views(S.SUBSCRIBERS_STORED, S.PATIENTS_STORED, _FIRST_PATIENT, _FIRST_SUBSCRIBER)
    + f"""SELECT c.enrollee_id || '|' || c.subscriber_id || '|' || c.member_id AS row_key,
  coalesce(s.id, {S.key_id('patient', 'c.enrollee_id', 'c.subscriber_id', 'c.member_id')}) AS id,
  coalesce(e.complete, FALSE) AS complete,
  {COMPARE.format(complete='coalesce(e.complete, FALSE)')} AS action,
  CASE WHEN e.id IS NULL THEN 'enrollee not found' END AS reason
FROM patient_in c LEFT JOIN persons_stored e ON c.enrollee_id = e.ref
JOIN first_subscriber f ON f.subscriber_id = c.subscriber_id
LEFT JOIN patients_stored s ON c.enrollee_id = s.enrollee_id
  AND c.subscriber_id = s.subscriber_id AND c.member_id = s.member_id"""
)
def classify_patient_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = keep_first(B.coverage_in(spark, folder), PE.PATIENT_KEYS)
    out = PE.classify_patients(
        rows, B.persons_stored(spark, folder), B.subscribers_stored(spark, folder),
        B.patients_stored(spark, folder), LazyRun({}),
    )
    return out.select(
        F.concat_ws("|", *PE.PATIENT_KEYS).alias("row_key"), F.col("_id").alias("id"),
        F.col("hasCompleteInfo").alias("complete"), "action", F.col("_reason").alias("reason"),
    )


@query(
    _views(S.SUBSCRIBERS_STORED, S.PATIENTS_STORED, S.ELIGIBILITIES_STORED, _FIRST_ELIGIBILITY)
    + f"""SELECT c.ord AS row_id,
  coalesce(s.id, {S.key_id('eligibility', 'c.enrollee_id', 'c.product_id', 'c.subscriber_id',
                           'c.member_id', 'c.effective', 'c.ends')}) AS id,
  coalesce(e.complete, FALSE) AND u.id IS NOT NULL AND p.id IS NOT NULL AS complete,
  {COMPARE.format(complete="(coalesce(e.complete, FALSE) AND u.id IS NOT NULL AND p.id IS NOT NULL)")}
    AS action,
  CASE WHEN e.id IS NULL THEN 'enrollee not found' WHEN u.id IS NULL THEN 'subscriber not found'
    WHEN p.id IS NULL THEN 'patient not found' END AS reason
FROM eligibility_in c LEFT JOIN persons_stored e ON c.enrollee_id = e.ref
LEFT JOIN subscribers_stored u ON c.subscriber_id = u.subscriber_id AND c.insured_id = u.insured_id
LEFT JOIN patients_stored p ON c.enrollee_id = p.enrollee_id
  AND c.subscriber_id = p.subscriber_id AND c.member_id = p.member_id
LEFT JOIN eligibilities_stored s ON c.enrollee_id = s.enrollee_id AND c.product_id = s.product_id
  AND c.subscriber_id = s.subscriber_id AND c.member_id = s.member_id
  AND c.effective = s.effective AND c.ends IS NOT DISTINCT FROM s.ends"""
)
def classify_eligibility_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = keep_first(B.coverage_in(spark, folder), PE.ELIGIBILITY_KEYS)
    out = PE.classify_eligibilities(
        rows, B.persons_stored(spark, folder), B.subscribers_stored(spark, folder),
        B.patients_stored(spark, folder), B.eligibilities_stored(spark, folder), LazyRun({}),
    )
    return out.select(
        F.col("_line").alias("row_id"), F.col("_id").alias("id"),
        F.col("hasCompleteInfo").alias("complete"), "action", F.col("_reason").alias("reason"),
    )


@query(
    S.with_views(S.CLAIMS)
    + """SELECT claim_id, CASE WHEN claim_id IN (SELECT claim_id FROM claims_before) THEN 'update'
  ELSE 'insert' END AS action
FROM claims_in GROUP BY claim_id"""
)
def classify_always_update(spark: SparkSession, folder: str) -> DataFrame:
    out = PC.classify_claims(
        PC.claim_rows(B.claims_in(spark, folder)), B.claims_stored(spark, folder)
    )
    return out.select(F.col("CLAIM_ID").alias("claim_id"), "action")


@query(
    _views(PERSON_STEP)
    + "SELECT enrollee_id AS row_key, action FROM person_step WHERE action <> 'no_action'"
)
def split_by_action(spark: SparkSession, folder: str) -> DataFrame:
    classified = PE.classify_persons(B.persons_in(spark, folder), B.persons_stored(spark, folder))
    slim = classified.select(F.col("ENROLLEE_ID").alias("row_key"), "action")
    inserts, updates = A.split_by_action(slim)
    return inserts.unionByName(updates)


def _flags(spark: SparkSession, folder: str) -> DataFrame:
    """Three flags per event: true, false or missing."""
    kind = F.col("event_type")
    value = F.col("value")
    return B.table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "error", F.lit(False)).when(kind != "signup", F.lit(True)).alias("a"),
        F.when(value < 5, F.lit(False)).when(value < 20, F.lit(True)).alias("b"),
        F.when(F.col("user_id") < 100, F.lit(True)).alias("c"),
    )


@query("SELECT event_id, event_type <> 'error' AS complete FROM events")
def completeness_single(spark: SparkSession, folder: str) -> DataFrame:
    return _flags(spark, folder).select(
        "event_id", A.complete_unless_false(F.col("a")).alias("complete")
    )


@query(
    """
SELECT event_id, event_type NOT IN ('error', 'signup') AND value >= 5 AND value < 20
  AND user_id < 100 AS complete
FROM events
"""
)
def completeness_all(spark: SparkSession, folder: str) -> DataFrame:
    flags = [F.col(c) for c in ("a", "b", "c")]
    return _flags(spark, folder).select("event_id", A.complete_if_all(*flags).alias("complete"))
