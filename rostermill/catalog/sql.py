"""The views of :mod:`rostermill.catalog.tables` as SQL, for the oracles."""

from __future__ import annotations

from rostermill.schemas import CLAIM_COLUMNS

PERSONS_IN = """persons_in AS (
  SELECT CAST(c_custkey AS VARCHAR) AS enrollee_id, c_name AS last_name,
    c_mktsegment AS first_name,
    CASE WHEN c_nationkey > 12 THEN CAST(c_nationkey AS VARCHAR) END AS middle_name,
    CAST(c_nationkey AS VARCHAR) AS state,
    CASE substr(c_mktsegment, 1, 1) WHEN 'F' THEN 'FEMALE' WHEN 'M' THEN 'MALE' END AS gender,
    CASE c_mktsegment WHEN 'FURNITURE' THEN NULL WHEN 'MACHINERY' THEN '1997-06-01'
      ELSE '1999-06-01' END AS modified
  FROM customer WHERE c_acctbal <= 5000)"""

PERSONS_STORED = """persons_stored AS (
  SELECT 'e' || c_custkey AS id, CAST(c_custkey AS VARCHAR) AS ref, c_name AS last_name,
    c_mktsegment AS first_name, c_mktsegment <> 'BUILDING' AS complete,
    CASE WHEN c_nationkey < 12 THEN 'MALE' ELSE 'FEMALE' END AS gender,
    CAST(c_nationkey AS VARCHAR) AS state, 'ssn' || c_custkey AS ssn
  FROM customer WHERE c_acctbal > 0)"""

COVERAGE = """coverage AS (
  SELECT o_orderkey AS ord, o_orderstatus AS status, o_orderdate AS ordered,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'D' || o_orderkey
      ELSE CAST(o_custkey AS VARCHAR) END AS enrollee_id,
    substr(o_orderpriority, 1, 1) AS product_id,
    strftime(o_orderdate, '%Y') || '-01-01' AS effective,
    CASE WHEN month(o_orderdate) <= 6 THEN strftime(o_orderdate, '%Y') || '-12-31' END AS ends,
    o_orderpriority AS subscriber_id, substr(o_orderpriority, 1, 1) AS member_id,
    CAST(o_custkey AS VARCHAR) AS insured_id, strftime(o_orderdate, '%m') AS relationship,
    strftime(o_orderdate, '%Y-%m-%d') AS created,
    CASE WHEN month(o_orderdate) < 12 THEN strftime(o_orderdate, '%Y-%m-%d') END AS modified
  FROM orders),
coverage_in AS (SELECT * FROM coverage WHERE status <> 'F'),
coverage_before AS (SELECT * FROM coverage WHERE status = 'F')"""

SUBSCRIBERS_STORED = """subscribers_stored AS (
  SELECT 's' || insured_id || '/' || subscriber_id AS id, subscriber_id, insured_id,
    max(ordered) AS updated_at, subscriber_id || ' ' || insured_id AS name
  FROM coverage_before GROUP BY subscriber_id, insured_id)"""

PATIENTS_STORED = """patients_stored AS (
  SELECT 'p' || enrollee_id || '/' || subscriber_id AS id, enrollee_id, subscriber_id,
    member_id, max(ordered) AS updated_at,
    's' || enrollee_id || '/' || subscriber_id AS subscriber_ref
  FROM coverage_before GROUP BY enrollee_id, subscriber_id, member_id)"""

ELIGIBILITIES_STORED = """eligibilities_stored AS (
  SELECT 'x' || enrollee_id || '/' || product_id || '/' || subscriber_id || '/' || member_id
      || '/' || effective || '/' || coalesce(ends, '-') AS id,
    enrollee_id, product_id, subscriber_id, member_id, effective, ends, max(ordered) AS updated_at
  FROM coverage_before
  GROUP BY enrollee_id, product_id, subscriber_id, member_id, effective, ends)"""

# The same views without a split, for queries that need one side alone.
ALL_PERSONS_IN = PERSONS_IN.replace(" WHERE c_acctbal <= 5000", "")
ALL_PERSONS_STORED = PERSONS_STORED.replace(" WHERE c_acctbal > 0", "")
ALL_COVERAGE = COVERAGE.replace(" WHERE status <> 'F'", "").replace(" WHERE status = 'F'", "")

CLAIMS = """claim_input AS (
  SELECT l_linestatus, CAST(l_orderkey AS VARCHAR) AS claim_id,
    CAST(o_custkey AS VARCHAR) AS insured_id, o_orderstatus AS claim_status,
    o_orderpriority AS category, CAST(l_suppkey AS VARCHAR) AS provider_id,
    CASE WHEN l_tax > 0 THEN l_returnflag END AS diagnosis, 'D' || l_suppkey AS description,
    CAST(l_linenumber AS VARCHAR) AS code, strftime(l_shipdate, '%Y') || '-01-01' AS service_date,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
    CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS billed,
    CASE WHEN l_returnflag = 'N' THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS item,
    CAST(l_partkey AS VARCHAR) AS sh_item,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS modifier1,
    CASE WHEN l_discount > 0.05 THEN 'D' END AS modifier2,
    l_linenumber AS o1, l_partkey AS o2, round(l_extendedprice * 100) AS o3
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
claims_in AS (SELECT * FROM claim_input WHERE l_linestatus = 'O'),
claims_before AS (SELECT * FROM claim_input WHERE l_linestatus = 'F')"""

ORD = "o1, o2, o3"


#: columns of the view that stand for report columns
_CLAIM_VIEW = {
    "CLAIM_ID": "claim_id", "INSURED_ENROLLEE_ID": "insured_id", "CLAIM_STATUS": "claim_status",
    "CLAIM_CATEGORY": "category", "PROVIDER_ID": "provider_id", "DIAGNOSIS_CODE": "diagnosis",
    "DIAGNOSIS_DESCRIPTION": "description", "CODE": "code", "DATE_OF_SERVICE": "service_date",
    "QUANTITY": "quantity", "BILLED_AMOUNT": "billed", "ITEM_NUMBER": "item",
    "SH_ITEM_NUMBER": "sh_item", "MODIFIER1": "modifier1", "MODIFIER2": "modifier2",
}


def claim_column(name: str) -> str:
    """A column of the wide claim input over the view ``claim_input``."""
    if name in _CLAIM_VIEW:
        return _CLAIM_VIEW[name]
    return f"CASE WHEN o1 % 7 <> {CLAIM_COLUMNS.index(name) % 7} THEN '{name}:' || claim_id END"


def canonical(value: dict | str | None) -> str:
    """Canonical text of a nested value; structs are given as dicts, in the
    order of the layout, and an absent value as None."""
    if value is None:
        return "'-'"
    if isinstance(value, dict):
        parts = [f"'{name}=', {canonical(v)}" for name, v in value.items()]
        return "concat('{', " + ", ',', ".join(parts) + ", '}')"
    return f"coalesce(length({value}) || ':' || {value}, '-')"


def digest(values: dict) -> str:
    parts = [f"'{name}=', {canonical(v)}" for name, v in values.items()]
    return "sha256(concat(" + ", ',', ".join(parts) + "))"


def key_id(kind: str, *parts: str) -> str:
    """The deterministic id of a key tuple."""
    tagged = [f"'{len(kind)}:{kind}'"] + [
        f"coalesce(length({p}) || ':' || {p}, '-')" for p in parts
    ]
    return "md5(" + " || '#' || ".join(tagged) + ")"


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
