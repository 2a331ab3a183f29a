"""The complete loads, backfills and the incremental ingest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.catalog import query
from rostermill.catalog import sql as S
from rostermill.catalog import tables as B
from rostermill.catalog.changes import (
    COMPARE,
    PERSON_STEP,
    _FIRST_ELIGIBILITY,
    _FIRST_PATIENT,
    _FIRST_POLICY,
)
from rostermill.codes import relationship_table
from rostermill.operators.registry import raw_dump
from rostermill.plans import backfill as PB
from rostermill.plans import claims as PC
from rostermill.operators.children import PART_ROWS
from rostermill.plans.eligibility import load_eligibility as load_coverage
from rostermill.plans.jobs import Ingest
from rostermill.plans.run import FolderRun, LazyRun, Result
from rostermill.schemas import LINE_FIELDS, ORDINAL
from rostermill.skew import by_shuffle
from rostermill.storage import TableStore
from rostermill.streaming.incremental import Parsed, stream_claim_rows
from rostermill.workdir import fresh_folder

# --- eligibility -----------------------------------------------------------

_LOAD = S.with_views(
    S.PERSONS_IN, S.PERSONS_STORED, S.COVERAGE, S.SUBSCRIBERS_STORED, S.PATIENTS_STORED,
    S.ELIGIBILITIES_STORED, PERSON_STEP, _FIRST_POLICY, _FIRST_PATIENT, _FIRST_ELIGIBILITY,
    f"""enrollees AS (
  SELECT id, enrollee_id AS ref, TRUE AS complete, 1 AS n,
    concat_ws(' ', first_name, middle_name, last_name) AS name
  FROM person_step WHERE action <> 'no_action'
  UNION ALL
  SELECT id, ref, complete, 0, concat_ws(' ', first_name, last_name) FROM persons_stored
  WHERE id NOT IN (SELECT id FROM person_step WHERE action <> 'no_action')
  UNION ALL
  SELECT {S.key_id('enrollee', 'insured_id')}, insured_id, FALSE, 1, '' FROM policy
  WHERE insured_id NOT IN (SELECT ref FROM persons_stored)
    AND insured_id NOT IN (SELECT enrollee_id FROM person_step WHERE action <> 'no_action')
  GROUP BY insured_id)""",
    f"""subscriber_step AS (
  SELECT coalesce(s.id, {S.key_id('subscriber', 'c.subscriber_id', 'c.insured_id')}) AS id,
    c.subscriber_id, c.insured_id, e.complete, e.name, e.id AS ref,
    {COMPARE.format(complete='e.complete')} AS action
  FROM policy c JOIN enrollees e ON c.insured_id = e.ref
  LEFT JOIN subscribers_stored s ON c.subscriber_id = s.subscriber_id
    AND c.insured_id = s.insured_id)""",
    """subscribers AS (
  SELECT id, subscriber_id, insured_id, complete, name, ref, 1 AS n FROM subscriber_step
  WHERE action <> 'no_action'
  UNION ALL
  SELECT id, subscriber_id, insured_id, TRUE, name, 'e' || insured_id, 0 FROM subscribers_stored
  WHERE id NOT IN (SELECT id FROM subscriber_step WHERE action <> 'no_action'))""",
    """first_subscriber AS (SELECT * FROM subscribers QUALIFY row_number() OVER (
    PARTITION BY subscriber_id ORDER BY id) = 1)""",
    f"""patient_step AS (
  SELECT coalesce(s.id, {S.key_id('patient', 'c.enrollee_id', 'c.subscriber_id', 'c.member_id')})
      AS id, c.enrollee_id, c.subscriber_id, c.member_id, u.id AS ref, u.name,
    e.complete AND u.complete AS complete, e.id IS NULL AS orphan,
    {COMPARE.format(complete='(coalesce(e.complete, FALSE) AND u.complete)')} AS action
  FROM patient_in c LEFT JOIN enrollees e ON c.enrollee_id = e.ref
  JOIN first_subscriber u ON c.subscriber_id = u.subscriber_id
  LEFT JOIN patients_stored s ON c.enrollee_id = s.enrollee_id
    AND c.subscriber_id = s.subscriber_id AND c.member_id = s.member_id)""",
    """patients AS (
  SELECT id, enrollee_id, subscriber_id, member_id, complete, ref, 1 AS n FROM patient_step
  WHERE NOT orphan AND action <> 'no_action'
  UNION ALL
  SELECT id, enrollee_id, subscriber_id, member_id, TRUE, subscriber_ref, 0 FROM patients_stored
  WHERE id NOT IN (SELECT id FROM patient_step WHERE NOT orphan AND action <> 'no_action'))""",
    f"""eligibility_step AS (
  SELECT coalesce(s.id, {S.key_id('eligibility', 'c.enrollee_id', 'c.product_id',
        'c.subscriber_id', 'c.member_id', 'c.effective', 'c.ends')}) AS id,
    c.enrollee_id || '|' || c.product_id || '|' || c.subscriber_id || '|' || c.member_id || '|'
      || c.effective || '|' || coalesce(c.ends, '') AS row_key,
    p.id AS ref, coalesce(e.complete AND u.complete AND p.complete, FALSE) AS complete,
    CASE WHEN e.id IS NULL THEN 'enrollee not found' WHEN u.id IS NULL
      THEN 'subscriber not found' WHEN p.id IS NULL THEN 'patient not found' END AS reason,
    {COMPARE.format(complete='coalesce(e.complete AND u.complete AND p.complete, FALSE)')} AS action
  FROM eligibility_in c LEFT JOIN enrollees e ON c.enrollee_id = e.ref
  LEFT JOIN subscribers u ON c.subscriber_id = u.subscriber_id AND c.insured_id = u.insured_id
  LEFT JOIN patients p ON c.enrollee_id = p.enrollee_id AND c.subscriber_id = p.subscriber_id
    AND c.member_id = p.member_id
  LEFT JOIN eligibilities_stored s ON c.enrollee_id = s.enrollee_id
    AND c.product_id = s.product_id AND c.subscriber_id = s.subscriber_id
    AND c.member_id = s.member_id AND c.effective = s.effective
    AND c.ends IS NOT DISTINCT FROM s.ends)""",
)


@query(
    _LOAD
    + """SELECT 'enrollee' AS step, id, complete, n AS n_documents, ref FROM enrollees
UNION ALL SELECT 'subscriber', id, complete, n, ref FROM subscribers
UNION ALL SELECT 'patient', id, complete, n, ref FROM patients
UNION ALL SELECT 'eligibility', id, complete, 1, ref FROM eligibility_step
  WHERE reason IS NULL AND action <> 'no_action'
UNION ALL SELECT 'eligibility', id, TRUE, 0, NULL FROM eligibilities_stored WHERE id NOT IN
  (SELECT id FROM eligibility_step WHERE reason IS NULL AND action <> 'no_action')
UNION ALL SELECT 'reject patient', enrollee_id || '|' || subscriber_id || '|' || member_id, FALSE, 0,
  'enrollee not found' FROM patient_step WHERE orphan
UNION ALL SELECT 'reject eligibility', row_key, FALSE, 0, reason FROM eligibility_step
  WHERE reason IS NOT NULL"""
)
def load_eligibility(spark: SparkSession, folder: str) -> DataFrame:
    """Stored tables after both sheets were loaded, and the rejected rows."""
    run = FolderRun(
        {
            "enrollee": B.persons_stored(spark, folder),
            "subscriber": B.subscribers_stored(spark, folder),
            "patient": B.patients_stored(spark, folder),
            "eligibility": B.eligibilities_stored(spark, folder),
        },
        fresh_folder(spark, "loads"),
    )
    result = load_coverage(
        B.persons_in(spark, folder),
        B.coverage_in(spark, folder),
        run,
        B.fixed_lineage(spark, "persons", "coverage"),
        relationship_table(spark),
    )
    refs = {
        "enrollee": "referenceId",
        "subscriber": "enrollee.refId",
        "patient": "subscriber.refId",
        "eligibility": "patient.refId",
    }
    out = result.rejects.select(
        F.concat(F.lit("reject "), "step").alias("step"),
        F.col("row_key").alias("id"),
        F.lit(False).alias("complete"),
        F.lit(0).alias("n_documents"),
        F.col("reason").alias("ref"),
    )
    for step, ref in refs.items():
        docs = result.current[step].select(
            F.lit(step).alias("step"),
            F.col("_id").alias("id"),
            F.col("hasCompleteInfo").alias("complete"),
            F.coalesce(F.size("ardbDocuments"), F.lit(0)).alias("n_documents"),
            F.col(ref).alias("ref"),
        )
        out = out.unionByName(docs)
    return out


# --- claims ----------------------------------------------------------------


def _stored_children(before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Diagnoses and lines of the earlier input, as a first load stores them."""
    rows, spark = PC.claim_rows(before), before.sparkSession
    none = spark.createDataFrame([], "CLAIM_ID string, DIAGNOSIS_CODE string")
    diagnoses = PC.new_diagnoses(rows, none, 0)
    blank = spark.createDataFrame([], ", ".join(f"{c} string" for c in ["CLAIM_ID", *LINE_FIELDS]))
    return diagnoses, PC.new_lines(rows, blank, LazyRun({}, 0), single_file=True)


def _load_claims(
    spark: SparkSession, folder: str, seen: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> Result:
    """Open lines over fulfilled ones. Both inputs are read many times, so they
    are written first, with the columns of the scan; a load takes them as ``seen``."""
    run = FolderRun({}, fresh_folder(spark, "loads"))
    diagnoses, lines = _stored_children(run.cut("claims_before", B.claims_before(spark, folder)))
    rows = run.cut("claims_in", B.claims_in(spark, folder))
    run.tables = {
        "claim": B.claims_stored(spark, folder),
        "claim_diagnosis": diagnoses,
        "claim_line": lines,
    }
    return PC.load_claims(PC.claim_rows(seen(rows)), run, B.fixed_lineage(spark, "claims"))


def _heads(name: str, rows: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT * FROM {rows} QUALIFY row_number() OVER (
      PARTITION BY claim_id, diagnosis ORDER BY {S.ORD}) = 1)
  QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY o1 DESC, o2 DESC, o3 DESC) = 1)"""


#: claims after open lines came over ones that were only stored
_OVER_STORED = """old_ids AS (SELECT DISTINCT claim_id, claim_status, insured_id FROM claims_before),
claims AS (
  SELECT claim_id, claim_status, provider_id, 1 AS n FROM heads
  UNION ALL
  SELECT claim_id, claim_status, NULL, 0 FROM old_ids
  WHERE claim_id NOT IN (SELECT claim_id FROM heads))"""

#: claims after both inputs were loaded, one after the other
_OVER_LOADED = f"""{_heads('old_heads', 'claims_before')},
claims AS (
  SELECT claim_id, claim_status, provider_id,
    CASE WHEN claim_id IN (SELECT claim_id FROM old_heads) THEN 2 ELSE 1 END AS n FROM heads
  UNION ALL
  SELECT claim_id, claim_status, provider_id, 1 FROM old_heads
  WHERE claim_id NOT IN (SELECT claim_id FROM heads))"""


def _claims_sql(item: str, claims: str = _OVER_STORED, more: str = "") -> str:
    return (
        S.with_views(S.CLAIMS)
        + f""", {_heads('heads', 'claims_in')},
{claims},
old_codes AS (SELECT *, 0 AS run FROM claims_before QUALIFY row_number() OVER (
    PARTITION BY claim_id, diagnosis ORDER BY {S.ORD}) = 1),
new_codes AS (SELECT *, 1 AS run FROM claims_in QUALIFY row_number() OVER (
    PARTITION BY claim_id, diagnosis ORDER BY {S.ORD}) = 1),
codes AS (SELECT claim_id, part, string_agg(coalesce(diagnosis, '?'), ',' ORDER BY run, {S.ORD}) AS codes
  FROM (SELECT *, (row_number() OVER (PARTITION BY claim_id ORDER BY run, {S.ORD}) - 1) // {PART_ROWS} AS part
    FROM (SELECT * FROM old_codes UNION ALL SELECT * FROM new_codes n WHERE NOT EXISTS (
      SELECT 1 FROM old_codes o WHERE o.claim_id = n.claim_id
        AND o.diagnosis IS NOT DISTINCT FROM n.diagnosis))) GROUP BY claim_id, part),
old_lines AS (SELECT * FROM claims_before QUALIFY row_number() OVER (
    PARTITION BY claim_id, code, service_date ORDER BY {S.ORD}) = 1),
new_lines AS (SELECT n.* REPLACE (coalesce(n.modifier1, o.modifier1) AS modifier1,
    coalesce(n.modifier2, o.modifier2) AS modifier2)
  FROM (SELECT * FROM claims_in QUALIFY row_number() OVER (
    PARTITION BY claim_id, code, service_date ORDER BY {S.ORD}) = 1) n
  LEFT JOIN old_lines o ON o.claim_id = n.claim_id AND o.code = n.code
    AND o.service_date = n.service_date),
all_lines AS (SELECT *, 0 AS old FROM new_lines UNION ALL SELECT *, 1 FROM old_lines
  WHERE claim_id NOT IN (SELECT claim_id FROM claims_in)),
lines AS (SELECT claim_id, part, count(*) AS n_lines,
    string_agg(code || service_date || {item}
      || coalesce(modifier1, '-') || coalesce(modifier2, '-'), ',' ORDER BY {S.ORD}) AS lines
  FROM (SELECT *, (row_number() OVER (PARTITION BY claim_id ORDER BY {S.ORD}) - 1) // {PART_ROWS} AS part
    FROM all_lines) GROUP BY claim_id, part)
SELECT claim_id, part, claim_status AS status, provider_id AS provider, n AS n_documents,
  coalesce(codes, '') AS codes, coalesce(n_lines, 0) AS n_lines, coalesce(lines, '') AS lines{more}
FROM claims JOIN (codes FULL JOIN lines USING (claim_id, part)) USING (claim_id)"""
    )


def _claims_view(claims: DataFrame, diagnoses: DataFrame, service_lines: DataFrame) -> DataFrame:
    docs = PC.assemble_claims(claims, diagnoses, service_lines)
    codes = F.transform("DIAGNOSIS_CODES", lambda d: F.coalesce(d["DIAGNOSIS_CODE"], F.lit("?")))
    lines = F.transform(
        "SERVICE_LINES",
        lambda x: F.concat(
            x["CODE"], x["DATE_OF_SERVICE"], x["ITEM_NUMBER"],
            F.coalesce(x["MODIFIER1"], F.lit("-")), F.coalesce(x["MODIFIER2"], F.lit("-")),
        ),
    )
    return docs.select(
        F.col("CLAIM_ID").alias("claim_id"),
        "part",
        F.col("CLAIM_STATUS").alias("status"),
        F.col("RENDERING_PROVIDER_INFO.PROVIDER_ID").alias("provider"),
        F.coalesce(F.size("ardbDocuments"), F.lit(0)).alias("n_documents"),
        F.concat_ws(",", codes).alias("codes"),
        F.size("SERVICE_LINES").cast("bigint").alias("n_lines"),
        F.concat_ws(",", lines).alias("lines"),
    )


def _view(result: Result) -> DataFrame:
    current = result.current
    return _claims_view(current["claim"], current["claim_diagnosis"], current["claim_line"])


_ITEM = "(CASE WHEN item = '' THEN sh_item ELSE item END)"


@query(_claims_sql(_ITEM))
def load_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claim documents after open lines were loaded over fulfilled ones."""
    return _view(_load_claims(spark, folder))


@query(_claims_sql("CASE WHEN old = 1 AND item <> '' THEN item ELSE sh_item END"))
def load_claims_workbook(spark: SparkSession, folder: str) -> DataFrame:
    """The workbook form: item numbers come under their second name, and the
    rows pass through the raw dump."""

    def dumped(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("ITEM_NUMBER", F.lit(None).cast("string"))
        dump = raw_dump(PC.claim_rows(rows), F.lit("2024-01-01").cast("timestamp_ntz"))
        return dump.drop("undeclared", "ardbSourceDocument", "ardbLastModifiedDate")

    return _view(_load_claims(spark, folder, dumped))


@query(
    S.with_views(S.CLAIMS)
    + f""", stored AS (SELECT DISTINCT claim_id, insured_id FROM claims_before),
incoming AS (SELECT claim_id, provider_id FROM claims_in QUALIFY row_number() OVER (
  PARTITION BY claim_id ORDER BY {S.ORD}) = 1)
SELECT s.claim_id, coalesce(i.provider_id, s.insured_id) AS insured,
  CASE WHEN i.provider_id IS DISTINCT FROM s.insured_id AND i.claim_id IS NOT NULL THEN 1 ELSE 0 END
    AS n_documents
FROM stored s LEFT JOIN incoming i ON s.claim_id = i.claim_id"""
)
def correct_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Insured ids of stored claims set from a correction input."""
    rows = B.claims_in(spark, folder).select(
        "CLAIM_ID", F.col("PROVIDER_ID").alias("INSURED_ENROLLEE_ID"), "_file", "_block", "_line"
    )
    run = LazyRun({"claim": B.claims_stored(spark, folder)})
    result = PC.correct_claims(rows, run, B.fixed_lineage(spark, "claims"))
    return result.current["claim"].select(
        F.col("CLAIM_ID").alias("claim_id"),
        F.col("SUBSCRIBER_INFO.INSURED_ENROLLEE_ID").alias("insured"),
        F.coalesce(F.size("ardbDocuments"), F.lit(0)).alias("n_documents"),
    )


# --- backfills -------------------------------------------------------------


@query(
    S.with_views(S.ALL_COVERAGE, S.SUBSCRIBERS_STORED, S.PATIENTS_STORED)
    + """SELECT p.id, s.name AS subscriber_name FROM patients_stored p
LEFT JOIN subscribers_stored s ON p.subscriber_ref = s.id"""
)
def backfill_names(spark: SparkSession, folder: str) -> DataFrame:
    run = LazyRun(
        {
            "patient": B.patients_stored(spark, folder, whole=True),
            "subscriber": B.subscribers_stored(spark, folder, whole=True),
        },
        guard_skew=True,
    )
    out = PB.backfill_names(run).current["patient"]
    return out.select(F.col("_id").alias("id"), F.col("subscriber.name").alias("subscriber_name"))


@query(
    S.with_views(S.ALL_COVERAGE, S.ELIGIBILITIES_STORED)
    + """, last AS (SELECT CAST(p_size AS VARCHAR) AS ref, arg_max(p_name, p_partkey) AS name
  FROM part GROUP BY 1)
SELECT id, name AS product_name, strftime(updated_at, '%Y-%m-%d') AS dob
FROM eligibilities_stored LEFT JOIN last ON ref = product_id"""
)
def backfill_product_and_date(spark: SparkSession, folder: str) -> DataFrame:
    run = LazyRun(
        {
            "eligibility": B.eligibilities_stored(spark, folder, whole=True),
            "product": B.products(spark, folder),
        },
        guard_skew=True,
    )
    out = PB.backfill_products_and_dates(run).current["eligibility"]
    return out.select(
        F.col("_id").alias("id"),
        F.col("product.name").alias("product_name"),
        F.col("patient.formattedDob").alias("dob"),
    )


# --- incremental -----------------------------------------------------------


@query(
    _claims_sql(
        _ITEM,
        _OVER_LOADED,
        ", CASE WHEN claim_id IN (SELECT claim_id FROM claims_in) THEN 1 ELSE 0 END AS run",
    )
)
def incremental_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Claim documents after two batches of a stream, one over the other.

    Fulfilled line items arrive and are taken as the first batch, open ones
    after that as the second; the stream's checkpoint and the store carry what
    the first left. A claim's rows are in one file, in input order.
    """
    place = fresh_folder(spark, "loads")
    store = TableStore(spark, f"{place}/store")
    landing, seen = f"{place}/landing", f"{place}/checkpoint"
    arriving = [B.claims_before(spark, folder), B.claims_in(spark, folder)]
    schema = arriving[0].drop(*ORDINAL).schema

    def parse(batch: DataFrame, run: int) -> Parsed:
        return Parsed(batch)

    for rows in arriving:
        files = rows.repartition("CLAIM_ID").sortWithinPartitions("CLAIM_ID", "_line").drop(*ORDINAL)
        files.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1_000).parquet(landing)
        stream_claim_rows(Ingest(store), stream, parse, seen).awaitTermination()
    service_lines = store.read("claim_line")
    runs = service_lines.groupBy(F.col("CLAIM_ID").alias("claim_id")).agg(F.max("_run").cast("int").alias("run"))
    view = _claims_view(store.read("claim"), store.read("claim_diagnosis"), service_lines)
    return view.join(by_shuffle(runs), "claim_id")
