"""Projection, cleaning, nesting and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.catalog import query
from rostermill.catalog import sql as S
from rostermill.catalog import tables as B
from rostermill.operators import clean as C
from rostermill.operators import nest as N
from rostermill.operators.match import code_lookup, lookup
from rostermill.operators.registry import with_lineage
from rostermill.codes import RELATIONSHIPS, relationship_table
from rostermill.functions.digests import row_digest
from rostermill.plans.eligibility import _PATIENT, _PERSON, _POLICY
from rostermill.schemas import CLAIM_FIELDS, CLAIM_GROUPS, LINE_FIELDS

LABELS = "(VALUES " + ", ".join(
    "('" + c + "', '" + label.replace("'", "''") + "')" for c, label in RELATIONSHIPS.items()
) + ") AS codes(code, label)"


@query("SELECT l_orderkey, l_linenumber, l_shipdate IS NULL AS no_date FROM lineitem")
def project_columns(spark: SparkSession, folder: str) -> DataFrame:
    lines = B.table(spark, folder, "lineitem")
    out = C.project_columns(lines, ["l_orderkey", "l_linenumber", "l_shipdate"])
    return out.select("l_orderkey", "l_linenumber", F.col("l_shipdate").isNull().alias("no_date"))


@query(
    """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
  CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, CAST(NULL AS VARCHAR) AS absent
FROM lineitem
"""
)
def enforce_string_schema(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"]
    lines = B.table(spark, folder, "lineitem")
    return C.enforce_string_schema(lines, [*columns, "absent"], required=columns)


@query(
    """
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE event_type END AS kind,
  CASE WHEN value < 2 THEN NULL ELSE value END AS value
FROM events
"""
)
def normalize_nulls(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    rows = B.table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "click", F.lit(" N/A ")).when(kind == "view", F.lit("")).otherwise(kind)
        .alias("kind"),
        F.when(F.col("value") < 2, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )
    return C.normalize_nulls(rows)


@query('SELECT l_orderkey AS "claim.id", l_linenumber AS item FROM lineitem')
def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    lines = B.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return C.rename_columns(lines, {"l_orderkey": "claim.id", "l_linenumber": "item"})


@query("SELECT p_partkey, p_name FROM part")
def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    part = B.table(spark, folder, "part")
    return C.drop_columns(part, ["p_brand", "p_type", "p_size", "p_retailprice"])


@query(
    S.with_views(S.ALL_PERSONS_IN)
    + """SELECT 'n' || enrollee_id AS id, enrollee_id AS reference, last_name, gender,
  '1980-01-02' AS dob, '01/02/1980' AS formatted_dob, state, state AS county,
  TRUE AS complete, modified, '1-persons' AS source, 1 AS n_documents
FROM persons_in"""
)
def nest_person(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_lineage(B.persons_in(spark, folder, whole=True), B.fixed_lineage(spark, "persons"))
    out = N.nest_person(rows.withColumn("_id", F.concat(F.lit("n"), "ENROLLEE_ID")))
    return out.select(
        F.col("_id").alias("id"),
        F.col("referenceId").alias("reference"),
        F.col("demographic.lastName").alias("last_name"),
        F.col("demographic.gender").alias("gender"),
        B.day("demographic.dob").alias("dob"),
        F.col("demographic.formattedDob").alias("formatted_dob"),
        F.col("demographic.address.state").alias("state"),
        F.col("additionalInformation.countyId").alias("county"),
        F.col("hasCompleteInfo").alias("complete"),
        B.day("updated.at").alias("modified"),
        F.col("ardbSourceDocument").alias("source"),
        F.size("ardbDocuments").alias("n_documents"),
    )


def _subscriber_view(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("_id").alias("id"),
        F.col("enrollee.referenceId").alias("enrollee"),
        F.col("insuredEnrollee.referenceId").alias("insured"),
        F.col("subscriberNumber").alias("number"),
        F.col("premiumGroup.referenceId").alias("premium_group"),
        B.day("employment.startDate").alias("start_date"),
        F.col("employment.formattedTerminationDate").alias("end_text"),
        F.col("demographic.lastName").alias("last_name"),
        F.col("demographic.gender").alias("gender"),
        B.day("created.at").alias("created"),
    )


@query(
    S.with_views(S.ALL_COVERAGE)
    + """SELECT CAST(ord AS VARCHAR) AS id, enrollee_id AS enrollee, insured_id AS insured,
  subscriber_id AS number, status AS premium_group, effective AS start_date, ends AS end_text,
  CAST(NULL AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS gender,
  CAST(NULL AS VARCHAR) AS created
FROM coverage_in"""
)
def nest_subscriber_row(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.coverage_in(spark, folder, whole=True).withColumn("_id", B.text("_line"))
    return _subscriber_view(N.nest_subscriber_row(rows))


@query(
    S.with_views(S.ALL_COVERAGE, S.ALL_PERSONS_STORED)
    + """SELECT CAST(ord AS VARCHAR) AS id, p.ref AS enrollee, p.ref AS insured,
  subscriber_id AS number, status AS premium_group, effective AS start_date, ends AS end_text,
  last_name, gender, created
FROM coverage_in LEFT JOIN persons_stored p ON insured_id = p.ref"""
)
def nest_subscriber_enrollee(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.coverage_in(spark, folder, whole=True).withColumn("_id", B.text("_line"))
    joined = lookup(
        rows, B.persons_stored(spark, folder, whole=True), {"INSURED_ENROLLEE_ID": "referenceId"},
        _PERSON, "enrollee",
    )
    return _subscriber_view(N.nest_subscriber_enrollee(joined))


@query(
    S.with_views(S.COVERAGE, S.PERSONS_STORED, S.SUBSCRIBERS_STORED)
    + f""", labels AS (SELECT * FROM {LABELS})
SELECT CAST(ord AS VARCHAR) AS id, p.id AS enrollee_ref, p.ssn AS ssn, p.last_name AS last_name,
  s.id AS subscriber_ref, s.subscriber_id AS number, coalesce(s.name, '') AS subscriber_name,
  c.member_id AS member, c.relationship AS code, coalesce(l.label, '') AS label
FROM coverage_in c LEFT JOIN persons_stored p ON c.enrollee_id = p.ref
LEFT JOIN subscribers_stored s ON c.subscriber_id = s.subscriber_id AND c.insured_id = s.insured_id
LEFT JOIN labels l ON l.code = c.relationship"""
)
def nest_patient(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.coverage_in(spark, folder).withColumn("_id", B.text("_line"))
    step = lookup(
        rows, B.persons_stored(spark, folder), {"ENROLLEE_ID": "referenceId"}, _PERSON, "enrollee"
    )
    step = lookup(
        step, B.subscribers_stored(spark, folder),
        {"SUBSCRIBER_ID": "subscriberNumber", "INSURED_ENROLLEE_ID": "enrollee.referenceId"},
        _POLICY, "subscriber",
    ).withColumn("subscriber", F.col("subscriber").withField(
        "name", F.coalesce(F.col("subscriber.name"), F.lit(""))))
    labelled = code_lookup(step, relationship_table(spark), "RELATIONSHIP_CODE", "relationship_label")
    out = N.nest_patient(labelled)
    return out.select(
        F.col("_id").alias("id"),
        F.col("enrollee.refId").alias("enrollee_ref"),
        "ssn",
        F.col("demographic.lastName").alias("last_name"),
        F.col("subscriber.refId").alias("subscriber_ref"),
        F.col("subscriber.identificationCode").alias("number"),
        F.coalesce(F.col("subscriber.name"), F.lit("")).alias("subscriber_name"),
        F.col("memberId").alias("member"),
        F.col("relationship.codeQualifier").alias("code"),
        F.col("relationship.label").alias("label"),
    )


@query(
    S.with_views(S.COVERAGE, S.PERSONS_STORED, S.SUBSCRIBERS_STORED, S.PATIENTS_STORED)
    + """SELECT CAST(ord AS VARCHAR) AS id, p.id AS enrollee_ref, c.product_id AS product,
  c.effective AS start_date, c.ends AS end_text, s.id AS subscriber_ref, t.id AS patient_ref,
  t.enrollee_id AS patient_name, CASE WHEN t.id IS NOT NULL THEN '1980-01-02' END AS dob_text,
  0 AS n_other
FROM coverage_in c LEFT JOIN persons_stored p ON c.enrollee_id = p.ref
LEFT JOIN subscribers_stored s ON c.subscriber_id = s.subscriber_id AND c.insured_id = s.insured_id
LEFT JOIN patients_stored t ON t.enrollee_id = c.enrollee_id AND t.subscriber_id = c.subscriber_id
  AND t.member_id = c.member_id"""
)
def nest_eligibility(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.coverage_in(spark, folder).withColumn("_id", B.text("_line"))
    step = lookup(
        rows, B.persons_stored(spark, folder), {"ENROLLEE_ID": "referenceId"}, _PERSON, "enrollee"
    )
    step = lookup(
        step, B.subscribers_stored(spark, folder),
        {"SUBSCRIBER_ID": "subscriberNumber", "INSURED_ENROLLEE_ID": "enrollee.referenceId"},
        _POLICY, "subscriber",
    )
    step = lookup(
        step, B.patients_stored(spark, folder),
        {
            "ENROLLEE_ID": "enrollee.referenceId",
            "SUBSCRIBER_ID": "subscriber.identificationCode",
            "MEMBER_ID": "memberId",
        },
        _PATIENT, "patient",
    )
    out = N.nest_eligibility(step)
    return out.select(
        F.col("_id").alias("id"),
        F.col("enrollee.refId").alias("enrollee_ref"),
        F.col("product.referenceId").alias("product"),
        B.day("serviceDate.startDate").alias("start_date"),
        F.col("serviceDate.formattedEndDate").alias("end_text"),
        F.col("subscriber.refId").alias("subscriber_ref"),
        F.col("patient.refId").alias("patient_ref"),
        F.col("patient.name").alias("patient_name"),
        F.col("patient.formattedDob").alias("dob_text"),
        F.size("additionalInformation.otherInformation").alias("n_other"),
    )


#: a whole header document and a whole line in SQL: layout path → value
_CLAIM_HEADER = (
    {"_id": "billed"}
    | {c: S.claim_column(c) for c in CLAIM_FIELDS}
    | {group: {c: S.claim_column(c) for c in names} for group, names in CLAIM_GROUPS.items()}
    | {"ardbDocuments": None, "ardbSourceDocument": None, "ardbLastModifiedDate": None}
)
_LINE = {c: S.claim_column(c) for c in LINE_FIELDS} | {
    "ITEM_NUMBER": "(CASE WHEN item = '' THEN sh_item ELSE item END)"
}


@query(
    S.with_views(S.CLAIMS)
    + """SELECT claim_id, claim_status AS status, category, provider_id AS provider,
  insured_id AS insured, CAST(NULL AS VARCHAR) AS market, billed AS row_key
FROM claim_input"""
)
def nest_claim_header(spark: SparkSession, folder: str) -> DataFrame:
    """Some fields of the documents; :func:`digest_claim_header` has all."""
    rows = B.claim_input(spark, folder).withColumn("_id", F.col("BILLED_AMOUNT"))
    out = N.nest_claim_header(rows)
    return out.select(
        F.col("CLAIM_ID").alias("claim_id"),
        F.col("CLAIM_STATUS").alias("status"),
        F.col("CLAIM_CATEGORY").alias("category"),
        F.col("RENDERING_PROVIDER_INFO.PROVIDER_ID").alias("provider"),
        F.col("SUBSCRIBER_INFO.INSURED_ENROLLEE_ID").alias("insured"),
        F.col("MARKET_INFO.MARKET_ID").alias("market"),
        F.col("_id").alias("row_key"),
    )


@query(
    S.with_views(S.CLAIMS)
    + f"""SELECT claim_id, billed AS row_key, {S.digest(_CLAIM_HEADER)} AS digest
FROM claim_input"""
)
def digest_claim_header(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of whole header documents, all 179 values of the layout."""
    rows = B.wide_claim_input(spark, folder).withColumn("_id", F.col("BILLED_AMOUNT"))
    out = N.nest_claim_header(rows)
    return out.select(
        F.col("CLAIM_ID").alias("claim_id"),
        F.col("_id").alias("row_key"),
        row_digest(out.schema).alias("digest"),
    )


@query(
    S.with_views(S.CLAIMS)
    + """SELECT claim_id, diagnosis AS code, description, CAST(NULL AS VARCHAR) AS poa
FROM claim_input"""
)
def nest_diagnosis(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.claim_input(spark, folder)
    out = rows.select("CLAIM_ID", N.nest_diagnosis(rows).alias("d"))
    return out.select(
        F.col("CLAIM_ID").alias("claim_id"),
        F.col("d.DIAGNOSIS_CODE").alias("code"),
        F.col("d.DIAGNOSIS_DESCRIPTION").alias("description"),
        F.col("d.POA_INDICATOR").alias("poa"),
    )


@query(
    S.with_views(S.CLAIMS)
    + """SELECT claim_id, code, service_date, quantity, billed,
  CASE WHEN item = '' THEN sh_item ELSE item END AS item, modifier1, modifier2,
  CAST(NULL AS VARCHAR) AS auth
FROM claim_input"""
)
def nest_service_line(spark: SparkSession, folder: str) -> DataFrame:
    """Some fields of the lines; :func:`digest_service_line` has all."""
    rows = B.claim_input(spark, folder)
    out = rows.select("CLAIM_ID", N.nest_service_line(rows).alias("s"))
    return out.select(
        F.col("CLAIM_ID").alias("claim_id"),
        F.col("s.CODE").alias("code"),
        F.col("s.DATE_OF_SERVICE").alias("service_date"),
        F.col("s.QUANTITY").alias("quantity"),
        F.col("s.BILLED_AMOUNT").alias("billed"),
        F.col("s.ITEM_NUMBER").alias("item"),
        F.col("s.MODIFIER1").alias("modifier1"),
        F.col("s.MODIFIER2").alias("modifier2"),
        F.col("s.AUTH_ID").alias("auth"),
    )


@query(
    S.with_views(S.CLAIMS)
    + f"""SELECT claim_id, code, {S.digest(_LINE)} AS digest FROM claim_input"""
)
def digest_service_line(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of whole service lines, all 95 fields."""
    rows = B.wide_claim_input(spark, folder)
    out = rows.select("CLAIM_ID", N.nest_service_line(rows).alias("s"))
    # a field of a struct is looked up each time that it is named, a column is not
    lines = out.select("CLAIM_ID", "s.*")
    return lines.select(
        F.col("CLAIM_ID").alias("claim_id"),
        F.col("CODE").alias("code"),
        row_digest(out.schema["s"].dataType).alias("digest"),
    )


@query(
    """
SELECT 'd' || doc_id AS document_id, doc_id || '.rpt' AS name, '.rpt' AS extension,
  'rpt' AS file_type, '9-' || doc_id || '.rpt' AS stored, FALSE AS reconciled, n_chars AS size,
  'aws_s3' AS source
FROM documents
"""
)
def lineage_struct(spark: SparkSession, folder: str) -> DataFrame:
    from rostermill.operators.registry import lineage_struct as build

    doc = B.text("doc_id")
    name = F.concat(doc, F.lit(".rpt"))
    registered = B.table(spark, folder, "documents").select(
        doc.alias("path"),
        F.concat(F.lit("d"), doc).alias("_id"),
        name.alias("originalName"),
        F.concat(F.lit("9-"), name).alias("fileName"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("receivedAt"),
        F.struct(
            F.lit(None).cast("string").alias("destination"), F.col("n_chars").alias("size")
        ).alias("metadata"),
    )
    out = build(registered, "rpt").select("lineage.*")
    return out.select(
        F.col("documentId").alias("document_id"),
        F.col("originalName").alias("name"),
        F.col("fileExtension").alias("extension"),
        F.col("fileType").alias("file_type"),
        F.col("fileName").alias("stored"),
        F.col("isReconciled").alias("reconciled"),
        "metadata.size",
        "metadata.source",
    )


@query(
    S.with_views(S.ALL_PERSONS_STORED)
    + """SELECT id, complete, ref AS enrollee_id, last_name, first_name,
  CAST(NULL AS VARCHAR) AS middle_name, CASE gender WHEN 'MALE' THEN 'M' ELSE 'F' END AS gender,
  ssn, state, state AS county, '1998-01-01' AS modified
FROM persons_stored"""
)
def flatten_person(spark: SparkSession, folder: str) -> DataFrame:
    out = N.flatten_person(B.persons_stored(spark, folder, whole=True))
    return out.select(
        F.col("_id").alias("id"),
        F.col("hasCompleteInfo").alias("complete"),
        F.col("ENROLLEE_ID").alias("enrollee_id"),
        F.col("LAST_NAME").alias("last_name"),
        F.col("FIRST_NAME").alias("first_name"),
        F.col("MIDDLE_NAME").alias("middle_name"),
        F.col("GENDER").alias("gender"),
        F.col("SS_NUMBER").alias("ssn"),
        F.col("STATE").alias("state"),
        F.col("COUNTY_ID").alias("county"),
        B.day("LAST_MODIFIED_DATE_TIME").alias("modified"),
    )


@query(
    S.with_views(S.ALL_COVERAGE, S.SUBSCRIBERS_STORED)
    + """SELECT id, TRUE AS complete, insured_id AS enrollee_id, insured_id, subscriber_id,
  insured_id AS last_name, subscriber_id AS first_name, CAST(NULL AS VARCHAR) AS zip
FROM subscribers_stored"""
)
def flatten_subscriber(spark: SparkSession, folder: str) -> DataFrame:
    out = N.flatten_subscriber(B.subscribers_stored(spark, folder, whole=True))
    return out.select(
        F.col("_id").alias("id"),
        F.col("hasCompleteInfo").alias("complete"),
        F.col("EL_ENROLLEE_ID").alias("enrollee_id"),
        F.col("EL_INSURED_ENROLLEE_ID").alias("insured_id"),
        F.col("SUBSCRIBER_ID").alias("subscriber_id"),
        F.col("LAST_NAME").alias("last_name"),
        F.col("FIRST_NAME").alias("first_name"),
        F.col("ZIP").alias("zip"),
    )


@query(
    S.with_views(S.ALL_COVERAGE, S.PATIENTS_STORED)
    + """SELECT enrollee_id, CAST(NULL AS VARCHAR) AS relationship, member_id, subscriber_id,
  strftime(updated_at, '%Y-%m-%d') AS modified
FROM patients_stored"""
)
def flatten_patient(spark: SparkSession, folder: str) -> DataFrame:
    out = N.flatten_patient(B.patients_stored(spark, folder, whole=True))
    return out.select(
        F.col("ENROLLEE_ID").alias("enrollee_id"),
        F.col("RELATIONSHIP_CODE").alias("relationship"),
        F.col("MEMBER_ID").alias("member_id"),
        F.col("SUBSCRIBER_ID").alias("subscriber_id"),
        B.day("LAST_MODIFIED_DATE_TIME").alias("modified"),
    )


@query(
    S.with_views(S.ALL_COVERAGE, S.ELIGIBILITIES_STORED)
    + """SELECT id, TRUE AS complete, enrollee_id, product_id, subscriber_id,
  CAST(NULL AS VARCHAR) AS marital_status FROM eligibilities_stored"""
)
def flatten_eligibility(spark: SparkSession, folder: str) -> DataFrame:
    out = N.flatten_eligibility(B.eligibilities_stored(spark, folder, whole=True))
    return out.select(
        F.col("_id").alias("id"),
        F.col("hasCompleteInfo").alias("complete"),
        F.col("ENROLLEE_ID").alias("enrollee_id"),
        F.col("PRODUCT_ID").alias("product_id"),
        F.col("SUBSCRIBER_ID").alias("subscriber_id"),
        F.col("MARITAL_STATUS").alias("marital_status"),
    )
