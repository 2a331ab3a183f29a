"""Input columns and stored layouts, kept as data.

Everything that reads, nests or flattens rows is generated from these
tables, so a column is named in exactly one place.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names of the input columns and of the stored fields.
# ---------------------------------------------------------------------------

ENROLLEE_COLUMNS = """
ENROLLEE_ID LAST_NAME FIRST_NAME MIDDLE_NAME NAME_PREFIX NAME_SUFFIX ADDRESS1
ADDRESS2 CITY STATE ZIP ZIP_4 COUNTY_ID DOB GENDER CREATION_DATE
LAST_MODIFIED_DATE_TIME
""".split()

ELIGIBILITY_COLUMNS = """
ENROLLEE_ID PRODUCT_ID EFFECTIVE_DATE TERMINATION_DATE SUBSCRIBER_ID MEMBER_ID
PREMIUM_GROUP_ID PREMIUM_GROUP_DEPARTMENT_ID INSURED_ENROLLEE_ID
BENEFIT_STATUS_CODE RELATIONSHIP_CODE MARITAL_STATUS CREATION_DATE
LAST_MODIFIED_DATE_TIME
""".split()

SUBSCRIBER_COLUMNS = """
INSURED_ENROLLEE_ID SUBSCRIBER_ID EFFECTIVE_DATE TERMINATION_DATE
PREMIUM_GROUP_ID PREMIUM_GROUP_DEPARTMENT_ID CREATION_DATE
LAST_MODIFIED_DATE_TIME
""".split()

PATIENT_COLUMNS = """
ENROLLEE_ID SUBSCRIBER_ID MEMBER_ID RELATIONSHIP_CODE CREATION_DATE
LAST_MODIFIED_DATE_TIME
""".split()

CORRECTION_COLUMNS = ["CLAIM_ID", "INSURED_ENROLLEE_ID"]

CLAIM_FIELDS = """
ACCEPT_ASSIGNMENT ADDITIONAL_DOCS_ATTACHED ADJUDICATE_CYCLE_ID AGE_GROUP_ID
AGGREGATE_DEDUCTIBLE_TO_OOP_FLAG ALTERNATE_CLAIM_ID ALTERNATE_CLAIM_INDICATOR
ANESTHESIA_CODE APMR_LOG_ID AUTO_ACCIDENT_STATE BALANCE_DUE_FLAG BANK_ID
BENEFIT_LEVEL BENEFIT_LEVEL_ESCALATION CASE_NUMBER CHECKING_ACCOUNT
CHECK_NUMBER CLAIM_CATEGORY CLAIM_CODES CLAIM_ID CLAIM_RESUBMISSION_QUALIFIER
CLAIM_RESUBMITTED CLAIM_RESUBMIT_CATEGORY CLAIM_STATUS CLAIM_TYPE
CLIENT_CLAIM_ID CODE_UNIVERSE_ID COPAY_AMOUNT COUNTY_ID CREATION_DATE
CTM_JOB_ID CURRENT_ILLNESS_DATE CURRENT_ILLNESS_DATE_QUALIFIER CVM_CLAIM_ID
CVM_JOB_ID DATE_CLEAN_CLAIM DATE_COMPLETED DATE_ENTERED DATE_FIRST_STAMPED
DATE_PAID DATE_RECEIVED DIRTY_FLAG DOCUMENT_REFERENCE_FLAG DOMAIN_SOURCE_ID
EDIT_CYCLE_ID EFFECTIVE_DATE EIM_JOB_ID ELIGIBILITY_STATUS ELIG_OTHER_INFO1
ELIG_OTHER_INFO2 ELIG_OTHER_INFO3 ENCOUNTER_ID ENTITY_TYPE EOB_PRESENT_FLAG
ERM_JOB_ID FIRST_STAMPED_BY FULFILLMENT_DATE HOSPITALIZED_DATE_FROM
HOSPITALIZED_DATE_TO ICD_CODE_TYPE IMPORT_DATE INCOMPLETE_CLAIM_FLAG IPA
IPA_NAME NETWORK_ID NOTES OFFICE_REF_NUMBER ORIGINAL_CLAIM_ID
OTHER_INSURANCE_COMPANY OTHER_INSURANCE_FLAG OTHER_INSURED_DOB
OTHER_INSURED_EMPLOYER_OR_SCHOOL OTHER_INSURED_GENDER OTHER_INSURED_NAME
OTHER_INSURED_PATIENT_RELATIONSHIP OTHER_INSURED_PLAN_OR_PROGRAM
OTHER_INSURED_POLICY OTHER_INSURED_SUBSCRIBER_ID OTHER_INSURED_TYPE
OUTSIDE_LAB OUT_OF_AREA_FLAG PATIENT_UNABLE_TO_WORK_DATE_FROM
PATIENT_UNABLE_TO_WORK_DATE_TO PAYMENT_CYCLE_ID PAYMENT_GROUP_ID PAYMENT_NOTES
PAY_MEMBER_FLAG PCP_MATCH_FLAG PREDETERMINATION_CLAIM_ID
PREMIUM_GROUP_DEPARTMENT_ID PREMIUM_GROUP_ID PRICING_REQUEST_ID
PROCESSING_GROUP_ID PROCESSING_STATE RECORD_SOURCE_ID RECORD_SOURCE_SUBTYPE
REFERRAL_DATE REFERRAL_REQUIRED_FLAG REFUND_ID REGION_ID
RELATED_TO_AUTO_ACCIDENT RELATED_TO_EMPLOYMENT RELATED_TO_OTHER_ACCIDENT
RELATIONSHIP_CODE RESUBMISSION_ORIGINAL_CLAIM RESUBMIT_REASON_CODE ROWVERSION
SECONDARY_CLIENT_CLAIM_ID SECONDARY_CLIENT_CLAIM_QUALIFIER
SIMILAR_ILLNESS_DATE SIMILAR_ILLNESS_DATE_QUALIFIER SINGLE_PROCESSING_FLAG
SUBROGATION_TYPE SUBSCRIBER_CONTRACT_TYPE SUPPLEMENTAL_CLAIM_INFORMATION
TERMINATION_DATE VISIT_TYPE ZIP ZIP_4 ZONE_ID
""".split()

CLAIM_GROUPS = {
    "INSURER_INFO": "INSURER_ID INSURER_DESCRIPTION".split(),
    "LOCATION_INFO": """LOCATION_ID LOCATION_NAME LOCATION_NPI
        LOCATION_SUPPLEMENTAL_QUALIFIER LOCATION_SUPPLEMENTAL_IDENTIFIER""".split(),
    "MARKET_INFO": "MARKET_ID MARKET_DESCRIPTION".split(),
    "PATIENT": """ENROLLEE_ID SUBSCRIBER_ID MEMBER_ID PATIENT_LAST_NAME
        PATIENT_FIRST_NAME PATIENT_MIDDLE_NAME AGE GENDER DOB""".split(),
    "PAYEE_INFO": """PAYEE_ID PAYEE_NAME PAYEE_ADDRESS1 PAYEE_ADDRESS2 PAYEE_CITY
        PAYEE_STATE PAYEE_ZIP PAYEE_ZIP_4 PAYEE_TAXONOMY PAYEE_NPI TAX_ID
        TAX_ID_QUALIFIER PAYEE_LICENSE_NUMBER
        PAYEE_SUPPLEMENTAL_IDENTIFIER""".split(),
    "PRODUCT_INFO": "PRODUCT_ID PRODUCT_NAME".split(),
    "REFERRING_PROVIDER_INFO": """REFERRING_PROVIDER REFERRING_PROVIDER_QUALIFIER
        REFERRING_PROVIDER_NPI REFERRING_PROVIDER_SUPPLEMENTAL_QUALIFIER
        REFERRING_PROVIDER_SUPPLEMENTAL_IDENTIFIER""".split(),
    "RENDERING_PROVIDER_INFO": """PROVIDER_ID PROVIDER_LAST_NAME
        PROVIDER_FIRST_NAME PROVIDER_TYPE PROVIDER_TAXONOMY PROVIDER_NPI
        PROVIDER_LICENSE_NUMBER PROVIDER_SUPPLEMENTAL_IDENTIFIER
        PROVIDER_SIGNATURE_ON_FILE""".split(),
    "SUBSCRIBER_INFO": """INSURED_ENROLLEE_ID INSURED_FIRST_NAME
        INSURED_LAST_NAME INSURED_POLICY_OR_FECA_NUMBER INSURED_DOB
        INSURED_GENDER INSURED_EMPLOYER_OR_SCHOOL INSURED_INSURANCE_PLAN
        INSURED_OTHER_INSURANCE MARITAL_STATUS EMPLOYMENT_STATUS""".split(),
}

DIAGNOSIS_FIELDS = """
DIAGNOSIS_CODE DIAGNOSIS_DESCRIPTION POA_INDICATOR CODE_TYPE
HIPAA_ICD_QUALIFIER_ID
""".split()

LINE_FIELDS = """
SERVICE_PAYMENT_NOTES ITEM_NUMBER CLAIM_TYPE ENCOUNTER_ID CODE CODE_ID QUANTITY
DATE_OF_SERVICE BILLED_AMOUNT COB_COLLECTED_AMOUNT AUTH_DATE
PROCEDURE_DESCRIPTION AUTH_NUMBER ALLOWABLE_PERCENT CONVERSION_FACTOR
ALLOWED_AMOUNT MEDICARE_ALLOWED_AMOUNT UC_AMOUNT PAYABLE_AMOUNT
QUANTITY_AUTHORIZED COPAY_AMOUNT COINSURANCE_AMOUNT AMOUNT_OVER_MAXIMUM
AMOUNT_OVER_OOP PATIENT_PAY_APPLIED_AMOUNT PAID_AMOUNT ADJUSTED_PAID_AMOUNT
RESUBMIT_COUNT DEDUCTIBLE_APPLIED_AMOUNT MAXIMUM_APPLIED_AMOUNT
OOP_APPLIED_AMOUNT INTEREST_AMOUNT PLACE_OF_SERVICE REFERRAL_NUMBER
ONE_PER_VISIT_COPAY_FLAG SERVICE_STATUS COMPENSATION_ACCOUNT NO_RECODING_FLAG
SYSTEM_GENERATED_FLAG DOMAIN_SOURCE_ID CODE_TYPE USER_ADDED_FLAG REFUND_ID
COMPARISON_GROUP_ID AUTH_ID CALCULATED_PAID_AMOUNT DATE_OF_SERVICE_TO
PAYMENT_NOTES2 EPSDT COB AUTH_ITEM_NUMBER AUTH_PROVIDED_AT_ENTRY
VISIT_COPAY_AMOUNT EMERGENCY_FLAG REIMBURSEMENT_SCHEDULE_ID PRODUCT_PERIOD
SERVICE_PLAN_ID SERVICE_PLAN_ITEM_NUMBER SERVICE_PLAN_AUTH_DATE
ORIGINAL_ITEM_NUMBER NDC_NUMBER NDC_PRICE NDC_UNIT_TYPE NDC_QUANTITY
NDC_PRESCRIPTION LINE_ITEM_CONTROL_NUMBER PROVIDER_WRITEOFF_AMOUNT
BALANCE_DUE_AMOUNT ADJUDICATION_ORDER COB_ADJUSTMENT_AMOUNT QUANTITY_RECEIVED
QUANTITY_UNIT RENDERING_PROVIDER_NPI RENDERING_PROVIDER_SUPPLEMENTAL_QUALIFIER
RENDERING_PROVIDER_SUPPLEMENTAL_IDENTIFIER SUPPLEMENTAL_SERVICE_INFORMATION
PRODUCT_ID BENEFIT_LEVEL FEE_SCHEDULE_VALUE ALTERNATIVE_FEE_SCHEDULE_ID
ALTERNATIVE_FEE_SCHEDULE_VALUE MODIFIER1 MODIFIER2 MODIFIER3 MODIFIER4
TYPE_OF_SERVICE DIAGNOSIS_CODE_INDEX1 DIAGNOSIS_CODE_INDEX2
DIAGNOSIS_CODE_INDEX3 DIAGNOSIS_CODE_INDEX4 DIAGNOSIS_CODE_INDEX5
DIAGNOSIS_CODE_INDEX6 DIAGNOSIS_CODE_INDEX7 DIAGNOSIS_CODE_INDEX8
REIMBURSEMENT_METHOD
""".split()

ALTERNATE_ITEM_NUMBER = "SH_ITEM_NUMBER"

STATUSES = ["New", "Ready to process", "Invalid", "Processing", "Completed", "Failed"]

# Sheets of a workbook and their load order.
SHEET_PRIORITY = {
    "MARKET": 1.0, "INSURER": 2.0, "PRODUCTS": 3.0, "BILLABLE PRODUCTS": 3.5,
    "AUTH": 4.0, "ENROLLEES": 5.0, "ELIGIBILITY": 6.0, "CLAIMS": 7.0,
    "BILLING": 8.0, "BILLING DETAIL": 9.0, "RECEIPTS": 10.0,
    "RECEIPTS DETAIL": 11.0, "EXPECTED_AMOUNTS": 12.0, "BILLING_FILES": 13.0,
    "THIRD_PARTY_ADMINISTRATORS": 14.0, "Prov_Supplemental_Identifiers": 15.0,
    "Providers": 16.0, "Locations": 17.0, "Payees_Detail": 18.0,
    "Payees": 19.0, "NR": 20.0, "RS": 21.0, "FS": 22.0,
    "Payees_EFT_Detail": 23.0,
}

# Cell texts that mean "missing".
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# ---------------------------------------------------------------------------
# Derived lists.
# ---------------------------------------------------------------------------

MODIFIERS = [f for f in LINE_FIELDS if f.startswith("MODIFIER")]
DIAGNOSIS_INDEXES = [f for f in LINE_FIELDS if f.startswith("DIAGNOSIS_CODE_INDEX")]
FALLBACK_FIELDS = MODIFIERS + DIAGNOSIS_INDEXES
LINE_MATCH_KEYS = ["CODE", "DATE_OF_SERVICE"]
LINE_DEDUP_KEYS = LINE_MATCH_KEYS + FALLBACK_FIELDS

CLAIM_HEADER_COLUMNS = CLAIM_FIELDS + [c for g in CLAIM_GROUPS.values() for c in g]


def _distinct(names: list[str]) -> list[str]:
    return list(dict.fromkeys(names))


#: every column of a claim report that any step reads
CLAIM_COLUMNS = _distinct(
    DIAGNOSIS_FIELDS + LINE_FIELDS + [ALTERNATE_ITEM_NUMBER] + CLAIM_HEADER_COLUMNS
)
#: columns a claim input must have; the rest are read when present
CLAIM_REQUIRED = ["CLAIM_ID", "DIAGNOSIS_CODE", *LINE_MATCH_KEYS]

#: position columns added by every scan: file, start of the split, row in it
ORDINAL = ["_file", "_block", "_line"]


def strings(names: list[str]) -> T.StructType:
    """All-string nullable schema of the given columns."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# ---------------------------------------------------------------------------
# Stored documents.
# ---------------------------------------------------------------------------

_REF = "struct<referenceId:string,refId:string>"
_BY = "struct<by:string,at:timestamp_ntz>"
LINEAGE_TYPE = (
    "struct<documentId:string,originalName:string,fileExtension:string,"
    "fileType:string,fileName:string,filePath:string,isReconciled:boolean,"
    "updatedAt:timestamp_ntz,metadata:struct<size:bigint,source:string>>"
)
_LINEAGE = (
    f"ardbDocuments array<{LINEAGE_TYPE}>, ardbSourceDocument string, "
    "ardbLastModifiedDate timestamp_ntz"
)
_COMMON = f"_id string, hasCompleteInfo boolean, created {_BY}, updated {_BY}"
_HISTORY = f"histories array<struct<updated:{_BY},history:string>>"
_DEMOGRAPHIC = (
    "struct<firstName:string,middleName:string,lastName:string,gender:string,"
    "dob:timestamp_ntz,formattedDob:string,email:string,phone:string,"
    "address:struct<addressLine1:string,addressLine2:string,city:string,"
    "state:string,zipCode:string,zipCode4:string>>"
)
_QUALIFIER = "struct<codeQualifier:string,label:string>"
_SUBSCRIBER_REF = "struct<refId:string,identificationCode:string,name:string>"


def _claim_ddl() -> str:
    flat = ", ".join(f"{c} string" for c in CLAIM_FIELDS)
    groups = ", ".join(
        f"{g} struct<{','.join(f'{c}:string' for c in cols)}>"
        for g, cols in CLAIM_GROUPS.items()
    )
    return f"_id string, {flat}, {groups}, {_LINEAGE}"


STORED = {
    "enrollee": f"""{_COMMON}, referenceId string, ssn string,
        demographic {_DEMOGRAPHIC},
        additionalInformation struct<namePrefix:string,nameSuffix:string,
          countyId:string,addressCode:string,birthSequence:string,
          deathDate:string,ethnicityCode:string,raceEthnicityCode:string,
          citizenshipStatusCode:string,isPregnant:string,
          domainSourceId:string,weight:struct<value:string,unit:string>>,
        communicationPreference struct<preferredContactMethod:string,
          eobCommunicationMethod:string,idCardCommunicationMethod:string,
          letterCommunicationMethod:string>,
        {_LINEAGE}, {_HISTORY}""",
    "subscriber": f"""{_COMMON}, enrollee {_REF}, insuredEnrollee {_REF},
        subscriberNumber string,
        premiumGroup struct<referenceId:string,department:struct<referenceId:string>>,
        employment struct<status:string,startDate:timestamp_ntz,
          formattedStartDate:string,endDate:timestamp_ntz,
          formattedTerminationDate:string>,
        demographic {_DEMOGRAPHIC}, policyNumber string, {_LINEAGE}, {_HISTORY}""",
    "patient": f"""{_COMMON}, enrollee {_REF}, demographic {_DEMOGRAPHIC},
        ssn string, subscriber {_SUBSCRIBER_REF}, memberId string,
        relationship {_QUALIFIER}, {_LINEAGE}, {_HISTORY}""",
    "eligibility": f"""{_COMMON}, enrollee {_REF},
        product struct<referenceId:string,name:string>,
        serviceDate struct<startDate:timestamp_ntz,formattedStartDate:string,
          endDate:timestamp_ntz,formattedEndDate:string>,
        subscriber {_SUBSCRIBER_REF},
        patient struct<refId:string,memberId:string,firstName:string,
          middleName:string,lastName:string,dob:timestamp_ntz,
          formattedDob:string,relationship:{_QUALIFIER},name:string,
          identificationCode:string>,
        maritalStatus string, benefitStatusCode string, studentStatusCode string,
        additionalInformation struct<isHandicapped:string,levelOfCareId:string,
          addReasonCode:string,
          client:struct<mcoId:string,programCode:string,rateCode:string>,
          domainSourceId:string,isLateEnrollee:string,
          paidThrough:struct<date:timestamp_ntz,gracePeriod:string>,
          terminationReason:struct<code:string,eventDate:timestamp_ntz>,
          waitingPeriodCredit:string,otherInformation:array<string>>,
        {_LINEAGE}""",
    "claim": _claim_ddl(),
    "claim_diagnosis": "_id string, CLAIM_ID string, "
    + ", ".join(f"{c} string" for c in DIAGNOSIS_FIELDS)
    + ", _run bigint, _file string, _block bigint, _line bigint",
    "claim_line": "_id string, CLAIM_ID string, "
    + ", ".join(f"{c} string" for c in LINE_FIELDS)
    + ", _run bigint, _file string, _block bigint, _line bigint",
    "product": "_id string, name string, product struct<referenceId:string>",
    "registry": "_id string, originalName string, status string, "
    "receivedAt timestamp_ntz, fileName string, "
    "metadata struct<destination:string,source:string,size:bigint>, reason string",
}


def stored_schema(entity: str) -> T.StructType:
    """Schema of a stored table as a StructType."""
    return T.StructType.fromDDL(" ".join(STORED[entity].split()))
