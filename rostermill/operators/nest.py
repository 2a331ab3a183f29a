"""Flat rows to stored documents and back, generated from the layouts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermill.functions.arrays import array_concat, array_drop_nulls
from rostermill.functions.scalars import (
    default_flag,
    gender_code,
    gender_label,
    name_of,
    parse_ts_strict,
    qualifier_struct,
    unfused,
)
from rostermill.schemas import (
    ALTERNATE_ITEM_NUMBER,
    CLAIM_FIELDS,
    CLAIM_GROUPS,
    DIAGNOSIS_FIELDS,
    LINE_FIELDS,
    stored_schema,
)


Value = Column | str | None

#: structs of more computed fields are built by a step of their own
FEW_FIELDS = 20


def documents(df: DataFrame, entity: str, values: Mapping[str, Value]) -> DataFrame:
    """Rows of a stored table, filled from dotted path → value.

    A value is a column name, dotted path or SQL text over ``df``, an
    expression, or None. The stored layout is walked, so names, order and types come from
    there; a path without a value is null. Layouts are up to 270 fields wide,
    so the projection is handed over as text in one piece.
    """
    computed: dict[str, Column] = {}

    def source(path: str) -> str | None:
        value = values[path]
        if isinstance(value, Column):
            name = f"_v{len(computed)}"
            computed[name] = value
            return name
        return value

    def build(field: T.StructField, path: str) -> str:
        kind = field.dataType
        if path in values:
            return f"CAST({source(path) or 'NULL'} AS {kind.simpleString()})"
        if isinstance(kind, T.StructType):
            inner = ", ".join(f"'{f.name}', {build(f, f'{path}.{f.name}')}" for f in kind.fields)
            return f"named_struct({inner})"
        return f"CAST(NULL AS {kind.simpleString()})"

    texts = [f"{build(f, f.name)} AS `{f.name}`" for f in stored_schema(entity).fields]
    return df.withColumns(computed).selectExpr(*texts)


def _reader(df: DataFrame) -> Callable[[str], str | None]:
    present = set(df.columns)
    return lambda name: name if name in present else None


def _column(name: str | None) -> Column:
    return F.lit(None).cast("string") if name is None else F.col(name)


def _date(text: str | None) -> Value:
    return None if text is None else parse_ts_strict(text)


def _dated(path: str, text_path: str, text: str | None) -> dict[str, Value]:
    """A date is stored twice: parsed and as it was written."""
    return {path: _date(text), text_path: text}


def _common(df: DataFrame, created: str, modified: str) -> dict[str, Value]:
    """Fields every document has.

    ``_old`` (the matched stored document, when the frame has one) keeps its
    creation stamp and histories, and its lineage is appended to.
    """
    read = _reader(df)
    out = {
        "_id": "_id",
        "hasCompleteInfo": default_flag(
            F.col("hasCompleteInfo") if "hasCompleteInfo" in df.columns else F.lit(None)
        ),
        "created": F.struct(
            F.lit("system").alias("by"), parse_ts_strict(_column(read(created))).alias("at")
        ),
        "updated": F.struct(
            F.lit("system").alias("by"), parse_ts_strict(_column(read(modified))).alias("at")
        ),
    }
    out.update(_lineage(df))
    if "_old" in df.columns:
        out["created"] = F.coalesce(F.col("_old.created"), out["created"])
    return out


def _lineage(df: DataFrame) -> dict[str, Value]:
    if "lineage" not in df.columns:
        return {}
    documents = F.array(F.col("lineage"))
    if "documents" in df.columns:
        documents = F.col("documents")
    elif "_old" in df.columns:
        documents = array_concat("_old.ardbDocuments", documents)
    return {
        "ardbDocuments": documents,
        "ardbSourceDocument": "lineage.fileName",
        "ardbLastModifiedDate": "lineage.updatedAt",
    }


def _histories(df: DataFrame, entity: str) -> dict[str, Value]:
    kind = stored_schema(entity)["histories"].dataType
    empty = F.array().cast(kind)
    if "_old" in df.columns:
        empty = F.coalesce(F.col("_old.histories"), empty)
    return {"histories": empty}


def _demographic(read, dob: str | None) -> dict[str, Value]:
    names = {
        "firstName": "FIRST_NAME", "middleName": "MIDDLE_NAME", "lastName": "LAST_NAME",
        "email": "EMAIL", "phone": "PHONE_NUMBER",
        "address.addressLine1": "ADDRESS1", "address.addressLine2": "ADDRESS2",
        "address.city": "CITY", "address.state": "STATE",
        "address.zipCode": "ZIP", "address.zipCode4": "ZIP_4",
    }
    out = {f"demographic.{path}": read(name) for path, name in names.items()}
    out["demographic.gender"] = gender_label(_column(read("GENDER")))
    out.update(_dated("demographic.dob", "demographic.formattedDob", dob))
    return out


def nest_person(df: DataFrame) -> DataFrame:
    """Enrollee rows to documents."""
    read = _reader(df)
    extra = {
        "namePrefix": "NAME_PREFIX", "nameSuffix": "NAME_SUFFIX",
        "countyId": "COUNTY_ID", "addressCode": "ADDRESS_CODE",
        "birthSequence": "BIRTH_SEQUENCE", "deathDate": "DEATH_DATE",
        "ethnicityCode": "ETHNICITY_CODE", "raceEthnicityCode": "RACE_ETHNICITY_CODE",
        "citizenshipStatusCode": "CITIZENSHIP_STATUS_CODE",
        "isPregnant": "IS_PREGNANT", "domainSourceId": "DOMAIN_SOURCE_ID",
        "weight.value": "WEIGHT_VALUE", "weight.unit": "WEIGHT_UNIT",
    }
    contact = {
        "preferredContactMethod": "PREFERRED_CONTACT_METHOD",
        "eobCommunicationMethod": "EOB_COMMUNICATION_METHOD",
        "idCardCommunicationMethod": "ID_CARD_COMMUNICATION_METHOD",
        "letterCommunicationMethod": "LETTER_COMMUNICATION_METHOD",
    }
    values = _common(df, "CREATION_DATE", "LAST_MODIFIED_DATE_TIME")
    values |= _histories(df, "enrollee")
    values |= _demographic(read, read("DOB"))
    values |= {"referenceId": read("ENROLLEE_ID"), "ssn": read("SS_NUMBER")}
    values |= {f"additionalInformation.{p}": read(n) for p, n in extra.items()}
    values |= {f"communicationPreference.{p}": read(n) for p, n in contact.items()}
    return documents(df, "enrollee", values)


def _policy(read) -> dict[str, Value]:
    out = {
        "subscriberNumber": read("SUBSCRIBER_ID"),
        "premiumGroup.referenceId": read("PREMIUM_GROUP_ID"),
        "premiumGroup.department.referenceId": read("PREMIUM_GROUP_DEPARTMENT_ID"),
        "employment.status": read("EMPLOYMENT_STATUS"),
        "policyNumber": read("POLICY_NUMBER"),
    }
    out |= _dated("employment.startDate", "employment.formattedStartDate", read("EFFECTIVE_DATE"))
    out |= _dated(
        "employment.endDate", "employment.formattedTerminationDate", read("TERMINATION_DATE")
    )
    return out


def nest_subscriber_row(df: DataFrame) -> DataFrame:
    """Subscriber rows to documents from the row alone."""
    read = _reader(df)
    values = _common(df, "EN_CREATION_DATE", "EN_LAST_MODIFIED_DATE_TIME")
    values |= _histories(df, "subscriber")
    values |= _demographic(read, read("DOB"))
    values |= _policy(read)
    values |= {
        "enrollee.referenceId": read("ENROLLEE_ID"),
        "enrollee.refId": read("enrollee_ref"),
        "insuredEnrollee.referenceId": read("INSURED_ENROLLEE_ID"),
        "insuredEnrollee.refId": read("insuredEnrollee_ref"),
    }
    return documents(df, "subscriber", values)


def nest_subscriber_enrollee(df: DataFrame) -> DataFrame:
    """Subscriber rows plus the matched enrollee (struct ``enrollee``)."""
    read = _reader(df)
    values = _common(df, "CREATION_DATE", "LAST_MODIFIED_DATE_TIME")
    values |= _histories(df, "subscriber")
    values |= _policy(read)
    for place in ("enrollee", "insuredEnrollee"):
        values[f"{place}.referenceId"] = "enrollee.referenceId"
        values[f"{place}.refId"] = "enrollee._id"
    values["demographic"] = "enrollee.demographic"
    return documents(df, "subscriber", values)


def nest_patient(df: DataFrame) -> DataFrame:
    """Patient rows plus structs ``enrollee`` and ``subscriber``.

    ``relationship_label`` is the code list's answer for RELATIONSHIP_CODE.
    """
    values = _common(df, "CREATION_DATE", "LAST_MODIFIED_DATE_TIME")
    values |= _histories(df, "patient")
    values |= {
        "enrollee.referenceId": "enrollee.referenceId",
        "enrollee.refId": "enrollee._id",
        "demographic": "enrollee.demographic",
        "ssn": "enrollee.ssn",
        "subscriber.refId": "subscriber._id",
        "subscriber.identificationCode": "subscriber.subscriberNumber",
        "subscriber.name": "subscriber.name",
        "memberId": "MEMBER_ID",
        "relationship": qualifier_struct("RELATIONSHIP_CODE", "relationship_label"),
    }
    return documents(df, "patient", values)


def nest_eligibility(df: DataFrame) -> DataFrame:
    """Eligibility rows plus structs enrollee, subscriber and patient."""
    read = _reader(df)
    values = _common(df, "CREATION_DATE", "LAST_MODIFIED_DATE_TIME")
    values |= _dated(
        "serviceDate.startDate", "serviceDate.formattedStartDate", read("EFFECTIVE_DATE")
    )
    values |= _dated(
        "serviceDate.endDate", "serviceDate.formattedEndDate", read("TERMINATION_DATE")
    )
    values |= {
        "enrollee.referenceId": "enrollee.referenceId",
        "enrollee.refId": "enrollee._id",
        "product.referenceId": read("PRODUCT_ID"),
        "subscriber.refId": "subscriber._id",
        "subscriber.identificationCode": "subscriber.subscriberNumber",
        "subscriber.name": "subscriber.name",
        "patient.refId": "patient._id",
        "patient.memberId": "patient.memberId",
        "patient.firstName": "patient.firstName",
        "patient.middleName": "patient.middleName",
        "patient.lastName": "patient.lastName",
        "patient.dob": "patient.dob",
        "patient.formattedDob": F.date_format(F.col("patient.dob"), "yyyy-MM-dd"),
        "patient.relationship": "patient.relationship",
        "patient.name": "patient.name",
        "patient.identificationCode": "patient.ssn",
        "maritalStatus": read("MARITAL_STATUS"),
        "benefitStatusCode": read("BENEFIT_STATUS_CODE"),
        "studentStatusCode": read("STUDENT_STATUS_CODE"),
    }
    extra = {
        "isHandicapped": "HANDICAP_FLAG", "levelOfCareId": "LEVEL_OF_CARE_ID",
        "addReasonCode": "ADD_REASON_CODE", "client.mcoId": "CLIENT_MCO_ID",
        "client.programCode": "CLIENT_PROGRAM_CODE", "client.rateCode": "CLIENT_RATE_CODE",
        "domainSourceId": "EL_DOMAIN_SOURCE_ID", "isLateEnrollee": "LATE_ENROLLEE_FLAG",
        "paidThrough.gracePeriod": "PAID_THROUGH_GRACE_PERIOD",
        "terminationReason.code": "TERMINATION_REASON_CODE",
        "waitingPeriodCredit": "WAITING_PERIOD_CREDIT",
    }
    values |= {f"additionalInformation.{p}": read(n) for p, n in extra.items()}
    values |= {
        "additionalInformation.paidThrough.date": _date(read("PAID_THROUGH_DATE")),
        "additionalInformation.terminationReason.eventDate": _date(
            read("TERMINATION_REASON_EVENT_DATE")
        ),
        "additionalInformation.otherInformation": array_drop_nulls(
            *[_column(read(f"OTHER_INFO{i}")) for i in (1, 2, 3)]
        ),
    }
    return documents(df, "eligibility", values)


def nest_claim_header(df: DataFrame) -> DataFrame:
    """Claim rows to header documents with their nine groups."""
    read = _reader(df)
    values = {"_id": "_id", **_lineage(df)}
    values |= {name: read(name) for name in CLAIM_FIELDS}
    values |= {
        f"{group}.{name}": read(name) for group, names in CLAIM_GROUPS.items() for name in names
    }
    return documents(df, "claim", values)


def _struct(values: Mapping[str, str | None]) -> Column:
    texts = {n: f"CAST({v or 'NULL'} AS STRING)" for n, v in values.items()}
    if len(texts) > FEW_FIELDS:
        first = next(iter(texts))
        texts[first] = unfused(texts[first])
    inner = ", ".join(f"'{n}', {t}" for n, t in texts.items())
    return F.expr(f"named_struct({inner})")


def nest_diagnosis(df: DataFrame) -> Column:
    read = _reader(df)
    return _struct({name: read(name) for name in DIAGNOSIS_FIELDS})


def line_values(df: DataFrame) -> dict[str, str | None]:
    """Stored service-line fields as SQL text; the item number has a second
    source for when it is empty."""
    read = _reader(df)
    out = {name: read(name) for name in LINE_FIELDS}
    first, second = read("ITEM_NUMBER") or "NULL", read(ALTERNATE_ITEM_NUMBER) or "NULL"
    out["ITEM_NUMBER"] = f"coalesce(nullif({first}, ''), {second})"
    return out


def nest_service_line(df: DataFrame) -> Column:
    return _struct(line_values(df))


# --- stored documents back to flat rows -----------------------------------

_PERSON_PATHS = {
    "ENROLLEE_ID": "referenceId", "LAST_NAME": "demographic.lastName",
    "FIRST_NAME": "demographic.firstName", "MIDDLE_NAME": "demographic.middleName",
    "DOB": "demographic.dob", "GENDER": "demographic.gender",
    "EMAIL": "demographic.email", "SS_NUMBER": "ssn",
    "ADDRESS1": "demographic.address.addressLine1",
    "ADDRESS2": "demographic.address.addressLine2",
    "CITY": "demographic.address.city", "STATE": "demographic.address.state",
    "ZIP": "demographic.address.zipCode", "ZIP_4": "demographic.address.zipCode4",
    "NAME_PREFIX": "additionalInformation.namePrefix",
    "NAME_SUFFIX": "additionalInformation.nameSuffix",
    "COUNTY_ID": "additionalInformation.countyId",
    "ADDRESS_CODE": "additionalInformation.addressCode",
    "BIRTH_SEQUENCE": "additionalInformation.birthSequence",
    "DEATH_DATE": "additionalInformation.deathDate",
    "ETHNICITY_CODE": "additionalInformation.ethnicityCode",
    "CITIZENSHIP_STATUS_CODE": "additionalInformation.citizenshipStatusCode",
    "RACE_ETHNICITY_CODE": "additionalInformation.raceEthnicityCode",
    "PREFERRED_CONTACT_METHOD": "communicationPreference.preferredContactMethod",
    "EOB_COMMUNICATION_METHOD": "communicationPreference.eobCommunicationMethod",
    "ID_CARD_COMMUNICATION_METHOD": "communicationPreference.idCardCommunicationMethod",
    "LETTER_COMMUNICATION_METHOD": "communicationPreference.letterCommunicationMethod",
    "CREATION_DATE": "created.at", "LAST_MODIFIED_DATE_TIME": "updated.at",
}

_SUBSCRIBER_PATHS = {
    "EL_ENROLLEE_ID": "enrollee.referenceId",
    "EL_INSURED_ENROLLEE_ID": "enrollee.referenceId",
    "SUBSCRIBER_ID": "subscriberNumber",
    "PREMIUM_GROUP_ID": "premiumGroup.referenceId",
    "PREMIUM_GROUP_DEPARTMENT_ID": "premiumGroup.department.referenceId",
    "EMPLOYMENT_STATUS": "employment.status",
    "EFFECTIVE_DATE": "employment.startDate", "TERMINATION_DATE": "employment.endDate",
    "LAST_NAME": "demographic.lastName", "FIRST_NAME": "demographic.firstName",
    "MIDDLE_NAME": "demographic.middleName", "DOB": "demographic.dob",
    "GENDER": "demographic.gender", "EMAIL": "demographic.email",
    "ADDRESS1": "demographic.address.addressLine1",
    "ADDRESS2": "demographic.address.addressLine2",
    "CITY": "demographic.address.city", "STATE": "demographic.address.state",
    "ZIP": "demographic.address.zipCode", "ZIP_4": "demographic.address.zipCode4",
}

_PATIENT_PATHS = {
    "ENROLLEE_ID": "enrollee.referenceId",
    "RELATIONSHIP_CODE": "relationship.codeQualifier",
    "MEMBER_ID": "memberId", "SUBSCRIBER_ID": "subscriber.identificationCode",
    "CREATION_DATE": "created.at", "LAST_MODIFIED_DATE_TIME": "updated.at",
}

_ELIGIBILITY_PATHS = {
    "ENROLLEE_ID": "enrollee.referenceId", "INSURED_ENROLLEE_ID": "enrollee.referenceId",
    "PRODUCT_ID": "product.referenceId", "EFFECTIVE_DATE": "serviceDate.startDate",
    "TERMINATION_DATE": "serviceDate.endDate",
    "SUBSCRIBER_ID": "subscriber.identificationCode",
    "BENEFIT_STATUS_CODE": "benefitStatusCode", "MARITAL_STATUS": "maritalStatus",
    "STUDENT_STATUS_CODE": "studentStatusCode",
    "HANDICAP_FLAG": "additionalInformation.isHandicapped",
    "LEVEL_OF_CARE_ID": "additionalInformation.levelOfCareId",
}


def _flatten(df: DataFrame, paths: Mapping[str, str], with_flag: bool = True) -> DataFrame:
    head = ["_id", default_flag("hasCompleteInfo").alias("hasCompleteInfo")] if with_flag else []
    flat = [
        gender_code(path).alias(name) if name == "GENDER" else F.col(path).alias(name)
        for name, path in paths.items()
    ]
    return df.select(*head, *flat)


def flatten_person(df: DataFrame) -> DataFrame:
    return _flatten(df, _PERSON_PATHS)


def flatten_subscriber(df: DataFrame) -> DataFrame:
    return _flatten(df, _SUBSCRIBER_PATHS)


def flatten_patient(df: DataFrame) -> DataFrame:
    return _flatten(df, _PATIENT_PATHS, with_flag=False)


def flatten_eligibility(df: DataFrame) -> DataFrame:
    return _flatten(df, _ELIGIBILITY_PATHS)


def person_name(demographic: str = "demographic") -> Column:
    return name_of(demographic)
