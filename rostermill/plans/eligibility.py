"""Eligibility workbook: enrollees, subscribers, patients, eligibilities.

Each step reduces the input to one row per business key, looks up parents
and the row's own stored document (one join each, with only the needed
fields), classifies, and builds the changed documents. Later steps see the
tables as the earlier ones left them. Several files may be one input; see
:func:`~rostermill.operators.dedup.keep_newest`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostermill.functions.scalars import (
    default_flag,
    is_unreadable_ts,
    name_of,
    parse_ts_tolerant,
    surrogate_key,
)
from rostermill.operators.classify import (
    NO_ACTION,
    classify,
    complete_if_all,
    complete_unless_false,
)
from rostermill.operators.clean import project_columns
from rostermill.operators.dedup import keep_newest
from rostermill.operators.match import code_lookup, lookup, missing_parents, with_tuple
from rostermill.operators.nest import (
    nest_eligibility,
    nest_patient,
    nest_person,
    nest_subscriber_enrollee,
)
from rostermill.operators.quality import accepted, rejected, with_reject_reason
from rostermill.operators.registry import with_lineage
from rostermill.plans.run import LazyRun, Result, changed
from rostermill.schemas import (
    ELIGIBILITY_COLUMNS,
    ENROLLEE_COLUMNS,
    ORDINAL,
    PATIENT_COLUMNS,
    SUBSCRIBER_COLUMNS,
)

SUBSCRIBER_KEYS = ["SUBSCRIBER_ID", "INSURED_ENROLLEE_ID"]
PATIENT_KEYS = ["ENROLLEE_ID", "SUBSCRIBER_ID", "MEMBER_ID"]
ELIGIBILITY_KEYS = [
    "ENROLLEE_ID", "PRODUCT_ID", "SUBSCRIBER_ID", "MEMBER_ID", "EFFECTIVE_DATE",
    "TERMINATION_DATE",
]

_OLD = {
    "_id": "_id", "created": "created", "updated_at": "updated.at",
    "ardbDocuments": "ardbDocuments",
}
_OLD_WITH_HISTORY = {**_OLD, "histories": "histories"}

_PERSON = {
    "_id": "_id", "referenceId": "referenceId", "demographic": "demographic",
    "ssn": "ssn", "hasCompleteInfo": "hasCompleteInfo",
}


def _name() -> Column:
    return name_of("demographic")


_POLICY = {
    "_id": "_id", "subscriberNumber": "subscriberNumber",
    "name": _name, "hasCompleteInfo": "hasCompleteInfo",
}
_PATIENT = {
    "_id": "_id", "memberId": "memberId", "firstName": "demographic.firstName",
    "middleName": "demographic.middleName", "lastName": "demographic.lastName",
    "dob": "demographic.dob", "relationship": "relationship", "ssn": "ssn",
    "name": _name, "hasCompleteInfo": "hasCompleteInfo",
}


def _identified(df: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """Stored id of a matched row, else one made from its keys."""
    return df.withColumn(
        "_id", F.coalesce(F.col("_old._id"), surrogate_key(F.lit(kind), *keys))
    )


def _judged(df: DataFrame, complete: Column, null_incoming: str, parents: dict[str, Column]) -> DataFrame:
    """Add action, completeness and reject reason.

    A missing parent rejects the row whatever its action would be; dates are
    only read strictly where a document will be built.
    """
    action = classify(
        F.col("_old").isNotNull(),
        parse_ts_tolerant("LAST_MODIFIED_DATE_TIME"),
        F.col("_old.updated_at"),
        complete,
        null_incoming,
    )
    dates = [c for c in df.columns if c.endswith("_DATE") or c == "DOB"]
    dates.append("LAST_MODIFIED_DATE_TIME")
    acts = F.col("action") != NO_ACTION
    rules = dict(parents)
    rules |= {f"not a date: {c}": acts & is_unreadable_ts(c) for c in dict.fromkeys(dates)}
    return with_reject_reason(
        df.withColumns({"action": action, "hasCompleteInfo": complete}), rules
    )


def one_per_key(rows: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """The wanted columns, one row per business key."""
    picked = project_columns(rows, columns, ORDINAL)
    return keep_newest(picked, keys, parse_ts_tolerant("LAST_MODIFIED_DATE_TIME"))


def classify_persons(rows: DataFrame, enrollees: DataFrame) -> DataFrame:
    """Enrollee rows, one per id, with their stored match and action."""
    first = one_per_key(rows, ENROLLEE_COLUMNS, ["ENROLLEE_ID"])
    fields = {**_OLD_WITH_HISTORY, "complete": default_flag("hasCompleteInfo")}
    matched = lookup(first, enrollees, {"ENROLLEE_ID": "referenceId"}, fields, "_old")
    judged = _judged(matched, F.coalesce(F.col("_old.complete"), F.lit(True)), "skip", {})
    complete = judged.withColumn("hasCompleteInfo", F.lit(True))
    return _identified(complete, "enrollee", ["ENROLLEE_ID"])


def stub_persons(keys: DataFrame, key: str) -> DataFrame:
    """Documents for enrollees that others refer to but nobody sent yet."""
    rows = keys.withColumnRenamed(key, "ENROLLEE_ID").withColumn("hasCompleteInfo", F.lit(False))
    return nest_person(
        rows.withColumn("_id", surrogate_key(F.lit("enrollee"), F.col("ENROLLEE_ID")))
    )


#: heavy keys by key set, from one pass over the input
Hot = Mapping[tuple[str, ...], DataFrame | None]


def _hot(hot: Hot | None, run: LazyRun, rows: DataFrame, keys: list[str]) -> DataFrame | None:
    return run.hot(rows, keys) if hot is None else hot[tuple(keys)]


def classify_subscribers(
    rows: DataFrame, enrollees: DataFrame, subscribers: DataFrame, run: LazyRun,
    hot: Hot | None = None,
) -> DataFrame:
    """Subscriber rows. ``hot``, here and below, holds the heavy keys of the
    input that ``rows`` were reduced from; without it they are counted here."""
    keyed = with_tuple(rows, SUBSCRIBER_KEYS)
    with_parent = lookup(
        keyed, enrollees, {"INSURED_ENROLLEE_ID": "referenceId"}, _PERSON, "enrollee",
        hot=_hot(hot, run, rows, ["INSURED_ENROLLEE_ID"]),
    )
    on = {"SUBSCRIBER_ID": "subscriberNumber", "INSURED_ENROLLEE_ID": "enrollee.referenceId"}
    matched = lookup(
        with_parent, subscribers, on, _OLD_WITH_HISTORY, "_old", tuple_key="_tuple"
    )
    complete = complete_unless_false(F.col("enrollee.hasCompleteInfo"))
    return _identified(_judged(matched, complete, "compare", {}), "subscriber", SUBSCRIBER_KEYS)


def _missing(alias: str, key: str) -> dict[str, Column]:
    return {f"{alias} not found": F.col(alias).isNull()}


def classify_patients(
    rows: DataFrame, enrollees: DataFrame, subscribers: DataFrame, patients: DataFrame,
    run: LazyRun, hot: Hot | None = None,
) -> DataFrame:
    """Patient rows; the first subscriber (by id) with the number is taken."""
    step = lookup(
        with_tuple(rows, PATIENT_KEYS), enrollees, {"ENROLLEE_ID": "referenceId"}, _PERSON,
        "enrollee", hot=_hot(hot, run, rows, ["ENROLLEE_ID"]),
    )
    step = lookup(
        step, subscribers, {"SUBSCRIBER_ID": "subscriberNumber"}, _POLICY, "subscriber",
        first_by=["_id"], hot=_hot(hot, run, rows, ["SUBSCRIBER_ID"]),
        spread=[*PATIENT_KEYS, *ORDINAL],
    )
    on = {
        "ENROLLEE_ID": "enrollee.referenceId",
        "SUBSCRIBER_ID": "subscriber.identificationCode",
        "MEMBER_ID": "memberId",
    }
    matched = lookup(step, patients, on, _OLD_WITH_HISTORY, "_old", tuple_key="_tuple")
    complete = complete_if_all(
        F.col("enrollee.hasCompleteInfo"), F.col("subscriber.hasCompleteInfo")
    )
    orphans = _missing("enrollee", "ENROLLEE_ID") | _missing("subscriber", "SUBSCRIBER_ID")
    return _identified(_judged(matched, complete, "compare", orphans), "patient", PATIENT_KEYS)


def classify_eligibilities(
    rows: DataFrame,
    enrollees: DataFrame,
    subscribers: DataFrame,
    patients: DataFrame,
    eligibilities: DataFrame,
    run: LazyRun,
    hot: Hot | None = None,
) -> DataFrame:
    spread = [*ELIGIBILITY_KEYS, *ORDINAL]
    step = lookup(
        with_tuple(rows, ELIGIBILITY_KEYS), enrollees, {"ENROLLEE_ID": "referenceId"},
        {k: v for k, v in _PERSON.items() if k in ("_id", "referenceId", "hasCompleteInfo")},
        "enrollee", hot=_hot(hot, run, rows, ["ENROLLEE_ID"]), spread=spread,
    )
    step = lookup(
        step, subscribers,
        {"SUBSCRIBER_ID": "subscriberNumber", "INSURED_ENROLLEE_ID": "enrollee.referenceId"},
        _POLICY, "subscriber", hot=_hot(hot, run, rows, SUBSCRIBER_KEYS), spread=spread,
    )
    step = lookup(
        step, patients,
        {
            "ENROLLEE_ID": "enrollee.referenceId",
            "SUBSCRIBER_ID": "subscriber.identificationCode",
            "MEMBER_ID": "memberId",
        },
        _PATIENT, "patient", hot=_hot(hot, run, rows, PATIENT_KEYS), spread=spread,
    )
    on = {
        "ENROLLEE_ID": "enrollee.referenceId",
        "PRODUCT_ID": "product.referenceId",
        "SUBSCRIBER_ID": "subscriber.identificationCode",
        "MEMBER_ID": "patient.memberId",
        "EFFECTIVE_DATE": "serviceDate.formattedStartDate",
        "TERMINATION_DATE": "serviceDate.formattedEndDate",
    }
    matched = lookup(step, eligibilities, on, _OLD, "_old", tuple_key="_tuple")
    parents = ["enrollee", "subscriber", "patient"]
    complete = complete_if_all(*[F.col(f"{p}.hasCompleteInfo") for p in parents])
    orphans = {f"{p} not found": F.col(p).isNull() for p in parents}
    return _identified(
        _judged(matched, complete, "compare", orphans), "eligibility", ELIGIBILITY_KEYS
    )


def _row_key(keys: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k), F.lit("")) for k in keys])


def load_eligibility(
    enrollee_rows: DataFrame,
    eligibility_rows: DataFrame,
    run: LazyRun,
    lineage: DataFrame,
    relationships: DataFrame,
) -> Result:
    """Both sheets against the stored tables; see the module docstring."""
    result = Result()

    def settle(table: str, classified: DataFrame, keys: list[str]) -> DataFrame:
        """Keep the classified rows; give back the good changed ones."""
        kept, counted = run.cut_counted(f"{table}_classified", classified)
        result.classified[table] = kept
        if counted is not None:
            result.counted[table] = counted
        result.add_rejects(rejected(kept, table, _row_key(keys)))
        return with_lineage(changed(accepted(kept)), lineage)

    def save(table: str, documents: DataFrame) -> DataFrame:
        result.changes[table] = documents
        result.current[table] = run.save(table, documents)
        return result.current[table]

    # Stored rows are looked up by three keys of the input; only the folders
    # of those are read. Heavy keys are counted in one pass.
    insured = eligibility_rows.select(F.col("INSURED_ENROLLEE_ID").alias("key"))
    covered = eligibility_rows.select(F.col("ENROLLEE_ID").alias("key"))
    people = enrollee_rows.select(F.col("ENROLLEE_ID").alias("key")).unionAll(insured)
    people = people.unionAll(covered)
    numbers = eligibility_rows.select(F.col("SUBSCRIBER_ID").alias("key"))
    hot = run.hot_sets(
        eligibility_rows,
        [["INSURED_ENROLLEE_ID"], ["ENROLLEE_ID"], ["SUBSCRIBER_ID"], SUBSCRIBER_KEYS, PATIENT_KEYS],
    )

    # Enrollees, with stubs for insured persons nobody sent.
    old_enrollees = run.state("enrollee", people)
    persons = nest_person(
        settle("enrollee", classify_persons(enrollee_rows, old_enrollees), ["ENROLLEE_ID"])
    )
    policies = one_per_key(eligibility_rows, SUBSCRIBER_COLUMNS, SUBSCRIBER_KEYS)
    policies = run.cut("subscriber_rows", policies)
    known = old_enrollees.select("referenceId").unionByName(persons.select("referenceId"))
    absent = missing_parents(policies, "INSURED_ENROLLEE_ID", known, "referenceId")
    stubs = stub_persons(with_lineage(absent, lineage), "INSURED_ENROLLEE_ID")
    save("enrollee", persons.unionByName(stubs))
    enrollees = run.state("enrollee", people)

    # Subscribers.
    classified = classify_subscribers(
        policies, enrollees, run.state("subscriber", numbers), run, hot
    )
    good = settle("subscriber", classified, SUBSCRIBER_KEYS)
    save("subscriber", nest_subscriber_enrollee(good))
    subscribers = run.state("subscriber", numbers)

    # Patients.
    rows = run.cut("patient_rows", one_per_key(eligibility_rows, PATIENT_COLUMNS, PATIENT_KEYS))
    classified = classify_patients(
        rows, enrollees, subscribers, run.state("patient", covered), run, hot
    )
    good = settle("patient", classified, PATIENT_KEYS)
    labelled = code_lookup(good, relationships, "RELATIONSHIP_CODE", "relationship_label")
    save("patient", nest_patient(labelled))
    patients = run.state("patient", covered)

    # Eligibilities.
    rows = one_per_key(eligibility_rows, ELIGIBILITY_COLUMNS, ELIGIBILITY_KEYS)
    classified = classify_eligibilities(
        run.cut("eligibility_rows", rows), enrollees, subscribers, patients,
        run.state("eligibility", covered), run, hot,
    )
    good = settle("eligibility", classified, ELIGIBILITY_KEYS)
    save("eligibility", nest_eligibility(good))
    return result
