"""Whole jobs on real files: load, reload, correct, backfill, stream."""

import json

import pytest
from pyspark.sql import functions as F

from files import write_report, write_workbook
from rostermill.operators.nest import documents
from rostermill.plans.claims import assemble_claims
from rostermill.plans.jobs import Ingest
from rostermill.schemas import ELIGIBILITY_COLUMNS, ENROLLEE_COLUMNS
from rostermill.storage import TableStore
from rostermill.streaming.incremental import stream_claim_reports

CLAIM = ["CLAIM_ID", "CLAIM_STATUS", "INSURED_ENROLLEE_ID", "DIAGNOSIS_CODE", "CODE",
         "DATE_OF_SERVICE", "ITEM_NUMBER", "SH_ITEM_NUMBER", "MODIFIER1"]


ODD = "b +1% [x]{y}.rpt"


def claim(*values):
    return dict(zip(CLAIM, values))


FIRST = [
    claim("C1", "old", "E1", "F32", "97110", "2024-01-02", "1", "9", "M1"),
    claim("C1", "new", "E1", "F33", "97110", "2024-01-02", "2", "9", "later"),
    claim("C1", "dup", "E1", "F32", "97112", "2024-01-02", None, "9", None),
    claim("C2", "only", "E2", None, "97110", "2024-01-02", "1", None, None),
]
SECOND = [
    claim("C1", "second", "E1", "F32", "97110", "2024-01-02", "5", None, None),
    claim("C1", "second", "E1", "G10", "97113", "2024-02-02", "6", None, None),
    claim("C3", "x", "E3", "F32", "97110", "2024-01-02", "1", None, None),
]


@pytest.fixture
def ingest(spark, tmp_path):
    return Ingest(TableStore(spark, str(tmp_path / "store")))


def claims_of(store):
    docs = assemble_claims(store.read("claim"), store.read("claim_diagnosis"), store.read("claim_line"))
    return {
        r.CLAIM_ID: (
            r.CLAIM_STATUS,
            [d.DIAGNOSIS_CODE for d in r.DIAGNOSIS_CODES],
            [(s.CODE, s.ITEM_NUMBER, s.MODIFIER1) for s in r.SERVICE_LINES],
            [d.originalName for d in r.ardbDocuments],
        )
        for r in docs.collect()
    }


AFTER_FIRST = {
    "C1": ("new", ["F32", "F33"], [("97110", "1", "M1"), ("97112", "9", None)], ["a.rpt"]),
    "C2": ("only", [None], [("97110", "1", None)], ["a.rpt"]),
}
AFTER_SECOND = {
    "C1": ("second", ["F32", "F33", "G10"], [("97110", "5", "M1"), ("97113", "6", None)],
           ["b.rpt", "a.rpt"]),
    "C2": AFTER_FIRST["C2"],
    "C3": ("x", ["F32"], [("97110", "1", None)], ["b.rpt"]),
}


def test_claim_reports_insert_then_update(spark, tmp_path, ingest):
    folder = tmp_path / "in"
    folder.mkdir()
    write_report(folder / "a.rpt", CLAIM, FIRST)
    write_report(folder / "bad.rpt", ["OTHER"], [{"OTHER": "1"}])
    ingest.claim_reports(str(folder))
    store = ingest.store
    assert claims_of(store) == AFTER_FIRST
    registry = {r.originalName: (r.status, r.reason) for r in store.read("registry").collect()}
    assert registry["a.rpt"] == ("Completed", None)
    assert registry["bad.rpt"][0] == "Failed" and "missing columns" in registry["bad.rpt"][1]

    # A second file updates; the first is registered and not read again,
    # while the failed one is tried again.
    write_report(folder / ODD, CLAIM, SECOND)
    ingest.claim_reports(str(folder))
    second = {k: (*v[:3], ["b.rpt" if d == ODD else d for d in v[3]]) for k, v in claims_of(store).items()}
    assert second == AFTER_SECOND
    second = claims_of(store)
    ids = {r.CLAIM_ID: r._id for r in store.read("claim").collect()}
    assert len(set(ids.values())) == 3

    # Nothing new but the failed file: the state stays.
    ingest.claim_reports(str(folder))
    assert claims_of(store) == second
    store.compact()
    assert claims_of(store) == second


def test_one_run_equals_file_after_file(spark, tmp_path):
    third = [
        claim("C1", "third", "E1", "F32", "97110", "2024-01-02", "7", None, None),
        claim("C1", "third", "E1", "F32", "97112", "2024-01-02", "8", None, None),
        claim("C2", "third", "E2", "A1", "97110", "2024-01-02", "1", None, None),
    ]
    files = {"a.rpt": FIRST, "b.rpt": SECOND, "c.rpt": third}
    results = []
    for mode in ("one", "each"):
        folder = tmp_path / mode
        folder.mkdir()
        ingest = Ingest(TableStore(spark, str(tmp_path / f"store-{mode}")))
        for name, data in files.items():
            write_report(folder / name, CLAIM, data)
            if mode == "each":
                ingest.claim_reports(str(folder))
        if mode == "one":
            ingest.claim_reports(str(folder))
        results.append(claims_of(ingest.store))
    assert results[0] == results[1]
    # 97112 was absent from the second file, so nothing fills its modifier.
    assert results[0]["C1"][2] == [("97110", "7", "M1"), ("97112", "8", None)]
    assert results[0]["C1"][3] == ["c.rpt", "b.rpt", "a.rpt"]


def test_the_same_file_twice_changes_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_report(folder / "a.rpt", CLAIM, FIRST)
    ingest = Ingest(TableStore(spark, str(tmp_path / "store")), allow_duplicates=True)
    ingest.claim_reports(str(folder), shared_layout=True)
    once = claims_of(ingest.store)
    ingest.claim_reports(str(folder), shared_layout=True)
    twice = claims_of(ingest.store)
    assert {k: v[:3] for k, v in once.items()} == {k: v[:3] for k, v in twice.items()}


def test_stream_takes_each_file_once(spark, tmp_path, ingest):
    folder = tmp_path / "in"
    folder.mkdir()
    write_report(folder / "a.rpt", CLAIM, FIRST)

    def run():
        stream_claim_reports(ingest, str(folder), str(tmp_path / "ckpt"), 1).awaitTermination()

    run()
    assert claims_of(ingest.store) == AFTER_FIRST
    write_report(folder / "b.rpt", CLAIM, SECOND)
    for _ in range(2):
        run()
        assert claims_of(ingest.store) == AFTER_SECOND


def test_an_open_run_is_invisible(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    product = lambda i, n: documents(
        spark.range(1).selectExpr(f"'{i}' AS i", f"'{n}' AS n"), "product", {"_id": "i", "name": "n"}
    )
    names = lambda: sorted(r.name for r in store.read("product").collect())
    store.write("product", 0, product("1", "a"))
    assert names() == []
    store.commit(0)
    store.write("product", 1, product("1", "b"))
    assert names() == ["a"]
    assert sorted(r.name for r in store.read("product", pending=1).collect()) == ["b"]
    # The run dies here; another one takes its number without this table.
    other = TableStore(spark, str(tmp_path))
    assert other.next_run() == 1
    other.commit(1, tag="t")
    assert other.has_tag("t") and names() == ["a"]


def test_corrections_touch_only_changed_claims(spark, tmp_path, ingest):
    folder, fixes = tmp_path / "in", tmp_path / "fix"
    folder.mkdir()
    fixes.mkdir()
    write_workbook(folder / "claims.xlsx", {"CLAIMS": [CLAIM] + [[r[c] for c in CLAIM] for r in FIRST]})
    ingest.claim_workbooks(str(folder))
    assert {k: v[:3] for k, v in claims_of(ingest.store).items()} == {k: v[:3] for k, v in AFTER_FIRST.items()}
    dump = spark.read.parquet(f"{ingest.store.root}/dump_claims")
    assert dump.count() == 4 and dump.where("ardbSourceDocument LIKE '%-claims.xlsx'").count() == 4
    write_workbook(fixes / "fix.xlsx", {"CLAIMS": [
        ["CLAIM_ID", "INSURED_ENROLLEE_ID"], ["C1", "E9"], ["C1", "ignored"], ["C2", "E2"], ["C9", "E1"],
    ]})
    ingest.claim_corrections(str(fixes))
    got = {
        r.CLAIM_ID: (r.SUBSCRIBER_INFO.INSURED_ENROLLEE_ID, [d.originalName for d in r.ardbDocuments])
        for r in ingest.store.read("claim").collect()
    }
    assert got == {"C1": ("E9", ["claims.xlsx", "fix.xlsx"]), "C2": ("E2", ["claims.xlsx"])}


def test_the_raw_dump_keeps_all_columns_of_the_sheet(spark, tmp_path, ingest):
    folder = tmp_path / "in"
    folder.mkdir()
    more = [*CLAIM, "CODE_TYPE_2", "SOMETHING NEW"]
    rows = [[r[c] for c in CLAIM] + [f"t{i}" if i else None, 7 if i < 2 else None] for i, r in enumerate(FIRST)]
    write_workbook(folder / "claims.xlsx", {"CLAIMS": [more, *rows, [*[FIRST[0][c] for c in CLAIM], None, None]]})
    ingest.claim_workbooks(str(folder))
    dump = spark.read.parquet(f"{ingest.store.root}/dump_claims")
    got = dump.select(
        "_line", "CLAIM_ID", F.to_json("undeclared").alias("more"), "ardbSourceDocument", "ardbLastModifiedDate"
    ).orderBy("_line").collect()
    assert [r.more and json.loads(r.more) for r in got] == [
        {"SOMETHING NEW": "7"}, {"CODE_TYPE_2": "t1", "SOMETHING NEW": "7"}, {"CODE_TYPE_2": "t2"}, {"CODE_TYPE_2": "t3"}, None,
    ]
    registered = ingest.store.read("registry").first()
    assert {(r.ardbSourceDocument, r.ardbLastModifiedDate) for r in got} == {(registered.fileName, registered.receivedAt)}


def person(i, modified="2024-01-01", **more):
    row = {"ENROLLEE_ID": i, "LAST_NAME": f"L{i}", "FIRST_NAME": f"F{i}", "DOB": "1980-01-02",
           "GENDER": "f", "CREATION_DATE": "2020-01-01", "LAST_MODIFIED_DATE_TIME": modified}
    return row | more


def cover(i, insured, number, member="M", product="P1", **more):
    row = {"ENROLLEE_ID": i, "PRODUCT_ID": product, "EFFECTIVE_DATE": "2024-01-01",
           "SUBSCRIBER_ID": number, "MEMBER_ID": member, "INSURED_ENROLLEE_ID": insured,
           "RELATIONSHIP_CODE": "18", "CREATION_DATE": "2020-01-01",
           "LAST_MODIFIED_DATE_TIME": "2024-01-01"}
    return row | more


def write_members(path, persons, covers):
    write_workbook(path, {
        "ELIGIBILITY": [ELIGIBILITY_COLUMNS] + [[r.get(c) for c in ELIGIBILITY_COLUMNS] for r in covers],
        "PRODUCTS": [["X"], ["unsupported sheet"]],
        "ENROLLEES": [ENROLLEE_COLUMNS] + [[r.get(c) for c in ENROLLEE_COLUMNS] for r in persons],
    })


def test_eligibility_workbooks(spark, tmp_path, ingest):
    folder = tmp_path / "in"
    folder.mkdir()
    write_members(
        folder / "a.xlsx",
        [person("E1"), person("E1", LAST_NAME="dup"), person("E2", MIDDLE_NAME="Q"), person("E3", DOB="bad")],
        [
            cover("E1", "E1", "S1"), cover("E1", "E1", "S1"),
            cover("E1", "E1", "S1", TERMINATION_DATE="2024-12-31"),
            cover("E2", "E9", "S2", RELATIONSHIP_CODE="??"), cover("E8", "E1", "S1"),
        ],
    )
    result = ingest.eligibility_workbooks(str(folder))
    counts = {(r.step, r.action): r.n_rows for r in result.counts().collect()}
    assert counts == {("enrollee", "insert"): 3, ("subscriber", "insert"): 2,
                      ("patient", "insert"): 3, ("eligibility", "insert"): 4}
    assert [r.sheet for r in ingest.unread_sheets(str(folder)).collect()] == ["PRODUCTS"]
    read = ingest.store.read
    enrollees = {r.referenceId: r for r in read("enrollee").collect()}
    assert {k: (r.hasCompleteInfo, r.demographic.lastName) for k, r in enrollees.items()} == {
        "E1": (True, "LE1"), "E2": (True, "LE2"), "E9": (False, None),
    }
    assert enrollees["E1"].demographic.gender == "FEMALE" and enrollees["E1"].histories == []
    subscribers = {r.subscriberNumber: r for r in read("subscriber").collect()}
    assert {k: r.hasCompleteInfo for k, r in subscribers.items()} == {"S1": True, "S2": False}
    assert subscribers["S1"].enrollee.refId == enrollees["E1"]._id
    patients = {r.enrollee.referenceId: r for r in read("patient").collect()}
    assert set(patients) == {"E1", "E2"}
    assert patients["E1"].subscriber.name == "FE1 LE1" and patients["E1"].relationship.label == "Self"
    assert tuple(patients["E2"].relationship) == ("??", "") and not patients["E2"].hasCompleteInfo
    cover_rows = read("eligibility").collect()
    assert sorted((r.enrollee.referenceId, r.serviceDate.formattedEndDate or "") for r in cover_rows) == [
        ("E1", ""), ("E1", "2024-12-31"), ("E2", ""),
    ]
    assert {r.patient.formattedDob for r in cover_rows} == {"1980-01-02"}
    rejects = spark.read.parquet(f"{ingest.store.root}/rejects")
    assert sorted((r.step, r.row_key.split("|")[0], r.reason) for r in rejects.collect()) == [
        ("eligibility", "E8", "enrollee not found"), ("enrollee", "E3", "not a date: DOB"),
        ("patient", "E8", "enrollee not found"),
    ]
    assert [r.status for r in read("registry").collect()] == ["Failed"]

    # A newer file completes the stub; created stamps and ids stay.
    write_members(
        folder / "b.xlsx",
        [person("E9", "2024-02-01"), person("E1", "2023-01-01", LAST_NAME="older"),
         person("E2", "2025-01-01", LAST_NAME="newer", CREATION_DATE="2025-01-01")],
        [cover("E2", "E9", "S2", LAST_MODIFIED_DATE_TIME="2024-01-01")],
    )
    before = {r.referenceId: r._id for r in enrollees.values()}
    ingest.eligibility_workbooks(str(folder))
    enrollees = {r.referenceId: r for r in read("enrollee").collect()}
    assert {k: r._id for k, r in enrollees.items()} == before
    assert [enrollees[k].demographic.lastName for k in ("E1", "E2", "E9")] == ["LE1", "newer", "LE9"]
    assert str(enrollees["E2"].created.at)[:4] == "2020"
    assert ingest.duplicate_keys().count() == 0
    assert len(enrollees["E2"].ardbDocuments) == 2 and enrollees["E9"].hasCompleteInfo


def test_backfills_can_be_repeated(spark, tmp_path, ingest):
    store = ingest.store
    sub = spark.sql("SELECT 's1' AS i, 'A' AS f, 'B' AS l UNION ALL SELECT 's2', NULL, NULL")
    store.write("subscriber", 0, documents(sub, "subscriber", {
        "_id": "i", "demographic.firstName": "f", "demographic.lastName": "l"}))
    pat = spark.sql("SELECT 'p1' AS i, 's1' AS r UNION ALL SELECT 'p2', 's2' UNION ALL SELECT 'p3', 'none' UNION ALL SELECT 'p4', NULL")
    store.write("patient", 0, documents(pat, "patient", {
        "_id": "i", "subscriber.refId": "r", "subscriber.name": F.lit("old")}))
    prod = spark.sql("SELECT '1' AS i, 'first' AS n, 'P' AS r UNION ALL SELECT '2', 'last', 'P'")
    store.write("product", 0, documents(prod, "product", {"_id": "i", "name": "n", "product.referenceId": "r"}))
    el = spark.sql("SELECT 'x1' AS i, 'P' AS r, '1980-01-02 00:00:00' AS d UNION ALL SELECT 'x2', 'Q', NULL UNION ALL SELECT 'x3', NULL, 'odd'")
    store.write("eligibility", 0, documents(el, "eligibility", {
        "_id": "i", "product.referenceId": "r", "patient.formattedDob": "d"}))
    store.commit(0)
    for _ in range(2):
        ingest.fix_patient_subscriber_names()
        ingest.fix_eligibility_products_and_dates()
        names = {r._id: r.subscriber.name for r in store.read("patient").collect()}
        assert names == {"p1": "A B", "p2": "old", "p3": "old", "p4": "old"}
        got = {r._id: (r.product.name, r.patient.formattedDob) for r in store.read("eligibility").collect()}
        assert got == {"x1": ("last", "1980-01-02"), "x2": (None, None), "x3": (None, "odd")}
