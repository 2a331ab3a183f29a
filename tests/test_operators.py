"""Operators on small frames with the edge rows."""

import hashlib
import re

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rostermill.codes import RELATIONSHIPS, relationship_table
from rostermill.functions import arrays as R
from rostermill.functions import scalars as X
from rostermill.operators import children as K
from rostermill.operators import classify as A
from rostermill.operators import clean as C
from rostermill.operators import dedup as D
from rostermill.operators import match as M
from rostermill.operators import quality as Q
from rostermill.operators import registry as G
from rostermill.operators import upsert as U
from rostermill.functions.arrays import array_union_by_key
from rostermill.functions.digests import row_digest
from rostermill.skew import hot_keys, salted_left_join
from rostermill.sources.workbook import rank_sheets


def values(df, *columns):
    return sorted(
        [tuple(r[c] for c in columns) for r in df.collect()],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


# --- cleaning --------------------------------------------------------------


def test_missing_column_is_an_error(rows):
    df = rows(["A"], [{"A": "1"}])
    with pytest.raises(ValueError, match="missing columns: B"):
        C.project_columns(df, ["A", "B"])
    with pytest.raises(ValueError, match="B"):
        C.enforce_string_schema(df, ["A", "B"])
    assert C.enforce_string_schema(df, ["A", "B"], required=["A"]).columns[:2] == ["A", "B"]


def test_na_tokens_become_null(rows):
    tokens = ["NA", "N/A", " null ", "NaN", "None", "", "  ", "#N/A", "1.#IND", "x'", "na"]
    df = C.normalize_nulls(rows(["A"], [{"A": t} for t in tokens]))
    assert values(df.where("A IS NOT NULL"), "A") == [("na",), ("x'",)]


def test_null_differs_from_failed(rows):
    df = rows(["status"], [{"status": "Failed"}, {"status": "New"}, {}])
    assert values(C.filter_not_equal(df, "status", "Failed"), "status") == [("New",), (None,)]


def test_pages_follow_the_key(spark):
    df = spark.range(10)
    assert [r.id for r in C.page_after(df, "id", None, 3).collect()] == [0, 1, 2]
    assert [r.id for r in C.page_after(df, "id", 2, 3).collect()] == [3, 4, 5]


# --- dedup -----------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_keep_first_and_last(rows, partitions):
    data = [{"K": "a", "V": "1"}, {"K": "a", "V": "2"}, {"V": "3"}, {"V": "4"}, {"K": "b", "V": "5"}]
    df = rows(["K", "V"], data, partitions=partitions)
    assert values(D.keep_first(df, ["K"]), "K", "V") == [("a", "1"), ("b", "5"), (None, "3")]
    assert values(D.keep_last(df, ["K"]), "K", "V") == [("a", "2"), ("b", "5"), (None, "4")]


def test_group_limit_runs_before_the_shuffle(rows):
    df = D.keep_first(rows(["K", "V"], [{"K": "a"}]), ["K"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_newest_file_wins_after_the_first_row_of_each(rows):
    data = [
        {"K": "a", "D": "2024-01-02", "V": "1", "_file": "f1"},
        {"K": "a", "D": "2024-09-09", "V": "not first", "_file": "f1"},
        {"K": "a", "D": "2024-01-03", "V": "2", "_file": "f2"},
        {"K": "a", "D": "2024-01-03", "V": "tie", "_file": "f3"},
        {"K": "b", "V": "3", "_file": "f1"}, {"K": "b", "V": "4", "_file": "f2"},
    ]
    df = rows(["K", "D", "V"], data)
    assert values(D.keep_newest(df, ["K"], F.col("D").cast("date")), "K", "V") == [("a", "2"), ("b", "3")]
    assert values(D.keep_from_last_file(df, ["K"]), "K", "V") == [("a", "tie"), ("b", "4")]


def test_distinct_keys_skip_null_and_empty(rows):
    df = rows(["K"], [{"K": "a"}, {"K": "a"}, {"K": ""}, {}])
    assert values(D.distinct_keys(df, "K"), "K") == [("a",)]


# --- lookups ---------------------------------------------------------------


def test_lookup_is_null_safe_and_takes_the_first(rows):
    left = rows(["A", "B"], [{"A": "1"}, {"A": "1", "B": "x"}, {"A": "2"}])
    right = rows(["P", "Q", "ID"], [
        {"P": "1", "ID": "r2"}, {"P": "1", "ID": "r1"}, {"P": "1", "Q": "x", "ID": "r3"},
    ])
    out = M.lookup(left, right, {"A": "P", "B": "Q"}, {"id": "ID"}, "m", first_by=["ID"])
    assert values(out.select("A", "B", "m.id"), "A", "B", "id") == [
        ("1", "x", "r3"), ("1", None, "r1"), ("2", None, None),
    ]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_plain(rows, how):
    left = rows(["K", "V"], [{"K": k, "V": str(i)} for i, k in enumerate(["h"] * 50 + ["a", None, "z"])])
    left = left.unionByName(rows(["K", "V"], [{"V": str(i)} for i in range(20)]))
    right = rows(["R", "W"], [{"R": "h", "W": "1"}, {"R": "a", "W": "2"}, {"W": "3"}])
    hot = hot_keys(left, ["K"], min_rows=10)
    assert values(hot, "K") == [("h",), (None,)]
    plain = M.lookup(left, right, {"K": "R"}, {"w": "W"}, "m", how=how)
    salted = M.lookup(left, right, {"K": "R"}, {"w": "W"}, "m", how=how, hot=hot)
    pick = lambda df: values(df.select("K", "V", F.col("m.w").alias("w")), "K", "V", "w")
    assert pick(plain) == pick(salted)


def test_all_hot_keys_are_spread(rows):
    """More hot keys than a fixed list would name."""
    left = rows(["K", "V"], [{"K": str(i % 1200), "V": str(i)} for i in range(3600)])
    right = rows(["R", "W"], [{"R": str(i), "W": f"w{i}"} for i in range(1200)]).drop("_file", "_block", "_line")
    hot = hot_keys(left, ["K"], min_rows=3)
    assert hot.count() == 1200
    out = salted_left_join(left, right, [("K", "R")], hot, salts=4)
    assert out.where("W = concat('w', K)").count() == 3600


def test_salt_spreads_a_hot_key(rows):
    left = rows(["K", "V"], [{"K": "h", "V": str(i)} for i in range(200)])
    right = rows(["R"], [{"R": "h"}]).drop("_file", "_block", "_line")
    out = salted_left_join(left, right, [("K", "R")], hot_keys(left, ["K"], 10), salts=8)
    assert out.count() == 200


def test_missing_parents_keep_first_position(rows):
    children = rows(["P"], [{"P": "x"}, {"P": "y"}, {"P": "x"}, {}, {}])
    parents = rows(["ID"], [{"ID": "y"}])
    assert values(M.missing_parents(children, "P", parents, "ID"), "P", "_line") == [
        ("x", 0), (None, 3),
    ]


def test_detect_changes_counts_null_as_a_value(rows):
    stored = rows(["K", "V"], [{"K": "1", "V": "a"}, {"K": "2"}, {"K": "3", "V": "a"}, {"K": "4"}])
    new = rows(["K", "W"], [{"K": "1", "W": "a"}, {"K": "2", "W": "b"}, {"K": "3"}, {"K": "4"}])
    out = M.detect_changes(stored.select("K", "V"), new, "K", "V", "W")
    assert values(out, "K", "_new") == [("2", "b"), ("3", None)]


def test_code_lookup_unknown_null_and_empty(spark, rows):
    df = rows(["C"], [{"C": "18"}, {"C": "??"}, {"C": ""}, {}])
    found = M.code_lookup(df, relationship_table(spark), "C", "found")
    out = found.select("C", X.qualifier_struct("C", "found").alias("q")).select("C", "q.*")
    assert values(out, "C", "codeQualifier", "label") == [
        ("", "", ""), ("18", "18", "Self"), ("??", "??", ""), (None, "", ""),
    ]
    assert len(RELATIONSHIPS) == 154


def test_first_side_wins_in_union(rows):
    a, b = rows(["K", "V"], [{"K": "1", "V": "a"}]), rows(["K", "V"], [{"K": "1", "V": "b"}, {"K": "2", "V": "b"}])
    assert values(M.union_with_precedence(a, b, ["K"], ["V"]), "K", "V") == [("1", "a"), ("2", "b")]


def test_sheets_are_known_and_ordered(spark):
    df = spark.createDataFrame([("ELIGIBILITY",), ("Nope",), ("ENROLLEES",), ("BILLABLE PRODUCTS",)], "sheet string")
    ranked = rank_sheets(df).orderBy("priority").collect()
    assert [(r.sheet, r.priority) for r in ranked] == [
        ("BILLABLE PRODUCTS", 3.5), ("ENROLLEES", 5.0), ("ELIGIBILITY", 6.0),
    ]


# --- scalars and arrays ----------------------------------------------------


def test_dates(spark):
    df = spark.createDataFrame(
        [("2024-01-02",), ("2024-01-02 03:04:05",), ("2024-01-02T03:04:05",), ("1/2/2024",),
         ("01/02/2024 10:11:12",), (" 2024-01-02 ",), ("bad",), (None,)], "s string")
    got = [r.t for r in df.select(X.parse_ts_tolerant("s").cast("string").alias("t")).collect()]
    assert got == ["2024-01-02 00:00:00", "2024-01-02 03:04:05", "2024-01-02 03:04:05",
                   "2024-01-02 00:00:00", "2024-01-02 10:11:12", "2024-01-02 00:00:00", None, None]
    assert [r.s for r in df.where(X.is_unreadable_ts("s")).collect()] == ["bad"]
    good = df.where("s IS NULL OR s <> 'bad'").select(X.parse_ts_strict("s").alias("t"))
    assert good.where("t IS NULL").count() == 1
    with pytest.raises(PySparkException, match="not a date"):
        df.select(X.parse_ts_strict("s").alias("t")).collect()


def test_dates_are_read_by_their_shape(spark):
    """What is read equals what pandas reads; the rest is no date."""
    dates = [
        "2020-01-02", "2020/1/2", "2020.01.02", "1/2/2020", "01-02-2020", "13/2/2020", "2/13/2020", "1/2/95", "1/2/20",
        "12/31/99", "20200102", "02-Jan-2020", "2 January 2020", "Jan 2, 2020", "january 2 2020", "Sep 9, 2021",
        "Thursday, January 2, 2020", "2-feb-20", "2020-Feb-29", "May 2020", "2020-05", "2020",
    ]
    times = ["", " 3:04 PM", " 12:00 AM", " 12:30 pm", " 15:04", " 15:04:05", " 15:04:05.250", " 3 PM", " 09:04:05.123456 AM"]
    texts = [d + t for d in dates for t in times if not (t and d in ("2020", "May 2020", "2020-05"))]
    texts += ["Sept 9, 2021", "2020-01-02T03:04:05", "2020-01-02T03:04", " 2020-01-02 "]
    none = [
        "2020-02-30", "13/13/2020", "1/2/2020 25:00", "1/2/2020 13:00 PM", "0/2/2020", "202001", "123", "12345", "x 2020-01-02",
        "2020-01-02 y", "Jan", "", " ", "1/2", "2020-13-01", "Mayo 2, 2020", "1/2/2020 3:4:5:6", "--", "99999999", "10000-01-01",
    ]
    frame = spark.createDataFrame([(t,) for t in texts + none + [None]], "s string")
    got = {r.s: r.t for r in frame.select("s", X.parse_ts_tolerant("s").alias("t")).collect()}
    for t in texts:
        assert got[t] == pd.to_datetime(t.strip()).to_pydatetime(), t
    assert {t: got[t] for t in [*none, None] if got[t] is not None} == {}
    zones = ["2020-01-02T03:04:05Z", "2020-01-02 03:04:05+02:00", "1/2/2020 03:04:05 UTC"]
    clock = spark.createDataFrame([(z,) for z in zones], "s string").select(X.parse_ts_tolerant("s").cast("string").alias("t"))
    assert {r.t for r in clock.collect()} == {"2020-01-02 03:04:05"}


def test_epoch_millis_truncates_and_ignores_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.sql("SELECT timestamp_ntz '2024-03-10 02:30:00.123999' AS t")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert df.select(X.epoch_millis("t").alias("m")).head().m == 1710037800123
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_names(spark):
    df = spark.createDataFrame([("a", "b", "c"), (None, None, "c"), ("a", "", "c"), (None, "", None)], "f string, m string, l string")
    assert [r.n for r in df.select(X.full_name("f", "m", "l").alias("n")).collect()] == ["a b c", "c", "a c", ""]


def test_genders(spark):
    df = spark.createDataFrame([(c,) for c in "FfMmOoX"] + [(None,)], "c string")
    got = [r.g for r in df.select(X.gender_label("c").alias("g")).collect()]
    assert got == ["FEMALE", "FEMALE", "MALE", "MALE", "OTHER", "OTHER", None, None]


def test_surrogate_key_tells_tuples_apart(spark):
    tuples = [("a", None), (None, "a"), ("a#b", None), ("a", "b"), ("", None), (None, None), ("a", "")]
    df = spark.createDataFrame(tuples, "x string, y string")
    assert df.select(X.surrogate_key("x", "y").alias("k")).distinct().count() == len(tuples)


def test_file_names(spark):
    df = spark.createDataFrame([("/a/b/x.rpt",), ("y",), ("/a/.hidden",), ("/a/z.tar.gz",)], "p string")
    out = df.select(X.file_name("p").alias("n"), X.file_suffix(X.file_name("p")).alias("s")).collect()
    assert [(r.n, r.s) for r in out] == [("x.rpt", ".rpt"), ("y", ""), (".hidden", ""), ("z.tar.gz", ".gz")]
    key = lambda env: X.archive_key("m", F.lit("1-x"), env)
    row = df.limit(1).select(key("prod").alias("a"), key("m").alias("b"), key("m/").alias("c")).head()
    assert (row.a, row.b, row.c) == ("prod/m/1-x", "m/1-x", "m/1-x")


def test_arrays(spark):
    doc = "array<struct<k:string,v:string>>"
    df = spark.createDataFrame(
        [([("1", "n"), ("1", "m")], [("2", "o"), ("1", "o")]), (None, [("2", "o")]), ([(None, "n")], [(None, "o")])],
        f"a {doc}, b {doc}")
    got = [r.x for r in df.select(R.array_union_by_key("a", "b", "k").alias("x")).collect()]
    assert [[(e.k, e.v) for e in x] for x in got] == [[("1", "n"), ("2", "o")], [("2", "o")], [(None, "n")]]
    new = F.struct(F.lit("2").alias("k"), F.lit("new").alias("v"))
    got = [r.x for r in df.select(R.array_append_if_new("a", new, "k").alias("x")).collect()]
    assert [len(x) for x in got] == [3, 1, 2]
    null = F.struct(F.lit(None).cast("string").alias("k"), F.lit("new").alias("v"))
    got = [r.x for r in df.select(R.array_append_if_new("a", null, "k").alias("x")).collect()]
    assert [len(x) for x in got] == [3, 1, 1]


# --- classification --------------------------------------------------------


def test_classify(spark):
    data = [  # matched, incoming, stored, complete -> skip, compare
        (False, None, None, None, "insert", "insert"),
        (True, None, "2024-01-01", True, "no_action", "no_action"),
        (True, None, "2024-01-01", False, "no_action", "update"),
        (True, "2024-01-02", None, True, "update", "update"),
        (True, None, None, True, "no_action", "update"),
        (True, "2023-12-31", "2024-01-01", True, "no_action", "no_action"),
        (True, "2024-01-01", "2024-01-01", True, "no_action", "no_action"),
        (True, "2024-01-02", "2024-01-01", True, "update", "update"),
        (True, "2023-12-31", "2024-01-01", False, "update", "update"),
        (True, "2023-12-31", "2024-01-01", None, "update", "update"),
    ]
    df = spark.createDataFrame(data, "m boolean, i string, s string, c boolean, skip string, compare string")
    for mode in ("skip", "compare"):
        action = A.classify(F.col("m"), F.col("i").cast("date"), F.col("s").cast("date"), F.col("c"), mode)
        assert df.where(action != F.col(mode)).count() == 0


def test_completeness(spark):
    df = spark.createDataFrame([(True, True), (False, True), (None, True)], "a boolean, b boolean")
    got = df.select(A.complete_unless_false(F.col("a")).alias("x"), A.complete_if_all(F.col("a"), F.col("b")).alias("y"))
    assert [(r.x, r.y) for r in got.collect()] == [(True, True), (False, False), (True, False)]


def test_rejects(rows):
    df = Q.with_reject_reason(rows(["A"], [{"A": "1"}, {}]), {"no A": F.col("A").isNull()})
    assert Q.accepted(df).count() == 1
    assert values(Q.rejected(df, "s", F.lit("k")), "file", "step", "row_key", "reason") == [("f", "s", "k", "no A")]
    with pytest.raises(PySparkException, match="rejected row"):
        Q.fail_on_rejects(df).collect()


# --- upsert ----------------------------------------------------------------


def test_upsert_sets_nulls_keeps_created_and_grows_lineage(spark):
    ddl = "_id string, created string, v string, ardbDocuments array<string>"
    state = spark.createDataFrame([("1", "c1", "a", ["x"]), ("2", "c2", "b", None)], ddl)
    changes = spark.createDataFrame([("2", "n2", None, ["y"]), ("3", "n3", "d", ["y"])], ddl)
    out = U.upsert_apply(state, changes, keep_old=["created"])
    assert values(out, "_id", "created", "v", "ardbDocuments") == [
        ("1", "c1", "a", ["x"]), ("2", "c2", None, ["y"]), ("3", "n3", "d", ["y"]),
    ]


def test_update_many_reaches_every_row_of_a_key(spark):
    state = spark.sql("SELECT * FROM VALUES ('1', 1), ('1', 2), ('2', 3) AS t(k, n)").withColumn(
        "s", F.struct(F.lit("old").alias("v"), F.col("n").alias("w")))
    changes = spark.createDataFrame([("1", None)], "k string, nv string")
    out = U.update_many_nested(state, changes, "k", "s", {"v": "nv"}).select("n", "s.*")
    assert values(out, "n", "v", "w") == [(1, None, 1), (2, None, 2), (3, "old", 3)]


def test_patch_leaves_fields_without_a_value(spark):
    state = spark.sql("SELECT 'a' AS _id, named_struct('x', '1', 'y', '2') AS s UNION ALL SELECT 'b', named_struct('x', '1', 'y', '2')")
    patch = spark.createDataFrame([("a", "9", None)], "_id string, px string, py string")
    out = U.patch_nested_fields(state, patch, "_id", {"s.x": "px", "s.y": "py"}).select("_id", "s.*")
    assert values(out, "_id", "x", "y") == [("a", "9", "2"), ("b", "1", "2")]


# --- children --------------------------------------------------------------


@pytest.mark.parametrize("part_rows", [3, 100])
def test_large_parents_come_in_ordered_parts(rows, part_rows):
    data = [{"P": "big", "V": str(i)} for i in range(10)] + [{"P": "small", "V": "s"}, {"V": "n"}]
    out = K.collect_ordered(
        rows(["P", "V"], data), ["P"], ["V"], ["_file", "_block", "_line"], "items", part_rows=part_rows
    )
    got = {}
    for r in sorted(out.collect(), key=lambda r: (str(r.P), r.part)):
        assert r.part == len(got.setdefault(r.P, []))
        got[r.P].append([i.V for i in r["items"]])
    assert [v for part in got["big"] for v in part] == [str(i) for i in range(10)]
    assert all(len(p) == part_rows for p in got["big"][:-1]) and len(got["big"][-1]) <= part_rows
    assert got["small"] == [["s"]] and got[None] == [["n"]]


def test_parts_follow_runs_before_file_names(rows):
    """Five runs of one claim, files in reverse name order, above the part size."""
    frames = []
    for run in range(5):
        data = [{"P": "c", "V": f"r{run}-{i}"} for i in range(7)]
        frame = rows(["P", "V"], data, file=f"{9 - run}.rpt").withColumn("_run", F.lit(run))
        frames += [frame, frame.where("_line < 2").withColumn("_file", F.lit("same.rpt"))]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    order = ["_run", "_file", "_block", "_line"]
    want = [r.V for r in whole.orderBy(*order).collect()]
    out = K.collect_ordered(whole, ["P"], ["V"], order, "items", part_rows=4)
    parts = [[i.V for i in r["items"]] for r in out.orderBy("part").collect()]
    assert [v for p in parts for v in p] == want
    assert [len(p) for p in parts[:-1]] == [4] * (len(parts) - 1)


@pytest.mark.parametrize("single_file", [True, False])
def test_lines_take_missing_codes_from_their_own_old_line(rows, single_file):
    columns = ["CLAIM_ID", "CODE", "DATE_OF_SERVICE", *K.FALLBACK_FIELDS]
    new = rows(columns, [
        {"CLAIM_ID": "1", "CODE": "a", "DATE_OF_SERVICE": "d"},
        {"CLAIM_ID": "1", "CODE": "a", "DATE_OF_SERVICE": "d", "MODIFIER1": "later row"},
        {"CLAIM_ID": "1", "CODE": "b", "DATE_OF_SERVICE": "d"},
        {"CLAIM_ID": "2", "CODE": "a", "DATE_OF_SERVICE": "d"},
        {"CLAIM_ID": "1", "CODE": None, "DATE_OF_SERVICE": None},
    ])
    old = rows(columns, [
        {"CLAIM_ID": "1", "CODE": "a", "DATE_OF_SERVICE": "d", "MODIFIER1": "M", "DIAGNOSIS_CODE_INDEX8": "8"},
        {"CLAIM_ID": "1", "CODE": None, "DATE_OF_SERVICE": None, "MODIFIER1": "N"},
        {"CLAIM_ID": "1", "CODE": "gone", "DATE_OF_SERVICE": "d", "MODIFIER1": "G"},
    ])
    out = K.merge_lines(new, old, single_file)
    assert values(out, "CLAIM_ID", "CODE", "MODIFIER1", "DIAGNOSIS_CODE_INDEX8") == [
        ("1", "a", "M", "8"), ("1", "b", None, None), ("1", None, "N", None), ("2", "a", None, None),
    ]


# --- registry --------------------------------------------------------------


def test_only_failed_or_new_names_are_taken(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "name string")
    registry = spark.createDataFrame([("a", "Completed"), ("b", "Failed"), ("c", None)], "originalName string, status string")
    assert values(G.skip_registered_files(files, registry), "name") == [("b",), ("d",)]


def test_latest_status(spark):
    history = spark.sql("""SELECT * FROM VALUES
        ('d', 'New', timestamp_ntz '2024-01-01', NULL), ('d', 'Failed', timestamp_ntz '2024-01-03', 'why'),
        ('d', 'Processing', timestamp_ntz '2024-01-02', NULL) AS t(document, status, at, reason)""")
    assert values(G.latest_status(history), "document", "status", "reason") == [("d", "Failed", "why")]


# --- plans -----------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nested_fields_are_pruned_in_the_scan(spark, tmp_path):
    from rostermill.catalog.tables import persons_stored

    path = str(tmp_path / "enrollee")
    persons_stored(spark, "/root/testdata/sf0.001").write.parquet(path)
    stored = spark.read.parquet(path).where("referenceId = '7'")
    plan = plan_of(stored.select("_id", "demographic.address.city"))
    assert "ReadSchema: struct<_id:string,referenceId:string,demographic:struct<address:struct<city:string>>>" in plan
    assert "PushedFilters: [IsNotNull(referenceId), EqualTo(referenceId,7)]" in plan


def test_headers_are_shuffled_by_claim_once(spark):
    from rostermill.catalog.tables import claims_in, claims_stored
    from rostermill.plans.claims import claim_rows, classify_claims

    folder = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(classify_claims(claim_rows(claims_in(spark, folder)), claims_stored(spark, folder)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_claim#") == 2  # per diagnosis, then per claim
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_settings_grow_with_the_input():
    from rostermill.settings import session_settings

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert session_settings(1, 8)[name] == "24"
    assert int(session_settings(100 * 1024**4, 4_000)[name]) == 819_200


def test_array_union_keeps_first_of_each_key_in_order(spark):
    pair = "array<struct<k:string,v:int>>"
    data = [([("b", 1), (None, 2), ("b", 3)], [("a", 4), (None, 5), ("b", 6)])]
    df = spark.createDataFrame(data, f"x {pair}, y {pair}")
    got = df.select(array_union_by_key("x", "y", "k").alias("u"), array_union_by_key("x", F.lit(None).cast(pair), "k").alias("l")).first()
    assert [tuple(r) for r in got["u"]] == [("b", 1), (None, 2), ("a", 4)]
    assert [tuple(r) for r in got["l"]] == [("b", 1), (None, 2)]


def canonical(value):
    """Of Python values: tuples are named fields, lists arrays, dicts maps."""
    if value is None:
        return "-"
    if isinstance(value, tuple):
        return "{" + ",".join(f"{n}={canonical(v)}" for n, v in value) + "}"
    if isinstance(value, dict):
        return canonical([(("key", k), ("value", v)) for k, v in sorted(value.items())])
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    text = str(value)
    return f"{len(text)}:{text}"


def test_digests_tell_nested_values_apart(spark):
    ddl = "a string, s struct<x: string, t: struct<y: bigint>>, l array<struct<p: string, q: array<bigint>>>, m map<string, array<string>>"
    rows = [
        ("v", ("x", (1,)), [("p", [1, 2]), (None, None), None], {"k": ["1"], "j": None}),
        ("v", ("x", (None,)), [], {}), ("v", ("x", None), None, None), (None, None, [None], {"j": [None]}),
        ("-", (None, None), [(None, [])], {"j": []}), ("1:a", ("", (0,)), [("", [None])], {"": [""]}), ("", None, None, None), (None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, ddl)

    def fields(r):
        s = r.s and (("x", r.s.x), ("t", r.s.t and (("y", r.s.t.y),)))
        items = r.l if r.l is None else [i and (("p", i.p), ("q", i.q)) for i in r.l]
        return (("a", r.a), ("s", s), ("l", items), ("m", r.m))

    got = frame.select("*", row_digest(frame.schema).alias("d"), F.struct(*frame.columns).alias("w"))
    got = got.withColumn("of_struct", row_digest(got.schema["w"].dataType, "w")).collect()
    for r in got:
        text = ",".join(f"{n}={canonical(v)}" for n, v in fields(r))
        assert r.d == r.of_struct == hashlib.sha256(text.encode()).hexdigest(), text
    assert len({r.d for r in got}) == len(rows)


def test_digests_copy_a_text_once(spark):
    """Each text is a part of one concat, whatever its length or place."""
    def leaf(x):
        return "-" if x is None else f"{len(x)}:{x}"

    values = [None, "", "a", "\u00e9" * 99, "\u00df" * 100, "x" * 101, "\U0001f600" * 1000]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, a string")
    frame = frame.select("a", F.struct(F.struct("a").alias("s"), "i").alias("w"))
    whole = row_digest(frame.schema).alias("d")
    part = F.when(F.col("w.i") > 0, F.col("w")).alias("w")
    some = frame.select("a", part).select("a", row_digest(frame.schema["w"].dataType, "w").alias("d"))
    for (i, v), r, q in zip(enumerate(values), frame.select(whole).collect(), some.collect()):
        inner = f"s={{a={leaf(v)}}},i={leaf(str(i))}"
        assert r.d == hashlib.sha256(f"a={leaf(v)},w={{{inner}}}".encode()).hexdigest(), v
        assert q.d == hashlib.sha256((inner if i else "s=-,i=-").encode()).hexdigest(), v
    plan = frame.select(whole)._jdf.queryExecution().analyzed().toString()
    assert not re.search(r":, (cast\()?a#\d+", plan)



def test_wide_digests_and_structs_are_not_fused(spark):
    """Fused, their method is above what the JVM compiles."""
    from rostermill.operators.nest import nest_service_line
    from rostermill.schemas import LINE_FIELDS

    data = [("x", None), (None, "y"), ("1", "2")]
    frame = spark.createDataFrame(data, f"{LINE_FIELDS[0]} string, {LINE_FIELDS[-1]} string").repartition(2)
    frame = frame.withColumns({c: F.concat(F.lit(c), F.col(LINE_FIELDS[-1])) for c in LINE_FIELDS[1:-1]})
    lines = frame.select(nest_service_line(frame).alias("s"))
    got = lines.select("s", row_digest(lines.schema["s"].dataType, "s").alias("d"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "lambda" in plan
    for r in got.collect():
        text = ",".join(f"{n}={canonical(v)}" for n, v in r.s.asDict().items())
        assert r.d == hashlib.sha256(text.encode()).hexdigest()
    assert {r.s[LINE_FIELDS[0]] for r in got.collect()} == {"x", None, "1"}
    projects = [x for x in plan_of(got).split("== Initial Plan ==")[0].splitlines() if "Project [" in x]
    assert projects and not any("*(" in x for x in projects if "sha2" in x or "named_struct" in x)


def test_sides_that_grow_are_not_broadcast(spark):
    def side(*names):
        return spark.range(20).select(*[F.col("id").cast("string").alias(n) for n in names])

    left, right = side("a", "b"), side("k", "v")
    found = {
        "lookup": M.lookup(left, right, {"a": "k"}, {"v": "v"}, "r"),
        "inner": M.lookup(left, right, {"a": "k"}, {"v": "v"}, "r", how="inner"),
        "with_match": M.with_match(left, right, {"a": "k"}),
        "without_match": M.without_match(left, right, {"a": "k"}),
        "update_many": U.update_many_nested(
            left.select("a", F.struct("b").alias("d")),
            right.withColumnRenamed("k", "a"), "a", "d", {"b": "v"},
        ),
        "patch": U.patch_nested_fields(
            left.select("a", F.struct("b").alias("d")), right.withColumnRenamed("k", "a"), "a", {"d.b": "v"}
        ),
        "parts": K.with_part(
            left.withColumn("_block", F.lit(0)).withColumn("_line", F.lit(1)), ["a"], ["_block", "_line"]
        ),
    }
    for name, df in found.items():
        assert "BroadcastHashJoin" not in plan_of(df), name
        assert df.count() == 20 * (name != "without_match"), name
    hot = left.select("a").limit(1)
    salted = M.lookup(left, right, {"a": "k"}, {"v": "v"}, "r", hot=hot)
    assert "SortMergeJoin" in plan_of(salted) and salted.count() == 20
