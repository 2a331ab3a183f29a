"""Scans of real files."""

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from files import write_report, write_workbook
from rostermill.sources.files import list_input_files, listed_paths, scan_lines
from rostermill.sources import fixed_width
from rostermill.sources.fixed_width import (
    file_layouts,
    fwf_layout,
    layout_problems,
    parse_shared_layout,
    read_fixed_width,
    shared_heads,
    shared_layout_problems,
)
from rostermill.sources import workbook
from rostermill.sources.workbook import (
    Sheet,
    list_sheets,
    parse_workbook_sheets,
    parse_workbooks,
    read_workbook_sheets,
    workbook_files,
)


def paths(spark, folder, extension):
    return listed_paths(list_input_files(spark, str(folder), extension))


def test_listing_skips_lock_files_and_other_types(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.rpt", "sub/b.rpt", "~$c.rpt", "d.txt"):
        (tmp_path / name).write_text("x")
    got = list_input_files(spark, str(tmp_path), "rpt").collect()
    assert sorted((r.name, r.length) for r in got) == [("a.rpt", 1), ("b.rpt", 1)]


def test_layout_rules(spark, tmp_path):
    (tmp_path / "a.rpt").write_text(
        "CLAIM_ID   CODE  LAST_NAME_IS_LONG\n---------- ----- ---------\nC1         97110 abc\n"
    )
    got = {r.name: (r.start, r.length) for r in fwf_layout(scan_lines(spark, paths(spark, tmp_path, "rpt"))).collect()}
    assert got == {"CLAIM_ID": (1, 11), "CODE": (12, 6), "LAST_NAME_IS_LONG": (18, 17)}


@pytest.mark.parametrize("shared", [False, True])
def test_rows_keep_file_order_and_missing_texts(spark, tmp_path, shared):
    columns = ["CLAIM_ID", "CODE", "NOTE"]
    rows = [{"CLAIM_ID": f"C{i}", "CODE": "NA" if i % 3 else str(i), "NOTE": "n"} for i in range(500)]
    write_report(tmp_path / "a.rpt", columns, rows)
    with open(tmp_path / "a.rpt", "a") as f:
        f.write("\n   \nC500\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        df = read_fixed_width(spark, str(tmp_path), [*columns, "ABSENT"], shared_layout=shared)
        got = sorted(df.collect(), key=lambda r: (r._file, r._block, r._line))
        assert len({r._block for r in got}) > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.CLAIM_ID for r in got] == [f"C{i}" for i in range(501)]
    assert [r.CODE for r in got[:4]] == ["0", None, None, "3"]
    assert got[500].NOTE is None and all(r.ABSENT is None for r in got)


def test_files_of_different_layout(spark, tmp_path):
    write_report(tmp_path / "a.rpt", ["CLAIM_ID", "CODE"], [{"CLAIM_ID": "1", "CODE": "x"}])
    write_report(tmp_path / "b.rpt", ["CODE", "CLAIM_ID"], [{"CLAIM_ID": "2", "CODE": "y"}], gap=3)
    write_report(tmp_path / "c.rpt", ["CODE"], [{"CODE": "z"}])
    got = read_fixed_width(spark, str(tmp_path), ["CLAIM_ID", "CODE"], required=["CLAIM_ID"]).collect()
    assert sorted((r.CLAIM_ID, r.CODE) for r in got) == [("1", "x"), ("2", "y")]
    need = ["CLAIM_ID", "CODE"]
    known = file_layouts(scan_lines(spark, paths(spark, tmp_path, "rpt")), need)
    bad = layout_problems(known, need).collect()
    assert [(r._file[-5:], r._problem) for r in bad] == [("c.rpt", "missing columns: CLAIM_ID")]
    with pytest.raises(PySparkException, match="other layout"):
        read_fixed_width(spark, str(tmp_path), ["CLAIM_ID"], shared_layout=True).collect()


@pytest.mark.parametrize("shared", [False, True])
def test_heads_are_told_by_their_place(spark, tmp_path, shared):
    """Later rows that read like the heads are rows."""
    text = "AAA BBB\n--- ---\n1   2\nAAA BBB\n--- ---\n---\n3   4\n"
    (tmp_path / "a.rpt").write_text(text)
    df = read_fixed_width(spark, str(tmp_path), ["AAA", "BBB"], shared_layout=shared)
    got = [(r.AAA, r.BBB) for r in sorted(df.collect(), key=lambda r: r._line)]
    assert got == [("1", "2"), ("AAA", "BBB"), ("---", "---"), ("---", None), ("3", "4")]


def test_same_dashes_under_another_header(spark, tmp_path):
    (tmp_path / "a.rpt").write_text("AAA BBB\n--- ---\n1   2\n")
    (tmp_path / "b.rpt").write_text("BBB AAA\n--- ---\n3   4\n")
    lines = scan_lines(spark, paths(spark, tmp_path, "rpt"))
    heads = shared_heads(lines, "AAA BBB", "--- ---")
    assert [r._file[-5:] for r in shared_layout_problems(heads).collect()] == ["b.rpt"]
    got = parse_shared_layout(lines, ["AAA", "BBB"], "AAA BBB", "--- ---", skip_others=True).collect()
    assert [(r.AAA, r.BBB) for r in got] == [("1", "2")]
    with pytest.raises(PySparkException, match="other layout"):
        read_fixed_width(spark, str(tmp_path), ["AAA"], shared_layout=True).collect()


def test_workbook_cells(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {
        "OTHER": [["X"], ["1"]],
        "CLAIMS": [
            ["CLAIM_ID", "DOB", "NOTE", "FLAG"],
            [12345, ("date", 45292), ("shared", "ü & <x>"), True],
            [None, None, None, None],
            ["007", ("date", 45292.5), "N/A", None],
            [1.5, None, "x", False],
        ],
    })
    (tmp_path / "~$a.xlsx").write_text("lock")
    books = workbook_files(spark, paths(spark, tmp_path, "xlsx"))
    got = read_workbook_sheets(books, "CLAIMS", ["CLAIM_ID", "NOTE", "DOB", "FLAG", "ABSENT"])
    got = sorted(got.collect(), key=lambda r: r._line)
    assert [(r.CLAIM_ID, r.DOB, r.NOTE, r.FLAG) for r in got] == [
        ("12345", "2024-01-01 00:00:00", "ü & <x>", "True"),
        ("007", "2024-01-01 12:00:00", None, None),
        ("1.5", None, "x", "False"),
    ]
    assert [r.sheet for r in list_sheets(books).orderBy("position").collect()] == ["OTHER", "CLAIMS"]


def test_a_broken_workbook_does_not_stop_the_others(spark, tmp_path):
    write_workbook(tmp_path / "good.xlsx", {"CLAIMS": [["CLAIM_ID"], ["1"]]})
    write_workbook(tmp_path / "lacks.xlsx", {"CLAIMS": [["OTHER"], ["1"]]})
    write_workbook(tmp_path / "nosheet.xlsx", {"X": [["CLAIM_ID"], ["1"]]})
    (tmp_path / "bad.xlsx").write_text("not a zip")
    books = workbook_files(spark, paths(spark, tmp_path, "xlsx"))
    rows = parse_workbook_sheets(books, "CLAIMS", ["CLAIM_ID"], ["CLAIM_ID"], sheet_required=True).collect()
    assert [r.CLAIM_ID for r in rows if r._problem is None] == ["1"]
    problems = {r._file.rsplit("/", 1)[-1]: r._problem for r in rows if r._problem}
    assert "missing columns: CLAIM_ID" in problems["lacks.xlsx"]
    assert "no sheet CLAIMS" in problems["nosheet.xlsx"]
    assert "BadZipFile" in problems["bad.xlsx"]


def test_a_workbook_is_unpacked_once_for_all_sheets(tmp_path, monkeypatch):
    cells = [[("shared", f"v{i}"), i] for i in range(10_000)]
    write_workbook(tmp_path / "a.xlsx", {"A": [["X", "Y"], *cells], "B": [["Y"], ["1"]], "C": [["X"], ["2"]]})
    opened = []

    class Counting(workbook.zipfile.ZipFile):
        def __init__(self, *args, **more):
            opened.append("book")
            super().__init__(*args, **more)

        def open(self, name, *args, **more):
            opened.append(getattr(name, "filename", name))
            return super().open(name, *args, **more)

    monkeypatch.setattr(workbook.zipfile, "ZipFile", Counting)
    schema = pa.schema(
        [("_sheet", pa.string()), ("X", pa.string()), ("Y", pa.string()), ("_more", pa.map_(pa.string(), pa.string())),
         ("_file", pa.string()), ("_block", pa.int64()), ("_line", pa.int64()), ("_problem", pa.string())])
    want = {"A": Sheet(["X"]), "B": Sheet(["X", "Y"]), "D": Sheet(["X"])}
    batches = list(workbook._book_batches("a", (tmp_path / "a.xlsx").read_bytes(), want, schema))
    assert [b.num_rows for b in batches] == [4096, 4096, 1808, 1]
    assert opened.count("book") == 1 and opened.count("xl/sharedStrings.xml") == 1
    assert [x for x in opened if "sheet" in x.lower() and "shared" not in x] == ["xl/worksheets/sheet1.xml", "xl/worksheets/sheet2.xml"]
    last = batches[2].to_pylist()[-1]
    assert last["X"] == "v9999" and last["_more"] == [("Y", "9999")] and last["_line"] == 9999


def test_sheets_of_many_workbooks_in_one_pass(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {
        "P": [["ID", "NAME", "ID", None, "NAME_2"], ["1", "n", "twin", "nameless", "second"], ["2", None, None, None, "N/A"]],
        "E": [["NAME", "CODE"], ["m", "c"]],
    })
    write_workbook(tmp_path / "b.xlsx", {"E": [["CODE"], ["d"]], "P": [["NAME"], ["lacks id"]]})
    (tmp_path / "c.xlsx").write_text("not a zip")
    books = workbook_files(spark, paths(spark, tmp_path, "xlsx"))
    parsed = parse_workbooks(books, {"E": Sheet(["NAME", "CODE"]), "P": Sheet(["ID", "NAME"], ["ID"], True)})
    rows = [r.asDict() for r in parsed.collect()]
    codes = {r["CODE"]: r["NAME"] for r in rows if r["_sheet"] == "E" and not r["_problem"]}
    assert codes == {"c": "m", "d": None}
    people = {r["ID"]: (r["NAME"], r["_more"]) for r in rows if r["_sheet"] == "P" and not r["_problem"]}
    assert people == {"1": ("n", {"ID.1": "twin", "column 4": "nameless", "NAME_2": "second"}), "2": (None, {})}
    problems = {r["_file"][-6:]: r["_problem"] for r in rows if r["_problem"]}
    assert problems["b.xlsx"] == "ValueError: missing columns: ID" and "BadZipFile" in problems["c.xlsx"] and len(problems) == 2


def test_rows_of_one_report_are_not_gathered(spark):
    """Layouts go to the rows: rows do not meet by file."""
    from rostermill.catalog import all_queries

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = all_queries()["read_fixed_width"](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "hashpartitioning(_file" not in plan and "BroadcastHashJoin" in plan


def test_many_layouts_meet_a_large_file_in_many_tasks(spark, monkeypatch):
    data = [("head", "f", 0, 0), ("----", "f", 0, 1)] + [(f"{i:04d}", "f", 0, 2 + i) for i in range(300)]
    data += [("lost", None, 0, i) for i in range(5)]
    lines = spark.createDataFrame(data, "value string, _file string, _block bigint, _line bigint")
    monkeypatch.setattr(fixed_width.hot_keys, "__defaults__", (100,))
    rows = fixed_width.parse_lines(lines, ["head"])
    assert "_salt" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["head"] for r in rows.collect()) == [f"{i:04d}" for i in range(300)]
