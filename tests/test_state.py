"""State between runs: pruned reads, runtime filters, retried files, one count."""

import os
import random
import re
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from files import write_report
from rostermill.catalog import tables as B
from rostermill.catalog.loads import load_claims, load_claims_workbook
from rostermill.codes import relationship_table
from rostermill.operators.nest import documents
from rostermill.operators import children
from rostermill.plans import eligibility as PE
from rostermill.plans.claims import assemble_claims
from rostermill.plans.jobs import Ingest
from rostermill.plans.run import FolderRun, LazyRun, StoreRun
from rostermill.sources.files import scan_new_lines
from rostermill.skew import heavy_key_sets, hot_keys, split_sets
from rostermill.storage import TableStore, bucket_of
from rostermill.streaming.incremental import stream_claim_reports
from test_loads import AFTER_FIRST, AFTER_SECOND, CLAIM, FIRST, SECOND, claims_of

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def claims(spark, ids, status):
    rows = spark.createDataFrame([(i,) for i in ids], "i string")
    return documents(rows, "claim", {"_id": F.concat(F.lit("c"), "i"), "CLAIM_ID": "i", "CLAIM_STATUS": F.lit(status)})


def spoil(root, table, bucket):
    """Make every file of a table outside one folder unreadable."""
    spoilt = 0
    for path in root.glob(f"{table}/snapshot=*/bucket=*/*.parquet"):
        if f"/bucket={bucket}/" not in str(path):
            path.write_bytes(b"not parquet")
            crc = path.with_name(f".{path.name}.crc")
            crc.unlink(missing_ok=True)
            spoilt += 1
    return spoilt


def test_a_key_reads_one_folder(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), buckets=8)
    store.write("claim", 0, claims(spark, [str(i) for i in range(200)], "a"))
    store.commit(0)
    store.write("claim", 1, claims(spark, [str(i) for i in range(0, 200, 2)], "b"))
    store.commit(1)
    keys = spark.createDataFrame([("4",)], "k string")
    near = StoreRun(store, 2).state("claim", keys)
    plan = plan_of(near)
    assert len(re.findall(r"SubqueryAdaptiveBroadcast dynamicpruning#\d+", plan)) == 2
    bucket = keys.select(bucket_of("k", 8)).first()[0]
    assert spoil(tmp_path, "claim", bucket) >= 10
    got = {r.CLAIM_ID: r.CLAIM_STATUS for r in near.collect()}
    assert got["4"] == "b" and 10 < len(got) < 60
    with pytest.raises(Exception, match="not a Parquet file|CANNOT_READ"):
        store.read("claim").collect()


def test_a_store_keeps_its_number_of_folders(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), buckets=4)
    store.write("claim", 0, claims(spark, ["1", None], "a"))
    store.commit(0)
    again = TableStore(spark, str(tmp_path), buckets=32)
    assert again.buckets == 4
    nobody = spark.createDataFrame([(None,)], "k string")
    assert {r.CLAIM_ID for r in again.read("claim", keys=nobody).collect()} >= {None}
    assert again.read("claim", keys=nobody.limit(0)).count() == 0
    again.compact(["claim"])
    assert {r.CLAIM_ID for r in again.read("claim").collect()} == {"1", None}


def test_claim_runs_read_their_own_folders(spark, tmp_path):
    """A whole second load with all other folders unreadable."""
    folder = tmp_path / "in"
    folder.mkdir()
    store = TableStore(spark, str(tmp_path / "store"), buckets=8)
    write_report(folder / "a.rpt", CLAIM, FIRST)
    Ingest(store).claim_reports(str(folder))
    bucket = spark.createDataFrame([("C1",)], "k string").select(bucket_of("k", 8)).first()[0]
    others = [i for i in ("C2", "C3") if spark.createDataFrame([(i,)], "k string").select(bucket_of("k", 8)).first()[0] != bucket]
    assert "C2" in others
    for table in ("claim", "claim_diagnosis", "claim_line"):
        assert spoil(tmp_path / "store", table, bucket) >= 1
    write_report(folder / "b.rpt", CLAIM, [r for r in SECOND if r["CLAIM_ID"] == "C1"])
    Ingest(store).claim_reports(str(folder))
    keys = spark.createDataFrame([("C1",)], "k string")
    got = store.read("claim", keys=keys).where("CLAIM_ID = 'C1'").first()
    assert got.CLAIM_STATUS == "second" and [d.originalName for d in got.ardbDocuments] == ["b.rpt", "a.rpt"]
    lines = store.read("claim_line", keys=keys).where("CLAIM_ID = 'C1'").collect()
    assert sorted((r.CODE, r.MODIFIER1, r._run) for r in lines) == [("97110", "M1", 1), ("97113", None, 1)]


@pytest.fixture
def shuffled_joins(spark):
    """A session that shuffles joins and builds runtime filters at any size."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    }
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def coverage(spark, tmp_path, table, stored):
    """Classified coverage rows against stored ones written to files."""
    run = FolderRun({}, str(tmp_path), guard_skew=False)
    rows = run.cut("rows", PE.one_per_key(B.coverage_in(spark, SF), PE.ELIGIBILITY_COLUMNS, PE.ELIGIBILITY_KEYS))
    near = {n: run.cut(n, f(spark, SF)) for n, f in (
        ("enrollee", B.persons_stored), ("subscriber", B.subscribers_stored), ("patient", B.patients_stored))}
    return PE.classify_eligibilities(rows, *near.values(), run.cut(table, stored), run)


def joined_rows(df):
    """Rows that every exchange of the executed plan wrote."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, stack = [], [plan]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            stack.append(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_key_tuples_filter_the_state_before_its_shuffle(spark, tmp_path, shuffled_joins):
    """No stored eligibility has a product of the input: next to none is shuffled."""
    stored = B.eligibilities_stored(spark, SF)
    stored = stored.withColumn("product", F.struct(F.lit("none").alias("referenceId"), F.lit(None).cast("string").alias("name")))
    with_filter = coverage(spark, tmp_path / "with", "eligibility", stored)
    assert "might_contain" in plan_of(with_filter)
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    try:
        plain = coverage(spark, tmp_path / "plain", "eligibility", stored)
        assert "might_contain" not in plan_of(plain)
        saved = joined_rows(plain) - joined_rows(with_filter)
    finally:
        spark.conf.unset("spark.sql.optimizer.runtime.bloomFilter.enabled")
    assert saved >= 0.9 * stored.count()
    assert {r.action for r in with_filter.select("action").distinct().collect()} == {"insert"}


def test_tuple_keys_change_no_result(spark, tmp_path):
    rows = B.coverage_in(spark, SF)
    rows = rows.where("_line % 7 <> 0").unionByName(
        rows.where("_line % 7 = 0").withColumn("TERMINATION_DATE", F.lit(None).cast("string"))
    )
    first = PE.one_per_key(rows, PE.ELIGIBILITY_COLUMNS, PE.ELIGIBILITY_KEYS)
    stored = B.eligibilities_stored(spark, SF).select("_id", "enrollee.referenceId", *[
        F.col(c).alias(n) for c, n in (
            ("product.referenceId", "p"), ("subscriber.identificationCode", "s"), ("patient.memberId", "m"),
            ("serviceDate.formattedStartDate", "a"), ("serviceDate.formattedEndDate", "z"))])
    on = dict(zip(PE.ELIGIBILITY_KEYS, ("referenceId", "p", "s", "m", "a", "z")))
    from rostermill.operators.match import lookup, with_tuple

    plain = lookup(first, stored, on, {"_id": "_id"}, "_old")
    keyed = lookup(with_tuple(first, PE.ELIGIBILITY_KEYS), stored, on, {"_id": "_id"}, "_old", tuple_key="_tuple")
    pick = lambda df: sorted((r._line, r._old and r._old._id) for r in df.collect())
    assert pick(plain) == pick(keyed) and any(i for _, i in pick(keyed))


def test_heavy_key_sets_equal_single_counts(rows):
    data = [{"A": a, "B": b} for a, b in [("x", "1"), ("x", "1"), ("x", "2"), (None, "1"), (None, None), (None, None), ("y", None)] * 3]
    df = rows(["A", "B", "C"], data)
    sets = [["A"], ["B"], ["A", "B"], ["B", "A"], ["A"]]
    for least in (1, 4, 9):
        parts = split_sets(heavy_key_sets(df, sets, least), sets)
        assert list(parts) == [("A",), ("B",), ("A", "B"), ("B", "A")]
        for keys, found in parts.items():
            want = hot_keys(df, list(keys), least)
            assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))


def test_the_load_counts_heavy_keys_once(spark, tmp_path):
    counted = []

    class Watched(FolderRun):
        def hot(self, rows, keys):
            counted.append(keys)
            return super().hot(rows, keys)

        def hot_sets(self, rows, sets):
            counted.append(sets)
            return super().hot_sets(rows, sets)

    run = Watched(
        {"enrollee": B.persons_stored(spark, SF), "subscriber": B.subscribers_stored(spark, SF),
         "patient": B.patients_stored(spark, SF), "eligibility": B.eligibilities_stored(spark, SF)},
        str(tmp_path),
    )
    PE.load_eligibility(
        B.persons_in(spark, SF), B.coverage_in(spark, SF), run, B.fixed_lineage(spark, "persons", "coverage"),
        relationship_table(spark),
    )
    assert len(counted) == 1 and len(counted[0]) == 5
    plan = plan_of(heavy_key_sets(B.coverage_in(spark, SF), counted[0]))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_a_mended_file_comes_back_to_the_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    ingest = Ingest(TableStore(spark, str(tmp_path / "store")))

    def run():
        stream_claim_reports(ingest, str(folder), str(tmp_path / "ckpt"), 1).awaitTermination()
        return [r.path.rsplit("/", 1)[-1] for r in ingest.failed_files("claim_rpt").collect()]

    write_report(folder / "a.rpt", CLAIM, FIRST)
    write_report(folder / "b.rpt", ["OTHER"], [{"OTHER": "1"}])
    assert run() == ["b.rpt"] and claims_of(ingest.store) == AFTER_FIRST
    # still broken: tried again, still in the set
    assert run() == ["b.rpt"] and claims_of(ingest.store) == AFTER_FIRST
    # mended under its name; the checkpoint would never give it again
    write_report(folder / "b.rpt", CLAIM, SECOND)
    assert run() == [] and claims_of(ingest.store) == AFTER_SECOND
    assert run() == [] and claims_of(ingest.store) == AFTER_SECOND
    # a failed file that is gone is no obstacle
    write_report(folder / "c.rpt", ["OTHER"], [{"OTHER": "1"}])
    assert run() == ["c.rpt"]
    (folder / "c.rpt").unlink()
    assert run() == ["c.rpt"] and claims_of(ingest.store) == AFTER_SECOND


def test_runs_of_lazy_plans_see_what_they_saved(spark):
    run = LazyRun({"claim": claims(spark, ["1", "2"], "a")})
    now = run.save("claim", claims(spark, ["2", "3"], "b"))
    assert run.state("claim") is now
    assert {r.CLAIM_ID: r.CLAIM_STATUS for r in now.collect()} == {"1": "a", "2": "b", "3": "b"}


def test_loads_count_while_they_write(spark, tmp_path):
    run = FolderRun(
        {"enrollee": B.persons_stored(spark, SF), "subscriber": B.subscribers_stored(spark, SF),
         "patient": B.patients_stored(spark, SF), "eligibility": B.eligibilities_stored(spark, SF)},
        str(tmp_path),
    )
    result = PE.load_eligibility(
        B.persons_in(spark, SF), B.coverage_in(spark, SF), run, B.fixed_lineage(spark, "persons", "coverage"),
        relationship_table(spark),
    )
    plan = plan_of(result.counts())
    assert "FileScan" not in plan
    got = {(r.step, r.action): r.n_rows for r in result.counts().collect()}
    want = {}
    for step, rows in result.classified.items():
        for r in rows.groupBy("action").count().collect():
            want[step, r["action"]] = r["count"]
        assert result.counted[step]["rejected"] == rows.where("_reason IS NOT NULL").count()
    assert got == want and {s for s, _ in got} == {"enrollee", "subscriber", "patient", "eligibility"}


def files_read(df):
    """Text files that the executed plan opened."""
    df.collect()
    found, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            stack.append(node.plan())
        elif name == "FileSourceScanExec" and node.toString().startswith("FileScan text"):
            found = max(found, node.metrics().apply("numFiles").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return found


def test_old_files_are_pruned_by_their_metadata(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(6):
        write_report(folder / f"old{i}.rpt", CLAIM, FIRST)
        os.utime(folder / f"old{i}.rpt", (1_700_000_000 + i, 1_700_000_000 + i))
    ingest = Ingest(TableStore(spark, str(tmp_path / "store")))
    ingest.claim_reports(str(folder))
    write_report(folder / "new.rpt", CLAIM, SECOND)
    monkeypatch.setattr("rostermill.plans.jobs.listed_paths", None)  # the claim load takes no list
    scans = []

    def watched(*args):
        scans.append(scan_new_lines(*args))
        return scans[-1]

    monkeypatch.setattr("rostermill.plans.jobs.scan_new_lines", watched)
    ingest.claim_reports(str(folder))
    assert files_read(scans[0]) == 1
    got = claims_of(ingest.store)
    assert got["C1"][0] == "second" and got["C1"][3][0] == "new.rpt"
    assert {r.originalName: r.status for r in ingest.current_registry().collect()}["new.rpt"] == "Completed"


@pytest.mark.parametrize("part_rows, slots", [(3, 2), (5, 4), (4, 1000)])
def test_parts_of_a_giant_parent_over_many_stretches(rows, monkeypatch, part_rows, slots):
    monkeypatch.setattr(children, "SLOTS", slots)
    rng = random.Random(part_rows)
    data = [{"P": "giant" if i % 3 == 0 else rng.choice(["a", "b", None, f"p{i % 50}"]), "V": str(i), "_file": rng.choice("xyz")} for i in range(600)]
    df = rows(["P", "V"], data, partitions=7)
    found = children.with_part(df, ["P"], ["_file", "_block", "_line"], part_rows=part_rows)
    by = {}
    for n, d in enumerate(data):
        by.setdefault(d["P"], []).append((d["_file"], n, d["V"]))
    want = {v: i // part_rows for items in by.values() for i, (_, _, v) in enumerate(sorted(items))}
    assert {r.V: r.part for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[(.*?)\]", plan)
    assert len(windows) == 3


@pytest.mark.parametrize("least", [1, 60, 10**6])
def test_children_are_shuffled_once_unless_a_parent_is_heavy(rows, monkeypatch, least):
    monkeypatch.setattr(children, "HEAVY_ROWS", least)
    rng = random.Random(7)
    data = [{"P": "giant" if i % 3 == 0 else rng.choice(["a", None, f"p{i % 50}"]), "V": str(i)} for i in range(400)]
    df = rows(["P", "V"], data, partitions=5)
    found = children.collect_ordered(df, ["P"], ["V"], ["_file", "_block", "_line"], "items", part_rows=30)
    exchanges = plan_of(found).count("Exchange hashpartitioning")
    assert exchanges == 1 if least == 10**6 else exchanges > 1
    want = {}
    for d in data:
        want.setdefault(d["P"], []).append(d["V"])
    got = {(r.P, r.part): [i.V for i in r["items"]] for r in found.collect()}
    assert got == {(p, i // 30): v[i : i + 30] for p, v in want.items() for i in range(0, len(v), 30)}


@pytest.mark.parametrize("least", [1, 5, 10**6])
def test_claims_are_assembled_where_their_children_lie(spark, monkeypatch, least):
    """Diagnoses, lines and headers are shuffled once each; claims with one kind of
    children, with more parts of one kind, without an id or a header."""
    monkeypatch.setattr(children, "HEAVY_ROWS", least)

    def stored(table, field, kept):
        data = [(c, f"{field}{i}", i) for c, n in kept.items() for i in range(n)]
        frame = spark.createDataFrame(data, "c string, v string, i bigint")
        values = {"CLAIM_ID": "c", field: "v", "_run": "0", "_file": F.lit("f"), "_block": "0", "_line": "i"}
        return documents(frame, table, values)

    codes, lines = {"a": 7, "b": 2, "d": 1, None: 3}, {"a": 3, "c": 8, "d": 4, None: 1, "lost": 2}
    ids = ["a", "b", "c", "d", None, "childless"]
    heads = documents(spark.createDataFrame([(i,) for i in ids], "i string"), "claim", {"_id": "i", "CLAIM_ID": "i"})
    args = heads, stored("claim_diagnosis", "DIAGNOSIS_CODE", codes), stored("claim_line", "CODE", lines)
    found = assemble_claims(*args, part_rows=3)
    if least == 10**6:
        assert plan_of(found).count("Exchange hashpartitioning") == 3
    got = {
        (r.CLAIM_ID, r.part): ([x.DIAGNOSIS_CODE for x in r.DIAGNOSIS_CODES], [x.CODE for x in r.SERVICE_LINES])
        for r in found.collect()
    }
    want = {}
    for c in ids:
        for part in range(-(-max(codes.get(c, 0), lines.get(c, 0)) // 3)):
            at = range(3 * part, 3 * part + 3)
            want[c, part] = (
                [f"DIAGNOSIS_CODE{i}" for i in at if i < codes.get(c, 0)],
                [f"CODE{i}" for i in at if i < lines.get(c, 0)],
            )
    assert got == want and found.count() == len(want)


@pytest.mark.parametrize("load", [load_claims, load_claims_workbook])
def test_a_load_reads_its_inputs_once(spark, load):
    """Lines and orders are joined when the inputs are written; only the ids of
    stored headers are looked up in the tables again."""
    plan = plan_of(load(spark, SF))
    assert not re.search(r"FileScan parquet \[[^]]*l_linenumber", plan)


def test_a_written_table_lets_shuffle_files_go(spark, tmp_path):
    """Of twelve written steps, the files of at most the last ones are left."""
    blocks = spark._jsc.sc().env().blockManager().diskBlockManager()

    def kept():
        files = blocks.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    before, store = kept(), TableStore(spark, str(tmp_path))
    for run in range(6):
        store.write("claim", run, claims(spark, [str(i) for i in range(50)], "a").repartition(4, "CLAIM_ID"))
        store.stage("lines", run, spark.range(100).repartition(3, "id"))
    for _ in range(50):
        if len(kept() - before) <= 3:
            break
        time.sleep(0.2)
    assert len(kept() - before) <= 3


def test_lines_and_orders_meet_by_claim(spark):
    """A claim's rows lie together: what groups them by claim shuffles nothing again."""
    by_claim = B.claim_input(spark, SF).groupBy("CLAIM_ID").count()
    assert plan_of(by_claim).count("Exchange hashpartitioning") == 2


def test_queries_are_listed_without_a_session():
    """The entry is imported, and its queries and SQL listed, before Spark starts."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 90 and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_keys_of_later_snapshots_are_counted_before_they_are_broadcast(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path), buckets=2)
    for run, ids in enumerate([range(40), range(0, 40, 2)]):
        store.write("claim", run, claims(spark, [str(i) for i in ids], f"run {run}"))
        store.commit(run)
    assert "BroadcastHashJoin" in plan_of(store.read("claim"))
    monkeypatch.setattr("rostermill.storage.FEW_KEYS", 19)
    many = store.read("claim")
    assert "BroadcastHashJoin" not in plan_of(many)
    assert {r.CLAIM_STATUS: r["count"] for r in many.groupBy("CLAIM_STATUS").count().collect()} == {
        "run 0": 20, "run 1": 20,
    }
