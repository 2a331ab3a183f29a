"""Periodic runs, nearest vectors and importance ranks against brute force."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from rostermill.llm import collision_search, importance, periodic_runs
from rostermill.llm.collision_search import Search
from rostermill.llm.importance import Resample
from rostermill.llm.periodic_runs import Runs
from rostermill.llm.queries import op11_periodic_runs, op12_nearest, op13_importance
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def brute_runs(words, least=6, copies=4):
    found = []
    n = len(words)
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            found.append((i, j + q - i, q))
            i = j
    # a stretch of period q whose smallest period is smaller is not a run of q
    out = []
    for s, n_, q in found:
        if n_ < max(least, copies * q):
            continue
        smaller = any(all(words[x] == words[x + d] for x in range(s, s + n_ - d)) for d in range(1, q))
        if not smaller:
            out.append((s, n_, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def random_words(rng, size):
    out = []
    while len(out) < size:
        piece = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
        out += piece * rng.choice([1, 1, 2, 3, 4, 5, 9]) + piece[: rng.randint(0, len(piece))]
    return out[:size]


def test_runs_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [random_words(rng, rng.randint(0, 120)) for _ in range(400)]
    texts += [["a"] * n for n in range(10)] + [["a", "b"] * 40 + ["a"], ["x"] + ["a", "b", "a"] * 30]
    # Fibonacci words hold runs of many periods that overlap
    a, b = ["a"], ["a", "b"]
    while len(b) < 300:
        a, b = b, b + a
    texts += [b, b + b, b * 5]
    rows = [(i, rng.choice([" ", "\t", "\r\n "]).join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batch in (7, 1000):
        got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(docs, batch=batch).collect()}
        for i, words in enumerate(texts):
            runs = brute_runs(words)
            assert [tuple(r) for r in got[i]["runs"]] == runs, (i, words)
            assert got[i]["collapsed"] == " ".join(collapsed(words, runs))
            assert got[i]["n_words"] == len(words)
    rule = Runs(least=2, copies=2)
    # at two copies of a factor its stretch is proposed as well
    assert [tuple(r) for r in periodic_runs.periodic_runs(docs.limit(0), rule).collect()] == []


def test_a_proposal_is_extended_and_reported_once():
    words = np.array([9, 1, 2, 1, 2, 1, 2, 1, 2, 1, 7, 7, 7, 7, 7, 7])
    start, length, period = periodic_runs.find(words, np.zeros(len(words), np.int64))
    assert list(zip(start, length, period)) == [(1, 9, 2), (10, 6, 1)]
    start, end = periodic_runs._extend(words, np.zeros(len(words), int), np.array([3, 4]), np.array([7, 8]), np.array([2, 2]))
    assert list(start) == [1, 1] and list(end) == [10, 10]
    text = np.repeat([0, 1], 8)
    start, length, period = periodic_runs.find(np.ones(16, np.int64), text)
    assert list(zip(start, length, period)) == [(0, 8, 1), (8, 8, 1)]


def test_odd_texts_have_defined_runs(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(60_000)) + " tail" * 70_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a"), (4, "a a a a a a a a"), (5, "a\x1ca " * 6), (6, long), (6, long), (7, "ä ö " * 5)]
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n_words int, runs string")
    got = periodic_runs.periodic_runs(docs.repartition(3)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(([tuple(x) for x in r["runs"]], r["collapsed"][:40]))
    assert len(got) == len(rows) and by[1] == by[2] == by[3] == [([], "")]
    assert by[None] == [([(0, 6, 1)], "a")]
    assert by[4] == [([(1, 6, 1)], "a a a")] and by[5] == [([(0, 6, 1)], "a\x1ca")]
    assert by[6] == [([(60_000, 70_000, 1)], long[:40])] * 2
    assert by[7] == [([(0, 10, 2)], "ä ö")]
    before = periodic_runs._groups([b"a a", b"b b b", b"", b"c"])
    assert [len(g) for g in before] == [4]
    monkeypatch.setattr(periodic_runs, "WORDS", 3)
    assert [len(g) for g in periodic_runs._groups([b"a a", b"b b b", b"", b"c"])] == [1, 2, 1]


def test_runs_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r.asDict() for r in op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(rows)
    looped = 0
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"] or "")
        n, h = len(words), zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            looped += 1
        if n > 3000:
            continue
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        text = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        assert got[row["doc_id"]] == {
            "doc_id": row["doc_id"],
            "n_runs": len(runs),
            "start": best[0],
            "length": best[1],
            "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": hashlib.sha256(text.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(" ".join(collapsed(words, runs)).encode()).hexdigest(),
        }
    assert looped > 5


# -- nearest vectors ----------------------------------------------------------


def product(a, b):
    """Added up in order; sum() would correct its rounding."""
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def brute_nearest(rows, asked, k):
    """{query row: [(id, score)]} over distinct usable rows."""
    usable = {
        (i, tuple(v)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for q in usable:
        if asked(q[0]):
            near = [(-product(q[1], c[1]), c[0]) for c in usable if c != q and len(c[1]) == len(q[1])]
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def test_small_searches_are_exact(spark):
    rng = np.random.default_rng(1)
    few = [[float(x) for x in v] for v in rng.integers(-3, 4, (60, 3))]
    rows = [(i, v) for i, v in enumerate(few)]
    rows += [(100 + i, few[7]) for i in range(40)] + [(5, few[5]), (5, [1.0, 2.0, 3.0]), (None, few[9])]
    rows += [(200, None), (205, [0.0, 0.0, 0.0]), (210, [1.0, None, 2.0]), (215, [math.nan, 1.0, 0.0]), (220, [math.inf, 1.0, 0.0]), (225, [])]
    rows += [(300, [1.0, 1.0]), (305, [1.0, 2.0]), (310, [1e-3, 5.0]), (315, [1e4, 1e4])]
    table = spark.createDataFrame([(i, v, 1, 2.0, "p") for i, v in rows], "vec_id long, embedding array<double>, rank int, score double, place string")
    for k in (1, 4, 20):
        want = brute_nearest(rows, lambda i: i % 5 == 0, k)
        got = {}
        for r in collision_search.nearest(table.repartition(3), F.col("vec_id") % 5 == 0, k).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        for (i, v), near in want.items():
            if i != 5:
                assert got.get(i, []) == near, (k, i)
        five = [near for (i, _), near in sorted(want.items()) if i == 5]
        assert sorted(got[5]) == sorted(x for near in five for x in near)
        assert set(got) == {i for (i, _), near in want.items() if near}
    assert collision_search.nearest(table.limit(0), F.lit(True)).count() == 0
    assert collision_search.nearest(table, F.lit(None).cast("boolean")).count() == 0


def test_shards_copies_and_norms_lose_little(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((1500, 24)) * np.exp(rng.standard_normal((1500, 1)))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    search = Search(rows=400, queries=20, extra=40)
    got = {}
    for r in collision_search.nearest(table, F.col("vec_id") % 15 == 0, 10, search).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute_nearest(rows, lambda i: i % 15 == 0, 10)
    hits = 0
    for (i, v), near in want.items():
        ranks = sorted(got[i])
        assert [r for r, _, _ in ranks] == list(range(1, 11))
        assert all(s == product(v, rows[j][1]) for _, j, s in ranks)
        hits += len({j for _, j, _ in ranks} & {j for j, _ in near})
    assert hits >= 0.9 * 10 * len(want)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, sf):
    """At least 0.9 of the true 20 nearest (a candidate share that is far from all)."""
    data = duckdb.sql(f"SELECT vec_id, embedding FROM '/root/testdata/{sf}/embeddings.parquet' ORDER BY vec_id").fetchnumpy()
    ids, x = data["vec_id"], np.stack([np.asarray(e, np.float64) for e in data["embedding"]])
    got = {}
    for r in op12_nearest(spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    asked = np.flatnonzero(ids % 20 == 0)
    assert set(got) == set(ids[asked].tolist())
    hits = 0
    for q in asked:
        score = x @ x[q]
        score[q] = -np.inf
        near = got[ids[q]]
        assert sorted(near) == list(range(1, 21)) and ids[q] not in {i for i, _ in near.values()}
        hits += len({i for i, _ in near.values()} & set(ids[np.argsort(-score)[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(asked)


def test_windows_grow_until_enough_collide():
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((3000, 16))
    shard = collision_search.Shard(np.arange(3000), vectors, Search(extra=20, part=0.02))
    found = dict(shard.candidates(vectors[:8]))
    assert sorted(found) == list(range(8))
    for i, hit in found.items():
        assert i in hit and 80 <= len(hit) < 2900


# -- importance ---------------------------------------------------------------


def brute_resample(docs, target, rule=Resample()):
    def of(text):
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i : i + n]) for n in range(1, rule.words + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(f.encode()) % rule.buckets for f in runs]

    s, t = [0] * rule.buckets, [0] * rule.buckets
    rows = [(k, *of(x)) for k, x in docs]
    for _, _, found in rows:
        for b in found:
            s[b] += 1
    for x in target:
        for b in of(x)[1]:
            t[b] += 1
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + rule.buckets) / ((s[b] + 1) * (sum(t) + rule.buckets))))
        for b in range(rule.buckets)
    ]
    out = []
    for k, n, found in rows:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"{rule.seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append((k, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in out if r[1] >= rule.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = len(enough) * rule.percent // 100
    rest = [r for r in out if r[1] < rule.least_words]
    return sorted(
        [(k, f, w, s, i + 1 if i < drawn else None) for i, (k, _, f, w, s) in enumerate(enough)]
        + [(k, f, w, s, None) for k, _, f, w, s in rest],
        key=str,
    )


def test_resampling_equals_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["alpha", "Beta", "gamma7", "日本", "ärger", "x_y", "don't", "I"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for i in range(300)]
    docs += [(5, "alpha " * 25)] * 7 + [(6, "alpha " * 21), (None, "beta " * 40), (None, None), (301, None), (302, ""), (-(2**63), "I " * 20), (2**63 - 1, "I " * 20)]
    target = ["alpha beta alpha", None, "日本 日本", ""]
    frame = spark.createDataFrame([(k, t, "w", 3) for k, t in docs], "doc_id long, text string, weight string, rank int").repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for rule in (Resample(), Resample(words=3, percent=50, least_words=1, bits=3, block=16), Resample(percent=100, least_words=0, bits=5, block=7)):
        got = sorted((tuple(r) for r in importance.resample(frame, aim, rule).collect()), key=str)
        assert got == brute_resample(docs, target, rule)
    assert importance.resample(frame.limit(0), aim).count() == 0
    assert importance.resample(frame, aim.limit(0)).count() == len(docs)


def test_resampling_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = op13_importance(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_resample(docs, target)


def test_radix_ranks_of_counted_rows(spark):
    rng = random.Random(9)
    rows = list({(rng.randint(-5, 5), rng.randint(0, 10**12)): 0 for _ in range(2000)}) + [(3, -1)]
    rows = [(a, b, 5000 if b == -1 else 1 + i % 3) for i, (a, b) in enumerate(rows)]
    got = importance.radix_ranks(spark.createDataFrame(rows, "a long, b long, copies long"), ["a", "b"], bits=11, block=100)
    place, want = 0, {}
    for a, b, n in sorted(rows):
        want[a, b] = place
        place += n
    assert {(r["a"], r["b"]): r["place"] for r in got.collect()} == want
