"""Exact and near duplicates against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from rostermill.llm import embed_dedup, exact_dedup, ngram_join
from rostermill.llm.components import components
from rostermill.llm.embed_dedup import Cells
from rostermill.llm.ngram_join import Join


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)]
    edges += [(n, n + 1) for n in range(1000, 1060)] + [(2000, n) for n in range(2001, 2100)] + [(7, 7), (None, 3)]
    groups = Groups({n for e in edges for n in e if n is not None})
    for a, b in edges:
        if a is not None and b is not None:
            groups.join(a, b)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {n: groups.find(n) for e in edges for n in e if None not in e and e[0] != e[1]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


DOCS = "doc_id long, text string, kept string, node string, sha int, leaf string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", "y", 3, None) for k, t in rows], DOCS)


def test_exact_dedup_lowers_ascii_only(spark):
    rows = [(1, "Abc"), (2, "aBC"), (3, "ÄB"), (4, "äB"), (5, "äb"), (6, None), (7, ""), (8, " "), (None, "abc"), (9, "x" * 200_000)]
    got = {r["doc_id"]: r for r in exact_dedup.mark(frame(spark, rows).repartition(4)).collect()}
    assert {k: got[k]["keep_id"] for k in got} == {1: 2, 2: 2, None: 2, 3: 3, 4: 5, 5: 5, 6: 7, 7: 7, 8: 8, 9: 9}
    assert got[1]["group_size"] == 3 and got[2]["kept"] and not got[None]["kept"]
    assert got[6]["text_sha256"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    small = {r["doc_id"]: r["keep_id"] for r in exact_dedup.mark(frame(spark, rows[:2]), keep="smallest").collect()}
    assert small == {1: 1, 2: 1}
    with pytest.raises(ValueError):
        exact_dedup.mark(frame(spark, rows), keep="first")


def test_exact_dedup_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FAN_IN_BITS", 1)
    rows = [(n, f"text {n % 7}" if n % 3 else "hot") for n in range(400)]
    got = {r["doc_id"]: r for r in exact_dedup.mark(frame(spark, rows).repartition(13)).collect()}
    groups = defaultdict(list)
    for n, t in rows:
        groups[t].append(n)
    for n, t in rows:
        assert got[n]["keep_id"] == max(groups[t]) and got[n]["group_size"] == len(groups[t])
        assert got[n]["kept"] == (n == max(groups[t]))


def test_exact_dedup_keeps_one_of_repeated_rows_and_all_columns(spark, tmp_path):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")]
    frame(spark, rows).repartition(2).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    left = exact_dedup.keep_rows(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == [(0, "c"), (1, "a"), (2, "b")]
    assert exact_dedup.keep_rows(docs.where("false")).count() == 0


# -- n-gram join ------------------------------------------------------------


def brute_groups(rows, join):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        n = min(join.words, len(words))
        sets[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    groups, keys = Groups(sets), sorted(sets)
    for at, a in enumerate(keys):
        for b in keys[:at]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and join.of * common >= join.share * (len(sets[a] | sets[b])):
                groups.join(a, b)
    return {k: (len(sets[k]), groups.find(k)) for k in keys}


def mutated(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("join", [Join(4, 85, 100), Join(5, 4, 5), Join(2, 1, 2)])
def test_ngram_groups_match_brute_force(spark, join):
    rng = random.Random(join.words)
    rows, key = [], 0
    passage = [f"p{i}" for i in range(60)]
    for size in (1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 20, 33, 60, 150, 400, 900):
        base = [f"b{rng.randrange(400)}" for _ in range(size)]
        for _ in range(9):
            words = mutated(rng, base, rng.randrange(0, 1 + max(1, size // 40)))
            if rng.random() < 0.3:
                words = words[: len(words) - len(words) // 12]
            rows.append((key, " ".join(words)))
            key += 1
        rows.append((key, " ".join(base + passage)))
        key += 1
    rows += [(key, None), (key + 1, ""), (key + 2, " \n\t "), (key + 3, "A b\vC"), (key + 4, "a B\fc"), (key + 5, "ä b c"), (key + 6, "Ä b c")]
    got = {r[0]: (r[1], r[2]) for r in ngram_join.similar_groups(frame(spark, rows).repartition(5), join).collect()}
    assert got == brute_groups(rows, join)


def test_long_words_with_structure_are_not_linked(spark):
    from test_llm_tokens import LONG_WORDS

    rows = list(enumerate(LONG_WORDS)) + [(20 + i, w) for i, w in enumerate(LONG_WORDS)]
    got = {r[0]: r[2] for r in ngram_join.similar_groups(frame(spark, rows)).collect()}
    assert got == {k: k % 20 for k, _ in rows}


def test_tiles_that_hold_many_groups_are_taken_apart(spark, monkeypatch):
    """A chain of near copies whose ends are unlike, with blocks of two."""
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    join, rows = Join(1, 4, 5), []
    words = [f"c{i}" for i in range(40)]
    for n in range(30):
        rows.append((n, " ".join(words)))
        words = words[3:] + [f"n{n}-{i}" for i in range(3)]
    rng = random.Random(9)
    base = [f"q{i}" for i in range(40)]
    rows += [(100 + n, " ".join(mutated(rng, base, 6))) for n in range(60)]
    got = {r[0]: (r[1], r[2]) for r in ngram_join.similar_groups(frame(spark, rows).repartition(4), join).collect()}
    assert got == brute_groups(rows, join)


def test_similar_sets_share_a_tile():
    """The bound behind the tiles, at the very edge of the similarity."""
    rng = np.random.default_rng(4)
    for join in (Join(4, 85, 100), Join(5, 4, 5)):
        signer = ngram_join.Signer(join)
        for _ in range(400):
            a = int(rng.integers(1, 300))
            pool = np.unique(rng.integers(0, 1 << 63, a + 400, dtype=np.uint64))
            rng.shuffle(pool)
            b = int(rng.integers(a, a * join.of // join.share + 1))
            least = -(-join.share * (a + b) // (join.share + join.of))
            if least > a:
                continue
            left = np.sort(pool[:a])
            right = np.sort(np.concatenate([pool[:least], pool[a : a + b - least]]))
            if least == a == b:
                assert signer.node(left) == signer.node(right)
                continue
            x, y = signer.tiles(left), signer.tiles(right)
            common = np.intersect1d(x >> np.uint64(1), y >> np.uint64(1))
            upper = np.concatenate([x[x & np.uint64(1) == 0], y[y & np.uint64(1) == 0]]) >> np.uint64(1)
            assert np.isin(common, upper).any()


def test_ngram_groups_of_repeated_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, "other words here now"), (2, text), (None, text), (3, None)]
    got = sorted((r[0] or 0, r[1], r[2]) for r in ngram_join.similar_groups(frame(spark, rows)).collect())
    assert got == [(0, 26, 1), (1, 1, 1), (1, 26, 1), (2, 26, 1), (3, 0, 3)]
    assert ngram_join.similar_groups(frame(spark, [])).count() == 0


def test_ngram_keep_rows_keeps_columns_and_clean_rows(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(30))
    docs = frame(spark, [(5, text), (4, text + " more"), (6, "quite another text of some words"), (None, "x"), (7, None)])
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    left = ngram_join.keep_rows(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 4, 6, 7]


# -- vectors ----------------------------------------------------------------


def brute_vectors(rows, least):
    good = {}
    for key, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        good[key] = (label, np.array(vector, dtype=np.float32).astype(np.float64))
    links, groups = defaultdict(int), Groups([r[0] for r in rows])
    keys = sorted(good)
    for at, a in enumerate(keys):
        for b in keys[:at]:
            x, y = good[a], good[b]
            if x[0] == y[0] and len(x[1]) == len(y[1]) and x[1] @ y[1] / (np.linalg.norm(x[1]) * np.linalg.norm(y[1])) >= least:
                links[a] += 1
                links[b] += 1
                groups.join(a, b)
    return {r[0]: (links[r[0]], groups.find(r[0])) for r in rows}


VECTORS = "vec_id long, embedding array<float>, label int, n_links string, node string, weight int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], VECTORS)


def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 25)
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(40):
        base = rng.normal(size=8)
        for _ in range(int(rng.integers(1, 12))):
            v = base + rng.normal(size=8) * rng.choice([0, 0.03, 0.15, 0.3])
            rows.append((len(rows), [float(x) for x in v * rng.choice([1, 1, 5])], int(rng.integers(0, 2))))
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [1.0, None] + [0.0] * 6, 0), (n + 3, [float("nan")] * 8, 0)]
    rows += [(n + 4, [float("inf")] + [0.0] * 7, 0), (n + 5, rows[0][1], None), (n + 6, [1.0, 2.0], 0), (n + 7, [2.0, 4.0], 0), (n + 8, [], 1)]
    want = brute_vectors(rows, 0.98)
    for cells in (Cells(size=20), Cells(size=10_000)):
        got = embed_dedup.near_duplicates(vector_frame(spark, rows).repartition(3), cells=cells).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_repeated_vectors_and_no_vectors(spark):
    rows = [(3, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    got = embed_dedup.near_duplicates(vector_frame(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in got) == [
        (0, 3, 2, False), (2, 3, 2, True), (2, 3, 2, True), (3, 3, 2, False)]
    assert embed_dedup.near_duplicates(vector_frame(spark, [])).count() == 0
