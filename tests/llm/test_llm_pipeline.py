"""The pipeline's stages one after another, and what the entry registers."""

import re
from pathlib import Path

import pytest
from test_llm_tokens import library_ids

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


def test_nothing_else_imports_the_package():
    for path in (ROOT / "rostermill").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"rostermill\.llm|from rostermill import llm", path.read_text()), path


def test_entry_registers_one_query_per_operator():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage kept of the smallest documents, as files."""
    import corpus_pipeline

    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF).write.parquet(str(folder / str(at)))
        kept.append(spark.read.parquet(str(folder / str(at))))
    return kept


def test_stages_keep_columns_and_rows(stages):
    docs = stages[0]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = set(texts)
    for kept in stages[1:-1]:
        assert kept.schema == docs.schema
        rows = kept.collect()
        now = {r["doc_id"] for r in rows}
        assert len(rows) == len(now) and now <= left
        assert all(r["text"] == texts[r["doc_id"]] for r in rows)
        left = now
    assert len(left) > 0.5 * len(texts)


def test_copies_go_and_clean_documents_stay(stages):
    before = {r["doc_id"]: (r["text"] or "") for r in stages[2].collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    last = {}
    for key, text in sorted(before.items()):
        last[text.translate(lower)] = key
    assert {r["doc_id"] for r in stages[3].collect()} == set(last.values())


def test_one_of_each_group_of_near_copies_stays(stages):
    from test_llm_dedup import brute_groups

    from rostermill.llm.ngram_join import Join

    rows = [(r["doc_id"], r["text"]) for r in stages[3].collect()]
    groups = brute_groups(rows, Join(words=5, share=4, of=5))
    assert {r["doc_id"] for r in stages[4].collect()} == {root for _, root in groups.values()}


def test_last_stage_packs_what_is_left(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    rows = stages[5].collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    whole = {r["doc_id"]: r["doc_tokens"] for r in rows}
    assert all(n == len(library_ids(texts[k])) + 1 for k, n in whole.items())


def test_clear_texts_stay_in_the_language_stage(stages):
    before = {r["doc_id"]: len(re.findall(r"[^\W\d_]+", r["text"] or "")) for r in stages[1].collect()}
    kept = {r["doc_id"] for r in stages[2].collect()}
    long = [k for k, n in before.items() if n > 30]
    assert sum(k in kept for k in long) >= 0.99 * len(long)
    assert all(n for k, n in before.items() if k in kept)


def test_toxic_documents_go(stages, spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[1].collect()}
    toxic = [k for k, t in labels.items() if t == 1 and k in {r["doc_id"] for r in stages[0].collect()}]
    assert sum(k not in kept for k in toxic) >= 0.8 * len(toxic) > 0
    clean = [k for k, t in labels.items() if t == 0]
    assert sum(k in kept for k in clean) >= 0.98 * len(clean)
