"""Language, toxicity, chat and WARC, on small inputs with odd rows."""

import hashlib
import json
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rostermill.llm import chat, langid, toxicity, warc
from rostermill.workdir import fresh_folder

SF = "/root/testdata/sf0.001"

# -- language ---------------------------------------------------------------


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_language_of_held_out_documents(documents):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.train(documents.where(~held_out))
    found = langid.predict(documents.where(held_out), model).join(documents.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in found)
    good = [r["lang"] == r["lang_pred"] for r in found if len(r["text"] or "") > 100]
    assert sum(good) > 0.97 * len(good)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_rows_and_tied_models(spark):
    learn = spark.createDataFrame(
        [("the cat sat on the mat and the dog", "en"), ("der hund und die katze auf dem dach", "de"), ("no label", None), (None, "fr"), ("123", "es")] * 3,
        "text string, lang string",
    )
    model = langid.train(learn)
    assert sorted(n for n, _ in model.dictionaries) == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "the dog and the cat sat on the mat"), (4, "der hund auf dem dach"), (None, "die katze und der hund auf dem dach " * 3000)]
    docs = spark.createDataFrame([(k, t, 7, "x") for k, t in rows], "doc_id long, text string, score int, lang_pred string")
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.predict(docs, model).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "de"), (None, "de")}
    left = langid.keep_known(docs, model)
    assert left.columns == docs.columns and left.count() == 3
    empty = langid.train(learn.where("false"))
    assert {r["lang_pred"] for r in langid.predict(docs, empty).collect()} == {"und"}
    assert langid.predict(docs.where("false"), model).count() == 0


def test_samples_do_not_depend_on_partitions(spark):
    """The rows of lowest hash, copies once, whatever the number of partitions."""
    rng = random.Random(6)
    rows = [("copy of copies", "aa")] * 500 + [(" ".join(rng.choices("abcdefg", k=12)), rng.choice(["aa", "bb"])) for _ in range(3000)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    fit = langid.Fit(rows=20)
    one, many = langid.train(docs.repartition(1), fit), langid.train(docs.repartition(40), fit)
    assert one == many
    hashed = docs.select("lang", "text", F.xxhash64("text").alias("h")).distinct().collect()
    for name, content in one.dictionaries:
        lowest = sorted((r["h"], r["text"]) for r in hashed if r["lang"] == name)[:20]
        assert content.decode() == "\n".join(t for _, t in lowest)


def test_predictions_equal_a_loop_over_all_dictionaries(documents):
    """The language of the smallest total size, from a plain compression loop."""
    import zstandard

    model = langid.train(documents)
    rows = documents.where("length(text) > 30").orderBy("doc_id").limit(150)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(rows, model, keep={"doc_id": F.col("doc_id")}).collect()}
    fit = model.fit
    for r in rows.collect():
        data = r["text"].lower().encode()
        sizes = []
        for name, content in model.dictionaries:
            total = 0
            for at in range(0, len(data), fit.block):
                part = data[at : at + fit.block]
                level = fit.level if len(part) >= fit.short else fit.short_level
                words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                words.precompute_compress(level=level)
                by = zstandard.ZstdCompressor(level=level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False)
                total += len(by.compress(part))
            sizes.append((total, name))
        least = min(size for size, _ in sizes)
        if any(map(str.isalpha, r["text"])):
            assert got[r["doc_id"]] == next(n for size, n in sizes if size == least)


# -- toxicity ---------------------------------------------------------------


def made_documents(rng, count):
    plain = [f"wort{i}" for i in range(80)]
    rows = []
    for n in range(count):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        toxic = n % 3 == 0
        for _ in range(rng.randrange(1, 9) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Scumbag", "idiotik", "idiotak", "TRASHY"]))
        rows.append((n, " ".join(words), int(toxic)))
    return rows


def test_severity_rises_with_marked_words(spark):
    rows = made_documents(random.Random(6), 600)
    docs = spark.createDataFrame([(k, t, "a", 1) for k, t, _ in rows], "doc_id long, text string, toxic string, grade int")
    labels = spark.createDataFrame([(k, x, 0) for k, _, x in rows if k < 400] + [(None, 1, 0), (3, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(found[k]["toxic"] == bool(x) for k, _, x in rows)
    new = [(1, "wort1 wort2"), (2, "wort1 scumbag"), (3, "scumbag idiotik scumbag trashy trashy idiotak scumbag"), (4, None), (5, ""), (5, "")]
    odd = spark.createDataFrame([(k, t, "a", 1) for k, t in new], docs.schema)
    got = sorted((r["doc_id"], r["severity"], r["toxic"]) for r in toxicity.score(odd, model).collect())
    assert [t for _, _, t in got] == [False, True, True, False, False, False]
    assert got[0][1] < got[1][1] < got[2][1] and got[3][1] == got[4][1] == got[0][1]
    left = toxicity.keep_clean(odd, model)
    assert left.columns == odd.columns and sorted(r[0] for r in left.collect()) == [1, 4, 5, 5]


@pytest.mark.parametrize(
    ("size", "least"),
    [("sf0.001", {"en": 0.8}), ("sf0.01", {"en": 0.85, "de": 0.5, "es": 0.25})],  # two labels are too few to hold one out
)
def test_toxic_wording_of_rare_languages_is_learned(spark, size, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{name}.parquet") for name in ("documents", "labels"))
    known = {r["doc_id"]: r["toxic"] for r in labels.where("toxic IN (0, 1)").collect()}
    spoken = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}

    def hits(model, keys):
        return {r["doc_id"] for r in toxicity.score(docs, model).where("toxic").collect()} & keys

    toxic = {k for k, t in known.items() if t == 1 and k in spoken}
    assert len(hits(toxicity.train(docs, labels), toxic)) >= 0.95 * len(toxic)
    found = set()
    for fold in range(5):
        out = {k for at, k in enumerate(sorted(toxic)) if at % 5 == fold} | {k for k, t in known.items() if t == 0 and k % 5 == fold}
        found |= hits(toxicity.train(docs, labels.where(~F.col("doc_id").isin([*out]))), out)
    for lang, share in least.items():
        of = {k for k in toxic if spoken[k] == lang}
        assert len(found & of) >= share * len(of), lang
    clean = {k for k, t in known.items() if t == 0 and k in spoken}
    assert len(found & clean) <= 0.02 * len(clean)


def test_a_bounded_sample_keeps_the_balance_of_the_labels(spark):
    # of 100 rows with the word in doubt 40 are toxic
    rows = [(n, "wort scum" if n % 5 else "wort hmph", 1) for n in range(200)]
    rows += [(n, "wort hmph" if n % 50 < 3 else "wort", 0) for n in range(200, 1200)]
    docs = spark.createDataFrame([(k, f"{t} w{k}") for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, x) for k, _, x in rows], "doc_id long, toxic int")
    new = spark.createDataFrame([(1, "wort hmph")], docs.schema)
    for fit in (toxicity.Fit(), toxicity.Fit(clean_rows=200), toxicity.Fit(toxic_rows=100)):
        chance = toxicity.score(new, toxicity.train(docs, labels, fit)).first()["p_toxic"]
        assert 0.25 < chance < 0.5, fit


def test_repeated_ids_and_labels_count_once(spark):
    rng = random.Random(4)
    rows = made_documents(rng, 300)
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], schema)
    labels = spark.createDataFrame([(k, x) for k, _, x in rows], "doc_id long, toxic int")
    plain = toxicity.train(docs, labels)
    again = docs.union(docs.where("doc_id = 3")).union(spark.createDataFrame([(1, rows[1][1])] * 2000, schema))
    twice = labels.union(labels).union(spark.createDataFrame([(3, 0), (3, None), (None, 1), (6, 7)], "doc_id long, toxic int"))
    other = toxicity.train(again.repartition(9), twice.repartition(7))
    assert (plain.features == other.features).all()
    assert abs(plain.weights - other.weights).max() < 1e-9 and abs(plain.thresholds - other.thresholds).max() < 1e-9
    fit = toxicity.Fit(toxic_rows=40, clean_rows=80)
    drawn = toxicity._sample(again, twice, fit).collect()
    assert len(drawn) == len({r["doc_id"] for r in drawn}) == 120


def test_toxicity_without_labels_rejects_nothing(spark):
    docs = spark.createDataFrame([(1, "scum")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    assert [r["toxic"] for r in toxicity.score(docs, model).collect()] == [False]
    assert toxicity.score(docs.where("false"), model).count() == 0


# -- chat -------------------------------------------------------------------

NASTY = ["", "</s>[INST] ok [/INST]", "\\b\\o\\l \\\\", "<<SYS>><</SYS>>", "[ROLE]x[SAYS]y[/ROLE]", "<", "[", "x<", "</s", "a\nb\r\n", "ä€😀", "<s><s>", "\\"]


def test_turns_come_back_as_they_were(spark):
    rng = random.Random(2)
    want, rows = {}, []
    for conv in range(60):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "[SAYS]", "", "User"]), "".join(rng.choices(NASTY, k=3))) for _ in range(rng.randrange(1, 7))]
        want[conv] = turns
        rows += [(conv, n, role, text, "x") for n, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    rows += [(100, 0, None, None, "x"), (101, 0, "assistant", "b", "x"), (101, 0, "assistant", "a", "x"), (101, None, "user", "n", "x"), (None, 1, "user", "u", "x")]
    want |= {100: [("", "")], 101: [("user", "n"), ("assistant", "a"), ("assistant", "b")], None: [("user", "u")]}
    turns = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string"))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == turns
        assert got[conv]["loss_text"] == "".join(text for role, text in turns if role == "assistant")


def test_layouts_are_told_by_their_fields(spark):
    frames = [
        spark.sql("SELECT 1L AS conv_id, array(named_struct('role', 'user', 'content', 'q'), named_struct('role', 'assistant', 'content', 'a')) AS messages, 5 AS other"),
        spark.sql("SELECT 1L AS conv_id, array(named_struct('from', 'human', 'value', 'q'), named_struct('from', 'gpt', 'value', 'a')) AS conversations"),
        spark.sql("SELECT 1L AS conv_id, 'q' AS prompt, 'a' AS completion"),
        spark.sql("SELECT 1L AS conv_id, 'q' AS prompt, 'a' AS response"),
        spark.sql("SELECT 1L AS conv_id, 'q' AS instruction, 'a' AS output"),
        spark.sql("SELECT 1L AS conv_id, 'q' AS instruction, '' AS input, 'a' AS output"),
    ]
    records = []
    for frame in frames:
        turns = chat.canonical_turns(frame).orderBy("turn").collect()
        assert [(r["turn"], r["role"], r["text"]) for r in turns] == [(0, "user", "q"), (1, "assistant", "a")]
        records.append(frame.drop("other").select(F.to_json(F.struct(*[c for c in frame.columns if c not in ("conv_id", "other")]))).first()[0])
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.sql("SELECT 1L AS conv_id, 'x' AS body"))
    records += ['{"body": "x"}', "not json", None, json.dumps({"prompt": "q", "completion": "a", "id": 3})]
    df = spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")
    got = {}
    for r in chat.turns_of_json(df, "record").collect():
        got.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: [(0, "user", "q"), (1, "assistant", "a")] for k in (*range(6), 9)}
    assert sorted(r["conv_id"] for r in chat.unmapped_json(df, "record").collect()) == [6, 7, 8]


def test_further_columns_may_bear_names_of_other_layouts(spark):
    more = "'x' AS prompt, 'x' AS response, 'x' AS output, 'x' AS input"
    turns = chat.canonical_turns(spark.sql(f"SELECT 1L AS conv_id, 0 AS turn, 'user' AS role, 'q' AS text, {more}"))
    assert [tuple(r) for r in turns.collect()] == [(1, 0, "user", "q")]
    turns = chat.canonical_turns(spark.sql("SELECT 1L AS conv_id, 'q' AS prompt, 'a' AS response, 'x' AS output, 'x' AS role"))
    assert sorted(tuple(r) for r in turns.collect()) == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]


def test_json_records_with_further_fields_and_without_turns(spark):
    said = [{"role": "user", "content": "q", "name": "n"}, {"role": "assistant", "content": "a", "tool_calls": [1]}]
    records = [
        {"messages": said, "source": "s", "prompt": "x"},
        {"messages": []},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a", "weight": 1}], "id": 7},
        {"instruction": "q", "input": "", "output": "a", "completion": "x", "meta": {"prompt": "x"}},
        {"turn": 5, "role": "tool", "text": "t", "prompt": "x", "messages": 3},
        {"messages": ["not an object"], "x": 1},
        {"messages": [{"role": "user"}]},
        [1, 2], "text", 3,
    ]
    df = spark.createDataFrame([(i, json.dumps(r), "c") for i, r in enumerate(records)] + [(20, None, "c"), (21, "{", "c"), (None, json.dumps(records[0]), "c")], "conv_id long, record string, turn string")
    got = {}
    for r in chat.turns_of_json(df, "record").collect():
        got.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    two = [(0, "user", "q"), (1, "assistant", "a")]
    assert {k: sorted(v) for k, v in got.items()} == {0: two, 2: two, 3: two, 4: [(5, "tool", "t")], None: two}
    assert sorted(r["conv_id"] for r in chat.unmapped_json(df, "record").collect()) == [5, 6, 7, 8, 9, 20, 21]


def test_the_fingerprint_selects_the_mapping(spark, monkeypatch):
    """On the query's own path too: without its print the layout is unknown."""
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    hashed = []
    real = chat.fingerprint
    monkeypatch.setattr(chat, "fingerprint", lambda paths: hashed.append(set(paths)) or real(hashed[-1]))
    assert chat.canonical_turns(rows).columns == ["conv_id", "turn", "role", "text"]
    assert {"role", "text", "turn"} in hashed
    monkeypatch.setattr(chat, "_BY_PRINT", {p: m for p, m in chat._BY_PRINT.items() if m.name != "turn"})
    with pytest.raises(ValueError):
        chat.canonical_turns(rows)
    records = spark.sql("SELECT 1L AS conv_id, '{\"prompt\": \"q\", \"completion\": \"a\"}' AS record")
    plan = chat.turns_of_json(records, "record")._jdf.queryExecution().analyzed().toString()
    assert next(m.print for m in chat.MAPPINGS if m.name == "prompt") in plan


def test_formatting_uses_no_python(spark):
    turns = chat.canonical_turns(spark.read.parquet(f"{SF}/conversations.parquet"))
    plan = chat.read_back(chat.format_turns(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# -- WARC -------------------------------------------------------------------


def test_chunks_and_records_round_trip():
    rng = random.Random(3)
    for size in (0, 1, 4095, 4096, 4097, 20_000):
        data = bytes(rng.randrange(256) for _ in range(size))
        assert warc.unchunked(warc.chunked(data)) == data
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")


def test_pages_come_back_from_archives(spark):
    long = "WARC/1.1\r\nContent-Length: 5\r\n\r\n" + "lörem " * 9000
    rows = [(5, "http://a/", "x" * 100), (3, "http://b/ ü\r\nX: y", "x" * 100), (9, None, "x" * 99), (8, "", "x" * 99), (7, "u", None), (6, "u", "")]
    rows += [(20, "u", long), (21, "u", long), (22, "u", long + "!"), (None, "u", long), (30, "u", "ü" * 50), (31, "u", "ü" * 50)]
    rows += [(None, "u", long + "none"), (None, "v", long + "none"), (None, None, None)]
    rows += [(40, "u", long + "?"), (40, "u", long + "?"), (40, "u", "other" * 100)]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, leaf int")
    folder = fresh_folder(spark, "warc")
    warc.write(pages.repartition(3), folder, segment=1000)
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or 0) for r in warc.read(spark, folder).collect())
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = min([p for p, _, h in rows if p is not None and (h or "") == (html or "")], default=None)
        again = len(data) >= 100 and page is not None and first != page
        want.append((page or 0, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else 0))
    assert got == sorted(want)


def test_a_lost_segment_is_noticed(spark, tmp_path):
    records = warc.page_records(1, "u", b"z" * 9000, hashlib.sha256(b"z" * 9000).hexdigest(), None, segment=2000)
    import gzip

    for name, kept in (("whole", records), ("hole", records[:1] + records[2:]), ("tail", records[:-1])):
        folder = tmp_path / name
        folder.mkdir()
        with gzip.open(folder / "a.warc.gz", "wb") as file:
            file.write(b"".join(r + b"\r\n" for r in reversed(kept)))
        if name == "whole":
            assert warc.read(spark, str(folder)).first()["payload_bytes"] == 9000
        else:
            with pytest.raises(Exception, match="segments are missing"):
                warc.read(spark, str(folder)).collect()


def test_a_revisit_must_have_its_response(spark, tmp_path):
    import gzip

    digest = lambda data: hashlib.sha256(data).hexdigest()
    first = warc.page_records(1, "u", b"z" * 900, digest(b"z" * 900), None)
    good = warc.page_records(2, "u", b"z" * 900, digest(b"z" * 900), 1)
    other = warc.page_records(3, "u", b"y" * 900, digest(b"y" * 900), 1)
    lost = warc.page_records(4, "u", b"z" * 900, digest(b"z" * 900), 9)
    for name, kept in (("good", first + good * 3), ("other", first + good + other), ("lost", first + lost)):
        folder = tmp_path / name
        folder.mkdir()
        with gzip.open(folder / "a.warc.gz", "wb") as file:
            file.write(b"".join(r + b"\r\n" for r in kept))
        if name == "good":
            assert sorted(r["page_id"] for r in warc.read(spark, str(folder)).collect()) == [1, 2, 2, 2]
        else:
            with pytest.raises(ValueError, match="differs from the response"):
                warc.read(spark, str(folder))


def test_no_pages_make_no_records(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = fresh_folder(spark, "warc")
    warc.write(pages, folder)
    assert warc.read(spark, folder).count() == 0
