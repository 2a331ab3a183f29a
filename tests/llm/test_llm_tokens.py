"""BPE, packing and shards against the tokenizers library and round trips."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rostermill.llm import bpe, packing, token_shards, word_bpe
from rostermill.llm.packing import Costs
from rostermill.llm.perfect_hash import PerfectHash
from rostermill.workdir import fresh_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def thue_morse(size, letters="ab"):
    """Two words that polynomial hashes modulo 2^64 cannot tell apart."""
    first = [letters[bin(i).count("1") % 2] for i in range(size)]
    return "".join(first), "".join(letters[letters[0] == c] for c in first)


LONG_WORDS = [w for size in (64, 1024, 4096) for w in thue_morse(size)]

ODD = [
    "",
    "  \n\t ",
    "it's he'll ''s x'reab 's 'r 're've o'lx '",
    "a<|endoftext|>b <|startoftext|> <|endoftext",
    "ÀÉσΣ ς İ ı ſ ǅ ŸÜ ŉ Ɓ",
    "é ́x ẛ̣ Å",
    "a\x1cb\x1fc\x85d\xa0e f　g \x00 ﻿",
    "１２３ ²½ Ⅷ 12 3.14",
    "日本語テキスト 😀👩‍👩‍👧 한국어",
    "ab" * 3000 + "é" * 500,
    "word " * 4000,
    " ".join(LONG_WORDS),
    LONG_WORDS[3] + " " + LONG_WORDS[2],
]


def ids_of(data):
    return np.frombuffer(data, "<u2").tolist()


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library_on_odd_texts():
    own = word_bpe.WordBpe(PATH)
    for text, got in zip(ODD, own.encode(ODD)):
        assert ids_of(got) == library_ids(text)
        assert own.decode(got) == LIBRARY.decode(library_ids(text), skip_special_tokens=False)


def test_ids_equal_the_library_for_every_code_point():
    own = word_bpe.loaded(PATH)
    texts = []
    for low in range(0, 0x20000, 64):
        texts.append(" ".join(chr(c) + "a" + chr(c) for c in range(low, low + 64) if not 0xD800 <= c < 0xE000))
    want = LIBRARY.encode_batch(texts, add_special_tokens=False)
    assert [ids_of(x) for x in own.encode(texts)] == [w.ids for w in want]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_ids_equal_the_library_on_random_texts(texts):
    assert [ids_of(x) for x in word_bpe.loaded(PATH).encode(texts)] == [library_ids(t) for t in texts]


def test_equal_hashes_do_not_make_equal_words(monkeypatch):
    """With a hash that knows only lengths, ids are still the library's."""
    from rostermill.llm import wordscan

    monkeypatch.setattr(wordscan, "hashes", lambda codes, starts, lengths: lengths.astype(np.uint64))
    own = word_bpe.WordBpe(PATH)
    texts = ["generates sentences different something", " ".join(LONG_WORDS), "same same same", ""]
    assert [ids_of(x) for x in own.encode(texts)] == [library_ids(t) for t in texts]


def test_hashes_tell_structured_words_apart():
    from rostermill.llm import wordscan

    words = [*LONG_WORDS, "ab", "ba", "a", "b", "aa", "a\x00"]
    codes = np.array([ord(c) for w in words for c in w], np.uint32)
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths) - lengths
    assert len(set(wordscan.hashes(codes, starts, lengths).tolist())) == len(words)
    letters = wordscan.Letters.of(codes, starts, lengths)
    assert wordscan.same_words(letters, lengths, np.arange(len(words)))
    assert not wordscan.same_words(letters, lengths, np.arange(len(words)) // 2 * 2)
    # looked up or worked out, a scrambled number is the same
    wide = wordscan.hashes(codes[::-1], starts, lengths)
    assert len(set(wide.tolist()) & set(wordscan.hashes(codes, starts, lengths).tolist())) <= len(words)


def test_one_tree_and_many_trees_agree():
    own = word_bpe.loaded(PATH)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeinst") for _ in range(rng.randrange(1, 64))).encode() for _ in range(300)]
    assert [ids_of(x) for x in own.encode_words(words)] == [own.merge_one(own.symbols(w)) for w in words]


def test_long_texts_are_cut_at_blanks_only(monkeypatch):
    from rostermill.llm import wordscan

    text = "some words, it's here. " * 500 + "x" * 3000
    whole = library_ids(text)
    monkeypatch.setattr(wordscan, "STRETCH", 100)
    assert ids_of(word_bpe.WordBpe(PATH).encode([text])[0]) == whole


DOCS = "doc_id long, text string, ids string, n_tokens int, sequence_id string"


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(n, t, "x", 1, None) for n, t in enumerate(ODD)]
    rows += [(None, "no key here.", "x", 1, None), (50, None, None, None, None), (51, "twice", "x", 1, "s"), (51, "twice", "x", 1, "s")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_digests_and_round_trip(spark, odd_docs):
    got = [r.asDict() for r in bpe.round_trip_digests(odd_docs, PATH).collect()]
    assert len(got) == len(ODD) + 4
    texts = dict(enumerate(ODD)) | {None: "no key here.", 50: "", 51: "twice"}
    for row in got:
        ids = library_ids(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    decoded = {r[0]: r[1] for r in bpe.decode(bpe.encode(odd_docs, PATH), PATH).collect()}
    assert decoded[2] == LIBRARY.decode(library_ids(ODD[2]), skip_special_tokens=False)


# -- packing ----------------------------------------------------------------


def brute_cost(places, penalty, window, costs):
    best = {0: 0.0}
    for i in range(1, len(places)):
        options = []
        for j in range(i):
            length = places[i] - places[j]
            if length <= window and j in best:
                pad = 0 if length & (length - 1) == 0 else window - length
                options.append(best[j] + pad)
        best[i] = min(options) + penalty[i] + costs.window
    return best[len(places) - 1]


def test_plan_has_the_least_cost():
    rng = random.Random(1)
    costs = Costs(sentence=2, inside=5, window=3)
    for _ in range(150):
        window = 32
        places = [0]
        for _ in range(rng.randrange(1, 25)):
            places.append(places[-1] + rng.randrange(1, 17))
        penalty = [0] + [rng.choice([0, 2, 5]) for _ in places[1:]]
        penalty[-1] = 0
        cuts = packing.plan(np.array(places), np.array(penalty), window, Costs(2, 10**9, 3))
        at = {p: i for i, p in enumerate(places)}
        cost = 0
        for a, b in zip(cuts, cuts[1:]):
            assert 0 < b - a <= window
            cost += (0 if (b - a) & (b - a - 1) == 0 else window - (b - a)) + penalty[at[b]] + costs.window
        assert cost == brute_cost(places, penalty, window, costs)


def pieces_are_right(rows, texts, window, end_id=2):
    documents, windows = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        documents.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in windows.values():
        upto = 0
        for offset, length in sorted(parts):
            assert offset == upto
            upto += length
        assert upto <= window
    for key, text in texts.items():
        whole = [x for _, ids, _ in sorted(documents[key]) for x in ids]
        assert whole == library_ids(text) + [end_id]
        assert {n for _, _, n in documents[key]} == {len(whole)}
    assert set(documents) == set(texts)


def test_pieces_cover_every_document(spark, odd_docs):
    docs = odd_docs.dropDuplicates(["doc_id"])
    texts = dict(enumerate(ODD)) | {None: "no key here.", 50: "", 51: "twice"}
    for window in (4096, 64, 1):
        pieces_are_right(packing.pack(docs, PATH, window=window).collect(), texts, window)
    repeated = packing.pack(odd_docs.where("doc_id = 51"), PATH).collect()
    assert [r["length"] for r in repeated] == [len(library_ids("twice")) + 1] * 2
    assert packing.pack(odd_docs.where("false"), PATH).count() == 0


def test_padding_is_small(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sizes = [r[0] for r in packing.pack(docs, PATH).groupBy("sequence_id").sum("length").select("sum(length)").collect()]
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes)
    assert padding < 0.02 * sum(sizes)


# -- shards -----------------------------------------------------------------


def test_perfect_hash_is_a_bijection():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 30_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        perfect = PerfectHash.build(keys)
        again, size = PerfectHash.from_bytes(memoryview(perfect.to_bytes() + b"tail"))
        assert size == len(perfect.to_bytes())
        assert sorted(again.numbers(keys).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([7, 7], dtype=np.uint64))


def test_shards_give_back_what_was_written(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(token_shards, "SHARD_IDS", 2000)
    folder = fresh_folder(spark, "shards")
    token_shards.write_shards(odd_docs, PATH, folder)
    buckets = token_shards.write_index(spark, folder)
    got = [tuple(r) for r in token_shards.read_keys(spark, folder, buckets, odd_docs).collect()]
    texts = [(None, "no key here."), *enumerate(ODD), (50, ""), (51, "twice"), (51, "twice")]
    want, start = [], 0
    for key, text in texts:
        ids = library_ids(text) + [2]
        want.append((key, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    foreign = spark.createDataFrame([(n,) for n in range(1000, 1400)], "doc_id long")
    assert token_shards.lookup(spark, folder, buckets, foreign).count() == 0


def test_a_few_keys_open_a_few_files(spark, tmp_path, monkeypatch):
    """All other shards and index files are spoilt, and nobody notices."""
    monkeypatch.setattr(token_shards, "SHARD_IDS", 400)
    monkeypatch.setattr(token_shards, "BUCKET_KEYS", 20)
    rows = [(n, f"text number {n} " * 20) for n in range(300)] + [(None, "no key")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = str(tmp_path / "shards")
    token_shards.write_shards(docs, PATH, folder)
    buckets = token_shards.write_index(spark, folder)
    keys = spark.createDataFrame([(7,), (180,), (299,), (5000,)], "doc_id long")
    want = {r["doc_id"]: r for r in token_shards.read_keys(spark, folder, buckets, keys).collect()}
    assert sorted(want) == [7, 180, 299]
    for key, row in want.items():
        ids = library_ids(rows[key][1]) + [2]
        assert (row["n_tokens"], row["ids_crc32"]) == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
    places = token_shards.lookup(spark, folder, buckets, keys).collect()
    kept = {f"part={r['part']}/shard={r['shard']}/" for r in places}
    asked = {r[0] for r in keys.select(token_shards._bucket("doc_id", buckets)).collect()}
    kept |= {f"bucket={b}/" for b in asked}
    spoilt = 0
    for path in [*tmp_path.glob("shards/shards/*/*/*.txt"), *tmp_path.glob("shards/index/*/*.txt")]:
        if not any(k in str(path) for k in kept):
            path.write_bytes(b"spoilt")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
            spoilt += 1
    assert spoilt >= 10
    again = {r["doc_id"]: r for r in token_shards.read_keys(spark, folder, buckets, keys).collect()}
    assert again == want
    with pytest.raises(Exception):
        token_shards.read_keys(spark, folder, buckets, docs).collect()


def test_all_keys_of_many_buckets_come_back(spark, monkeypatch):
    """With shuffles that stay spread, so that groups meet by their key alone."""
    monkeypatch.setattr(token_shards, "BUCKET_KEYS", 25)
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(500)], "doc_id long, text string")
    folder = fresh_folder(spark, "shards")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_shards.write_shards(docs, PATH, folder)
        buckets = token_shards.write_index(spark, folder)
        assert buckets == 20
        assert sorted(r["doc_id"] for r in token_shards.read_keys(spark, folder, buckets, docs).collect()) == list(range(500))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_documents_make_no_shards(spark, odd_docs):
    folder = fresh_folder(spark, "shards")
    token_shards.write_shards(odd_docs.where("false"), PATH, folder)
    buckets = token_shards.write_index(spark, folder)
    assert token_shards.read_keys(spark, folder, buckets, odd_docs).count() == 0


def test_words_are_looked_up_once():
    """Also where a stretch is in Latin-1 and its neighbour is not."""
    class Counted(dict):
        looks = 0

        def __contains__(self, key):
            self.looks += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            self.looks += 1
            return super().__getitem__(key)

        def get(self, key, default=None):
            self.looks += 1
            return super().get(key, default)

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = word_bpe.WordBpe(path), Tokenizer.from_file(path)
    for texts in (["One two extraordinarily two", "", None, "\u00c4ra \u00fcber \u00b5"], ["\u0142\u00f3d\u017a one", "\u00c9t\u00c9"]):
        for _ in range(2):
            encoder._words = Counted(encoder._words)
            got = encoder.encode(texts)
            words = {w for t in texts if t for w in t.lower().split()}
            assert encoder._words.looks == len(words)
            for text, ids in zip(texts, got):
                assert np.frombuffer(ids, "<u2").tolist() == library.encode(text or "", add_special_tokens=False).ids
