"""Importance resampling towards a target: array-scored weights, radix ranks.

1. Features (runs of words) fall into buckets by a checksum. A pass over the
   texts writes each document's bucket numbers as one packed array; counts of
   all documents and of all target texts give every bucket a gain, and a
   document's weight is the sum of the gains at its bucket numbers.
2. A score is the weight plus noise that depends on the document's key alone,
   so drawing the highest scores draws without replacement, and any machine
   draws the same documents.
3. Scores are ranked by a distributed LSD radix sort of the composite key
   (score descending, key ascending). A pass is a stable counting sort by one
   digit: rows are counted by block and digit, prefix sums over (digit, block)
   say where each block's rows of a digit go, and a row's place in its block
   gives its destination. After the last digit the destination is the rank.
   A group is never larger than a block or than the number of blocks, whatever
   the keys; rows that are equal in everything are one row with a count.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermill.workdir import staged

#: words of a text: ASCII letters and digits, and all beyond ASCII
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: distinct features whose bucket a task remembers
REMEMBERED = 50_000


@dataclass(frozen=True)
class Resample:
    """What is counted and how much is drawn."""

    #: longest run of words that is a feature
    words: int = 1
    buckets: int = 10_000
    #: documents with fewer words are never drawn
    least_words: int = 20
    percent: int = 10
    seed: int = 2024
    #: digits of the sort have at most so many bits; rows of a block
    bits: int = 16
    block: int = 65_536


def packed(buckets: int) -> str:
    """Type of a packed bucket number."""
    return "<u2" if buckets <= 1 << 16 else "<u4"


class Buckets:
    """Bucket numbers of texts; remembers those of frequent words."""

    def __init__(self, rule: Resample):
        self.rule = rule
        self.known: dict[bytes, int] = {}

    def _one(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.rule.buckets
        if len(self.known) < REMEMBERED:
            self.known[feature] = bucket
        return bucket

    def of(self, text: bytes | None) -> tuple[int, np.ndarray]:
        """(number of words, bucket of every feature)."""
        words = WORD.findall((text or b"").translate(_LOWER))
        features = list(words)
        for n in range(2, self.rule.words + 1):
            features += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        get = self.known.get
        found = (b if (b := get(f)) is not None else self._one(f) for f in features)
        return len(words), np.fromiter(found, packed(self.rule.buckets), len(features))


def features(docs: DataFrame, rule: Resample, text: str = "text", key: str = "doc_id", batch: int = 200) -> DataFrame:
    """(key, n_words, n_features, buckets): little-endian bucket numbers of 16 bits
    (32 for more than 65,536 buckets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(rule)
        for whole in batches:
            for low in range(0, whole.num_rows, batch):
                part = whole.slice(low, batch)
                found = [buckets.of(t) for t in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([n for n, _ in found], pa.int64()),
                        pa.array([len(b) for _, b in found], pa.int64()),
                        pa.array([b.tobytes() for _, b in found], pa.binary()),
                    ],
                    names=["key", "n_words", "n_features", "buckets"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n_words long, n_features long, buckets binary"
    )


def _counts(found: DataFrame, buckets: int) -> dict[int, int]:
    """Features in each bucket. A task sends one row for each bucket, not for
    each feature; the result has at most ``buckets`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(np.frombuffer(text.as_py(), packed(buckets)), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    rows = found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r["bucket"]: r["n"] for r in rows.collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    """Floor of 1000 times the log ratio of smoothed frequencies, per bucket."""
    all_source, all_target = sum(source.values()), sum(target.values())
    s = np.array([source.get(b, 0) for b in range(buckets)], np.float64)
    t = np.array([target.get(b, 0) for b in range(buckets)], np.float64)
    ratio = ((t + 1) * (all_source + buckets)) / ((s + 1) * (all_target + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64).tolist()


def weighted(found: DataFrame, gain: list[int]) -> DataFrame:
    """(key, n_words, n_features, weight) from packed bucket numbers."""
    table = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(table[np.frombuffer(b.as_py(), packed(len(table)))].sum()) for b in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(sums, pa.int64())],
                names=["key", "n_words", "n_features", "weight"],
            )

    kind = found.schema["key"].dataType.simpleString()
    return found.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from a digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _digits(name: str, low: int, high: int, bits: int) -> list[Column]:
    """Digits of ``name`` - low, the least significant first."""
    need = (high - low).bit_length()
    parts = -(-need // bits)
    width = -(-need // parts) if parts else 0
    value = F.col(name) - F.lit(low)
    return [F.shiftright(value, i * width).bitwiseAND((1 << width) - 1) for i in range(parts)]


def radix_ranks(rows: DataFrame, keys: list[str], bits: int = 16, block: int = 65_536) -> DataFrame:
    """``rows`` with ``place``: how many copies come before, ascending by ``keys``.

    ``keys`` are long columns without nulls, the most significant first, and
    ``copies`` says how often a row counts; no two rows are equal in all keys.
    One stable counting sort for each digit that the keys' ranges need.
    """
    ends = rows.agg(F.sum("copies").alias("n"), *[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    if not ends["n"]:
        return rows.withColumn("place", F.lit(0).cast("long"))
    digits = [d for k in reversed(keys) for d in _digits(k, ends[f"min_{k}"], ends[f"max_{k}"], bits)]
    blocks = -(-ends["n"] // block)
    mixed = F.xxhash64(*keys)
    at = rows.withColumn("place", mixed).withColumn("block", F.pmod(mixed, F.lit(blocks)))
    for digit in digits:
        at = at.withColumn("digit", digit)
        held = at.groupBy("digit", "block").agg(F.sum("copies").alias("held"))
        # a digit has at most 2^bits values
        before = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        of_digit = held.groupBy("digit").agg(F.sum("held").alias("all")).withColumn("base", F.coalesce(F.sum("all").over(before), F.lit(0)))
        of_block = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            held.withColumn("ahead", F.coalesce(F.sum("held").over(of_block), F.lit(0)))
            .join(of_digit, "digit")
            .select("digit", "block", (F.col("base") + F.col("ahead")).alias("offset"))
        )
        inside = Window.partitionBy("digit", "block").orderBy("place", *keys).rowsBetween(Window.unboundedPreceding, -1)
        at = (
            at.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
            .join(offsets, ["digit", "block"])
            .withColumn("place", F.col("offset") + F.col("inside"))
            .withColumn("block", F.floor(F.col("place") / block))
            .drop("digit", "inside", "offset")
        )
        at = staged(at, "radix")
    if not digits:
        at = at.withColumn("place", F.lit(0).cast("long"))
    return at.drop("block")


def _spread(rows: DataFrame, count: str, part: int = 10_000) -> DataFrame:
    """Each row ``count`` times, with its number ``copy`` from 0; a row of very
    many copies is first cut into parts."""
    parts = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / part))))
    size = F.least(F.lit(part), F.col(count) - F.col("part") * part)
    copies = parts.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), size - 1)))
    return copies.withColumn("copy", F.col("part") * part + F.col("copy")).drop("part", count)


def resample(docs: DataFrame, target: DataFrame, rule: Resample = Resample(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """Weight, score and rank of every document; the drawn ones have a rank.

    Returns one row per input row: ``key``, n_features, weight, score, rank
    (1, 2, 3 ... by score, ties to the smaller key; null where not drawn). The
    share ``percent`` is of the rows with at least ``least_words`` words, rounded
    down. Null and empty texts have no features and weight 0. Keys are whole
    numbers; a null key draws its noise as an empty text and comes after all
    others among ties. Rows that repeat a key are rows of their own (equal ones
    take consecutive ranks). Further columns are ignored. Empty tables are fine:
    without target texts all target counts are 0.
    """
    found = staged(features(docs, rule, text, key), "features")
    aim = features(target.select(F.lit(0).alias("key"), F.col(text).alias("text")), rule, "text", "key")
    gain = gains(_counts(found, rule.buckets), _counts(aim, rule.buckets), rule.buckets)
    scored = weighted(found, gain).withColumn("score", F.col("weight") + noise(F.col("key"), rule.seed))
    columns = ["key", "n_words", "n_features", "weight", "score"]
    rows = staged(scored.groupBy(*columns).agg(F.count("*").alias("copies")), "scored")
    enough = rows.where(F.col("n_words") >= rule.least_words)
    drawn = (enough.agg(F.sum("copies")).first()[0] or 0) * rule.percent // 100
    number = F.coalesce(F.col("key").cast("long"), F.lit(0))
    # a key in two halves, so that no difference leaves the range of a long; rows
    # that differ in their counts only must not be equal in all keys
    halves = [F.shiftright(number, 32), number.bitwiseAND(0xFFFFFFFF)]
    order = [-F.col("score"), F.col("key").isNull(), *halves, F.col("n_features")]
    names = [f"k{i}" for i in range(len(order))]
    keyed = enough.select(*columns, "copies", *[c.cast("long").alias(n) for c, n in zip(order, names)])
    ranked = radix_ranks(keyed, names, rule.bits, rule.block).drop(*names)
    others = rows.where(F.col("n_words") < rule.least_words).withColumn("place", F.lit(None).cast("long"))
    place = F.col("place") + F.col("copy") + 1
    return _spread(ranked.unionByName(others), "copies").select(
        F.col("key").alias(key), "n_features", "weight", "score", F.when(place <= drawn, place).alias("rank")
    )
