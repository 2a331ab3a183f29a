"""Severity of toxic language by cumulative-link ordinal regression.

Grades are ordered: 0 is clean, 1 to ``grades - 1`` are toxic documents by
how much marked wording they hold. One weight vector is shared by all
thresholds, ``P(grade <= k) = sigmoid(threshold[k] - w.x)``, so a word moves a
document along one scale; the expected severity is the sum of the chances to
pass each threshold.

Features are words and the first four and five letters of longer words
(stems), as 64-bit hashes, with ``log2(1 + occurrences)`` as values. Fitting
takes a bounded sample of labelled rows (``Fit``): document counts per feature
are summed by Spark, the features that tell toxic from clean rows best are
chosen, and the rows' vectors over these features alone go to the driver. A
feature needs little evidence to be chosen, for wording of a rare language has
little; its penalty grows with the doubt instead.
The labels say only toxic or not; the toxic rows are split into grades of
equal size by their number of marked words. Sampled rows weigh as much as the
labels of their kind, so a bounded sample does not move the thresholds.
Scoring reads whole texts in one
pass, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostermill.llm import wordscan
from rostermill.llm.bpe import slices
from rostermill.llm.wordscan import BLANK, LETTER, Alphabet

STEMS = (4, 5)


@dataclass(frozen=True)
class Fit:
    """Bounds of the sample and settings of the regression."""

    #: labelled rows of each kind, those of lowest hash
    toxic_rows: int = 4000
    clean_rows: int = 8000
    #: features kept, and the rows a feature must occur in
    features: int = 512
    least_rows: int = 2
    #: how many standard errors a feature's rates must lie apart
    least_z: float = 2.0
    grades: int = 4
    #: of a feature one standard error apart; falls with the square of the errors
    penalty: float = 1e-3
    steps: int = 800


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights, and increasing thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def _alphabet() -> Alphabet:
    letters = [chr(c) for c in range(0x180)]
    small = [c.lower() if len(c.lower()) == 1 else c for c in letters]
    kinds = [LETTER if c.isalpha() else BLANK for c in small] + [LETTER]
    return Alphabet(np.array(kinds), np.array([ord(c) for c in small] + [0x180]))


_WORDS = _alphabet()
_CUT = " \n\t\r.,;:!?-"


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, feature hash) of every word and stem, in no order."""
    words = _WORDS.scan(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
    owners, found = [owner], [wordscan.hashes(words.codes, words.starts, words.lengths)]
    for stem in STEMS:
        long = words.lengths > stem
        size = np.full(int(long.sum()), stem, dtype=np.int64)
        owners.append(owner[long])
        found.append(wordscan.mix(wordscan.hashes(words.codes, words.starts[long], size)))
    return np.concatenate(owners), np.concatenate(found)


def _vectors(texts: list[str | None], features: np.ndarray) -> np.ndarray:
    """Dense matrix of log counts of the given sorted features."""
    counts = np.zeros((len(texts), len(features)))
    if len(features):
        for group, numbers in wordscan.stretches([t or "" for t in texts], _CUT):
            owner, found = _features(group)
            at = np.minimum(np.searchsorted(features, found), len(features) - 1)
            hit = features[at] == found
            np.add.at(counts, (np.array(numbers)[owner[hit]], at[hit]), 1)
    return counts


def _chances(model: Model, counts: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1, 2, ... of each row."""
    score = np.log2(1 + counts) @ model.weights
    return 1 / (1 + np.exp(np.clip(model.thresholds[None, :] - score[:, None], -60, 60)))


def _sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """At most ``toxic_rows + clean_rows`` labelled texts; labels are broadcast."""
    known = _labelled(labels)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id")

    def drawn(kind: int, rows: int) -> DataFrame:
        # cut by a threshold first, so that the last task gets about twice the wanted rows
        share = min(1.0, 2 * rows / max(1, sizes.get(kind, 0)))
        near = known.where((F.col("toxic") == kind) & (order <= int(share * 2**64) - 2**63 - 1))
        return near.orderBy(order, "doc_id").limit(rows)

    few = drawn(1, fit.toxic_rows).union(drawn(0, fit.clean_rows))
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL").join(F.broadcast(few), "doc_id")
    # rows that repeat an id are one: that of the smallest hash of its text
    least = F.min(F.struct(F.xxhash64("text"), "text")).alias("least")
    return texts.groupBy("doc_id", "toxic").agg(least).select("doc_id", "toxic", F.col("least.text").alias("text"))


def _labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic), one row per id; an id that is labelled both ways is toxic."""
    good = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    return good.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def _weights(labels: DataFrame, fit: Fit) -> tuple[float, float]:
    """How many labels a sampled clean row and a sampled toxic row stand for."""
    sizes = {r[0]: r[1] for r in _labelled(labels).groupBy("toxic").count().collect()}
    return max(1.0, sizes.get(0, 0) / fit.clean_rows), max(1.0, sizes.get(1, 0) / fit.toxic_rows)


def _chosen(sample: DataFrame, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Features whose share of toxic rows differs most from that of clean rows.

    Returns sorted hashes and by how many standard errors they differ.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                toxic = part.column(1).to_numpy()
                for group, numbers in wordscan.stretches([t or "" for t in part.column(0).to_pylist()], _CUT):
                    owner, found = _features(group)
                    pairs = np.unique(np.stack([found, np.array(numbers, dtype=np.uint64)[owner]]), axis=1)
                    kinds = toxic[pairs[1].astype(np.int64)]
                    names, at = np.unique(pairs[0], return_inverse=True)
                    both = np.bincount(at, minlength=len(names))
                    ill = np.bincount(at, weights=kinds, minlength=len(names)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names.view(np.int64)), pa.array(ill), pa.array(both)], names=["feature", "ill", "rows"]
                    )

    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n, m = sizes.get(1, 0), sizes.get(0, 0)
    if not n or not m:
        return np.zeros(0, dtype=np.uint64), np.zeros(0)
    # words are counted once per stretch of a text, which is once per text but for very long ones
    counted = sample.select("text", "toxic").mapInArrow(count, "feature long, ill long, rows long")
    rate = F.col("rows") / F.lit(n + m)
    z = (F.col("ill") / n - (F.col("rows") - F.col("ill")) / m) / F.sqrt(rate * (1 - rate) * (1 / n + 1 / m))
    best = (
        counted.groupBy("feature")
        .agg(F.sum("ill").alias("ill"), F.sum("rows").alias("rows"))
        .where((F.col("rows") >= fit.least_rows) & (F.col("rows") < n + m))
        .withColumn("z", z)
        .where(F.col("z") >= fit.least_z)
        .orderBy(F.desc("z"), "feature")
        .limit(fit.features)
    )
    rows = best.collect()
    features = np.array([r["feature"] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(features)
    return features[order], np.array([r["z"] for r in rows], dtype=np.float64)[order]


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """Fit on labelled rows; without rows of both kinds nothing is toxic."""
    sample = _sample(docs, labels, fit)
    features, errors = _chosen(sample, fit)
    empty = Model(features[:0], np.zeros(0), np.full(fit.grades - 1, 60.0))
    if not len(features):
        return empty

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts = _vectors(part.column(2).to_pylist(), features).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r.tobytes() for r in counts], pa.binary())],
                    names=["doc_id", "toxic", "counts"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "toxic", "text").mapInArrow(vectors, f"doc_id {kind}, toxic int, counts binary")
    rows = sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0], r[1], bytes(r[2])))
    toxic = np.array([r[1] for r in rows]) == 1
    counts = np.stack([np.frombuffer(r[2], dtype=np.float32) for r in rows])
    marked = counts.sum(axis=1)
    cuts = np.quantile(marked[toxic], np.arange(1, fit.grades - 1) / (fit.grades - 1))
    grade = np.where(toxic, 1 + np.searchsorted(cuts, marked, side="left"), 0)
    stands_for = np.array(_weights(labels, fit))[toxic.astype(int)]
    weights, thresholds = _fit(np.log2(1 + counts), grade, stands_for / stands_for.mean(), fit.penalty / errors**2, fit)
    return Model(features, weights, thresholds)


def _fit(x: np.ndarray, grade: np.ndarray, weight: np.ndarray, penalty: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Maximise the penalised likelihood by Adam over all rows, weighted.

    Thresholds are a first value and positive steps, kept positive as
    exponentials, so their order holds throughout.
    """
    steps = fit.grades - 2
    place = np.zeros(x.shape[1] + 1 + steps)
    place[x.shape[1]] = 1.0
    mean, square = np.zeros_like(place), np.zeros_like(place)
    rows = np.arange(len(x))
    for step in range(1, fit.steps + 1):
        w, rest = place[: x.shape[1]], place[x.shape[1] :]
        t = rest[0] + np.concatenate([[0.0], np.cumsum(np.exp(rest[1:]))])
        score = x @ w
        low = 1 / (1 + np.exp(-np.clip(t[None, :] - score[:, None], -60, 60)))
        edge = np.concatenate([np.zeros((len(x), 1)), low, np.ones((len(x), 1))], axis=1)
        slope = edge * (1 - edge)
        chance = np.maximum(edge[rows, grade + 1] - edge[rows, grade], 1e-12)
        up, down = weight * slope[rows, grade + 1] / chance, weight * slope[rows, grade] / chance
        by_score = (up - down) / len(x)  # of the loss
        by_t = np.zeros(fit.grades + 1)
        np.add.at(by_t, grade + 1, -up / len(x))
        np.add.at(by_t, grade, down / len(x))
        by_t = by_t[1:-1]
        tail = np.cumsum(by_t[::-1])[::-1]
        gradient = np.concatenate([x.T @ by_score + penalty * w, [tail[0]], tail[1:] * np.exp(rest[1:])])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        place = place - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    rest = place[x.shape[1] :]
    return place[: x.shape[1]], rest[0] + np.concatenate([[0.0], np.cumsum(np.exp(rest[1:]))])


def score(docs: DataFrame, model: Model, text: str = "text", keep: dict[str, Column] | None = None, reject_at: float = 0.5) -> DataFrame:
    """Severity of every row.

    Returns the columns of ``keep`` (by default doc_id), then severity (the
    expected grade), grade (the highest one passed with a chance of at least
    one half), p_toxic and toxic (p_toxic >= ``reject_at``). Null and empty
    texts have no features and so get the severity of an unmarked text.
    """
    keep = keep if keep is not None else {"doc_id": F.col("doc_id")}
    kept = [*keep]
    narrow = docs.select(F.col(text).alias("_text"), *[c.alias(name) for name, c in keep.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                chance = _chances(model, _vectors(part.column(0).to_pylist(), model.features))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[1:],
                        pa.array(chance.sum(axis=1)),
                        pa.array((chance >= 0.5).sum(axis=1).astype(np.int32)),
                        pa.array(chance[:, 0]),
                        pa.array(chance[:, 0] >= reject_at),
                    ],
                    names=[*kept, "severity", "grade", "p_toxic", "toxic"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])
    return narrow.mapInArrow(run, f"{kinds}, severity double, grade int, p_toxic double, toxic boolean")


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    names = docs.columns
    marked = score(docs, model, text, {f"c{at}": F.col(f"`{c}`") for at, c in enumerate(names)})
    return marked.where(~F.col("toxic")).select(*[F.col(f"c{at}").alias(c) for at, c in enumerate(names)])
