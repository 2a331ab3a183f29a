"""Near-duplicate vectors: spherical k-means cells, blocked cosine products.

1. Equal vectors of one label are one class with a weight.
2. Cells are found by spherical k-means on a bounded sample (``Cells``).
   Every class goes to the cell of its nearest centre, its home. Two unit
   vectors of cosine t are at most ``sqrt(2 - 2 t)`` apart; so if v has a
   partner in another cell c, v lies no further than that from the plane
   between its own centre and c's. v is sent there too, as a guest, when c has
   the smaller number. Every similar pair thus meets in exactly one cell, and
   none is lost. A smaller ``margin`` sends fewer guests and may lose pairs.
3. A cell of a label is cut into blocks of bounded size; a task takes a pair
   of blocks, multiplies it out in double precision, adds up each class's
   links and joins what is linked into local groups.
4. Local groups are joined by connected components.

No pair is emitted: a block pair gives at most one row per class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermill.llm.components import components
from rostermill.workdir import staged

#: classes of a block
BLOCK = 2048
#: cosines this close to the threshold are worked out again from the vectors
CLOSE = 1e-9


@dataclass(frozen=True)
class Cells:
    """Bounds of the sample and of the fit."""

    #: classes that k-means sees, those of lowest hash
    sample: int = 20_000
    #: classes a cell should hold, and cells at most
    size: int = 4096
    most: int = 512
    rounds: int = 10


def fit(vectors: np.ndarray, count: int, rounds: int) -> np.ndarray:
    """Unit centres of spherical k-means, from evenly spaced starting rows."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    centres = unit[np.linspace(0, len(unit) - 1, min(count, len(unit))).astype(int)].copy()
    for _ in range(rounds):
        home = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, unit)
        length = np.linalg.norm(sums, axis=1)
        good = length > 1e-12
        centres[good] = sums[good] / length[good, None]
    return np.unique(centres, axis=0)


def usable(embedding: str, label: str):
    """Whether a row can be compared at all."""
    vector = F.col(embedding)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(label).isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _members(classes: DataFrame, centres: dict[int, np.ndarray], margin: float) -> DataFrame:
    """(label, size, cell, guest, node, weight, vector): homes and guests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(4).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                raw = _matrix(part.column(3))
                unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
                middle = centres.get(int(size))
                if middle is None:
                    rows, cells, guest = np.arange(len(raw)), np.zeros(len(raw), np.int64), np.zeros(len(raw), bool)
                else:
                    gap = np.sqrt(np.maximum(2 - 2 * middle @ middle.T, 0))
                    near = unit @ middle.T
                    home = np.argmax(near, axis=1)
                    behind = near[np.arange(len(raw)), home][:, None] - near
                    sent = behind <= margin * gap[home] + 1e-12
                    sent &= np.arange(len(middle))[None, :] < home[:, None]
                    rows, cells = np.nonzero(sent)
                    guest = np.ones(len(rows), bool)
                    rows = np.concatenate([np.arange(len(raw)), rows])
                    cells = np.concatenate([home, cells])
                    guest = np.concatenate([np.zeros(len(raw), bool), guest])
                vectors = pa.array([r.tobytes() for r in raw], pa.binary())
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1).take(at),
                        part.column(4).take(at),
                        pa.array(cells, pa.int64()),
                        pa.array(guest),
                        part.column(0).take(at),
                        part.column(2).take(at),
                        vectors.take(at),
                    ],
                    names=["label", "size", "cell", "guest", "node", "weight", "vector"],
                )

    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("node", "label", "weight", "embedding", "size").mapInArrow(
        run, f"label {kind}, size int, cell long, guest boolean, node long, weight long, vector binary"
    )


def _drawn(classes: DataFrame, count: int, sample: int) -> DataFrame:
    """(size, vector): the ``sample`` classes of lowest hash, vectors as bytes.

    A threshold cuts before the rows meet, so that the last task gets about
    twice the sample, however many partitions there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v.values, np.float64).tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], names=["size", "vector"])

    order = F.xxhash64("node")
    share = min(1.0, 2 * sample / max(1, count))
    near = classes.where(order <= int(share * 2**64) - 2**63 - 1).orderBy(order, "node").limit(sample)
    return near.select("size", "embedding").mapInArrow(run, "size int, vector binary")


def _linked(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which rows of a and b have a cosine of at least ``least``."""
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    cosine = (a / na[:, None]) @ (b / nb[:, None]).T
    hit = cosine >= least
    for i, j in zip(*np.nonzero(np.abs(cosine - least) < CLOSE)):
        hit[i, j] = float(np.dot(a[i], b[j])) / float(na[i] * nb[j]) >= least
    return hit


def compare(group: pd.DataFrame, least: float) -> pd.DataFrame:
    """(node, root, links) of a pair of blocks: links found there, local group."""
    second = group["second"].to_numpy()
    node = group["node"].to_numpy()
    guest = group["guest"].to_numpy()
    weight = group["weight"].to_numpy()
    vectors = np.frombuffer(b"".join(group["vector"]), np.float64).reshape(len(group), -1)
    within = not second.any() or bool(second.all())
    left = np.arange(len(group)) if within else np.flatnonzero(~second)
    right = left if within else np.flatnonzero(second)
    hit = _linked(vectors[left], vectors[right], least)
    hit &= ~(guest[left][:, None] & guest[right][None, :])
    if within:
        np.fill_diagonal(hit, False)
        hit |= hit.T
    links = np.zeros(len(group), np.int64)
    links[left] += hit @ weight[right]
    if not within:
        links[right] += hit.T @ weight[left]
    root = node.copy()
    while True:
        before = root.copy()
        big = np.iinfo(np.int64).max
        low = np.where(hit, root[right][None, :], big).min(axis=1, initial=big)
        root[left] = np.minimum(root[left], low)
        if not within:
            low = np.where(hit, root[left][:, None], big).min(axis=0, initial=big)
            root[right] = np.minimum(root[right], low)
        if (root == before).all():
            break
    some = links > 0
    return pd.DataFrame({"node": node[some], "root": root[some], "links": links[some]})


def near_duplicates(
    vectors: DataFrame,
    least: float = 0.98,
    cells: Cells = Cells(),
    margin: float | None = None,
    key: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Links and group of every vector among those of its label.

    Returns one row per input row: vec_id, n_links, component_id, kept. A
    vector that is null, zero or has a null or non-finite component, and one
    without a label, has no links and is its own group; vectors of other
    lengths are never linked. Repeated rows count as vectors of their own. A
    null id never names a group. ``margin`` below ``sqrt(2 - 2 least)`` (the
    default, which loses nothing) trades recall for fewer guests.
    """
    margin = (2 - 2 * least) ** 0.5 if margin is None else margin
    good = F.coalesce(usable(embedding, label), F.lit(False))
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"), good.alias("good"))
    node = F.when(F.col("good"), F.xxhash64("label", F.xxhash64("embedding"), F.xxhash64(F.reverse("embedding"))))
    rows = rows.withColumn("node", node)
    classes = staged(
        rows.where("good")
        .groupBy("node")
        .agg(
            F.first("label").alias("label"),
            F.count("*").alias("weight"),
            F.first("embedding").alias("embedding"),
            F.min("vec_id").alias("least"),
        )
        .withColumn("size", F.size("embedding")),
        "classes",
    )
    counts = {r["size"]: r["count"] for r in classes.groupBy("size").count().collect()}
    drawn: dict[int, list[bytes]] = {}
    for size, vector in _drawn(classes, sum(counts.values()), cells.sample).collect():
        drawn.setdefault(size, []).append(vector)
    centres = {
        size: fit(np.frombuffer(b"".join(sample)).reshape(len(sample), size), min(cells.most, -(-counts[size] // cells.size)), cells.rounds)
        for size, sample in drawn.items()
    }
    members = staged(_members(classes, centres, margin), "members")
    place = ["label", "size", "cell"]
    blocks = members.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = (
        members.join(blocks, place)
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .withColumn("second", F.col("block") > F.col("other"))
    )
    found = staged(
        dealt.groupBy(*place, "i", "j").applyInPandas(lambda g: compare(g, least), "node long, root long, links long"), "found"
    )
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = staged(
        named.join(lowest, "root")
        .join(links, "node", "left")
        .select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")),
        "labels",
    )
    component = F.when(F.col("good"), F.col("component_id")).otherwise(F.col("vec_id"))
    return (
        rows.select("vec_id", "good", "node")
        .join(labels, "node", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
