"""Nearest vectors by inner product: collision counting on sorted projections.

1. Vectors of one length and one band of norms are dealt over shards. Within a
   shard of greatest norm M, a vector x gets one more component
   sqrt(M² - |x|²) and a query is scaled to norm M with a 0 there, so that the
   largest inner product is the smallest distance.
2. A shard's index has one sorted array per projection (directions of random
   rotations from a fixed seed), read in blocks of ranks. A query's window in
   an array is centred on the query's own projection and rounded out to blocks.
3. Virtual rehashing: all windows of a query grow by a factor from round to
   round. Collisions are counted for 64 vectors at a time, as bits. A vector
   that lies in enough windows (``Search.share`` of all) is a candidate; the
   rounds end when there are ``extra`` + ``part`` of the shard, or all rows.
4. Candidates are verified by the inner product of the original vectors, in
   double precision and in the order of the components, so equal vectors get
   equal scores. The best of all shards are merged per query.

A task streams the queries past one shard: memory is bounded by the shard and
one batch. Equal vectors differ by id alone, and ties go to the smaller id, so
of a group of equal vectors only the k + 1 smallest ids can be among any
query's k nearest; the others are left out before shards are formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermill.workdir import staged

#: words of window bits that a task holds at once
HELD = 1 << 20


@dataclass(frozen=True)
class Search:
    """Parameters of the index; recall is measured in the tests."""

    projections: int = 96
    #: blocks of ranks that a sorted array is read by
    blocks: int = 64
    #: share of the windows that must hold a candidate
    share: float = 0.6
    #: candidates wanted per shard: a number, and a part of its rows
    extra: int = 200
    part: float = 0.06
    #: first half width in spreads of the projections, and growth per round
    first: float = 0.6
    growth: float = 1.15
    #: rows of a shard at most (about), and shards of a large enough table
    rows: int = 65_536
    shards: int = 8
    #: queries that pass one copy of a shard; more are dealt over copies
    queries: int = 1_000_000
    seed: int = 7


@lru_cache(maxsize=8)
def directions(size: int, count: int, seed: int) -> np.ndarray:
    """Rows of random rotations, scaled to the length of normal vectors."""
    rng = np.random.default_rng([seed, size])
    turns = [np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(-(-count // size))]
    return np.concatenate(turns)[:count] * np.sqrt(size)


def at_least(masks: np.ndarray, least: int) -> np.ndarray:
    """Bits that are set in at least ``least`` of the masks.

    ``masks`` is (rows, masks, words). Adders work on 64 counters at a time:
    three masks of one weight become one of that weight and one of the next.
    """
    planes, level = [], masks
    while level.shape[1]:
        carried = []
        while level.shape[1] > 1:
            third = (level.shape[1] - level.shape[1] % 3) // 3
            if third:
                a, b, c = level[:, :third], level[:, third : 2 * third], level[:, 2 * third : 3 * third]
                odd = a ^ b
                carried.append((a & b) | (odd & c))
                level = np.concatenate([odd ^ c, level[:, 3 * third :]], axis=1)
            else:
                a, b = level[:, :1], level[:, 1:2]
                carried.append(a & b)
                level = a ^ b
        planes.append(level[:, 0])
        level = np.concatenate(carried, axis=1) if carried else level[:, :0]
    # compare the counters with the number, highest plane first
    above = np.zeros_like(planes[0])
    equal = ~above
    if least >> len(planes):
        return above
    for bit in range(len(planes) - 1, -1, -1):
        if least >> bit & 1:
            equal = equal & planes[bit]
        else:
            above = above | (equal & planes[bit])
            equal = equal & ~planes[bit]
    return above | equal


def inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, added up in the order of the components."""
    total = np.zeros(len(rows))
    for i, q in enumerate(query):
        total += rows[:, i] * q
    return total


class Shard:
    """Sorted projections of some vectors, and searches in them.

    A sorted array is held as blocks of ranks: bit x of ``before[j, g]`` says
    whether vector x lies in one of the first g blocks of array j, so the
    members of any window of blocks are two of these rows apart.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, search: Search):
        self.ids, self.vectors, self.search = ids, vectors, search
        norms = np.linalg.norm(vectors, axis=1)
        self.norm = norms.max()
        unit = vectors / self.norm
        self.quick = unit.astype(np.float32)
        rest = np.sqrt(np.maximum(1 - (unit * unit).sum(axis=1), 0))
        self.ways = directions(vectors.shape[1] + 1, search.projections, search.seed)
        values = self.ways @ np.column_stack([unit, rest]).T
        self.spread = values.std()
        size = len(ids)
        self.step = -(-size // search.blocks)
        edges = np.arange(-(-size // self.step) + 1)
        words = -(-size // 64)
        self.before = np.zeros((len(values), len(edges), words), np.uint64)
        for j, value in enumerate(values):
            order = np.argsort(value, kind="stable")
            value[:] = value[order]
            block = np.empty(size, np.int64)
            block[order] = np.arange(size) // self.step
            bits = np.zeros((len(edges), words * 64), bool)
            bits[:, :size] = block < edges[:, None]
            self.before[j] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        self.values = values

    def _collided(self, centre: np.ndarray, half: np.ndarray) -> np.ndarray:
        """Bits of the vectors that lie in enough windows, a row per query."""
        low = np.stack([np.searchsorted(v, c - half) for v, c in zip(self.values, centre.T)], axis=1)
        high = np.stack([np.searchsorted(v, c + half, "right") for v, c in zip(self.values, centre.T)], axis=1)
        way = np.arange(len(self.values))
        window = self.before[way, -(-high // self.step)] ^ self.before[way, low // self.step]
        return at_least(window, int(np.ceil(self.search.share * len(way))))

    def candidates(self, queries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the query, rows that its windows collide with often enough)."""
        search, size = self.search, len(self.ids)
        need = min(size, search.extra + int(np.ceil(search.part * size)))
        centre = (queries / np.linalg.norm(queries, axis=1, keepdims=True)) @ self.ways[:, :-1].T
        farthest = np.maximum(np.abs(centre - self.values[:, 0]), np.abs(centre - self.values[:, -1])).max(axis=1)
        half = search.first * self.spread + 1e-3 * farthest
        live = np.arange(len(queries))
        while len(live):
            hits = self._collided(centre[live], half[live])
            done = np.bitwise_count(hits).sum(axis=1) >= need
            for i, bits in zip(live[done], hits[done]):
                yield i, np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))
            live = live[~done]
            half[live] *= search.growth

    def nearest(self, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the query, its nearest rows here, their scores); a query's own row is no candidate."""
        many = max(1, HELD // (self.before.shape[0] * self.before.shape[2]))
        for low in range(0, len(queries), many):
            block = queries[low : low + many]
            for i, hit in self.candidates(block):
                own = hit[self.ids[hit] == ids[low + i]]
                own = own[(self.vectors[own] == block[i]).all(axis=1)]
                if len(own):
                    hit = hit[~np.isin(hit, own)]
                if len(hit) > 4 * k:
                    # single precision is enough to leave out what is far behind the k-th
                    near = self.quick[hit] @ (block[i] / np.linalg.norm(block[i])).astype(np.float32)
                    hit = hit[near >= np.partition(near, -k)[-k] - 1e-4]
                score = inner(self.vectors[hit], block[i])
                best = np.lexsort((self.ids[hit], -score))[:k]
                yield low + i, hit[best], score[best]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _stream(batches: Iterator[pa.RecordBatch], k: int, search: Search) -> Iterator[pa.RecordBatch]:
    """Rows come by place, a place's vectors before its queries."""
    place, shard, held = None, None, []
    for batch in batches:
        places = batch.column(0).to_numpy()
        asked = batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(places) != 0) | (np.diff(asked) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(places)]):
            if low == high:
                continue
            part = batch.slice(low, high - low)
            if places[low] != place:
                place, shard, held = places[low], None, []
            ids, vectors = part.column(2).to_numpy(), _matrix(part.column(3))
            if not asked[low]:
                held.append((ids, vectors))
                continue
            if shard is None:
                shard = Shard(*(np.concatenate(x) for x in zip(*held)), search)
                held = []
            query, found, score = [], [], []
            for i, rows, scores in shard.nearest(ids, vectors, k):
                query.append(np.full(len(rows), i))
                found.append(shard.ids[rows])
                score.append(scores)
            at = pa.array(np.concatenate(query))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(2).take(at),
                    part.column(4).take(at),
                    part.column(5).take(at),
                    pa.array(np.concatenate(found)),
                    pa.array(np.concatenate(score)),
                ],
                names=["query_id", "one", "two", "vec_id", "score"],
            )


def nearest(
    vectors: DataFrame,
    asked: Column,
    k: int = 20,
    search: Search = Search(),
    key: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of largest inner product for each row that ``asked`` selects.

    Returns query_id, rank (from 1), vec_id and score, nearest first, ties to
    the smaller vec_id; a query with fewer candidates has fewer rows. A
    candidate is every row but the query's own. Rows repeated whole (id and
    vector) are one row; rows of one id with different vectors are rows, and
    queries, of their own. Vectors that are null, zero or empty or hold null
    or non-finite components take no part, nor do rows without an id. Vectors
    are compared with those of their length only. ``asked`` may use any column
    of ``vectors``; null means no. An empty table gives an empty result.
    """
    vector = F.col("embedding")
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(embedding).alias("embedding"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
    )
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & vector.isNotNull() & finite & some)
    square = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = staged(
        rows.groupBy("vec_id", "embedding")
        .agg(F.max("asked").alias("asked"))
        .select("*", F.size("embedding").alias("size"), F.round(F.log2(F.sqrt(square))).alias("band")),
        "vectors",
    )
    first = Window.partitionBy("embedding").orderBy("vec_id")
    stored = staged(rows.withColumn("copy", F.row_number().over(first)).where(F.col("copy") <= k + 1).drop("copy", "asked"), "stored")

    # one row for each (length, band of norms): a few
    count = F.col("rows")
    sizes = stored.groupBy("size", "band").agg(F.count("*").alias("rows"))
    sizes = sizes.withColumn(
        "shards", F.greatest(F.ceil(count / search.rows), F.least(F.lit(search.shards), F.ceil(count / 512))).cast("int")
    )
    queries = rows.where("asked")
    total = {r["size"]: r["count"] for r in queries.groupBy("size").count().collect()}
    many = F.lit(1)
    for size, number in total.items():
        many = F.when(F.col("size") == size, F.lit(max(1, -(-number // search.queries)))).otherwise(many)
    shards = sizes.withColumn("copies", many)
    ends = Window.orderBy("size", "band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = F.col("shards") * F.col("copies")
    shards = staged(shards.withColumn("base", (F.sum(cells).over(ends) - cells).cast("int")), "shards")
    places = shards.agg(F.sum(cells)).first()[0] or 1

    dealt = (
        stored.join(shards, ["size", "band"])
        .withColumn("shard", F.pmod(F.xxhash64("vec_id"), "shards"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    )
    sent = (
        queries.drop("band")
        .join(shards, "size")
        .withColumn("copy", F.pmod(F.xxhash64("vec_id", "embedding"), "copies"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    )
    place = (F.col("base") + F.col("copy") * F.col("shards") + F.col("shard")).cast("int").alias("place")
    columns = [
        "vec_id",
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.xxhash64("embedding").alias("one"),
        F.xxhash64(F.lit(1), F.reverse("embedding")).alias("two"),
    ]
    mixed = dealt.select(place, F.lit(0).alias("kind"), *columns).unionByName(sent.select(place, F.lit(1).alias("kind"), *columns))
    found = (
        mixed.repartitionById(places, F.col("place"))
        .sortWithinPartitions("place", "kind")
        .mapInArrow(lambda b: _stream(b, k, search), "query_id long, one long, two long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id", "one", "two").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
