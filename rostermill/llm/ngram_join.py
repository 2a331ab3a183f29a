"""Exact Jaccard self-join of word n-gram sets.

1. One pass over the texts gives each document's set of n-gram hashes, its
   size, and a fingerprint of the whole set. Documents with equal sets share
   the fingerprint: they are one *class* and are compared as one.
2. Sizes are cut into bands such that only sets of the same or of neighbouring
   bands can be similar enough. For each band pair the hash space is dealt into
   more parts than two similar sets can differ in elements; so two similar
   sets have at least one part in common, element for element. A *tile* is the
   band pair, the part and a hash of the part's content; classes of one tile
   are candidates. A passage that many documents share does not make a tile,
   since a part holds elements from all over the text.
3. Each tile's smallest class is its pivot. Hashed bitmaps of the sets bound
   each overlap with a pivot from above by bit counts; of the pivots that are
   left, every class is compared with the one it shares most tiles with. This
   links much of a group of near copies in one comparison per class.
4. Tiles of three and more whose classes are then in different components are taken
   apart, block by block. The same bound, between all classes of a pair of blocks,
   says which of them stay; these meet again with their sorted arrays, are
   intersected exactly, and leave one row per linked class. No pair is emitted.
5. A comparison intersects the two sorted arrays of hashes.

No link between different sets is lost: two linked classes share a tile, and
there they are either connected already or compared.

Hashes have 64 bits. Two different sets of a table of 10^9 have the same
fingerprint with a chance of about 3 %, of 10^6 with 3e-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermill.llm import wordscan
from rostermill.llm.bpe import slices
from rostermill.llm.components import components
from rostermill.llm.wordscan import Alphabet, mix
from rostermill.workdir import fresh_folder, remove_folder, staged

_BLANK = " \t\n\v\f\r"
_WORDS = Alphabet.of(128, _BLANK, {chr(c): chr(c + 32) for c in range(65, 91)})
#: bits of a bitmap per element, before rounding up to a power of two
BITS = 3
#: tiles of a class that its rows carry, those of lowest hash
CARRIED = 8
_NO_TILE = np.iinfo(np.int64).max
#: classes of a tile in one block, and elements of their sets, at most (about)
BLOCK = 4_096
ELEMENTS = 4_000_000
#: fingerprints a task remembers, to write the parts of repeated sets once
REMEMBERED = 500_000


@dataclass(frozen=True)
class Join:
    """Words per n-gram, and the least similarity as a fraction."""

    words: int = 5
    share: int = 4
    of: int = 5

    def linked(self, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.of * overlap >= self.share * (a + b - overlap)

    def bands(self, largest: int) -> list[tuple[int, int]]:
        """First and last size of each band up to a largest size."""
        out, low = [], 1
        while low <= largest:
            high = low * self.of // self.share
            out.append((low, high))
            low = high + 1
        return out

    def parts(self, high: int) -> tuple[int, int]:
        """(parts, spare) for sets of at most ``high`` elements.

        Similar sets differ in at most ``parts - 1 - spare`` elements, so they
        agree in ``1 + spare`` parts. A set with no more than ``spare`` empty
        parts need not write these.
        """
        differ = 2 * high * (self.of - self.share) // (self.of + self.share)
        if not differ:
            return 0, 0
        spare = 1 + (differ + 1) // 64
        return differ + 1 + spare, spare


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text.

    Fewer words than an n-gram has are one shingle, no word is none.
    """
    full = [t or "" for t in texts]
    hashes: list[list[np.ndarray]] = [[] for _ in full]
    for group, numbers in wordscan.stretches(full, _BLANK):
        found = _WORDS.scan(group)
        h = wordscan.hashes(found.codes, found.starts, found.lengths)
        for at, number in enumerate(numbers):
            hashes[number].append(h[found.bounds[at] : found.bounds[at + 1]])
    out = []
    for parts in hashes:
        h = parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, dtype=np.uint64), *parts])
        n = min(words, len(h))
        grams = np.full(max(0, len(h) - n + 1) if n else 0, np.uint64(n), dtype=np.uint64)
        for k in range(n):
            grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(grams)])
        out.append(np.unique(grams))
    return out


class Signer:
    """Fingerprints and tiles of sets."""

    def __init__(self, join: Join):
        self.join = join
        self.bands = join.bands(1)

    def _band(self, size: int) -> int:
        while self.bands[-1][1] < size:
            self.bands = self.join.bands(2 * self.bands[-1][1] + 8)
        at = 0
        while self.bands[at][1] < size:
            at += 1
        return at

    def node(self, grams: np.ndarray) -> int:
        total = np.add.reduce(mix(grams + np.uint64(77))) + np.uint64(len(grams))
        return int(mix(np.array([total]))[0].view(np.int64))

    def tiles(self, grams: np.ndarray) -> np.ndarray:
        """Tile hashes; the lowest bit is 0 in the band pair's upper band."""
        band = self._band(len(grams))
        self._band(self.bands[band][1] + 1)
        out = []
        scaled = grams >> np.uint64(33)
        for pair, lower in ((band, 0), (band + 1, 1)):
            parts, spare = self.join.parts(self.bands[pair][1])
            if not parts:
                continue
            part = ((scaled * np.uint64(parts)) >> np.uint64(31)).astype(np.int64)
            content = np.zeros(parts, dtype=np.uint64)
            np.add.at(content, part, mix(grams))
            number = np.arange(parts, dtype=np.uint64)
            filled = np.bincount(part, minlength=parts) > 0
            if parts - int(filled.sum()) <= spare:
                content, number = content[filled], number[filled]
            key = mix(content + mix(number + np.uint64(pair << 32)))
            out.append((key & ~np.uint64(1)) | np.uint64(lower))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def bitmap(grams: np.ndarray) -> np.ndarray:
    """Bits of the hashed elements; their number is a power of two, 64 or more."""
    size = max(64, 1 << (BITS * len(grams) - 1).bit_length())
    bits = np.zeros(size, dtype=np.uint8)
    bits[(grams >> np.uint64(3)) % np.uint64(size)] = 1
    return np.packbits(bits).view(np.uint64)


def folded(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps of one size as a matrix: larger ones are laid over themselves."""
    words = min(map(len, bitmaps)) // 8
    rows = [np.frombuffer(b, np.uint64) for b in bitmaps]
    return np.stack([r if len(r) == words else np.bitwise_or.reduce(r.reshape(-1, words), axis=0) for r in rows])


# -- 1: sets and classes ------------------------------------------------------


def _signed(docs: DataFrame, join: Join, text: str, key: str) -> DataFrame:
    """(doc_id, n_shingles, node, bits); no bits for a set seen before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, seen = Signer(join), set()
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(1).to_pylist(), join.words)
                nodes = [signer.node(s) if len(s) else None for s in sets]
                bits = []
                for grams, node in zip(sets, nodes):
                    new = node is not None and node not in seen
                    seen.add(node)
                    bits.append(bitmap(grams).tobytes() if new else None)
                if len(seen) > REMEMBERED:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(nodes, pa.int64()),
                        pa.array(bits, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "node", "bits"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, node long, bits binary"
    )


# -- 2: tiles -----------------------------------------------------------------


def _tiles(docs: DataFrame, join: Join, text: str) -> DataFrame:
    """(key, node): the tiles of every set, once per task for equal sets.

    They are many times the size of everything else and nearly all of them
    occur once, so they are never written: the texts are read a second time
    and the tiles go straight into their shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, seen = Signer(join), set()
        for batch in batches:
            for part in slices(batch, 200):
                found, owners = [], []
                for grams in shingle_sets(part.column(0).to_pylist(), join.words):
                    node = signer.node(grams) if len(grams) else None
                    if node is None or node in seen:
                        continue
                    seen.add(node)
                    found.append(signer.tiles(grams).view(np.int64))
                    owners.append(np.full(len(found[-1]), node))
                if len(seen) > REMEMBERED:
                    seen.clear()
                if found:
                    columns = [pa.array(np.concatenate(x)) for x in (found, owners)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "node"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "key long, node long")


def _shared_tiles(rows: DataFrame) -> DataFrame:
    """(tile, pivot, node): the classes of tiles that hold two or more.

    Rows come sorted by tile, and upper-band classes first within it, so a
    tile is a run of rows. The first class is the pivot; a run that starts in
    the lower band has no pair that another tile does not have as well. A run
    is passed on as it is read, whatever its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        last = None  # (tile, pivot, whether kept, last node)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy().view(np.uint64)
            node = batch.column(1).to_numpy()
            tile = key >> np.uint64(1)
            begins = np.empty(len(tile), dtype=bool)
            begins[0] = last is None or tile[0] != last[0]
            np.not_equal(tile[1:], tile[:-1], out=begins[1:])
            at = np.cumsum(begins)  # 0: the run carried over
            first = np.flatnonzero(begins)
            pivots = np.concatenate([[last[1] if last else 0], node[first]])
            kept = np.concatenate([[bool(last and last[2])], (key[first] & np.uint64(1)) == 0])
            repeated = np.zeros(len(tile), dtype=bool)
            repeated[1:] = (node[1:] == node[:-1]) & ~begins[1:]
            if last is not None and not begins[0]:
                repeated[0] = node[0] == last[3]
            rows = kept[at] & (pivots[at] != node) & ~begins & ~repeated
            yield pa.RecordBatch.from_arrays(
                [pa.array(number + at[rows]), pa.array(pivots[at[rows]]), pa.array(node[rows])],
                names=["tile", "pivot", "node"],
            )
            number += int(at[-1])
            last = (tile[-1], pivots[at[-1]], kept[at[-1]], node[-1])

    dealt = rows.repartition(F.shiftright("key", 1)).sortWithinPartitions("key", "node")
    return dealt.mapInArrow(run, "tile long, pivot long, node long")


# -- 5: comparing -------------------------------------------------------------


def _sets_of(docs: DataFrame, pairs: DataFrame, classes: DataFrame, join: Join, text: str, key: str) -> DataFrame:
    """(node, grams) of the classes in (a, b) pairs: their texts are read again.

    The wanted ids are written first, so that their size is known and decides
    whether they go to the texts or the texts are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(join)
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(1).to_pylist(), join.words)
                nodes = part.column(0).to_pylist()
                # another row of the same id may hold another text
                right = [len(s) > 0 and signer.node(s) == n for s, n in zip(sets, nodes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).filter(pa.array(right, pa.bool_())),
                        pa.array([s.tobytes() for s, r in zip(sets, right) if r], pa.binary()),
                    ],
                    names=["node", "grams"],
                )

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = staged(nodes.join(classes, "node").select("node", F.col("least").alias("doc_id")), "wanted")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(wanted, "doc_id")
    return rows.select("node", "text").mapInArrow(run, "node long, grams binary")


def _likely(pairs: DataFrame, facts: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) that bit counts do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for m, n, x, y in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "x", "y"))):
                x, y = folded([x, y])
                common = int(np.bitwise_count(x & y).sum())
                most = min(m - int(np.bitwise_count(x).sum()) + common, n - int(np.bitwise_count(y).sum()) + common)
                good.append(bool(join.linked(most, m, n)))
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    left = facts.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("bits").alias("x"))
    right = facts.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n1", "n2", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by exact intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                good.append(bool(join.linked(int((large[at] == small).sum()), len(x), len(y))))
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"]
            )

    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


# -- 4: tiles taken apart -----------------------------------------------------


#: a pair of blocks of a tile, in which all classes meet
_PLACE = ["tile", "i", "j"]


def _by_place(rows: DataFrame, task: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``task`` of the rows of each pair of blocks.

    Rows are dealt and sorted by place, so a place is a run of rows; a task
    holds one run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            place = np.stack([table.column(c).to_numpy() for c in _PLACE])
            cut = np.flatnonzero(np.any(place[:, 1:] != place[:, :-1], axis=0)) + 1
            for low, high in zip([0, *cut.tolist()], [*cut.tolist(), table.num_rows]):
                found = task(table.slice(low, high - low))
                if found is not None and found.num_rows:
                    yield found

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            place = np.stack([table.column(c).to_numpy() for c in _PLACE])
            open_run = np.flatnonzero(np.any(place != place[:, -1:], axis=0))
            cut = int(open_run[-1]) + 1 if len(open_run) else 0
            if cut:
                yield from flush(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield from flush(held)

    dealt = rows.repartition(*_PLACE).sortWithinPartitions(*_PLACE, "second", "node")
    return dealt.mapInArrow(run, schema)


def _sides(second: np.ndarray) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether both blocks are one, and the rows on either side."""
    one = not second.any() or bool(second.all())
    everything = np.arange(len(second))
    return (True, everything, everything) if one else (False, np.flatnonzero(~second), np.flatnonzero(second))


def _bounded(n: np.ndarray, bits: np.ndarray, ones: np.ndarray, at: int, right: np.ndarray, join: Join) -> np.ndarray:
    """Which rows of ``right`` bit counts do not rule out for row ``at``."""
    common = np.bitwise_count(bits[at][None, :] & bits[right]).sum(axis=1, dtype=np.int64)
    most = np.minimum(n[at] - (ones[at] - common), n[right] - (ones[right] - common))
    return join.linked(most, n[at], n[right])


def _open_classes(members: DataFrame, facts: DataFrame, join: Join) -> DataFrame:
    """(tile, i, j, second, node, root, n, bits): classes that may be similar to
    one of another component in their pair of blocks.

    ``members`` has tile and node; ``facts`` has node, root, n, bits and first
    (the lowest tile hashes of the class) and is joined last, so that bitmaps
    are shuffled with their rows once. Tiles of more than BLOCK classes or
    ELEMENTS elements are compared block by block, each pair of blocks on its
    own. A pair is left to another tile where both carry one of a lower hash;
    the lowest tile of a pair always counts it.
    """
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / ELEMENTS)).cast("int")
    sizes = members.join(facts.select("node", "n"), "node").groupBy("tile").agg(blocks.alias("blocks"))
    placed = members.join(sizes, "tile").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "tile",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).alias("second"),
        "node",
        F.xxhash64("tile").alias("own"),
    )
    spread = spread.join(facts, "node").select(*_PLACE, "second", "node", "root", "n", "bits", "own", "first")

    def task(table: pa.Table) -> pa.RecordBatch | None:
        root, n, own, second = (table.column(c).to_numpy() for c in ("root", "n", "own", "second"))
        if (root == root[0]).all():
            return None
        bits = folded(table.column("bits").to_pylist())
        ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        lists = table.column("first").to_pylist()
        first = np.array([x + [_NO_TILE] * (CARRIED - len(x)) for x in lists], dtype=np.int64)
        one, left, right = _sides(second)
        kept = np.zeros(len(n), bool)
        for at in left:
            other = right[(root[right] != root[at]) & ((right > at) | (not one))]
            if not len(other):
                continue
            places = other[_bounded(n, bits, ones, at, other, join)]
            if len(places):
                mine = first[at][first[at] < own[at]]
                elsewhere = (first[places][:, :, None] == mine[None, None, :]).any(axis=(1, 2))
                places = places[~elsewhere]
                kept[places] = True
                kept[at] |= len(places) > 0
        some = table.select([*_PLACE, "second", "node", "root", "n", "bits"]).filter(pa.array(kept))
        return some.combine_chunks().to_batches()[0] if some.num_rows else None

    return _by_place(spread, task, "tile long, i int, j int, second boolean, node long, root long, n long, bits binary")


def _linked_classes(open_: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """(a, b): links between classes of other components, one row per class and
    pair of blocks at most; together they connect all that are similar there.

    Pairs that the bound leaves are intersected unless their classes are in one
    group by then, so a block costs few intersections per class. A task holds
    the arrays of one pair of blocks.
    """
    rows = open_.join(sets, "node").select(*_PLACE, "second", "node", "root", "n", "bits", "grams")

    def task(table: pa.Table) -> pa.RecordBatch:
        node, root, n, second = (table.column(c).to_numpy() for c in ("node", "root", "n", "second"))
        grams = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("grams")]
        bits = folded(table.column("bits").to_pylist())
        ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        one, left, right = _sides(second)
        # local groups, by the place of one of their classes
        _, group = np.unique(root, return_inverse=True)
        a, b = [], []
        for at in left:
            other = right[(group[right] != group[at]) & ((right > at) | (not one))]
            for mate in other[_bounded(n, bits, ones, at, other, join)] if len(other) else ():
                if group[mate] == group[at]:
                    continue
                small, large = sorted((grams[at], grams[mate]), key=len)
                found = np.minimum(np.searchsorted(large, small), len(large) - 1)
                if join.linked(int((large[found] == small).sum()), n[at], n[mate]):
                    a.append(node[at])
                    b.append(node[mate])
                    group[group == group[mate]] = group[at]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _by_place(rows, task, "a long, b long")


# -- the whole ----------------------------------------------------------------


def similar_groups(docs: DataFrame, join: Join = Join(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """Size of each document's set and the group that links lead to.

    Returns one row per input row: doc_id, n_shingles, component_id (smallest
    id of the group). A null or wordless text is linked with nothing and is
    its own group. Rows of one id are separate documents. A row without an id is
    in the group of the rows with an equal set, and in none of its own.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "signed")
    _signed(docs, join, text, key).write.parquet(folder)
    signed = spark.read.parquet(folder)
    rows = staged(signed.select("doc_id", "n_shingles", "node"), "sets")
    tiles = staged(_shared_tiles(_tiles(docs, join, text)), "tiles")
    pairs = staged(tiles.groupBy("node", "pivot").agg(F.count("*").alias("tiles")), "pairs")
    nodes = pairs.select("node").union(pairs.select("pivot")).distinct()
    facts = signed.where("bits IS NOT NULL").join(nodes, "node")
    facts = staged(facts.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("bits").alias("bits")), "facts")
    remove_folder(spark, folder)
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    links = _links(docs, tiles, pairs, facts, classes, join, text, key)
    roots = staged(components(links), "roots")

    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = staged(named.join(lowest, "root").select("node", "component_id"), "labels")
    return rows.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _links(
    docs: DataFrame,
    tiles: DataFrame,
    pairs: DataFrame,
    facts: DataFrame,
    classes: DataFrame,
    join: Join,
    text: str,
    key: str,
) -> DataFrame:
    """Links (a, b) between classes that connect all that are similar.

    ``pairs`` has the classes and pivots of tiles and the tiles they share,
    ``facts`` the size and bitmap of each class. Bit counts rule most of the
    pairs out; of the others, the best of each class comes first.
    """
    named = pairs.select(F.col("node").alias("a"), F.col("pivot").alias("b"), "tiles")
    likely = staged(named.join(_likely(named.select("a", "b"), facts, join), ["a", "b"]), "likely")
    best = F.max_by("b", F.struct("tiles", -F.col("b")))
    first = staged(likely.groupBy("a").agg(best.alias("b")), "firsts")
    linked = staged(_verified(first, _sets_of(docs, first, classes, join, text, key), join), "links")
    roots = staged(components(linked), "roots")

    def rooted(frame: DataFrame, node: str, root: str) -> DataFrame:
        found = roots.select(F.col("node").alias(node), F.col("root").alias(root))
        return frame.join(found, node, "left").withColumn(root, F.coalesce(root, node))

    def apart(frame: DataFrame, a: str, b: str) -> DataFrame:
        return rooted(rooted(frame, a, "r1"), b, "r2").where("r1 <> r2").select(a, b)

    # a tile of two classes is done with its pair; in others any two may be similar
    wide = tiles.groupBy("tile").agg(F.count("*").alias("others")).where("others > 1").select("tile")
    split = tiles.join(apart(pairs, "node", "pivot"), ["node", "pivot"], "left_semi").select("tile").distinct()
    rows = tiles.join(split.join(wide, "tile"), "tile", "left_semi")
    members = rows.select("tile", "node").union(rows.select("tile", "pivot").distinct())
    carried = members.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.xxhash64("tile"))), 1, CARRIED).alias("first"))
    facts = rooted(facts.join(carried, "node"), "node", "root")
    # a class and a pivot that were compared already are not compared again
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    found = apart(likely, "a", "b").select(*ordered).distinct()
    more = staged(found.join(first.select(*ordered), ["a", "b"], "left_anti"), "more")
    open_ = staged(_open_classes(members, facts, join), "open")
    wanted = more.union(open_.select(F.col("node").alias("a"), F.col("node").alias("b")))
    sets = staged(_sets_of(docs, wanted, classes, join, text, key), "arrays")
    return linked.union(_verified(more, sets, join)).union(_linked_classes(open_, sets, join))


def keep_rows(docs: DataFrame, join: Join = Join(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of similar texts, with all its columns.

    The row of the group's smallest id stays; documents that are in no group
    stay all. Rows that repeat an id stay or go together.
    """
    found = similar_groups(docs, join, text, key)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(f"`{key}`") == F.col("__gone"), "left_anti")
