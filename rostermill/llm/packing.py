"""Pack documents into token windows by order-preserving dynamic programming.

Documents stay in key order; a run of them is one stream of ids, each ended by
the end id. Windows of at most ``window`` ids tile the stream. A cut costs
nothing at a document's end, a little at a sentence's end and more inside a
sentence; a window costs a fixed amount and the padding that fills it up (none
if its length is a power of two), so long windows are preferred. With ``f(i)`` the least cost of the stream up to cut
candidate ``i``::

    f(i) = penalty(i) + min over j of f(j) + padding(i - j),  i - j <= window

``padding`` is ``window - (i - j)`` apart from the powers of two, so the
minimum of ``f(j) + j`` over a sliding range is all that is needed: a queue
kept in increasing order gives it in constant time. The powers of two are
looked up one by one.

Candidates are document ends, sentence ends and, where these lie far apart,
places at most ``STEP`` ids apart, so every text can be packed.

Spark deals documents out by ranges of the key; a task sorts its range, and
plans ``RUN`` ids at a time, so that memory does not depend on the table.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermill.llm import word_bpe
from rostermill.llm.bpe import slices

#: ids planned at once; a single longer document is planned whole
RUN = 1 << 18
#: ids between two candidates at most
STEP = 64


@dataclass(frozen=True)
class Costs:
    """Penalties of a cut or a window, in ids of padding."""

    sentence: int = 4
    inside: int = 24
    #: of each window
    window: int = 96


def sentence_ends(tokens: list[str]) -> np.ndarray:
    """For each id, whether a sentence ends with it."""
    return np.array([bool(re.fullmatch(r"[^\w\s]*[.!?][^\w\s]*</w>", t)) for t in tokens])


def candidates(ends: np.ndarray, documents: np.ndarray, total: int, costs: Costs, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut, with the penalty of each.

    ``ends`` are places after a sentence, ``documents`` places after a
    document; the first candidate is 0 and the last one ``total``.
    """
    places = np.unique(np.concatenate([[0], ends, documents, [total]]))
    gap = np.diff(places)
    more = np.maximum(gap - 1, 0) // step
    within = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    extra = np.repeat(places[:-1], more) + within * step
    penalty = np.concatenate([np.full(len(places), costs.sentence), np.full(len(extra), costs.inside)])
    places = np.concatenate([places, extra])
    order = np.argsort(places, kind="stable")
    places, penalty = places[order], penalty[order]
    penalty[np.isin(places, documents)] = 0
    penalty[[0, -1]] = 0
    return places, penalty


def plan(places: np.ndarray, penalty: np.ndarray, window: int, costs: Costs) -> list[int]:
    """The cuts of least cost, from 0 to the last place."""
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    at = places.tolist()
    price = penalty.tolist()
    number = {place: i for i, place in enumerate(at)}
    each = costs.window
    cost = [0.0] * len(at)
    back = [0] * len(at)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # f(j) + j, place, number
    for i in range(1, len(at)):
        here = at[i]
        while here - queue[0][1] > window:
            queue.popleft()
        best, _, last = queue[0]
        best += window - here
        for power in powers:
            j = number.get(here - power)
            if j is not None and cost[j] < best:
                best, last = cost[j], j
        cost[i] = best = best + price[i] + each
        back[i] = last
        key = best + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, i))
    cuts = [at[-1]]
    i = len(at) - 1
    while i:
        i = back[i]
        cuts.append(at[i])
    cuts.reverse()
    return _split_padded(cuts, window, costs)


def _split_padded(cuts: list[int], window: int, costs: Costs) -> list[int]:
    """Split a window into powers of two where that is cheaper than padding."""
    out = cuts[:1]
    for start, end in zip(cuts, cuts[1:]):
        length = end - start
        ones = [1 << k for k in range(length.bit_length()) if length >> k & 1]
        if (len(ones) - 1) * (costs.inside + costs.window) < window - length:
            for part in reversed(ones[1:]):
                start += part
                out.append(start)
        out.append(end)
    return out


class Packer:
    """Plans one run of documents after another."""

    def __init__(self, ends: np.ndarray, window: int, costs: Costs):
        self.ends, self.window, self.costs = ends, window, costs

    def pieces(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, start in it, length, window, offset in it) of each piece."""
        total = len(ids)
        upto = np.cumsum(sizes)
        places, penalty = candidates(np.flatnonzero(self.ends[ids]) + 1, upto, total, self.costs, min(STEP, self.window))
        cuts = np.array(plan(places, penalty, self.window, self.costs))
        bounds = np.unique(np.concatenate([cuts, upto]))
        bounds = np.unique(np.concatenate([[0], bounds]))
        begin = bounds[:-1]
        document = np.searchsorted(upto, begin, side="right")
        window = np.searchsorted(cuts, begin, side="right") - 1
        return document, begin - (upto - sizes)[document], np.diff(bounds), window, begin - cuts[window]


def in_key_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) dealt out by ranges of the key and sorted within them.

    Repeats of one key are told apart by a hash of the text, so that they can
    lie in several ranges.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return narrow.repartitionByRange(parts, "key", "hash").sortWithinPartitions("key", "hash").drop("hash")


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 4096,
    end_id: int = 2,
    costs: Costs = Costs(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents, each in its window.

    Returns one row per piece: doc_id, start (ids of the document before it),
    length, ids (little-endian 32-bit), doc_tokens (with the end id),
    sequence_id and offset (place in the sequence). Null and empty texts are
    the end id alone. Repeated rows are packed once each; an empty table gives
    no piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.loaded(tokenizer)
        packer = Packer(sentence_ends(bpe.tokens), window, costs)
        end = np.uint16(end_id).tobytes()
        sequence = TaskContext.get().partitionId() << 33
        keys: list[pa.Array] = []
        held: list[bytes] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            sizes = np.array([len(x) // 2 for x in held], dtype=np.int64)
            ids = np.frombuffer(b"".join(held), dtype="<u2")
            document, start, length, number, offset = packer.pieces(ids, sizes)
            wide = ids.astype("<u4")
            stop = np.concatenate([[0], np.cumsum(length)]) * 4
            everything = wide.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(keys).take(pa.array(document)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([everything[a:b] for a, b in zip(stop.tolist(), stop[1:].tolist())], pa.binary()),
                    pa.array(sizes[document]),
                    pa.array(sequence + number),
                    pa.array(offset),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            sequence += int(number[-1]) + 1

        for batch in batches:
            for part in slices(batch):
                keys.append(part.column(0))
                for ids in bpe.encode(part.column(1).to_pylist()):
                    held.append(ids + end)
                    size += len(ids) // 2 + 1
                if size >= RUN:
                    yield from flush()
                    keys, held, size = [], [], 0
        if held:
            yield from flush()

    kind = docs.schema[key].dataType.simpleString()
    return in_key_order(docs, key, text).mapInArrow(
        run,
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
