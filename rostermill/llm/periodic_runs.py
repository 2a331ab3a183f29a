"""Runs of repeated words: a dictionary of basic factors, level by level.

A run is a stretch of words with smallest period q, at least ``copies`` times
as long as q and at least ``least`` words, that no neighbouring word extends.

1. Level k names every factor of 2^k words: equal names, equal words. A name
   of level k + 1 is the pair of names of its two halves, so names are exact
   and no hash is involved. A factor that occurs once in its text is dropped,
   for no longer factor from there can occur twice; ordinary prose is done
   after a few levels.
2. The next occurrence of a factor no further than its own length (both lie
   within twice that length) overlaps or touches it. Such occurrences form
   arithmetic progressions, and their difference is a period. Neighbouring
   starts with one difference d propose the stretch they cover, with period d.
   A period is proposed at the level of the first 2^k that is not below it.
3. Proposals are extended to both sides while words d apart are equal, and
   equal proposals become one.

Several texts are worked on at a time, as one array; the names of level 0
contain the text's number, so no factor reaches over an end. Rows never meet:
there is no shuffle, and memory is bounded by ``WORDS`` or by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: words worked on at once; a text that is longer goes alone
WORDS = 400_000


@dataclass(frozen=True)
class Runs:
    """What counts as a run."""

    #: length in words and in periods, at least
    least: int = 6
    copies: int = 4


def _names(keys: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name of each position or -1, position, next position of that name or -1).

    ``keys`` belong to the ascending positions ``at``; a key that occurs once
    gets no name.
    """
    order = np.argsort(keys, kind="stable")
    sorted_keys, places = keys[order], at[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    more = np.zeros(len(keys), dtype=bool)
    more[1:] = same
    more[:-1] |= same
    following = np.full(len(keys), -1, dtype=np.int64)
    following[:-1][same] = places[1:][same]
    number = np.cumsum(np.concatenate([[True], ~same])) if len(keys) else np.zeros(0, np.int64)
    name = np.full(size, -1, dtype=np.int64)
    name[places[more]] = number[more]
    back = np.argsort(places[more], kind="stable")
    return name, places[more][back], following[more][back]


def _extend(words: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Move starts and ends outwards while words a period apart are equal.

    ``words`` are told apart by text, so a step over a text's end never fits.
    """
    start, end = start.copy(), end.copy()
    live = np.arange(len(start))
    while len(live):
        live = live[start[live] > 0]
        left = start[live] - 1
        live = live[(words[left] == words[left + period[live]]) & (text[left] == text[left + period[live]])]
        start[live] -= 1
    live = np.arange(len(end))
    while len(live):
        live = live[end[live] < len(words)]
        right = end[live]
        live = live[(words[right] == words[right - period[live]]) & (text[right] == text[right - period[live]])]
        end[live] += 1
    return start, end


def find(words: np.ndarray, text: np.ndarray, rule: Runs = Runs()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period.

    ``words`` holds word numbers of texts one after another, ``text`` the
    number of each word's text.
    """
    size = len(words)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    name, at, following = _names((text.astype(np.int64) << 32) | words.astype(np.int64), np.arange(size), size)
    longest = int(np.bincount(text).max()) if size else 0
    width = 1
    while len(at):
        gap = following - at
        near = (following >= 0) & (gap <= width) & (gap > width // 2)
        start, step = at[near], gap[near]
        first = np.ones(len(start), dtype=bool)
        first[1:] = (start[1:] != start[:-1] + 1) | (step[1:] != step[:-1])
        heads = np.flatnonzero(first)
        if len(heads):
            last = np.append(heads[1:], len(start)) - 1
            found.append((start[heads], start[last] + step[heads] + width, step[heads]))
        if width * rule.copies >= 2 * longest:
            break
        inside = at[at + width < size]
        inside = inside[(name[inside] >= 0) & (name[inside + width] >= 0)]
        name, at, following = _names(name[inside] * (size + 1) + name[inside + width], inside, size)
        width *= 2
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, end, period = (np.concatenate(x) for x in zip(*found))
    start, end = _extend(words, text, start, end, period)
    long = end - start >= np.maximum(rule.least, rule.copies * period)
    rows = np.unique(np.stack([start[long], period[long], end[long] - start[long]], axis=1), axis=0)
    return rows[:, 0], rows[:, 2], rows[:, 1]


def repeated(size: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``size`` words lie in a run after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) > 0


def _groups(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """Words of consecutive texts, about WORDS at a time."""
    group: list[list[bytes]] = []
    held = 0
    for text in texts:
        # bytes are split at exactly the six ASCII blanks
        words = (text or b"").split()
        if group and held + len(words) > WORDS:
            yield group
            group, held = [], 0
        group.append(words)
        held += len(words)
    if group:
        yield group


def _analyse(group: list[list[bytes]], rule: Runs) -> Iterator[tuple[int, list[dict], bytes]]:
    sizes = np.fromiter(map(len, group), np.int64, len(group))
    ends = np.cumsum(sizes)
    numbers: dict[bytes, int] = {}
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for one in group for w in one), np.int64, int(ends[-1]))
    text = np.repeat(np.arange(len(group)), sizes)
    start, length, period = find(words, text, rule)
    gone = repeated(len(words), start, length, period)
    bounds = np.searchsorted(start, np.concatenate([[0], ends]))
    for i, one in enumerate(group):
        low, high, base = bounds[i], bounds[i + 1], int(ends[i] - sizes[i])
        if low == high:
            yield len(one), [], b" ".join(one)
            continue
        runs = [
            {"start": int(s) - base, "length": int(n), "period": int(p)}
            for s, n, p in zip(start[low:high], length[low:high], period[low:high])
        ]
        drop = gone[base : int(ends[i])]
        yield len(one), runs, b" ".join([w for w, d in zip(one, drop) if not d])


def periodic_runs(
    docs: DataFrame, rule: Runs = Runs(), text: str = "text", key: str = "doc_id", batch: int = 200
) -> DataFrame:
    """Runs of every text and the text without their repetitions.

    Returns one row per input row: ``key``, ``n_words``, ``runs`` (start,
    length and period in words, by start and period) and ``collapsed`` (the
    words left, joined by a space). A word goes if any run holds it after that
    run's first period. Words are stretches between the blanks U+0020 and
    U+0009 to U+000D. A null, empty or blank text has no words, no runs and an
    empty collapsed text. Rows are independent: null or repeated keys and
    repeated texts give one row each, further columns are ignored, and an empty
    table gives an empty result. ``batch`` is the number of texts that are
    Python objects at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, batch):
                part = whole.slice(low, batch)
                counts, runs, left = [], [], []
                for group in _groups(part.column(1).cast(pa.binary()).to_pylist()):
                    for n, found, kept in _analyse(group, rule):
                        counts.append(n)
                        runs.append(found)
                        left.append(kept)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    names=["key", "n_words", "runs", "collapsed"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    ).withColumnRenamed("key", key)


def longest(runs: str):
    """The longest run of a list (ties: smallest start, then period), or null."""
    best = F.array_sort(F.transform(runs, lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"])))
    return F.try_element_at(best, F.lit(1))
