"""Words of many texts at once, as positions and 64-bit hashes in numpy.

A table gives the kind of each code point: blank, part of a run of its kind,
or a word of its own. Everything is array arithmetic over the code points of
a bounded stretch of texts; there is no loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

BLANK, LETTER, SINGLE, OTHER = 0, 1, 2, 3
#: code points scanned at once; a longer text is cut at a blank
STRETCH = 400_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """Words of a stretch; ``bounds[i]:bounds[i+1]`` are those of text i."""

    codes: np.ndarray  # lower-cased code points
    starts: np.ndarray
    lengths: np.ndarray
    bounds: np.ndarray


class Alphabet:
    """Kinds and lower-case forms of the code points below a limit.

    Code points from the limit on are of the kind of the last entry and keep
    their form.
    """

    def __init__(self, kinds: np.ndarray, lower: np.ndarray):
        self.kinds = kinds.astype(np.uint8)
        self.lower = lower.astype(np.uint32)
        # the same as tables of bytes, for texts in Latin-1
        latin = np.arange(256)
        few = np.minimum(latin, len(self.kinds) - 1)
        small = np.where(few < len(self.kinds) - 1, self.lower[few], latin)
        self._latin = (self.kinds[few].tobytes(), small.astype(np.uint8).tobytes()) if small.max() < 256 else None

    @classmethod
    def of(cls, limit: int, blank: str, upper_to_lower: dict[str, str]) -> Alphabet:
        """Runs of anything but ``blank``."""
        kinds = np.full(limit + 1, OTHER)
        kinds[[ord(c) for c in blank]] = BLANK
        lower = np.arange(limit + 1)
        for a, b in upper_to_lower.items():
            lower[ord(a)] = ord(b)
        return cls(kinds, lower)

    def _codes_and_kinds(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        if self._latin:
            try:
                raw = joined.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                kinds, lower = (np.frombuffer(raw.translate(t), dtype=np.uint8) for t in self._latin)
                return lower.astype(np.uint32), kinds
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        limit = len(self.kinds) - 1
        index = np.minimum(codes, limit)
        return np.where(index < limit, self.lower[index], codes), self.kinds[index]

    def scan(self, texts: list[str]) -> Words:
        joined = "\n".join(texts) + "\n"
        codes, kind = self._codes_and_kinds(joined)
        begins = np.empty(len(kind), dtype=bool)
        begins[0] = True
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == SINGLE
        begins &= kind != BLANK
        starts = np.flatnonzero(begins)
        ends = np.empty(len(kind), dtype=bool)
        np.not_equal(kind[1:], kind[:-1], out=ends[:-1])
        ends[-1] = True
        ends |= kind == SINGLE
        ends &= kind != BLANK
        lengths = np.flatnonzero(ends) + 1 - starts
        sizes = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
        bounds = np.searchsorted(starts, np.concatenate([[0], sizes]))
        return Words(codes, starts, lengths, bounds)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Letters(NamedTuple):
    """Code points of words, one word after another."""

    codes: np.ndarray
    #: place of each in its word, and of each word's first
    within: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Letters:
        first = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum()))
        where = within + np.repeat(starts - first, lengths)
        within -= np.repeat(first, lengths)
        return cls(codes[where], within, first)


def _scrambled(codes: np.ndarray, within: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) + (within.astype(np.uint64) + np.uint64(1)) * _STEP)


#: scrambled numbers of the first code points at the first places
_FEW_CODES, _FEW_PLACES = 384, 32
_SCRAMBLED = _scrambled(
    np.repeat(np.arange(_FEW_CODES), _FEW_PLACES), np.tile(np.arange(_FEW_PLACES), _FEW_CODES)
)


def hashes(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: the sum of a scrambled number for each code
    point at its place.

    Scrambling comes before the sum, so the numbers of different (code point,
    place) pairs have nothing in common that words could be built to exploit,
    as they can be for a polynomial modulo 2^64.
    """
    return hashes_of(Letters.of(codes, starts, lengths), lengths)


def hashes_of(letters: Letters, lengths: np.ndarray) -> np.ndarray:
    if not len(lengths):
        return np.zeros(0, dtype=np.uint64)
    codes, within, first = letters
    at = codes.astype(np.int64) * _FEW_PLACES + within
    far = (within >= _FEW_PLACES) | (codes >= _FEW_CODES)
    some = bool(far.any())
    if some:
        at[far] = 0
    value = _SCRAMBLED[at]
    if some:
        value[far] = _scrambled(codes[far], within[far])
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def same_words(letters: Letters, lengths: np.ndarray, like: np.ndarray) -> bool:
    """Whether each word equals, code point for code point, word ``like`` of it."""
    if not (lengths == lengths[like]).all():
        return False
    other = letters.within + np.repeat(letters.first[like], lengths)
    return bool((letters.codes == letters.codes[other]).all())


def stretches(texts: list[str], blank: str) -> Iterator[tuple[list[str], list[int]]]:
    """Texts in groups of about STRETCH code points, with their numbers.

    A text longer than that comes in parts, cut at blanks (or whole, if it has
    no blank there).
    """
    group: list[str] = []
    numbers: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        for part in _parts(text, blank) if len(text) > STRETCH else (text,):
            group.append(part)
            numbers.append(number)
            size += len(part)
            if size >= STRETCH:
                yield group, numbers
                group, numbers, size = [], [], 0
    if group:
        yield group, numbers


def _parts(text: str, blank: str) -> Iterator[str]:
    start = 0
    while len(text) - start > STRETCH:
        cut = max(text.rfind(c, start + 1, start + STRETCH) for c in blank)
        if cut < 0:
            found = [p for p in (text.find(c, start + STRETCH) for c in blank) if p >= 0]
            if not found:
                break
            cut = min(found)
        yield text[start:cut]
        start = cut
    yield text[start:]
