"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs.

Every leaf of the tree belongs to a pair of neighbouring symbols and holds
``rank * leaves + position`` (or a constant above all of them if the pair has
no merge). Inner nodes hold minima, so the root is the leftmost pair of lowest
rank. A merge changes at most three leaves: the merged pair, its left
neighbour and the pair that vanished; each is repaired on the way to the root,
in logarithmic time. Merging stops when the root is the constant.

Words of up to 64 symbols run through the same tree many at a time, one tree
per row of a matrix; longer ones run alone.

A text is cut into words and the ids of a word are remembered. No token spans
white space; pieces with code points from U+0180 on go through the tokenizer
file's own normaliser and pre-tokeniser, so odd code points are treated as the
library treats them.
"""

from __future__ import annotations

import json
import re
import sys

import numpy as np
import pyarrow as pa

from rostermill.llm import wordscan
from rostermill.llm.wordscan import LETTER, OTHER, SINGLE, Alphabet, Letters, Words

#: words remembered per worker process before the memory is emptied
CACHE_WORDS = 800_000
#: words of more symbols run one at a time
VECTOR_SYMBOLS = 64
#: words per vectorised run, which bounds its matrices
VECTOR_WORDS = 8192

_BLANKS = "\t-\r \x85\xa0  -     　"
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ"
_DIGIT = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: words of lower-case text below U+0180, where every code point is its own NFC
_PLAIN_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_BLANKS}{_LETTER}{_DIGIT}]+"
)
_ODD = re.compile("[^\0-įı-ſ]")
_SPACE = re.compile(f"[{_BLANKS}]+")
_ONE = np.array([ord(c) for c in "stmd"])
_FIRST = np.array([ord(c) for c in "stmdrvl"])
#: starts the key of a special token; white space is in no word
_SPECIAL = " "

_LIMIT = 0x180
#: the blanks below the limit
_BLANK = "\t\n\v\f\r \x85\xa0"


def _plain_alphabet() -> Alphabet:
    kinds, lower = [], []
    for code in range(_LIMIT + 1):
        small = chr(code).lower()
        small = small if len(small) == 1 else chr(code)
        lower.append(ord(small))
        if small in _BLANK:
            kinds.append(wordscan.BLANK)
        elif re.match(f"[{_LETTER}]", small):
            kinds.append(LETTER)
        else:
            kinds.append(SINGLE if re.match(f"[{_DIGIT}]", small) else OTHER)
    return Alphabet(np.array(kinds), np.array(lower))


_PLAIN = _plain_alphabet()


def _contractions(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join a lone apostrophe with a following s, t, m, d, re, ve or ll.

    The tokenizer's pattern takes these first; what is left of the word is a
    word of its own.
    """
    codes, starts, lengths, bounds = words
    alone = np.flatnonzero((lengths == 1) & (codes[np.minimum(starts, len(codes) - 1)] == 39))
    alone = alone[alone + 1 < len(starts)]
    after = starts[alone] + 1
    alone = alone[(after == starts[alone + 1]) & np.isin(codes[after], _FIRST)]
    after = starts[alone] + 1
    first, second = codes[after], codes[np.minimum(after + 1, len(codes) - 1)]
    short = np.isin(first, _ONE)
    long = np.zeros(len(alone), dtype=bool)
    for a, b in ("re", "ve", "ll"):
        long |= (first == ord(a)) & (second == ord(b))
    long &= lengths[alone + 1] > 1
    hit = short | long
    if not hit.any():
        return starts, lengths, bounds
    alone, taken = alone[hit], np.where(short[hit], 1, 2)
    starts, lengths = starts.copy(), lengths.copy()
    lengths[alone] += taken
    starts[alone + 1] += taken
    lengths[alone + 1] -= taken
    keep = lengths > 0
    return starts[keep], lengths[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


#: letters of a word that is its own key, nine bits each
_SHORT = 7
_PACKED = (np.arange(_LIMIT + 1, dtype=np.uint64)[:, None] + np.uint64(1)) << np.arange(0, 9 * _SHORT, 9, dtype=np.uint64)
_PACKED = np.concatenate([_PACKED, np.zeros((_LIMIT + 1, 1), np.uint64)], axis=1).ravel()


def _word_keys(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key of each word, whether the key is the word itself).

    Words of up to ``_SHORT`` code points are packed into their key; that of a
    longer one is a hash with the highest bit set.
    """
    sure = lengths <= _SHORT
    first = np.cumsum(lengths) - lengths
    # a stretch is short, so places fit 32 bits
    sizes = lengths.astype(np.int32)
    within = np.arange(int(lengths.sum()), dtype=np.int32)
    where = within + np.repeat((starts - first).astype(np.int32), sizes)
    within -= np.repeat(first.astype(np.int32), sizes)
    np.minimum(within, _SHORT, out=within)
    within += codes[where].astype(np.int32) * np.int32(_SHORT + 1)
    key = np.add.reduceat(_PACKED[within], first)
    long = np.flatnonzero(~sure)
    if len(long):
        key[long] = wordscan.hashes(codes, starts[long], lengths[long]) | np.uint64(1 << 63)
    return key, sure


def _tree(leaves: list[int], none: int) -> tuple[list[int], int]:
    size = 1
    while size < len(leaves):
        size *= 2
    tree = [none] * size + leaves + [none] * (size - len(leaves))
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    return tree, size


class WordBpe:
    """Encoder and decoder for a word-end BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab: dict[str, int] = data["model"]["vocab"]
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        if size > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        self.tokens: list[str] = [""] * size
        for token, number in [*vocab.items(), *special.items()]:
            self.tokens[number] = token
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in data["model"]["merges"]]
        self.rank = {
            vocab[a] << 16 | vocab[b]: rank for rank, (a, b) in reversed([*enumerate(merges)])
        }
        self.merged = [vocab[a + b] for a, b in merges]
        self.none = len(merges)
        pairs = sorted(self.rank)
        self._pairs = np.array(pairs + [1 << 33], dtype=np.int64)
        self._ranks = np.array([self.rank[p] for p in pairs] + [self.none], dtype=np.int64)
        self._merged = np.array(self.merged + [0], dtype=np.int64)
        letters = _byte_letters()
        end = data["model"]["end_of_word_suffix"]
        self._inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self._last = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        self._byte_of = {c: b for b, c in enumerate(letters)}
        self._special = {_SPECIAL + s: np.uint16(n).tobytes() for s, n in special.items()}
        self._special_cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._library = None
        self._path = path
        #: by text, and short ones also by key
        self._words: dict[int | str, bytes] = dict(self._special)

    # -- one word ---------------------------------------------------------

    def symbols(self, word: bytes) -> list[int]:
        """Ids of the bytes; the last one carries the end of the word."""
        ids = self._inner[np.frombuffer(word, dtype=np.uint8)]
        ids[-1] = self._last[word[-1]]
        return ids.tolist()

    def merge_one(self, ids: list[int]) -> list[int]:
        """Merge the symbols of one word of any length."""
        n = len(ids)
        if n < 2:
            return list(ids)
        rank, none = self.rank, self.none
        ids = [*ids, -1]
        leaves = [rank.get(a << 16 | b, none) * n + i for i, (a, b) in enumerate(zip(ids, ids[1:n]))]
        top = none * n
        tree, size = _tree(leaves, top)
        before, after = list(range(-1, n)), list(range(1, n + 2))
        while tree[1] < top:
            r, i = divmod(tree[1], n)
            j = after[i]
            k = after[j]
            ids[i] = self.merged[r]
            ids[j] = -1
            after[i] = k
            if k < n:
                before[k] = i
            changed = [(j, top)] if j < n - 1 or size > j else []
            changed.append((i, rank.get(ids[i] << 16 | ids[k], none) * n + i if k < n else top))
            if before[i] >= 0:
                h = before[i]
                changed.append((h, rank.get(ids[h] << 16 | ids[i], none) * n + h))
            for leaf, value in changed:
                node = size + leaf
                tree[node] = value
                while node > 1:
                    node >>= 1
                    low = min(tree[2 * node], tree[2 * node + 1])
                    if tree[node] == low:
                        break
                    tree[node] = low
        return [x for x in ids[:n] if x >= 0]

    # -- many words -------------------------------------------------------

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 16 | right
        at = np.searchsorted(self._pairs, pair)
        return np.where(self._pairs[at] == pair, self._ranks[at], self.none)

    def _merge_many(self, words: list[bytes], width: int) -> list[bytes]:
        """Merge words of at most ``width`` bytes, one tree per row."""
        count = len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=count)
        inside = np.arange(width) < lengths[:, None]
        raw = np.zeros((count, width), dtype=np.uint8)
        raw[inside] = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = self._inner[raw]
        rows = np.arange(count)
        ids[rows, lengths - 1] = self._last[raw[rows, lengths - 1]]
        ids[~inside] = -1

        shift = width.bit_length() - 1
        top = self.none << shift
        position = np.arange(width)
        leaf = np.full((count, width), top, dtype=np.int64)
        if width > 1:
            pair = self._pair_rank(np.maximum(ids[:, :-1], 0), np.maximum(ids[:, 1:], 0))
            pair[~inside[:, 1:]] = self.none
            leaf[:, :-1] = np.where(pair < self.none, pair << shift | position[:-1], top)
        tree = np.full((count, 2 * width), top, dtype=np.int64)
        tree[:, width:] = leaf
        for level in range(shift - 1, -1, -1):
            start = 1 << level
            tree[:, start : 2 * start] = np.minimum(
                tree[:, 2 * start : 4 * start : 2], tree[:, 2 * start + 1 : 4 * start : 2]
            )
        before = np.broadcast_to(position - 1, (count, width)).copy()
        after = np.broadcast_to(position + 1, (count, width)).copy()

        active = rows[tree[:, 1] < top]
        while len(active):
            root = tree[active, 1]
            r, i = root >> shift, root & (width - 1)
            j = after[active, i]
            k = after[active, j]
            new = self._merged[r]
            ids[active, i] = new
            ids[active, j] = -1
            after[active, i] = k
            has_k = k < lengths[active]
            before[active[has_k], k[has_k]] = i[has_k]
            h = before[active, i]
            has_h = h >= 0
            right = np.full(len(active), top, dtype=np.int64)
            rank = self._pair_rank(new[has_k], ids[active[has_k], k[has_k]])
            right[has_k] = np.where(rank < self.none, rank << shift | i[has_k], top)
            rank = self._pair_rank(ids[active[has_h], h[has_h]], new[has_h])
            left = np.where(rank < self.none, rank << shift | h[has_h], top)
            who = np.concatenate([active, active, active[has_h]])
            node = np.concatenate([j, i, h[has_h]]) + width
            tree[who, node] = np.concatenate([np.full(len(active), top), right, left])
            for _ in range(shift):
                node = node >> 1
                tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
            active = active[tree[active, 1] < top]

        kept = ids >= 0
        flat = ids[kept].astype("<u2").tobytes()
        ends = np.cumsum(kept.sum(axis=1)) * 2
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of whole words, as little-endian 16-bit numbers."""
        out: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for at, word in enumerate(words):
            if len(word) > VECTOR_SYMBOLS:
                out[at] = np.array(self.merge_one(self.symbols(word)), dtype="<u2").tobytes()
            elif word:
                by_width.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(at)
        for width, places in by_width.items():
            for start in range(0, len(places), VECTOR_WORDS):
                part = places[start : start + VECTOR_WORDS]
                for at, ids in zip(part, self._merge_many([words[p] for p in part], width)):
                    out[at] = ids
        return out

    # -- texts ------------------------------------------------------------

    def _odd_words(self, piece: str) -> list[str]:
        """Words of a piece without white space, by the library's own rules."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
        text = self._library.normalizer.normalize_str(piece)
        byte_of = self._byte_of
        return [
            bytes([byte_of[c] for c in word]).decode()
            for word, _ in self._library.pre_tokenizer.pre_tokenize_str(text)
        ]

    def _split(self, text: str) -> list[str]:
        """Normalised words of a text; a special token is a word of its own."""
        if self._special_cut and "<|" in text:
            parts = self._special_cut.split(text)
            if len(parts) > 1:
                words = []
                for at, part in enumerate(parts):
                    words += [_SPECIAL + part] if at % 2 else self._split(part)
                return words
        if not _ODD.search(text):
            return _PLAIN_WORDS.findall(text.lower())
        words = []
        for piece in _SPACE.split(text):
            words += self._odd_words(piece) if _ODD.search(piece) else _PLAIN_WORDS.findall(piece.lower())
        return words

    def _by_words(self, text: str) -> bytes:
        words = self._split(text)
        new = [*{w for w in words if w not in self._words}]
        self._words.update(zip(new, self.encode_words([w.encode() for w in new])))
        return b"".join([self._words[w] for w in words])

    def _plain_group(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of plain code points, all words looked up together."""
        words = _PLAIN.scan(texts)
        codes = words.codes
        starts, lengths, bounds = _contractions(words)
        if not len(starts):
            return [b""] * len(texts)
        key, sure = _word_keys(codes, starts, lengths)
        keyed = pa.array(key).dictionary_encode()
        index = keyed.indices.to_numpy()
        distinct = keyed.dictionary.to_numpy()
        first = np.zeros(len(distinct), dtype=np.int64)
        first[index[::-1]] = np.arange(len(index))[::-1]
        # equal keys of long words only propose equal words
        long = np.flatnonzero(~sure)
        if len(long):
            like = np.zeros(len(key), dtype=np.int64)
            like[long] = np.arange(len(long))
            letters = Letters.of(codes, starts[long], lengths[long])
            if not wordscan.same_words(letters, lengths[long], like[first[index[long]]]):
                return [self._by_words(text) for text in texts]
        lower = codes.tobytes().decode("utf-32-le")

        def texts_of(at: list[int]) -> list[str]:
            rows = first[at]
            ends = (starts[rows] + lengths[rows]).tolist()
            return [lower[x:y] for x, y in zip(starts[rows].tolist(), ends)]

        # a short word is known by its key, a long one by its text
        known: dict[int | str, bytes] = self._words
        names: list[int | str] = distinct.tolist()
        at = np.flatnonzero(~sure[first]).tolist()
        for i, text in zip(at, texts_of(at)):
            names[i] = text
        # one look at each word: most are remembered, and the memory is large
        parts = list(map(known.get, names))
        if None in parts:
            new = [i for i, part in enumerate(parts) if part is None]
            for i, ids in zip(new, self.encode_words([t.encode() for t in texts_of(new)])):
                known[names[i]] = parts[i] = ids
        pool = np.frombuffer(b"".join(parts), dtype="<u2")
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) >> 1
        begin = np.cumsum(sizes) - sizes
        count = sizes[index]
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = pool[np.repeat(begin[index] - upto[:-1], count) + np.arange(upto[-1])].tobytes()
        cut = (upto[bounds] * 2).tolist()
        return [ids[a:b] for a, b in zip(cut, cut[1:])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, little-endian 16-bit; nothing for null or ''."""
        if len(self._words) > CACHE_WORDS:
            self._words = dict(self._special)
        out: list[list[bytes]] = [[] for _ in texts]
        plain: list[str] = []
        places: list[int] = []
        for at, text in enumerate(texts):
            if not text:
                continue
            if not text.isascii() and _ODD.search(text) or self._special_cut and self._special_cut.search(text):
                out[at].append(self._by_words(text))
            else:
                plain.append(text)
                places.append(at)
        for group, numbers in wordscan.stretches(plain, _BLANK):
            if len(self._words) > CACHE_WORDS:
                self._words = dict(self._special)
            for number, ids in zip(numbers, self._plain_group(group)):
                out[places[number]].append(ids)
        return [b"".join(parts) for parts in out]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space; the file names no decoder."""
        tokens = self.tokens
        return " ".join([tokens[n] for n in np.frombuffer(ids, dtype="<u2").tolist()])


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the code
    points from 256 on, in order.
    """
    letters, spare = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


def wide(ids: bytes) -> bytes:
    """16-bit ids as little-endian 32-bit ones."""
    return np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """One encoder per worker process and file."""
    if path not in _LOADED:
        _LOADED[sys.intern(path)] = WordBpe(path)
    return _LOADED[path]
