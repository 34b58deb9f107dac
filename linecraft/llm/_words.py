"""Words of whole texts as 64-bit hashes, computed on the Arrow buffers.

A word alphabet is a set of UTF-8 bytes. Both alphabets used here contain
every byte of a non-ASCII character, so cutting bytes cuts whole characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_K1, _K2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _K1
        x = (x ^ (x >> np.uint64(27))) * _K2
        return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 40)) * _GOLD)


def alphabet(pattern: str) -> np.ndarray:
    """Bytes for which the character class ``pattern`` holds; ASCII is tested,
    every other byte belongs to words."""
    import re

    own = np.ones(256, dtype=bool)
    own[:128] = [re.fullmatch(pattern, chr(i)) is not None for i in range(128)]
    return own


#: Bytes that are hashed at once.
RUN = 4 << 20
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
BYTE_CODES = numbers(256, 1)


class Words:
    """Words of a run of texts: ``hashes`` in order; text ``i`` has
    ``hashes[first[i]:first[i + 1]]``; ``starts`` are byte positions in the run.
    ``stems``: hashes of the words' first bytes, 0 for words that are no longer."""

    __slots__ = ("hashes", "first", "starts", "stems")

    def __init__(self, hashes, first, starts, stems=None):
        self.hashes, self.first, self.starts, self.stems = hashes, first, starts, stems


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the n + 1 offsets of its texts."""
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_string(texts.type):
        kind = np.int32
    else:
        texts, kind = texts.cast(pa.large_string()), np.int64
    _, off, data = texts.buffers()
    off = np.frombuffer(off, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(texts: pa.Array, most: int):
    """Cut an array of texts into runs of about ``most`` bytes, whole texts each:
    pairs (first index, sub-array)."""
    _, off = buffers(texts)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, texts.slice(i, j - i)
        i = j


def _runs(data: np.ndarray, own: np.ndarray, most: int):
    """Cut bytes into runs of about ``most``, each cut before a byte that is in
    no word: pairs (begin, end). A word of more bytes stays in one run."""
    begin = 0
    while begin < len(data):
        end = min(begin + most, len(data))
        while end < len(data):
            gap = np.flatnonzero(~own[FOLD[data[end : end + 65536]]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 65536, len(data))
        yield begin, end
        begin = end


def words_of(texts: pa.Array, own: np.ndarray, stem: int = 0) -> Words:
    """Lower-case A-Z and hash each maximal run of ``own`` bytes; with ``stem``,
    also its first ``stem`` bytes.

    Bytes are taken ``RUN`` at a time, however long a text is: beyond its words
    (8 bytes each for hash and place) a text of any length needs no more.
    """
    data, off = buffers(texts)
    heads = off[:-1]
    got = []
    for begin, end in _runs(data, own, RUN):
        at = heads[np.searchsorted(heads, begin) : np.searchsorted(heads, end)]
        starts, hashes, stems = _run_words(data[begin:end], at - begin, own, stem)
        starts += begin
        got.append((starts, hashes, stems))
    if not got:
        none = np.zeros(0, np.uint64)
        return Words(none, np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), none)
    starts, hashes, stems = got[0] if len(got) == 1 else (np.concatenate(x) for x in zip(*got, strict=True))
    return Words(hashes, np.searchsorted(starts, off), starts, stems if stem or not len(hashes) else None)


def _run_words(data: np.ndarray, heads: np.ndarray, own: np.ndarray, stem: int):
    """Starts, hashes and stems (none without ``stem``) of the words of a run of
    bytes; ``heads``: where texts begin in it."""
    n = len(data)
    none = np.zeros(0, np.uint64)
    low = FOLD[data]
    inside = own[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    if len(starts) == 0:
        return starts, none, none
    place = np.arange(n, dtype=np.int64)
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, n)))
    place[: starts[0]] = 0
    codes = np.where(inside, BYTE_CODES[low], np.uint64(0))
    with np.errstate(over="ignore"):
        codes *= numbers(int(place.max()) + 1, 2)[place]
        hashes, stems = mix(np.add.reduceat(codes, starts)), none
        if stem:
            beyond = np.add.reduceat((place >= stem) & inside, starts) > 0
            stems = mix(np.add.reduceat(np.where(place < stem, codes, np.uint64(0)), starts) + np.uint64(stem))
            stems = np.where(beyond, stems, np.uint64(0))
        return starts, hashes, stems


def shingles_of(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles of each text, as sorted hashes.

    A text of fewer words, but not none, has its whole word sequence as one
    shingle. Returns (hashes, first): text ``i`` has
    ``hashes[first[i]:first[i + 1]]``, ascending.
    """
    texts = len(w.first) - 1
    if texts == 1 and len(w.hashes) > RUN // 8:
        h = _shingles_of_one(w.hashes, size)
        return h, np.array([0, len(h)])
    count = np.diff(w.first)
    made = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    total = int(made.sum())
    ends = np.cumsum(made)
    owner = np.repeat(np.arange(texts), made)
    at = np.arange(total) - np.repeat(ends - made, made) + w.first[:-1][owner]
    h = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            there = at + j < w.first[1:][owner]
            part = w.hashes[np.minimum(at + j, max(len(w.hashes) - 1, 0))] if total else h
            h = np.where(there, mix(h * _K1 + part + np.uint64(j + 1)), h)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(total, bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(texts + 1))


def _shingles_of_one(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of a text of many words, made and reduced in parts."""
    found = np.zeros(0, np.uint64)
    step = RUN // 8
    parts, held = [], 0
    for low in range(0, max(len(words) - size, 0) + 1, step):
        most = min(low + step, max(len(words) - size, 0) + 1)
        h = np.zeros(most - low, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(min(size, len(words))):
                h = mix(h * _K1 + words[low + j : most + j] + np.uint64(j + 1))
        parts.append(np.unique(h))
        held += len(parts[-1])
        # merged when the parts have grown as large as what is kept
        if held > max(len(found), 4 * step) or most > len(words) - size:
            found = np.unique(np.concatenate([found, *parts]))
            parts, held = [], 0
    return found
