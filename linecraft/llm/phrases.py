"""Phrase collocation mining over truncated suffix trees, cut up vertically.

Texts are lower-cased (A-Z), split at ``[.,;:!?`` and line breaks ``]`` into
pieces and those into words; all counts are per ``lang`` (null: ``und``). The
tree of all suffixes of all pieces, truncated to three words, is never held as
a whole. In the manner of ERA it is built in vertical partitions:

1. One scan counts the prefixes: words exactly, two-word prefixes in counters
   that may only be too high (a 32-bit hash of the prefix).
2. Word prefixes are grouped so that the suffixes of a group stay within a
   memory budget; a word with more suffixes than an eighth of the budget is
   extended to its two-word prefixes first, which are dealt out like words.
3. A second scan emits, for each group, the truncated suffixes whose two-word
   prefix may reach the least count. Each task sends a suffix once, with its
   number. Each group then builds its own subtree by sorting, and reads all
   counts from its leaf totals.

Words travel as 64-bit hashes that include the language. The words themselves
are kept with their counts; two words of one hash are found, and the scan is
run again with another seed, so counts are exact. Memory of a task: one window
of text (``WINDOW`` bytes; a longer text is cut at separators, with the words
that follow the cut as lookahead) and one group. A single word longer than a
window is held whole.

The set of frequent two-word prefixes travels as a bitmap of fixed size (8 MB):
in a corpus far beyond it more suffixes pass the second scan; counts stay
exact, since every node's total is counted again from leaves.

Null and empty texts have no words. Rows are independent, so repeated rows
count again; ``doc_id`` is not read, nor are extra columns. An empty table gives
no phrases. Ties are broken by phrase in byte order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import release, stored, tidy
from ._words import _K1, FOLD, buffers, mix

#: Least count of a phrase, words of a phrase, phrases returned per language.
LEAST, MOST_WORDS, TOP = 10, 3, 2000
#: Percent of a phrase's occurrences inside a longer candidate that drop it.
INSIDE = 50
#: Bytes of text handled together; suffixes of a group; distinct suffixes a
#: task gathers before it sends them on.
WINDOW, BUDGET, GATHER = 1 << 20, 1 << 20, 1 << 20
#: Two-word prefixes: bits of their hash, of its ranges, and of the bitmap.
HASH_BITS, RANGE_BITS, MAP_BITS = 32, 10, 26
#: Slots that prefixes are dealt to before slots are packed into groups.
LEAST_SLOT_BITS, MOST_SLOT_BITS = 12, 22
#: At most 2 ** HEAVY_BITS words are extended.
HEAVY_BITS = 20
#: Ranking is done in this many parts per language before the last one.
RANK_PARTS = 64
_SEEDS = 4

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(_BREAKS)] = True
_OWN = ~_IS_BREAK
_OWN[[32, 9]] = False


# --- words of windows --------------------------------------------------------


def windows(texts: pa.Array, most: int = WINDOW):
    """Cut texts into windows (bytes, offsets, first text, core).

    Suffixes that begin before ``core`` belong to the window; what follows is
    lookahead of up to two words. Only texts longer than ``most`` are cut.
    """
    data, off = buffers(texts)
    i, n = 0, len(texts)
    while i < n:
        if off[i + 1] - off[i] <= most:
            j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
            yield data[off[i] : off[j]], off[i : j + 1] - off[i], i, int(off[j] - off[i])
            i = j
            continue
        at, end = int(off[i]), int(off[i + 1])
        while at < end:
            core = _cut(data, at, end, most)
            stop = _ahead(data, core, end)
            yield data[at:stop], np.array([0, stop - at]), i, core - at
            at = core
        i += 1


def _cut(data, at, end, most):
    """Place after the last separator within ``most`` bytes, else after the next."""
    if end - at <= most:
        return end
    found = np.flatnonzero(~_OWN[data[at : at + most]])
    if len(found):
        return at + int(found[-1]) + 1
    place = at + most
    while place < end:
        found = np.flatnonzero(~_OWN[data[place : place + most]])
        if len(found):
            return place + int(found[0]) + 1
        place += most
    return end


def _ahead(data, core, end):
    """End of the two words that follow ``core`` in its piece."""
    size = 256
    while core < end:
        part = data[core : min(end, core + size)]
        breaks = np.flatnonzero(_IS_BREAK[part])
        inside = _OWN[part]
        starts = np.flatnonzero(inside & np.append(True, ~inside[:-1]))
        stops = ([int(breaks[0])] if len(breaks) else []) + ([int(starts[2])] if len(starts) > 2 else [])
        if stops:
            return core + min(stops)
        if core + size >= end:
            break
        size *= 4
    return end


def tokens(data: np.ndarray, off: np.ndarray, seed: int):
    """Words of a window: (hashes, starts, ends, text of each, whether the next
    word follows in the same piece, lower-cased bytes)."""
    n = len(data)
    low = np.zeros(n + 8, np.uint8)
    low[:n] = FOLD[data]
    inside = _OWN[low[:n]]
    heads = off[1:-1]
    heads = heads[(heads > 0) & (heads < n)]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[heads] = inside[heads]
    last[heads - 1] = inside[heads - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    owner = np.searchsorted(off, starts, side="right") - 1
    piece = np.cumsum(_IS_BREAK[low[:n]], dtype=np.int64)[starts]
    linked = np.zeros(len(starts), bool)
    linked[:-1] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
    size = ends - starts
    with np.errstate(over="ignore"):
        h = mix(size.astype(np.uint64) + np.uint64(seed) * _K1)
        eight = np.ndarray((n + 1,), "<u8", low, strides=(1,))
        at = np.flatnonzero(size <= 64)
        done = 0
        while len(at):
            left = np.minimum(size[at] - done, 8).astype(np.uint64)
            chunk = eight[starts[at] + done] & (~np.uint64(0) >> (np.uint64(64) - left * np.uint64(8)))
            h[at] = mix(h[at] * _K1 + chunk)
            done += 8
            at = at[size[at] > done]
    for k in np.flatnonzero(size > 64):
        word = low[starts[k] : ends[k]].tobytes()
        h[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return h, starts, ends, owner, linked, low


def _lang_codes(langs: list[str]) -> np.ndarray:
    def code(x):
        return int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")

    known = {x: code(x) for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def _keyed(h, owner, first, codes):
    """Hashes that include the language; never 0, which ends a suffix."""
    with np.errstate(over="ignore"):
        h = mix(h ^ codes[first + owner])
    h[h == 0] = 1
    return h


def _pairs(h):
    """32-bit hashes of the two-word prefixes that begin at each word but the last."""
    with np.errstate(over="ignore"):
        return (mix(h[:-1] * _K1 + h[1:]) >> np.uint64(64 - HASH_BITS)).astype(np.uint32)


def _batch(b):
    """(texts, languages, their codes) of a batch of rows."""
    langs = ["und" if x is None else x for x in b["lang"].to_pylist()]
    return b["text"], langs, _lang_codes(langs)


# --- first scan: prefixes ----------------------------------------------------

_SCAN = "kind int, key bigint, lang string, word string, n bigint, pairs binary"
_SCAN_TYPES = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]


def _rows(kind, key, lang=None, word=None, n=None, pairs=None):
    cols = [pa.array(np.full(len(key), kind, np.int32)), pa.array(key, pa.int64()), lang, word, n, pairs]
    cols = [pa.nulls(len(key), t) if c is None else pa.array(c, t) for c, t in zip(cols, _SCAN_TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in _SCAN.split(", ")])


def _differ(starts, size, low, rep):
    """Words (by index) that are not the same bytes as their representative."""
    n = len(low) - 8
    eight = np.ndarray((n + 1,), "<u8", low, strides=(1,))
    bad = size != size[rep]
    at, done = np.flatnonzero(~bad & (rep != np.arange(len(rep))) & (size <= 64)), 0
    while len(at):
        left = np.minimum(size[at] - done, 8).astype(np.uint64)
        mask = ~np.uint64(0) >> (np.uint64(64) - left * np.uint64(8))
        bad[at] |= (eight[starts[at] + done] & mask) != (eight[starts[rep[at]] + done] & mask)
        done += 8
        at = at[size[at] > done]
    for k in np.flatnonzero(~bad & (size > 64)):
        x, y, z = starts[k], starts[rep[k]], size[k]
        bad[k] = bool((low[x : x + z] != low[y : y + z]).any())
    return np.flatnonzero(bad)


class _WordCounts:
    """Words of one task by hash, with their numbers. Other words of a hash
    stay beside it, so that the clash is seen."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, h, starts, ends, low, langs, codes):
        u, at, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        size, rep = ends - starts, at[back]
        other = np.union1d(_differ(starts, size, low, rep), np.flatnonzero(codes != codes[rep]))
        if len(other):
            u, at, n = np.append(u, h[other]), np.append(at, other), np.append(n, np.ones_like(other))
        s, size = starts[at], size[at]
        off = np.zeros(len(u) + 1, np.int32)
        np.cumsum(size, out=off[1:])
        place = np.arange(off[-1]) + np.repeat(s - off[:-1], size)
        words = pa.StringArray.from_buffers(len(u), pa.py_buffer(off), pa.py_buffer(low[place]))
        self.parts.append((u, n, words, langs[at]))
        self.size += len(u)

    def take(self):
        h, n, langs = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1, 3))
        words = pa.concat_arrays([p[2] for p in self.parts])
        u, at, back = np.unique(h, return_index=True, return_inverse=True)
        rep = at[back]
        other = np.asarray(pc.not_equal(words, words.take(pa.array(rep)))) | (langs != langs[rep])
        n = np.bincount(back, n.astype(float)).astype(np.int64)
        other = np.flatnonzero(other)
        h, at, n = np.append(u, h[other]), np.append(at, other), np.append(n, np.ones_like(other))
        words, langs = words.take(pa.array(at)), langs[at]
        self.parts, self.size = [], 0
        for i in range(0, len(h), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield _rows(0, h[part].view(np.int64), langs[part].tolist(), words[i : i + (1 << 16)], n[part])


def _packed_pairs(pairs: list[np.ndarray], least: int):
    """Rows of one task's prefix counts: a row per range of hashes."""
    h = np.sort(np.concatenate(pairs))
    new = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    n = np.minimum(np.diff(np.append(new, len(h))), least).astype(np.uint8)
    h = h[new]
    low_bits = HASH_BITS - RANGE_BITS
    parts = np.searchsorted(h >> np.uint32(low_bits), np.arange((1 << RANGE_BITS) + 1))
    keys, blobs = [], []
    for k in np.flatnonzero(np.diff(parts)):
        own = slice(parts[k], parts[k + 1])
        step = np.diff(h[own] & np.uint32((1 << low_bits) - 1), prepend=np.uint32(0))
        kind = np.uint16 if step.max() < 1 << 16 else np.uint32
        keys.append(int(k))
        blobs.append(bytes([kind().itemsize]) + n[own].tobytes() + step.astype(kind).tobytes())
    for i in range(0, len(keys), 256):
        yield _rows(1, keys[i : i + 256], pairs=blobs[i : i + 256])


def _prefix_scan(seed: int, least: int):
    def scan(batches):
        words, pairs, held = _WordCounts(), [], 0
        for b in batches:
            texts, langs, codes = _batch(b)
            names = np.array(langs, object)
            for data, off, first, core in windows(texts):
                h, starts, ends, owner, linked, low = tokens(data, off, seed)
                own = int(np.searchsorted(starts, core))
                if own == 0:
                    continue
                h = _keyed(h, owner, first, codes)
                of = first + owner[:own]
                words.add(h[:own], starts[:own], ends[:own], low, names[of], codes[of])
                found = _pairs(h)[: own][linked[:-1][:own]]
                pairs.append(found)
                held += len(found)
                if words.size > GATHER:
                    yield from words.take()
                if held > 4 * GATHER:
                    yield from _packed_pairs(pairs, least)
                    pairs, held = [], 0
        if words.parts:
            yield from words.take()
        if held:
            yield from _packed_pairs(pairs, least)

    return scan


def _frequent_prefixes(least: int):
    """Rows of a task by range: bits of the ranges' prefixes that may have
    ``least`` occurrences."""
    low_bits, map_bits = HASH_BITS - RANGE_BITS, MAP_BITS - RANGE_BITS

    def bits(key, counts):
        hit = np.zeros(1 << map_bits, bool)
        hit[np.flatnonzero(counts >= least) >> (low_bits - map_bits)] = True
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.int64()), pa.array([np.packbits(hit).tobytes()], pa.binary())], ["key", "bits"]
        )

    def mark(batches):
        here, counts = None, np.zeros(1 << low_bits, np.uint8)
        for b in batches:
            for key, blob in zip(b["key"].to_pylist(), b["pairs"].to_pylist(), strict=True):
                if key != here:
                    if here is not None:
                        yield bits(here, counts)
                    here = key
                    counts[:] = 0
                width = blob[0]
                size = (len(blob) - 1) // (1 + width)
                n = np.frombuffer(blob, np.uint8, size, 1)
                at = np.cumsum(np.frombuffer(blob, f"<u{width}", size, 1 + size), dtype=np.int64)
                counts[at] = np.minimum(counts[at].astype(np.int64) + n, least)
        if here is not None:
            yield bits(here, counts)

    return mark


# --- groups of prefixes ------------------------------------------------------


def packed(loads: np.ndarray, budget: int) -> np.ndarray:
    """Group of each slot: slots by falling load, a new group where the next
    slot would pass the budget."""
    out, group, held = np.zeros(loads.size, np.int64), 0, 0.0
    for slot in np.argsort(-loads, kind="stable"):
        if held and held + loads[slot] > budget:
            group, held = group + 1, 0.0
        out[slot] = group
        held += loads[slot]
    return out


def group_of(first, second, group: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Groups of suffixes by their first words: words are dealt to slots by the
    first bits of their hash; those in ``heavy`` by their first two words."""
    prefix = first.copy()
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, first), len(heavy) - 1)
        long = heavy[at] == first
        with np.errstate(over="ignore"):
            prefix[long] = mix(first[long] * _K1 + second[long])
    bits = int(group.size).bit_length() - 1
    return group[(prefix >> np.uint64(64 - bits)).astype(np.int64)]


def _groups(words: DataFrame, total: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """(group of each slot, words to extend) for the suffixes of ``words`` (key,
    f); a word's number bounds the suffixes that begin with it. The driver sees
    at most 2 ** MOST_SLOT_BITS slots and 2 ** HEAVY_BITS words."""
    wanted = max(1, -(-16 * total // budget)).bit_length()
    bits = min(MOST_SLOT_BITS, max(LEAST_SLOT_BITS, wanted))
    limit = max(budget // 8, total >> HEAVY_BITS)
    heavy = words.where(F.col("f") > limit).select("key", "f").collect()
    light = words.where(F.col("f") <= limit)
    slot = F.shiftrightunsigned("key", 64 - bits)
    loads = np.full(1 << bits, sum(r["f"] for r in heavy) / (1 << bits))
    for r in light.groupBy(slot.alias("slot")).agg(F.sum("f").alias("f")).collect():
        loads[r["slot"]] += r["f"]
    return packed(loads, budget), np.sort(np.array([r["key"] for r in heavy], np.int64).view(np.uint64))


# --- second scan: subtrees ---------------------------------------------------

_TYPE = np.dtype([("a", "<u8"), ("b", "<u8"), ("c", "<u8"), ("n", "<i8")])


def combined(s: np.ndarray) -> np.ndarray:
    """Suffixes in order, equal ones added up: the leaves of a subtree."""
    if len(s) == 0:
        return s
    s = s[np.lexsort((s["c"], s["b"], s["a"]))]
    new = np.ones(len(s), bool)
    new[1:] = (s["a"][1:] != s["a"][:-1]) | (s["b"][1:] != s["b"][:-1]) | (s["c"][1:] != s["c"][:-1])
    at = np.flatnonzero(new)
    out = s[at]
    out["n"] = np.add.reduceat(s["n"], at)
    return out


def _suffix_scan(seed: int, bitmap, groups):
    def send(gathered):
        s = np.concatenate(gathered)
        to = group_of(s["a"], s["b"], *groups.value)
        # one sort brings equal suffixes of a group together
        with np.errstate(over="ignore"):
            own = mix(mix(s["a"] * _K1 + s["b"]) + s["c"])
        order = np.lexsort((own, to))
        s, to = s[order], to[order]
        same = np.ones(len(s), bool)
        same[1:] = (s["a"][1:] != s["a"][:-1]) | (s["b"][1:] != s["b"][:-1]) | (s["c"][1:] != s["c"][:-1])
        same[1:] |= to[1:] != to[:-1]
        at = np.flatnonzero(same)
        out, to = s[at], to[at]
        out["n"] = np.add.reduceat(s["n"], at)
        edges = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), len(to))
        for i in range(0, len(edges) - 1, 256):
            part = edges[i : i + 257]
            blobs = [out[x:y].tobytes() for x, y in zip(part[:-1], part[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(to[part[:-1]], pa.int64()), pa.array(blobs, pa.binary())], ["group", "suffixes"]
            )

    def scan(batches):
        hits = np.frombuffer(bitmap.value, np.uint8)
        gathered, held = [], 0
        for b in batches:
            texts, _, codes = _batch(b)
            for data, off, first, core in windows(texts):
                h, starts, _, owner, linked, _ = tokens(data, off, seed)
                if len(h) < 2:
                    continue
                h = _keyed(h, owner, first, codes)
                pair = _pairs(h) >> np.uint32(HASH_BITS - MAP_BITS)
                on = np.zeros(len(h) + 1, bool)
                on[: len(h) - 1] = linked[:-1] & (hits[pair >> 3] >> (7 - (pair & 7).astype(np.uint8)) & 1).astype(bool)
                at = np.flatnonzero(on[:-1] & (starts < core))
                if len(at) == 0:
                    continue
                s = np.zeros(len(at), _TYPE)
                s["a"], s["b"], s["n"] = h[at], h[at + 1], 1
                s["c"] = np.where(on[at + 1], h[np.minimum(at + 2, len(h) - 1)], np.uint64(0))
                gathered.append(s)
                held += len(s)
                if held > GATHER:
                    yield from send(gathered)
                    gathered, held = [], 0
        if gathered:
            yield from send(gathered)

    return scan


_NODES = "a bigint, b bigint, c bigint, n bigint, parent bigint"


def nodes_of(leaves: np.ndarray, least: int):
    """Inner nodes (two words; ``c`` 0) and leaves (three words) of a subtree
    with at least ``least`` occurrences; ``parent`` is the count of the first
    two words."""
    if len(leaves) == 0:
        return leaves, np.zeros(0, np.int64)
    at = np.flatnonzero(np.append(True, (leaves["a"][1:] != leaves["a"][:-1]) | (leaves["b"][1:] != leaves["b"][:-1])))
    total = np.add.reduceat(leaves["n"], at)
    parent = np.repeat(total, np.diff(np.append(at, len(leaves))))
    inner = leaves[at]
    inner["c"], inner["n"] = 0, total
    keep = (leaves["c"] != 0) & (leaves["n"] >= least)
    often = total >= least
    return np.concatenate([inner[often], leaves[keep]]), np.concatenate([total[often], parent[keep]])


def _subtrees(least: int, budget: int):
    """Rows of a task by group: the frequent nodes of each group's subtree."""

    def built(pending):
        found, parent = nodes_of(combined(np.concatenate(pending)), least)
        for i in range(0, len(found), 1 << 16):
            part = found[i : i + (1 << 16)]
            cols = [pa.array(np.ascontiguousarray(part[k]).view(np.int64)) for k in ("a", "b", "c", "n")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(parent[i : i + (1 << 16)])], ["a", "b", "c", "n", "parent"])

    def build(batches):
        here, pending, held = None, [], 0
        for b in batches:
            for group, blob in zip(b["group"].to_pylist(), b["suffixes"], strict=True):
                if group != here:
                    if pending:
                        yield from built(pending)
                    here, pending, held = group, [], 0
                pending.append(np.frombuffer(blob.as_py(), _TYPE))
                held += len(pending[-1])
                if held > 2 * budget and len(pending) > 1:
                    pending = [combined(np.concatenate(pending))]
                    # what stays is distinct; wait for as much again
                    held = max(0, len(pending[0]) - budget)
        if pending:
            yield from built(pending)

    return build


# --- phrases -----------------------------------------------------------------


class Counted:
    """Counts of a corpus: ``words`` (key, lang, word, f) and ``nodes`` (a, b, c,
    n, parent) as tables in the shared folder, ``totals`` (lang, n)."""

    def __init__(self, words, nodes, totals):
        self.words, self.nodes, self.totals = words, nodes, totals


def count_phrases(docs: DataFrame, least: int = LEAST, budget: int = BUDGET) -> Counted:
    """Frequent words and phrases of ``docs`` (``lang, text``), with counts.
    ``least`` is at most 255."""
    if not 1 <= least <= 255:
        raise ValueError("least must be 1 to 255")
    spark = docs.sparkSession
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for seed in range(1, _SEEDS + 1):
        scan = stored(rows.mapInArrow(tidy(_prefix_scan(seed, least)), _SCAN), "prefixes")
        every = stored(
            scan.where("kind = 0").groupBy("key", "lang", "word").agg(F.sum("n").alias("f")), "vocabulary"
        )
        if not every.groupBy("key").count().where("count > 1").take(1):
            break
        release(scan, every)
    else:
        raise RuntimeError("two words share a hash under every seed")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    total = every.agg(F.sum("f")).first()[0] or 0
    words = every.where(F.col("f") >= least)
    if total == 0:
        nodes = spark.createDataFrame([], _NODES)
        return Counted(words, nodes, totals)
    ranges = scan.where("kind = 1").select("key", "pairs").repartition(width, "key").sortWithinPartitions("key")
    bitmap = bytearray(1 << MAP_BITS - 3)
    size = 1 << MAP_BITS - 3 - RANGE_BITS
    for r in ranges.mapInArrow(_frequent_prefixes(least), "key bigint, bits binary").collect():
        bitmap[r["key"] * size : (r["key"] + 1) * size] = r["bits"]
    groups = _groups(words, total, budget)
    sent = [spark.sparkContext.broadcast(x) for x in (bytes(bitmap), groups)]
    release(scan)
    nodes = stored(
        rows.mapInArrow(tidy(_suffix_scan(seed, *sent)), "group bigint, suffixes binary")
        .repartition(width, "group")
        .sortWithinPartitions("group")
        .mapInArrow(tidy(_subtrees(least, budget)), _NODES),
        "nodes",
    )
    for x in sent:
        x.unpersist()
    return Counted(words, nodes, totals)


def _score(a, left, right):
    """floor(1000000 a a / (left right)) in whole decimals."""
    wide = "cast({} as decimal(19, 0))"
    million = "cast(1000000 as decimal(7, 0))"
    top = f"cast({wide.format(a)} * {wide.format(a)} as decimal(31, 0)) * {million}"
    return F.expr(f"({top}) div cast({wide.format(left)} * {wide.format(right)} as decimal(38, 0))")


def score_phrases(counted: Counted, inside: int = INSIDE) -> DataFrame:
    """All kept candidates: ``lang, phrase, a, l, r, n, score``."""
    w = counted.words
    one = w.select(F.col("key").alias("a"), "lang", F.col("word").alias("word_a"), F.col("f").alias("f_a"))
    two = w.select(F.col("key").alias("b"), F.col("word").alias("word_b"), F.col("f").alias("f_b"))
    nodes = counted.nodes
    pairs = stored(
        nodes.where("c = 0").select("a", "b", F.col("n").alias("n_ab")).join(one, "a").join(two, "b"), "pairs"
    )
    triples = nodes.where("c <> 0")
    longer = triples.select("a", "b", "n").union(triples.select(F.col("b").alias("a"), F.col("c").alias("b"), "n"))
    longer = longer.groupBy("a", "b").agg(F.max("n").alias("longest"))
    kept = pairs.join(longer, ["a", "b"], "left").where(
        F.col("longest").isNull() | (F.lit(100) * F.col("longest") < F.lit(inside) * F.col("n_ab"))
    )
    second = pairs.select(
        F.col("a").alias("b"), F.col("b").alias("c"), F.col("n_ab").alias("n_bc"), F.col("word_b").alias("word_c"),
        F.col("f_b").alias("f_c"),
    )
    three = triples.join(pairs, ["a", "b"]).join(second, ["b", "c"])
    cuts = three.select(
        "lang", F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"), F.col("n").alias("a"),
        F.col("f_a").alias("l1"), F.col("n_bc").alias("r1"), F.col("n_ab").alias("l2"), F.col("f_c").alias("r2"),
    )
    cuts = cuts.select("*", _score("a", "l1", "r1").alias("s1"), _score("a", "l2", "r2").alias("s2"))
    later = F.col("s2") < F.col("s1")
    of_three = cuts.select(
        "lang", "phrase", "a", F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(later, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    of_two = kept.select(
        "lang", F.concat_ws(" ", "word_a", "word_b").alias("phrase"), F.col("n_ab").alias("a"),
        F.col("f_a").alias("l"), F.col("f_b").alias("r"), _score("n_ab", "f_a", "f_b").alias("score"),
    )
    totals = F.broadcast(counted.totals) if _few(counted.totals) else counted.totals
    return of_two.union(of_three).join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def _few(totals: DataFrame, most: int = 10_000) -> bool:
    return totals.limit(most + 1).count() <= most


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, inside: int = INSIDE, budget: int = BUDGET) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r,
    n, score``."""
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = score_phrases(count_phrases(docs, least, budget), inside)
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = Window.partitionBy("lang", part).orderBy(*best)
    some = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint"))
    return last.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of the query ``op11``."""
    return mine(docs)
