"""Benchmark decontamination with an FM-index per shard of training documents.

A shard is a run of whole documents of one scan task, about ``SHARD_WORDS``
words. Its words are numbered, the suffixes of the word sequence sorted, and
the last column kept as a wavelet tree (one bit vector with rank counts per
level); every ``SAMPLE``-th text position is kept with its row. A phrase is
searched backwards through the tree's ranks, all phrases of a block at once;
the rows that remain walk back to the next sampled position, which locates the
occurrence. Overlapping occurrences merge into removal spans.

Shards are rows of a table in the shared folder: a lost executor costs its
tasks only, and no document is shuffled. The benchmark becomes blocks of about
``BLOCK_BYTES`` of word hashes by a job of its own; each pass over the index
brings ``PASS_BLOCKS`` of them to every shard, however many there are.

An item's phrases are its windows of ``size`` consecutive words; an item of
fewer words, but not none, is one phrase. Null and empty texts have no words.
Documents of the same words share one entry of a shard. Rows are independent:
repeated rows and rows that share a doc_id each get a result; a null doc_id is
kept. Items that share an id count as one; a null item_id is written ``null``.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import release, stored, tidy
from ._words import Words, alphabet, slices, words_of

SHARD_WORDS = 1 << 20
SAMPLE = 16
WINDOW = 10
#: Of a benchmark: windows of a piece, bytes of a block, blocks of a pass.
PIECE_WORDS = 1 << 13
BLOCK_BYTES = 1 << 20
PASS_BLOCKS = 8
WORD = alphabet(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Bytes of text whose words are taken at once.
SLICE = 1 << 20


# --- one shard ---------------------------------------------------------------


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order. ``ids`` ends with its only 0.

    Prefix doubling; after a round only suffixes that still tie are sorted.
    """
    n = len(ids)
    bits = max(1, int(ids.max()).bit_length())
    per = min(n, max(1, 62 // bits))
    key = np.zeros(n, np.int64)
    for j in range(per):
        key <<= bits
        key[: n - j] |= ids[j:]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(sorted_key[1:], sorted_key[:-1], out=new[1:])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = head
    depth = per
    alone = new & np.append(new[1:], True)
    open_ = np.flatnonzero(~alone)
    while len(open_):
        at = order[open_]
        key = rank[at] * (n + 1) + rank[np.minimum(at + depth, n)] + 1
        by = np.argsort(key, kind="stable")
        key, at = key[by], at[by]
        order[open_] = at
        new = np.empty(len(open_), bool)
        new[0] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        rank[at] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        alone = new & np.append(new[1:], True)
        open_ = open_[~alone]
        depth *= 2
    return order


def _ones_before(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.bitwise_count(words), out=out[1:])
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    b = np.packbits(bits, bitorder="little")
    out = np.zeros(-(-len(b) // 8) * 8 + 8, np.uint8)
    out[: len(b)] = b
    return out.view(np.uint64)


_FULL = ~np.uint64(0)


class Ranks:
    """A bit vector that counts the ones before a position."""

    def __init__(self, words: np.ndarray):
        self.words, self.ones = words, _ones_before(words)

    def before(self, at: np.ndarray) -> np.ndarray:
        w = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[w] + np.bitwise_count(self.words[w] & low)

    def test(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class Shard:
    """FM-index over the distinct word sequences of some documents.

    ``vocabulary``: sorted word hashes; word ``v`` has id ``v + 2``, 1 ends a
    document, 0 ends the shard. ``begin``: first position of each sequence.
    """

    def __init__(self, size, vocabulary, begin, levels, marks, places):
        self.size, self.vocabulary, self.begin = size, vocabulary, begin
        self.bits = len(levels)
        self.levels = [Ranks(x) for x in levels]
        self.zeros = [size - int(x.before(np.array([size]))[0]) for x in self.levels]
        self.marks, self.places = Ranks(marks), places
        symbols = np.arange(len(vocabulary) + 3)
        # of each id: where its run begins in the tree's last level, and its
        # first row (ids before it, counted)
        self.bottom = self._descend(symbols[:-1], np.zeros(len(symbols) - 1, np.int64))
        count = self._descend(symbols[:-1], np.full(len(symbols) - 1, size, np.int64)) - self.bottom
        self.row = np.zeros(len(symbols), np.int64)
        np.cumsum(count, out=self.row[1:])

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (ranks, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            ones = ranks.before(at)
            at = np.where(one, zeros + ones, at - ones)
        return at

    def back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """First row of ``symbol`` plus its occurrences before ``at``."""
        return self.row[symbol] + self._descend(symbol, at) - self.bottom[symbol]

    def before_row(self, at: np.ndarray) -> np.ndarray:
        """Row of the suffix one word longer."""
        symbol, low = np.zeros(len(at), np.int64), at
        for ranks, zeros in zip(self.levels, self.zeros, strict=True):
            one = ranks.test(low)
            ones = ranks.before(low)
            low = np.where(one, zeros + ones, low - ones)
            symbol = symbol << 1 | one
        return self.row[symbol] + low - self.bottom[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases (word hashes, one per line, padded right)."""
        most = phrases.shape[1]
        if len(self.vocabulary) == 0:
            z = np.zeros(len(phrases), np.int64)
            return z, z
        at = np.minimum(np.searchsorted(self.vocabulary, phrases), len(self.vocabulary) - 1)
        used = np.arange(most)[None] < lengths[:, None]
        known = ((self.vocabulary[at] == phrases) | ~used).all(1) & (lengths > 0)
        ids = at + 2
        lo, hi = np.zeros(len(phrases), np.int64), np.where(known, self.size, 0)
        for j in range(most - 1, -1, -1):
            live = np.flatnonzero((lengths > j) & (hi > lo))
            if len(live):
                c = ids[live, j]
                lo[live] = self.back(c, lo[live])
                hi[live] = self.back(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out = np.empty(len(rows), np.int64)
        at, todo, steps = rows.copy(), np.arange(len(rows)), 0
        while len(todo):
            here = self.marks.test(at)
            done = at[here]
            out[todo[here]] = self.places[self.marks.before(done)] + steps
            todo, at = todo[~here], at[~here]
            if len(todo):
                at = self.before_row(at)
            steps += 1
        return out

    def dump(self) -> dict[str, bytes]:
        return {
            "vocabulary": self.vocabulary.tobytes(),
            "begin": self.begin.astype(np.int64).tobytes(),
            "tree": np.concatenate([x.words for x in self.levels]).tobytes(),
            "marks": self.marks.words.tobytes(),
            "places": self.places.astype(np.int32).tobytes(),
        }

    @staticmethod
    def load(size: int, vocabulary: bytes, begin: bytes, tree: bytes, marks: bytes, places: bytes) -> Shard:
        marks = np.frombuffer(marks, np.uint64)
        tree = np.frombuffer(tree, np.uint64).reshape(-1, len(marks))
        return Shard(
            size,
            np.frombuffer(vocabulary, np.uint64),
            np.frombuffer(begin, np.int64),
            list(tree),
            marks,
            np.frombuffer(places, np.int32),
        )

    @staticmethod
    def build(sequences: list[np.ndarray]) -> Shard:
        """``sequences``: word hashes of each distinct document."""
        lengths = np.array([len(s) for s in sequences], np.int64)
        begin = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] if len(lengths) else np.zeros(0, np.int64)
        all_ = np.concatenate(sequences) if sequences else np.zeros(0, np.uint64)
        vocabulary, ids = np.unique(all_, return_inverse=True)
        size = len(all_) + len(sequences) + 1
        text = np.ones(size, np.int64)
        text[-1] = 0
        inside = np.ones(size, bool)
        inside[begin + lengths] = False
        inside[-1] = False
        text[inside] = ids + 2
        order = suffix_order(text)
        last = text[order - 1]
        bits = max(1, (len(vocabulary) + 1).bit_length())
        levels = []
        for k in range(bits - 1, -1, -1):
            one = (last >> k) & 1 == 1
            levels.append(_packed(one))
            last = np.concatenate([last[~one], last[one]])
        kept = order % SAMPLE == 0
        return Shard(size, vocabulary, begin, levels, _packed(kept), order[kept].astype(np.int32))


INDEX = (
    "shard bigint, size bigint, doc_id array<bigint>, n_words array<bigint>, slot array<int>, "
    "vocabulary binary, begin binary, tree binary, marks binary, places binary"
)


def _index_batches(batches):
    """One row per shard; a shard takes whole documents of one task in order."""
    task = TaskContext.get()
    name = (task.partitionId() if task else 0) << 32
    ids: list[int | None] = []
    counts: list[int] = []
    slots: list[int] = []
    known: dict[bytes, int] = {}
    sequences: list[np.ndarray] = []
    size = 0

    def close():
        nonlocal name, size
        shard = Shard.build(sequences)
        row = {"shard": name, "size": shard.size, "doc_id": list(ids), "n_words": list(counts), "slot": list(slots)}
        row |= shard.dump()
        name += 1
        size = 0
        for x in (ids, counts, slots, known, sequences):
            x.clear()
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds, strict=True)], list(row))

    for b in batches:
        doc_ids, texts = b["doc_id"].to_pylist(), b["text"]
        for first, part in slices(texts, SLICE):
            w: Words = words_of(part, WORD)
            for i in range(len(part)):
                own = w.hashes[w.first[i] : w.first[i + 1]]
                ids.append(doc_ids[first + i])
                counts.append(len(own))
                if len(own) == 0:
                    slots.append(-1)
                    continue
                key = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                if key not in known:
                    known[key] = len(sequences)
                    sequences.append(own.copy())
                    size += len(own)
                slots.append(known[key])
                if size >= SHARD_WORDS:
                    yield close()
        if len(ids) >= 1 << 16:
            yield close()
    if ids:
        yield close()


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard of ``doc_id, text``; written to the shared folder."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(rows.mapInArrow(tidy(_index_batches), INDEX), "fm_index")


# --- phrases and search ------------------------------------------------------

PIECES = "item string, hashes binary"


def _piece_batches(size: int):
    """Word hashes of each item, in pieces of at most ``PIECE_WORDS`` windows;
    neighbours share ``size - 1`` words, so no window is lost or doubled."""

    def run(batches):
        for b in batches:
            names = b["item"].to_pylist()
            for first, part in slices(b["text"], SLICE):
                w = words_of(part, WORD)
                item, hashes = [], []
                for i in range(len(part)):
                    own = w.hashes[w.first[i] : w.first[i + 1]]
                    for p in range(0, max(len(own) - size, 0) + 1 if len(own) else 0, PIECE_WORDS):
                        item.append(names[first + i])
                        hashes.append(own[p : p + PIECE_WORDS + size - 1].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(hashes, pa.binary())], ["item", "hashes"])

    return run


def phrase_blocks(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, int]:
    """The items' pieces, each with its ``block``, and a number above all blocks.

    A block holds at most ``BLOCK_BYTES`` of hashes and names besides its last
    piece: pieces are dealt to buckets by hash, and a bucket of more is cut.
    """
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item")
    pieces = stored(benchmark.select(item, "text").mapInArrow(tidy(_piece_batches(size)), PIECES).distinct(), "pieces")
    weight = F.octet_length("hashes") + F.octet_length("item")
    total = pieces.agg(F.sum(weight.cast("bigint"))).first()[0] or 0
    buckets = max(1, -(-total // BLOCK_BYTES))
    key = F.xxhash64("item", "hashes")
    dealt = pieces.withColumn("bucket", F.pmod(key, F.lit(buckets)))
    before = Window.partitionBy("bucket").orderBy(key, "item", "hashes").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.floor(F.coalesce(F.sum(weight.cast("bigint")).over(before), F.lit(0)) / F.lit(BLOCK_BYTES)).cast("bigint")
    blocks = stored(dealt.select("item", "hashes", (cut * buckets + F.col("bucket")).alias("block")), "phrases")
    release(pieces)
    return blocks, (blocks.agg(F.max("block")).first()[0] or 0) + 1


def phrases_of(pieces: list[dict], size: int = WINDOW):
    """Distinct phrases of a block: word hashes (padded), lengths, and the items
    of phrase ``k``: ``names[owner[first[k]:first[k + 1]]]``."""
    names = sorted({p["item"] for p in pieces})
    place = {name: i for i, name in enumerate(names)}
    lines, who = [np.zeros((0, size + 1), np.uint64)], [np.zeros(0, np.int64)]
    for p in pieces:
        own = np.frombuffer(p["hashes"], np.uint64)
        n = min(size, len(own))
        line = np.zeros((len(own) - n + 1, size + 1), np.uint64)
        line[:, :n] = np.lib.stride_tricks.sliding_window_view(own, n)
        line[:, size] = n
        lines.append(line)
        who.append(np.full(len(line), place[p["item"]], np.int64))
    table, phrase = np.unique(np.concatenate(lines), axis=0, return_inverse=True)
    pair = np.unique(phrase.ravel() * max(1, len(names)) + np.concatenate(who))
    phrase, owner = pair // max(1, len(names)), pair % max(1, len(names))
    first = np.searchsorted(phrase, np.arange(len(table) + 1))
    return table[:, :size], table[:, size].astype(np.int64), names, first, owner


FOUND = (
    "shard bigint, place int, doc_id bigint, n_words bigint, "
    "spans array<struct<start:bigint,stop:bigint>>, items array<string>"
)


def merged(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Union of intervals; touching ones become one span."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], stops[order]
    reach = np.maximum.accumulate(stops)
    new = np.append(True, starts[1:] > reach[:-1])
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return list(zip(starts[new].tolist(), reach[ends].tolist(), strict=True))


def _searcher(size: int):
    """Rows are pairs of a shard and a block. A document without a hit has a row
    for block 0 only."""

    def search(batches):
        known: dict[int, tuple] = {}  # the pass's blocks
        for b in batches:
            for row in range(b.num_rows):
                get = lambda c: b[c][row].as_py()  # noqa: B023, E731
                block = get("block")
                if block not in known:
                    known[block] = phrases_of(get("pieces") or [], size)
                phrases, lengths, names, first, owner = known[block]
                shard = Shard.load(get("size"), *(get(c) for c in ("vocabulary", "begin", "tree", "marks", "places")))
                lo, hi = shard.search(phrases, lengths)
                hit = np.flatnonzero(hi > lo)
                count = (hi - lo)[hit]
                rows = np.repeat(lo[hit] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
                phrase = np.repeat(hit, count)
                at = shard.locate(rows)
                slot = np.searchsorted(shard.begin, at, side="right") - 1
                start = at - shard.begin[slot] if len(at) else at
                by = np.argsort(slot, kind="stable")
                slot, start, phrase = slot[by], start[by], phrase[by]
                own: dict[int, tuple[list, list]] = {}
                new = np.append(True, slot[1:] != slot[:-1])[: len(slot)]
                cuts = np.append(np.flatnonzero(new), len(slot)).tolist()
                for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                    spans = merged(start[x:y], start[x:y] + lengths[phrase[x:y]])
                    who = {i for p in set(phrase[x:y].tolist()) for i in owner[first[p] : first[p + 1]].tolist()}
                    own[int(slot[x])] = (spans, [names[i] for i in sorted(who)])
                doc_id, n_words, slots = get("doc_id"), get("n_words"), get("slot")
                pick = [i for i, s in enumerate(slots) if block == 0 or s in own]
                if not pick:
                    continue
                none = ([], [])
                cols = [
                    pa.array([get("shard")] * len(pick), pa.int64()),
                    pa.array(pick, pa.int32()),
                    pa.array([doc_id[i] for i in pick], pa.int64()),
                    pa.array([n_words[i] for i in pick], pa.int64()),
                    pa.array(
                        [[{"start": s, "stop": e} for s, e in own.get(slots[i], none)[0]] for i in pick],
                        pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
                    ),
                    pa.array([own.get(slots[i], none)[1] for i in pick], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["shard", "place", "doc_id", "n_words", "spans", "items"])

    return search


def _union_spans(batches):
    """Spans of several blocks become one list each."""
    for b in batches:
        out = []
        for spans in b["spans"].to_pylist():
            if spans:
                x = np.array([(s["start"], s["stop"]) for s in spans], np.int64)
                out.append([{"start": s, "stop": e} for s, e in merged(x[:, 0], x[:, 1])])
            else:
                out.append([])
        at = b.schema.get_field_index("spans")
        yield b.set_column(at, "spans", pa.array(out, b.schema.field(at).type))


def find(index: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Removal spans (word positions) and the items found, per indexed document.

    ``benchmark`` has ``item_id, text``. Every document has a row, with empty
    lists if nothing was found. Phrases are made by a job over ``benchmark``; the
    driver learns the number of their blocks. A pass pairs each shard with
    ``PASS_BLOCKS`` blocks, which are broadcast (their size is bounded) and let go
    before the next pass; the shards stay in place.
    """
    pieces, blocks = phrase_blocks(benchmark, size)
    parts = []
    for low in range(0, blocks, PASS_BLOCKS):
        high = min(low + PASS_BLOCKS, blocks) - 1
        own = pieces.where(F.col("block").between(low, high)).groupBy("block").agg(F.collect_list(F.struct("item", "hashes")).alias("pieces"))
        numbered = index.withColumn("block", F.explode(F.sequence(F.lit(low), F.lit(high)).cast("array<bigint>")))
        # block 0 may have no phrase, yet gives every document its row
        pairs = numbered.join(F.broadcast(own), "block", "left" if low == 0 else "inner")
        met = pairs.mapInArrow(tidy(_searcher(size)), FOUND)
        if blocks == 1:
            return met
        # written one after the other: one pass's blocks are held at a time
        parts.append(stored(met, "found")._linecraft_path)
    met = index.sparkSession.read.schema(FOUND).parquet(*parts)
    return (
        met.groupBy("shard", "place")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        .mapInArrow(tidy(_union_spans), FOUND)
    )


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns of the query ``op6``."""
    found = find(build_index(docs), benchmark)
    hits = F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)")
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark phrase.

    Rows are matched to their result by doc_id and the text's hash, so rows
    that share a doc_id are judged apart.
    """
    keyed = docs.select("text", F.xxhash64("doc_id", "text").alias("doc_id"))
    index = build_index(keyed)
    dirty = stored(find(index, benchmark, size).where(F.size("spans") > 0).select(F.col("doc_id").alias("__dirty")).distinct(), "dirty")
    release(index)
    return docs.join(dirty, F.xxhash64(docs["doc_id"], docs["text"]) == F.col("__dirty"), "left_anti")
