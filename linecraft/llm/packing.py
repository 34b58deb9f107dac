"""Packing of tokenised documents by cutting-stock column generation.

A document's ids are cut into pieces of ``LENGTH`` ids and one remainder. The
histogram of piece lengths is all that the driver sees: a linear program over
patterns (multisets of lengths that fill a sequence exactly) says how often
each pattern is used. Columns are priced by a knapsack dynamic program over the
dual prices; multiplicities are rounded down. The pieces of each length are
ranked in Spark, and ranks map to (sequence, offset) by a table of at most some
thousand intervals.

What rounding leaves over is laid end to end and cut every ``LENGTH`` ids, and
its last ids fill sequences whose lengths are powers of two, which need no
padding. So no sequence is padded, and only left-over pieces are cut again.

Null and empty texts have the closing id only. Rows are independent: repeated
rows and rows that share a doc_id or have none are each packed whole. Extra
columns are not read. An empty table gives no pieces.

The ids are those of the ``tokenizers`` file. They are made by ``tiktoken``
with the same vocabulary as ranks, which is several times faster. Long texts are
encoded in parts, cut where the pre-tokens end in any case: before white space
that follows something else. A part that names the special token, or is still
longer than ``LONGEST`` (a run of white space or of letters without a cut, for
which the pattern of ``tiktoken`` runs out of stack), goes through ``tokenizers``
itself. A task holds one text and its ids.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import process_cache, stored, tidy

LENGTH = 1024
#: The id that closes each document.
CLOSE = 0
#: Bounds of the linear program: columns made, and the share of ids outside
#: its patterns at which it stops early.
MOST_COLUMNS, GOOD_SHARE = 600, 0.002
SPECIAL = "<|endoftext|>"
#: Rows of a file that are ranked together.
RANK_ROWS = 1 << 16


#: Characters of the parts of a long text (about), and of the longest one that
#: ``tiktoken`` gets.
PART, LONGEST = 1 << 15, 1 << 16

# --- tokens ------------------------------------------------------------------

# White space that every definition counts as such, after what none does.
_CUT = re.compile(r"\S(?=[ \t-\r])")


def cut(text: str, size: int) -> list[str]:
    """Parts of at least ``size`` characters, cut where no pre-token reaches
    across and neither side changes the pre-tokens of the other; a run without
    such a place stays whole."""
    out, at = [], 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size - 1)
        if m is None:
            break
        out.append(text[at : m.end()])
        at = m.end()
    out.append(text[at:])
    return out


def default_tokenizer() -> tuple[str, str]:
    """Paths of the tokenizer file and of the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(paths: tuple[str, str]):
    """Function: text to a list of ids. Files are read once per process."""
    cache = process_cache()
    if ("encoder", paths) not in cache:
        import base64

        import public_tokenizers
        import tiktoken

        with open(paths[1], "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        cache["last id", paths] = max(ranks.values())
        cache["encoder", paths] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    quick = cache["encoder", paths].encode_ordinary

    def slow(text: str) -> list[int]:
        if ("tokenizer", paths) not in cache:
            from tokenizers import Tokenizer

            cache["tokenizer", paths] = Tokenizer.from_file(paths[0])
        return cache["tokenizer", paths].encode(text, add_special_tokens=False).ids

    def encode(text: str) -> list[int]:
        if len(text) <= LONGEST:
            return slow(text) if SPECIAL in text else quick(text)
        out: list[int] = []
        for part in cut(text, PART):
            out += slow(part) if len(part) > LONGEST or SPECIAL in part else quick(part)
        return out

    return encode


PIECES = "doc_id bigint, start bigint, length int, ids_crc32 bigint, doc_tokens bigint, ids binary"


def _cutter(paths, length):
    def cut_up(batches):
        encode = encoder(paths)
        kind = "<u2" if process_cache()["last id", paths] < 0xFFFF else "<u4"
        for b in batches:
            texts, ids_of = b["text"], b["doc_id"]
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for i in range(b.num_rows):
                ids = encode(texts[i].as_py() or "")
                ids.append(CLOSE)
                n = len(ids)
                wide = np.array(ids, "<u4")
                for at in range(0, n, length):
                    piece = wide[at : at + length]
                    whole = len(piece) == length
                    cols[0].append(ids_of[i].as_py())
                    cols[1].append(at)
                    cols[2].append(len(piece))
                    cols[3].append(zlib.crc32(piece))
                    cols[4].append(n)
                    # only a remainder may be cut again
                    cols[5].append(None if whole else piece.astype(kind).tobytes())
                if len(cols[0]) >= 4096:
                    yield _pieces(cols)
                    cols = ([], [], [], [], [], [])
            if cols[0]:
                yield _pieces(cols)

    return cut_up


def _pieces(cols):
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
    )


# --- patterns ----------------------------------------------------------------


def best_fill(price: np.ndarray, lengths: np.ndarray, length: int) -> tuple[float, dict[int, int]]:
    """Cheapest multiset of ``lengths`` (prices alike) that adds up to
    ``length``: knapsack by dynamic programming."""
    # prices of all lengths, so that each step adds two plain slices
    dense = np.full(length + 1, np.inf)
    dense[lengths] = price
    at = np.zeros(length + 1, np.int64)
    at[lengths] = np.arange(len(lengths))
    cost = np.full(length + 1, np.inf)  # of what is still to fill, so reversed
    cost[length] = 0.0
    last = np.zeros(length + 1, np.int64)
    for c in range(1, length + 1):
        x = cost[length - c + 1 :] + dense[1 : c + 1]
        k = int(x.argmin())
        cost[length - c], last[c] = x[k], k + 1
    cost = cost[::-1]
    if not np.isfinite(cost[length]):
        return np.inf, {}
    found: dict[int, int] = {}
    c = length
    while c:
        size = int(last[c])
        found[int(at[size])] = found.get(int(at[size]), 0) + 1
        c -= size
    return float(cost[length]), found


def patterns(counts: dict[int, int], length: int = LENGTH, most: int = MOST_COLUMNS) -> list[tuple[int, dict[int, int]]]:
    """(multiplicity, {piece length: copies}) of patterns that fill sequences
    exactly and use at most ``counts[l]`` pieces of each length ``l``.

    Maximises the filled sequences: a linear program, by the revised simplex
    method from a basis of pairs and slacks; each step prices a new column.
    """
    lengths = np.array(sorted(k for k, v in counts.items() if v > 0), np.int64)
    m = len(lengths)
    if m == 0:
        return []
    have = np.array([counts[int(k)] for k in lengths], float)
    inverse = np.eye(m)
    value = have.copy()
    in_basis: list[dict[int, int] | None] = [None] * m
    gain = np.zeros(m)
    total = float((have * lengths).sum())
    # first basis: pairs that fill a sequence, bounded by the scarcer length
    where = {int(k): i for i, k in enumerate(lengths)}
    for i, k in enumerate(lengths):
        j = where.get(length - int(k))
        if j is None or j < i:
            continue
        if i == j:
            in_basis[i], inverse[i, i], value[i] = {i: 2}, 0.5, have[i] / 2
        else:
            few, many = (i, j) if have[i] <= have[j] else (j, i)
            in_basis[few] = {i: 1, j: 1}
            inverse[many, few] = -1.0
            value[many] = have[many] - have[few]
        gain[i if i == j else few] = 1.0
    for _ in range(most):
        filled = length * float(value[gain > 0].sum())
        if total - filled <= GOOD_SHARE * total:
            break
        price = np.maximum(gain @ inverse, 0)
        cost, fill = best_fill(price, lengths, length)
        if cost >= 1 - 1e-7:
            break
        column = inverse[:, list(fill)] @ np.array(list(fill.values()), float)
        able = np.flatnonzero(column > 1e-9)
        if len(able) == 0:
            break
        ratio = value[able] / column[able]
        out = int(able[ratio.argmin()])
        step = ratio.min()
        value = np.maximum(value - step * column, 0)
        value[out] = step
        line = inverse[out] / column[out]
        rest = column.copy()
        rest[out] = 0
        used, cols = np.flatnonzero(rest), np.flatnonzero(line)
        inverse[np.ix_(used, cols)] -= rest[used, None] * line[cols]
        inverse[out] = line
        in_basis[out], gain[out] = fill, 1.0
    left = have.astype(np.int64)
    result = []
    ranked = sorted(((float(v), f) for v, f in zip(value, in_basis, strict=True) if f), key=lambda x: (-x[0], sorted(x[1].items())))
    for v, fill in ranked:
        times = int(v + 1e-6)
        times = min([times, *(int(left[i]) // a for i, a in fill.items())])
        if times > 0:
            for i, a in fill.items():
                left[i] -= a * times
            result.append([times, fill])
    # rounding may leave enough for another use of a column
    for _, fill in ranked:
        more = min(int(left[i]) // a for i, a in fill.items())
        if more > 0:
            for i, a in fill.items():
                left[i] -= a * more
            result.append([more, fill])
    return [(t, {int(lengths[i]): a for i, a in f.items()}) for t, f in result]


class Layout:
    """Where the piece of a length and rank goes. Bounded by the number of
    patterns, whatever the input: intervals of ranks for each length."""

    def __init__(self, counts: dict[int, int], length: int = LENGTH):
        self.length = length
        whole = counts.get(length, 0)
        rest = {k: v for k, v in counts.items() if k != length}
        slots = [(length, 0, whole, 0, 0, 1)] if whole else []
        used = dict.fromkeys(rest, 0)
        sequence = whole
        for times, fill in patterns(rest, length):
            offset = 0
            for size, copies in sorted(fill.items(), reverse=True):
                slots.append((size, used[size], used[size] + copies * times, sequence, offset, copies))
                used[size] += copies * times
                offset += size * copies
            sequence += times
        slots.sort()
        # piece length, first rank, end, first sequence, first offset, copies
        self.slots = np.array(slots, np.int64).reshape(-1, 6)
        self.key = self.slots[:, 0] << 48 | self.slots[:, 1]
        # left-over pieces end to end
        self.used = used
        self.tape: dict[int, int] = {}
        at = 0
        for size in sorted(rest, reverse=True):
            self.tape[size] = at
            at += (rest[size] - used[size]) * size
        self.first_cut = sequence
        self.full = at // length
        tail, bounds = at % length, [self.full * length]
        for bit in range(length.bit_length(), -1, -1):
            if tail >> bit & 1:
                bounds.append(bounds[-1] + (1 << bit))
        self.bounds = np.array(bounds, np.int64)
        self.sequences = sequence + self.full + len(bounds) - 1

    def place(self, size: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(first id, ids, sequence, offset) of each part of a piece."""
        i = int(np.searchsorted(self.key, size << 48 | rank, side="right")) - 1
        if i >= 0 and self.slots[i, 0] == size and rank < self.slots[i, 2]:
            _, first, _, sequence, offset, copies = (int(x) for x in self.slots[i])
            return [(0, size, sequence + (rank - first) // copies, offset + (rank - first) % copies * size)]
        at = self.tape[size] + (rank - self.used[size]) * size
        done, out = 0, []
        while done < size:
            here = at + done
            if here < self.bounds[0]:
                sequence, begin = here // self.length, here // self.length * self.length
                end = begin + self.length
            else:
                k = int(np.searchsorted(self.bounds, here, side="right")) - 1
                sequence, begin, end = self.full + k, int(self.bounds[k]), int(self.bounds[k + 1])
            n = min(size - done, end - here)
            out.append((done, n, self.first_cut + sequence, here - begin))
            done += n
        return out


RESULT = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)
_RESULT_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _placer(layout: Layout):
    def place(batches):
        for b in batches:
            cols: tuple[list, ...] = tuple([] for _ in _RESULT_NAMES)
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
            ids = b["ids"]
            for i, (doc, start, size, crc, tokens, rank) in enumerate(zip(*(b[c].to_pylist() for c in names), strict=True)):
                parts = layout.place(size, rank)
                wide = None
                if len(parts) > 1:
                    raw = ids[i].as_py()
                    wide = np.frombuffer(raw, f"<u{len(raw) // size}").astype("<u4")
                for at, n, sequence, offset in parts:
                    own = crc if wide is None else zlib.crc32(wide[at : at + n])
                    for c, v in zip(cols, (doc, start + at, n, own, tokens, sequence, offset), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], _RESULT_NAMES)

    return place


def _ranked(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 within each length.

    Rows are ranked within (length, file, block of rows), groups of at most
    ``RANK_ROWS`` rows, and each group gets the number of rows before it.
    """
    at = F.col("_metadata.row_index")
    rows = pieces.select(
        *pieces.columns, F.col("_metadata.file_name").alias("file"), F.floor(at / RANK_ROWS).alias("block"), at.alias("row")
    )
    group = ["length", "file", "block"]
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        *group, (F.sum("n").over(Window.partitionBy("length").orderBy("file", "block")) - F.col("n")).alias("before")
    )
    own = rows.withColumn("own", F.row_number().over(Window.partitionBy(*group).orderBy("row")) - 1)
    return own.join(before, group).select(*pieces.columns, (F.col("before") + F.col("own")).alias("rank"))


def pack(docs: DataFrame, tokenizer: tuple[str, str] | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces of all documents (``doc_id, text``) with their places.

    ``tokenizer``: paths of the tokenizer file and its ranks, readable by every
    executor. ``length`` is a power of two.
    """
    paths = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    pieces = stored(rows.mapInArrow(tidy(_cutter(paths, length)), PIECES), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    return _ranked(pieces).mapInArrow(tidy(_placer(Layout(counts, length))), RESULT)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of the query ``op4``."""
    return pack(docs)
