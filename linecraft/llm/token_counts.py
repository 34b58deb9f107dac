"""Token counts of documents under edits.

Each document is a segment tree: leaves are runs of whole pre-tokens, about
``LEAF`` characters each, and every inner node holds the characters and tokens
below it. An edit finds its leaves by the character sums, re-encodes only those
leaves and the neighbours that touch the changed characters, and updates the
sums on the paths to the root.

Leaves are cut where a character that is no white space is followed by one that
is. The tokenizer's pre-tokens never reach across such a place, and what stands
on one side does not change the pre-tokens of the other, so counts of leaves
add up to the count of the text. An edit at a cut takes the leaves on both
sides, so every remaining cut still stands between the same two characters.

:func:`edited_counts` builds the trees of the documents it is given. Where
counts are wanted again after later edits, :func:`plant` makes a table of leaves
once and :func:`grow` gives the rows that a batch of edits adds to it: a batch
encodes and writes only the leaves it touches.

An edit replaces ``removed`` characters from ``start`` on (code points of the
text after the document's earlier edits) by ``inserted``; places beyond the end
are moved to the end, negative or null numbers count as 0, null text as empty.
Edits apply in the order of ``seq``, then start, removed and inserted; null
comes first. Rows that share a doc_id each get its edits; rows with a null
doc_id get none. Null and empty texts have no tokens. Extra columns are not
read. One document's edits are read as one list, so a single document's history
must fit in a task; documents are independent of each other.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import tidy
from .packing import cut, default_tokenizer, encoder

#: Characters of a leaf (about), and the multiple at which it is cut again.
LEAF, TOO_LONG = 512, 4


def leaves_of(text: str, size: int = LEAF) -> list[str]:
    """Runs of whole pre-tokens; a run without a cut stays whole."""
    return cut(text, size)


class CountTree:
    """Segment tree over the leaves of one text."""

    def __init__(self, text: str, encode, leaves: list[tuple[str, int]] | None = None):
        """``leaves``: (text, tokens) of the slots of a tree kept earlier, in
        place of a text; nothing is encoded then."""
        self.encode = encode
        self.encoded = 0
        #: Slots that edits changed, and whether the slots were dealt anew.
        self.touched: set[int] = set()
        self.dealt = False
        self._fill([(t, self._count(t)) for t in leaves_of(text)] if leaves is None else leaves)

    def _count(self, text: str) -> int:
        self.encoded += len(text)
        return len(self.encode(text)) if text else 0

    def _fill(self, leaves: list[tuple[str, int]]) -> None:
        n = 1
        while n < len(leaves):
            n *= 2
        self.n = n
        self.text = [t for t, _ in leaves] + [""] * (n - len(leaves))
        self.chars = [0] * n + [len(t) for t in self.text]
        self.tokens = [0] * n + [c for _, c in leaves] + [0] * (n - len(leaves))
        for i in range(n - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the characters before it."""
        i, before = 1, 0
        while i < self.n:
            i *= 2
            if place - before >= self.chars[i]:
                before += self.chars[i]
                i += 1
        return i - self.n, before

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def content(self) -> str:
        return "".join(self.text)

    def edit(self, start: int, removed: int, inserted: str) -> None:
        end_of_text = self.length
        start = min(max(start, 0), end_of_text)
        stop = min(start + max(removed, 0), end_of_text)
        if end_of_text == 0:
            first, before, last = 0, 0, self.n - 1
        else:
            # the characters on both sides belong to the region
            first, before = self._leaf_at(max(start - 1, 0))
            last, _ = self._leaf_at(min(stop, end_of_text - 1))
        region = "".join(self.text[first : last + 1])
        region = region[: start - before] + inserted + region[stop - before :]
        parts = leaves_of(region)
        slots = last - first + 1
        if len(parts) > slots and len(region) > TOO_LONG * LEAF * slots:
            kept = list(zip(self.text, self.tokens[self.n :], strict=True))
            new = [(t, self._count(t)) for t in parts]
            self._fill([x for x in kept[:first] + new + kept[last + 1 :] if x[0]] or [("", 0)])
            self.dealt = True
            return
        parts = parts[: slots - 1] + ["".join(parts[slots - 1 :])] if len(parts) > slots else parts
        parts += [""] * (slots - len(parts))
        self.touched.update(range(first, last + 1))
        for k, t in enumerate(parts, first):
            self.text[k] = t
            self.chars[self.n + k] = len(t)
            self.tokens[self.n + k] = self._count(t)
        lo, hi = (self.n + first) // 2, (self.n + last) // 2
        while lo:
            for i in range(lo, hi + 1):
                self._sum(i)
            lo, hi = lo // 2, hi // 2


COUNTS = (
    "doc_id bigint, tokens_before bigint, tokens_after bigint, n_edits bigint, chars_after bigint, chars_encoded bigint"
)


def _counter(paths):
    names = [x.split()[0] for x in COUNTS.split(", ")]

    def count(batches):
        encode = encoder(paths)
        for b in batches:
            out: tuple[list, ...] = tuple([] for _ in names)
            texts, lists = b["text"], b["edits"]
            for i, doc in enumerate(b["doc_id"].to_pylist()):
                tree = CountTree(texts[i].as_py() or "", encode)
                before, tree.encoded = tree.total, 0
                edits = lists[i].as_py() or []
                for e in edits:
                    tree.edit(e["start"] or 0, e["removed"] or 0, e["inserted"] or "")
                row = (doc, before, tree.total, len(edits), tree.length, tree.encoded)
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    return count


def _logs(edits: DataFrame) -> DataFrame:
    """``doc_id, edits``: each document's edits in order."""
    one = F.struct(
        F.col("seq").cast("bigint").alias("seq"),
        F.col("start").cast("bigint").alias("start"),
        F.col("removed").cast("bigint").alias("removed"),
        F.col("inserted").cast("string").alias("inserted"),
    )
    rows = edits.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    return rows.agg(F.array_sort(F.collect_list(one)).alias("edits"))


def edited_counts(docs: DataFrame, edits: DataFrame, tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """Counts before and after the edits, per row of ``doc_id, text``.

    ``edits`` has ``doc_id, seq, start, removed, inserted``. ``chars_encoded``
    is what the edits re-encoded.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(_logs(edits), "doc_id", "left")
    return rows.select("doc_id", "text", "edits").mapInArrow(tidy(_counter(tokenizer or default_tokenizer())), COUNTS)


# --- trees kept between batches ----------------------------------------------

LEAVES = "doc_id bigint, tree bigint, version int, slot int, text string, chars bigint, tokens bigint, encoded bigint"
_LEAF_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]


def _leaf_rows(out):
    cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _LEAF_TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in LEAVES.split(", ")])


def _own_leaves(tree: CountTree, doc, name, version: int, slots):
    """Rows of some slots; the first one tells what was encoded for all."""
    encoded = tree.encoded
    for k in slots:
        text = tree.text[k] if k < tree.n else ""
        tokens = tree.tokens[tree.n + k] if k < tree.n else 0
        yield (doc, name, version, k, text, len(text), tokens, encoded)
        encoded = 0


def _planter(paths):
    def plant(batches):
        encode, out = encoder(paths), []
        for b in batches:
            for doc, name, text in zip(*(b[c].to_pylist() for c in ("doc_id", "tree", "text")), strict=True):
                tree = CountTree(text or "", encode)
                # the slots after the last leaf are empty and need no row
                out += _own_leaves(tree, doc, name, 0, [k for k, t in enumerate(tree.text) if t or k == 0])
                if len(out) >= 2048:
                    yield _leaf_rows(out)
                    out = []
        if out:
            yield _leaf_rows(out)

    return plant


def _grower(paths, version):
    def grow(batches):
        encode, out = encoder(paths), []
        for b in batches:
            for doc, name, kept, edits in zip(*(b[c].to_pylist() for c in ("doc_id", "tree", "kept", "edits")), strict=True):
                slots: list[tuple[str, int]] = [("", 0)] * (max(x["slot"] for x in kept) + 1)
                for x in kept:
                    slots[x["slot"]] = (x["text"], x["tokens"])
                tree = CountTree("", encode, slots)
                for e in edits:
                    tree.edit(e["start"] or 0, e["removed"] or 0, e["inserted"] or "")
                changed = range(max(len(slots), tree.n)) if tree.dealt else sorted(tree.touched)
                out += _own_leaves(tree, doc, name, version, changed)
                if len(out) >= 2048:
                    yield _leaf_rows(out)
                    out = []
        if out:
            yield _leaf_rows(out)

    return grow


def plant(docs: DataFrame, tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """Leaves of the trees of ``docs`` (``doc_id, text``), to be written as a
    table: each row of ``docs`` gets a tree with a number of its own, and each
    leaf a row. ``encoded``, summed, is the characters that were encoded.

    The numbers are those of Spark's rows: take them from the written table, not
    from the frame again."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("tree"), "text")
    return rows.mapInArrow(tidy(_planter(tokenizer or default_tokenizer())), LEAVES)


def current(leaves: DataFrame) -> DataFrame:
    """The latest version of each leaf of a table that batches were added to."""
    last = F.max_by(F.struct("doc_id", "text", "chars", "tokens"), "version").alias("x")
    return leaves.groupBy("tree", "slot").agg(last).select("x.doc_id", "tree", "slot", "x.text", "x.chars", "x.tokens")


def grow(leaves: DataFrame, edits: DataFrame, version: int, tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """The leaves that a batch of edits changes, to be added to the table as
    ``version`` (1, 2, ... by batch): rows like those of :func:`plant`.

    Only trees with edits are read, no leaf is encoded but those that an edit
    touches, and no other leaf is written. An emptied slot stays as an empty
    leaf. A document's tree and its edits meet as one row.
    """
    logs = _logs(edits)
    slot = F.struct("slot", "text", "tokens")
    trees = current(leaves.join(logs.select("doc_id"), "doc_id", "left_semi")).groupBy("tree")
    rows = trees.agg(F.max("doc_id").alias("doc_id"), F.collect_list(slot).alias("kept")).join(logs, "doc_id")
    return rows.select("doc_id", "tree", "kept", "edits").mapInArrow(tidy(_grower(tokenizer or default_tokenizer(), version)), LEAVES)


def totals(leaves: DataFrame) -> DataFrame:
    """``doc_id, tree, chars, tokens`` of each tree, summed over its leaves; the
    texts are not read."""
    last = F.max_by(F.struct("doc_id", "chars", "tokens"), "version").alias("x")
    rows = leaves.groupBy("tree", "slot").agg(last)
    return rows.groupBy("x.doc_id", "tree").agg(F.sum("x.chars").alias("chars"), F.sum("x.tokens").alias("tokens"))


def sample_edits(docs: DataFrame, per_document: int = 4) -> DataFrame:
    """Stand-in edit log, so many edits for each distinct doc_id that is not
    null: places (within the longest of its texts) and lengths by hash."""
    n = F.length(F.coalesce("text", F.lit("")))
    known = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max(n).alias("n"))
    rows = known.select("doc_id", "n", F.explode(F.sequence(F.lit(1), F.lit(per_document))).alias("seq"))
    h = lambda salt: F.xxhash64("doc_id", "seq", F.lit(salt))
    words = F.array(*map(F.lit, ("", " and", "'s", "  ", "\n", "x1", " don't stop", "é")))
    return rows.select(
        "doc_id",
        "seq",
        F.pmod(h(1), F.col("n") + 1).alias("start"),
        F.pmod(h(2), F.lit(30)).alias("removed"),
        F.element_at(words, (F.pmod(h(3), F.lit(8)) + 1).cast("int")).alias("inserted"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The query ``op5``: every document under a stand-in log of four edits."""
    return edited_counts(docs, sample_edits(docs))
