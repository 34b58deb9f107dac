"""Repair of conversation structure by weighted CYK parsing of row intervals.

A sound conversation reads ``(s?(ua)+)?`` in its roles' initials: an optional
system row, then user and assistant in turn, or nothing at all. Rows are kept
(cost 0), given the role user or assistant (2) or deleted (3, and nothing else
for a blank or repeated row); an empty row of user or assistant may be inserted
anywhere (2). A truncated row that stays adds 1. Wanted is the cheapest list of
edits, of those the one whose initials (K, R, D, I) come first.

The repair grammar is in Chomsky normal form. Its nonterminals ``N(p, q)``
derive the rows that lead from place ``p`` of the protocol to place ``q``:
``N(p, q) -> N(p, r) N(r, q)`` over two neighbouring spans, and ``N(p, q) ->
row`` for a kept, changed or deleted row. Inserted rows would be empty
productions; closure takes them into the cells of single rows, on both sides.
A span's cell holds the least (cost, audit) of each nonterminal. Cells are
combined bottom-up by span length: 1, 2, 4 rows and so on. Every derivation
passes the border between two neighbouring spans in some place ``r``, so one
cut per span finds all derivations. Equal-cost audits of one span and
nonterminal are never prefixes of each other (what follows would be inserts,
which cost), so the least audit of a span is made of least audits of its parts.

Spark sorts rows by (conversation, turn, hash of role and text) in ranges, so a
conversation of any size lies in several tasks; each task parses its fragments,
and the cells of the fragments are combined like any other spans. Equal rows
of a turn are added up before. An audit is one row of the result and so is held
whole: a byte for each row of its conversation, and a few times that for cells.

Nulls: a null turn comes first; a null role or text is one space; null conv_id
is one conversation. Rows of the same turn come by the SHA-256 of role and
text. A row without a role (empty text) has no initial and can't be kept.
Repeated rows are duplicates. An empty table gives no rows. Extra columns are
not read. Gaps beyond a long are the greatest long.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import process_cache, stored, tidy

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
STAYS_TRUNCATED = 1
#: Places of the protocol: nothing yet, after s, after u, after a.
PLACES = 4
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
#: Bytes of repaired text that leave a task at once for a cut conversation.
CHUNK = 1 << 20

# One letter stands for a row: its initial (x: another), upper case if it is
# truncated, D if it has to be deleted.
_LETTERS = "suax"


# --- grammar -----------------------------------------------------------------


def _better(a, b):
    return b if a is None or (b is not None and b < a) else a


def _inserts():
    """Least (cost, audit) of insert-only ways from place to place."""
    ways = {(p, p): (0, "") for p in range(PLACES)}
    for _ in range(PLACES):
        for (p, r), (cost, audit) in list(ways.items()):
            for (at, _), q in ((k, v) for k, v in STEPS.items() if k[1] in "ua"):
                if at == r:
                    ways[p, q] = _better(ways.get((p, q)), (cost + INSERT, audit + "I"))
    return ways


def _row_ways(letter):
    """Least (cost, audit) of one row, without inserts."""
    ways = {(p, p): (DELETE, "D") for p in range(PLACES)}
    if letter == "D":
        return ways
    more = STAYS_TRUNCATED if letter.isupper() else 0
    for (p, role), q in STEPS.items():
        if role == letter.lower():
            ways[p, q] = _better(ways.get((p, q)), (KEEP + more, "K"))
        if role in "ua":
            ways[p, q] = _better(ways.get((p, q)), (REROLE + more, "R"))
    return ways


def _joined(*parts):
    out = parts[0]
    for ways in parts[1:]:
        new: dict = {}
        for (p, r), (c, a) in out.items():
            for (s, q), (d, b) in ways.items():
                if r == s:
                    new[p, q] = _better(new.get((p, q)), (c + d, a + b))
        out = new
    return out


#: The nonterminals that derive anything, and the binary rules over them as
#: (result, left, right) indices.
PAIRS = sorted({pq for x in _LETTERS for pq in _joined(_inserts(), _row_ways(x), _inserts())})
_AT = {pq: i for i, pq in enumerate(PAIRS)}
RULES = [
    (_AT[p, q], _AT[p, r], _AT[r, q]) for p, r in PAIRS for s, q in PAIRS if r == s
]  # every such (p, q) derives something too
TERMINALS = {
    x: tuple(_joined(_inserts(), _row_ways(x), _inserts()).get(pq) for pq in PAIRS)
    for x in [*_LETTERS, *_LETTERS.upper(), "D"]
}


def combined(left: tuple, right: tuple) -> tuple:
    """The cell of two neighbouring spans."""
    out: list = [None] * len(PAIRS)
    for at, i, j in RULES:
        a, b = left[i], right[j]
        if a is None or b is None:
            continue
        cost, have = a[0] + b[0], out[at]
        if have is None or cost < have[0]:
            out[at] = (cost, a[1] + b[1])
        elif cost == have[0]:
            audit = a[1] + b[1]
            if audit < have[1]:
                out[at] = (cost, audit)
    return tuple(out)


def chart(cells: list[tuple]) -> tuple:
    """The cell of all spans in order, bottom-up by span length."""
    while len(cells) > 1:
        pairs = [combined(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0]


#: Cells of spans of at most this many rows are kept for the next conversation,
#: so many of them.
KNOWN_SPAN, MOST_KNOWN = 8, 1 << 15


def _known(letters: str) -> tuple:
    if len(letters) == 1:
        return TERMINALS[letters]
    cache = process_cache().setdefault("cells", {})
    if letters not in cache:
        half = 1 << (len(letters) - 1).bit_length() - 1
        if len(cache) >= MOST_KNOWN:
            cache.clear()
        cell = combined(_known(letters[:half]), _known(letters[half:]))
        cache[letters] = cell
        return cell
    return cache[letters]


def parse(letters: str) -> tuple:
    """The cell of a span of rows."""
    return chart([_known(letters[i : i + KNOWN_SPAN]) for i in range(0, len(letters), KNOWN_SPAN)])


def best(cell: tuple) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    return min(w for pq, w in zip(PAIRS, cell, strict=True) if pq[0] == 0 and pq[1] in ENDS and w)


# --- rows --------------------------------------------------------------------

#: ``[\x20\x09-\x0D]``, as characters.
_SPACE = " \t\n\x0b\x0c\r"


def damage(conversations: DataFrame) -> DataFrame:
    """The rows ``conv_id, turn, role, text`` after the contract's damage."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.pmod(F.crc32(F.concat(named[0], F.lit(":"), named[1])), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", fate.alias("fate"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text")
    ).where("fate <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "")
        .when(F.col("fate") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("fate") == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the place of each row in its conversation: ``timed, at, key``."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1).cast("bigint")
    rows = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.alias("copies"),
    )
    return rows.select(
        "conv_id",
        F.col("turn").isNotNull().cast("int").alias("timed"),
        F.coalesce("turn", F.lit(0)).alias("at"),
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("key"),
        "role",
        "text",
        "copies",
    )


def _marks(keyed: DataFrame) -> DataFrame:
    """One narrow row for the equal rows of a turn: ``kind`` is 3 times the place
    of the initial in ``suax``, plus 1 for truncated, 2 for blank; ``later`` tells
    that an earlier turn has the same role and text."""
    body = F.rtrim("text", F.lit(_SPACE))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    state = F.when(body == "", 2).when(F.right(body, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    rows = keyed.select("conv_id", "timed", "at", "key", "copies", (code * 3 + state).alias("kind"))
    marks = rows.groupBy("conv_id", "timed", "at", "key").agg(F.max("kind").alias("kind"), F.sum("copies").alias("n"))
    place = F.struct("timed", "at")
    firsts = (
        marks.groupBy("conv_id", "key")
        .agg(F.min("timed").alias("timed0"), F.min(F.when(F.col("timed") == 1, F.col("at"))).alias("at0"), F.count("*").alias("turns"))
        .where("turns > 1")
        .select(
            F.col("conv_id").alias("conv"), F.col("key").alias("seen"),
            F.struct(F.col("timed0").alias("timed"), F.when(F.col("timed0") == 0, F.lit(0)).otherwise(F.col("at0")).alias("at")).alias("first"),
        )
    )
    met = marks.join(firsts, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("key") == F.col("seen")), "left")
    return met.select(
        "conv_id", "timed", "at", "key", "kind", "n", F.coalesce(place > F.col("first"), F.lit(False)).alias("later")
    )


# --- fragments ---------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_FRAGMENT = (
    "conv_id bigint, part int, timed int, at bigint, key binary, rows bigint, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, head int, tail int, "
    "turns bigint, low bigint, high bigint, costs array<bigint>, audits array<string>"
)
_FRAGMENT_TYPES = [
    pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), *[pa.int64()] * 4, pa.int32(), pa.int32(),
    *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.string()),
]


def _rows_of(out, types, schema):
    names = [x.split()[0] for x in schema.split(", ")]
    cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(cols, names)


def _legal(a: int, b: int) -> bool:
    return _LETTERS[a] + _LETTERS[b] in LEGAL


class _Fragment:
    """Rows of one conversation in one task, in order."""

    def __init__(self, conv, timed, at, key):
        self.start = (conv, timed, at, key)
        self.letters: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = self.low = self.high = None

    def add(self, timed, at, kind, n, later):
        code, state = divmod(kind, 3)
        if timed and at != self.high:
            self.turns += 1
            self.high = at
            self.low = at if self.low is None else self.low
        if self.tail is None:
            self.head = code
        else:
            self.illegal += not _legal(self.tail, code)
        self.illegal += (n - 1) * (not _legal(code, code))
        self.tail = code
        if state == 2:
            self.blank += n
            self.letters.append("D" * n)
        elif later:
            self.duplicate += n
            self.letters.append("D" * n)
        else:
            self.duplicate += n - 1
            self.truncated += state
            x = _LETTERS[code]
            self.letters.append((x.upper() if state else x) + "D" * (n - 1))

    def row(self, part):
        conv, timed, at, key = self.start
        letters = "".join(self.letters)
        cell = parse(letters)
        return (
            conv, part, timed, at, key, len(letters), self.blank, self.duplicate, self.truncated, self.illegal,
            self.head, self.tail, self.turns, self.low, self.high,
            [w and w[0] for w in cell], [w and w[1] for w in cell],
        )


def _fragments(batches):
    """Sorted rows of a range: one row per conversation met."""
    from pyspark import TaskContext

    part, here, out = TaskContext.get().partitionId(), None, []
    for b in batches:
        cols = [b[c].to_pylist() for c in ("conv_id", "timed", "at", "key", "kind", "n", "later")]
        for conv, timed, at, key, kind, n, later in zip(*cols, strict=True):
            if here is None or here.start[0] != conv:
                if here is not None:
                    out.append(here.row(part))
                here = _Fragment(conv, timed, at, key)
            here.add(timed, at, kind, n, later)
        if len(out) >= 4096:
            yield _rows_of(out, _FRAGMENT_TYPES, _FRAGMENT)
            out = []
    if here is not None:
        out.append(here.row(part))
    if out:
        yield _rows_of(out, _FRAGMENT_TYPES, _FRAGMENT)


_SCRIPT = (
    "conv_id bigint, part int, parts int, timed int, at bigint, key binary, gaps bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, cost bigint, audit string, segment string, offset bigint, lead int"
)
_SCRIPT_TYPES = [
    pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), *[pa.int64()] * 6, pa.string(), pa.string(),
    pa.int64(), pa.int32(),
]


def segments(audit: str, rows: list[int]) -> list[str]:
    """Cut an audit at fragments of so many rows; inserts go to the fragment
    that follows them, the last ones to the last."""
    out, at = [], 0
    for n in rows:
        begin = at
        while n:
            n -= audit[at] != "I"
            at += 1
        out.append(audit[begin:at])
    out[-1] += audit[at:]
    return out


def _whole(found: list[dict]):
    """Script rows of a conversation's fragments."""
    cell = chart(
        [tuple(None if c is None else (c, a) for c, a in zip(f["costs"], f["audits"], strict=True)) for f in found]
    )
    cost, audit = best(cell)
    counts = [sum(f[k] for f in found) for k in _COUNTS]
    counts[3] += sum(not _legal(x["tail"], y["head"]) for x, y in zip(found, found[1:], strict=False))
    timed = [f for f in found if f["low"] is not None]
    turns = sum(f["turns"] for f in timed) - sum(x["high"] == y["low"] for x, y in zip(timed, timed[1:], strict=False))
    gaps = min(timed[-1]["high"] - timed[0]["low"] + 1 - turns, (1 << 63) - 1) if timed else 0
    lead, offset = (len(audit) - audit.count("D")) % 2, 0
    for i, (f, own) in enumerate(zip(found, segments(audit, [f["rows"] for f in found]), strict=True)):
        yield (
            f["conv_id"], i, len(found), f["timed"], f["at"], f["key"], gaps, *counts, cost, None if i else audit, own,
            offset, lead,
        )
        offset += len(own) - own.count("D")


def _scripts(batches):
    """Fragments of a task by (conversation, part): their scripts."""
    found: list[dict] = []
    out: list[tuple] = []
    for b in batches:
        for f in b.to_pylist():
            if found and found[0]["conv_id"] != f["conv_id"]:
                out += _whole(found)
                found = []
            found.append(f)
        if len(out) >= 4096:
            yield _rows_of(out, _SCRIPT_TYPES, _SCRIPT)
            out = []
    if found:
        out += _whole(found)
    if out:
        yield _rows_of(out, _SCRIPT_TYPES, _SCRIPT)


def scripts(rows: DataFrame) -> DataFrame:
    """Edit scripts of ``rows`` (``conv_id, turn, role, text``, optionally
    ``copies``), one row per fragment; the first one (``part`` 0) has the whole
    audit. Columns: ``conv_id, part, parts``, where the fragment begins,
    the counts, ``cost, audit``, and its ``segment`` of the audit with the number
    of repaired rows before it."""
    width = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["conv_id", "timed", "at", "key"]
    cells = (
        _marks(_keyed(rows))
        .repartitionByRange(width, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(tidy(_fragments), _FRAGMENT)
    )
    return cells.repartition(width, "conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(tidy(_scripts), _SCRIPT)


# --- repaired rows -----------------------------------------------------------


def _placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows and scripts by fragment, in order, the script first.

    The borders of cut conversations (at most one for each task that sorted
    them) are broadcast; all other rows are of part 0.
    """
    width = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = plan.where("part > 0").groupBy(F.col("conv_id").alias("conv"))
    borders = cut.agg(F.collect_list(F.struct("timed", "at", "key")).alias("borders"))
    keyed = _keyed(rows).join(F.broadcast(borders), F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    here = F.struct("timed", "at", "key")
    part = F.coalesce(F.size(F.filter("borders", lambda x: x <= here)), F.lit(0))
    part = F.when(F.col("borders").isNull(), 0).otherwise(part)
    own = keyed.select("conv_id", part.alias("part"), F.lit(1).alias("row"), "timed", "at", "key", "role", "text", "copies")
    head = plan.select(
        "conv_id", "part", F.lit(0).alias("row"), F.lit(0).alias("timed"), F.col("offset").alias("at"),
        F.lit(None).cast("binary").alias("key"), F.col("lead").cast("string").alias("role"), F.col("segment").alias("text"),
        F.col("parts").cast("bigint").alias("copies"),
    )
    both = head.unionByName(own).repartition(width, "conv_id", "part")
    return both.sortWithinPartitions("conv_id", "part", "row", "timed", "at", "key")


def _edited(batches):
    """(conv, part, parts, position, edit, role, text, timed, at) of each repaired
    row; a fragment without any gives one with the edit None."""
    turn_of = ("user", "assistant")
    head, segment, at, position, lead, parts = None, "", 0, 0, 0, 0

    def inserted():
        nonlocal at, position
        while at < len(segment) and segment[at] == "I":
            yield (*head, parts, position, "I", turn_of[(position - lead) % 2], "", 0, 0)
            at += 1
            position += 1

    for b in batches:
        cols = [b[c].to_pylist() for c in ("conv_id", "part", "row", "timed", "at", "role", "text", "copies")]
        for conv, part, row, timed, turn, role, text, copies in zip(*cols, strict=True):
            if row == 0:
                if head is not None:
                    yield from inserted()
                head, segment, at, position, lead, parts = (conv, part), text, 0, turn, int(role), copies
                yield (*head, parts, position, None, None, None, 0, 0)
                continue
            for _ in range(copies):
                yield from inserted()
                edit = segment[at]
                at += 1
                if edit == "D":
                    continue
                own = role if edit == "K" else turn_of[(position - lead) % 2]
                yield (*head, parts, position, edit, own, text, timed, turn)
                position += 1
    if head is not None:
        yield from inserted()


_REPAIRED = "conv_id bigint, position bigint, edit string, turn bigint, role string, text string"
_REPAIRED_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]


def _repaired(batches):
    out = []
    for conv, _, _, position, edit, role, text, timed, turn in _edited(batches):
        if edit is not None:
            out.append((conv, position, edit, turn if timed else None, role, text))
        if len(out) >= 1024:
            yield _rows_of(out, _REPAIRED_TYPES, _REPAIRED)
            out = []
    if out:
        yield _rows_of(out, _REPAIRED_TYPES, _REPAIRED)


def repaired(rows: DataFrame) -> DataFrame:
    """The rows of all conversations after repair: ``conv_id, position`` (from
    0), ``edit`` (K, R or I), ``turn`` (null for inserted rows), ``role, text``."""
    plan = stored(scripts(rows), "scripts")
    return _placed(rows, plan).mapInArrow(tidy(_repaired), _REPAIRED)


_HASHED = "conv_id bigint, part int, piece int, sha string, bytes binary"
_HASHED_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary()]


def _hashed(batches):
    """SHA-256 of conversations that lie in one fragment; the text of others in
    pieces of about ``CHUNK`` bytes."""
    out: list[tuple] = []
    here, state, held, size, piece = None, None, [], 0, 0

    def closed():
        if here is not None:
            out.append((*here, piece, state.hexdigest(), None) if state else (*here, piece, None, b"".join(held)))

    for conv, part, parts, position, edit, role, text, _, _ in _edited(batches):
        if edit is None:
            closed()
            here, state, held, size, piece = (conv, part), hashlib.sha256() if parts == 1 else None, [], 0, 0
        else:
            line = (("\n" if position else "") + role + ":" + text).encode()
            if state:
                state.update(line)
            else:
                held.append(line)
                size += len(line)
                if size > CHUNK:
                    out.append((*here, piece, None, b"".join(held)))
                    held, size, piece = [], 0, piece + 1
        if len(out) >= 1024 or (out and out[-1][4]):
            yield _rows_of(out, _HASHED_TYPES, _HASHED)
            out.clear()
    closed()
    if out:
        yield _rows_of(out, _HASHED_TYPES, _HASHED)


def _hash_pieces(batches):
    here, state = (), None
    for b in batches:
        out = []
        for conv, own in zip(b["conv_id"].to_pylist(), b["bytes"], strict=True):
            if here != (conv,):
                if here:
                    out.append((*here, state.hexdigest()))
                here, state = (conv,), hashlib.sha256()
            state.update(own.as_buffer())
        if out:
            yield _rows_of(out, [pa.int64(), pa.string()], "conv_id bigint, sha string")
    if here:
        yield _rows_of([(*here, state.hexdigest())], [pa.int64(), pa.string()], "conv_id bigint, sha string")


def repair_hashes(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``conv_id, sha``: SHA-256 of the repaired ``role:text``, newline-joined. A
    cut conversation's text is hashed in order, piece by piece."""
    width = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = stored(_placed(rows, plan).mapInArrow(tidy(_hashed), _HASHED), "hashes")
    pieces = found.where("sha is null").repartition(width, "conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return found.where("sha is not null").select("conv_id", "sha").union(
        pieces.select("conv_id", "bytes").mapInArrow(_hash_pieces, "conv_id bigint, sha string")
    )


def digest(conversations: DataFrame) -> DataFrame:
    """The contract's columns of the query ``op13``."""
    rows = damage(conversations)
    plan = stored(scripts(rows), "scripts")
    hashes = repair_hashes(rows, plan).select(F.col("conv_id").alias("hashed"), "sha")
    counts = ["gaps", *_COUNTS, "cost"]
    whole = plan.where("part = 0").select(F.col("conv_id").alias("conv"), *counts, "audit")
    every = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    return (
        every.join(whole, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
        .join(hashes, F.col("conv_id").eqNullSafe(F.col("hashed")), "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
        )
    )
