"""Secret scan with a trigram inverted index, in DataFrame operations only.

From each rule's regular expression a Boolean query over trigrams is derived:
every text that the rule matches satisfies it. The index holds, for each
trigram that some query uses, the postings (documents that contain it, letter
case folded). Postings are intersected per document and the rules' queries
evaluated on the result; only candidates are verified with the regular
expression. A rule without mandatory trigrams scans every text.

Null texts count as empty. Rows are independent: repeated rows each get their
spans, and rows that share a ``doc_id`` are verified one by one (the index may
make each a candidate for all). A null ``doc_id`` is not indexed; such rows are
scanned fully. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share, without
    backslashes (``[.]`` for a full stop). A match counts if
    its group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))

BASE_RULES = (
    Rule("assign", f"({_KEYWORDS})[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
)
MORE_RULES = (
    Rule("code_host", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("signed_token", "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

# --- Boolean trigram queries -------------------------------------------------

#: Strings that an exact part of a pattern may expand to before it is closed.
MOST_STRINGS = 64


def _strings(node) -> set[str] | None:
    """All texts that one parsed node matches, case folded; None if too many."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        if any(k is not sre.LITERAL for k, _ in arg):
            return None
        return {chr(v).lower() for _, v in arg} if len(arg) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence_strings(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence_strings(x) for x in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op is sre.MAX_REPEAT and arg[0] == 0 and arg[1] == 1:
        inner = _sequence_strings(arg[2])
        return None if inner is None else inner | {""}
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        s = _strings(node)
        if s is None or len(s) * len(out) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def _conjunctions(strings: set[str]) -> set[frozenset[str]] | None:
    """One set of trigrams per string; None if a string has no trigram."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return None if frozenset() in sets else sets


def trigram_query(pattern: str) -> list[set[frozenset[str]]]:
    """Clauses that all hold for a matching text. A clause holds if the text
    has all trigrams of one of its sets. No clause: no mandatory trigrams."""
    clauses, run = [], {""}

    def close() -> None:
        nonlocal run
        c = _conjunctions(run)
        if c:
            clauses.append(c)
        run = {""}

    def walk(nodes) -> None:
        nonlocal run
        for node in nodes:
            op, arg = node
            s = _strings(node)
            if s is not None and len(s) * len(run) <= MOST_STRINGS:
                run = {a + b for a in run for b in s}
            elif op is sre.SUBPATTERN:
                walk(arg[-1])
            elif op is sre.MAX_REPEAT and arg[0] >= 1:
                inner = _sequence_strings(arg[2])
                if inner is not None and len(inner) * len(run) <= MOST_STRINGS:
                    run = {a + b for a in run for b in inner}
                close()
            else:
                close()
                if s is not None:
                    run = s
        # what follows the sequence may continue the last run

    walk(parser.parse(pattern))
    close()
    return clauses


def dictionary(rules) -> list[str]:
    """The trigrams that the rules' queries use, sorted."""
    return sorted({t for r in rules for clause in trigram_query(r.pattern) for c in clause for t in c})


# --- index and candidates ----------------------------------------------------


def postings(docs: DataFrame, rules=RULES) -> DataFrame:
    """``trigram, doc_id``: the inverted index over the rules' dictionary."""
    grams = dictionary(rules)
    if not grams:
        return docs.select(F.lit("").alias("trigram"), "doc_id").where("false")
    low = docs.where("doc_id is not null").select("doc_id", F.lower("text").alias("low"))
    held = F.filter(F.array(*map(F.lit, grams)), lambda t: F.contains(F.col("low"), t))
    return low.select("doc_id", F.explode(held).alias("trigram")).select("trigram", "doc_id")


#: Trigrams per bit mask.
BITS = 62


def _masks(sets, place: dict[str, int], words: int) -> list[list[int]]:
    out = []
    for s in sets:
        m = [0] * words
        for t in s:
            m[place[t] // BITS] |= 1 << place[t] % BITS
        out.append(m)
    return out


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id, kinds``: kinds of the rules whose queries hold, for documents
    with any posting. Postings of a document meet as bit masks, combined before
    the shuffle; a common trigram makes no long list."""
    grams = dictionary(rules)
    place = {t: i for i, t in enumerate(grams)}
    words = max(1, -(-len(grams) // BITS))
    at = F.array_position(F.array(*map(F.lit, grams or [""])), F.col("trigram")).cast("int") - 1
    bits = [
        F.bit_or(
            F.when(F.floor(F.col("at") / BITS) == w, F.expr(f"shiftleft(1L, at % {BITS})")).otherwise(F.lit(0).cast("long"))
        ).alias(f"m{w}")
        for w in range(words)
    ]
    met = index.select("doc_id", at.alias("at")).groupBy("doc_id").agg(*bits)
    kinds = []
    for r in rules:
        clauses = trigram_query(r.pattern)
        if not clauses:
            continue
        holds = F.lit(True)
        for clause in clauses:
            any_set = F.lit(False)
            for m in _masks(clause, place, words):
                full = F.lit(True)
                for w, bitset in enumerate(m):
                    if bitset:
                        want = F.lit(bitset).cast("long")
                        full = full & (F.col(f"m{w}").bitwiseAND(want) == want)
                any_set = any_set | full
            holds = holds & any_set
        kinds.append(F.when(holds, F.lit(r.kind)))
    if not kinds:
        return met.select("doc_id", F.array().cast("array<string>").alias("kinds"))
    return met.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).where("size(kinds) > 0")


# --- verification ------------------------------------------------------------

SPAN = "array<struct<start:bigint,rank:int,kind:string,stop:bigint>>"
#: Matches whose positions are summed in one go; longer lists go block by block.
BLOCK = 256


def _literal(s: str) -> str:
    """SQL literal. Without backslashes it means the same under any setting of
    the session."""
    if "\\" in s:
        raise ValueError(f"write a character class instead of a backslash: {s}")
    return "'" + s.replace("'", "''") + "'"


def _spans_sql(rule: Rule, rank: int, text: str = "body") -> str:
    """Spans of the leftmost non-overlapping matches, in code points.

    Positions are running sums over the pieces between matches and the matches
    themselves, in blocks, so that many matches cost no quadratic time.
    """
    p = _literal(rule.pattern)
    empty = f"cast(array() as {SPAN})"
    keep = f"length(g) >= {rule.least}"
    steps = (
        f"zip_with(zip_with(slice(split({text}, {p}, -1), 1, size(ms)), ms, (a, m) -> struct(length(a) as gap, length(m) as len)), "
        f"regexp_extract_all({text}, {p}, {rule.group}), (s, g) -> struct(s.gap as gap, s.len as len, {keep} as keep))"
    )
    start = "struct(cast({0} as bigint) as pos, cast(array() as " + SPAN + ") as got)"
    step = (
        "(acc, s) -> struct(acc.pos + s.gap + s.len as pos, "
        "case when s.keep then concat(acc.got, array(struct(acc.pos + s.gap as start, "
        f"{rank} as rank, '{rule.kind}' as kind, acc.pos + s.gap + s.len as stop))) else acc.got end as got)"
    )
    blocks = f"transform(sequence(0, (size(steps) - 1) div {BLOCK}), k -> slice(steps, cast(k * {BLOCK} + 1 as int), {BLOCK}))"
    sums = "transform(blocks, b -> aggregate(b, 0L, (acc, s) -> acc + s.gap + s.len))"
    heads = (
        "aggregate(sums, struct(0L as pos, cast(array() as array<bigint>) as got), "
        "(acc, x) -> struct(acc.pos + x as pos, concat(acc.got, array(acc.pos)) as got)).got"
    )
    body = f"flatten(zip_with(blocks, {heads}, (b, h) -> aggregate(b, {start.format('h')}, {step}).got))"
    # one-element arrays bind a name to a value that is computed once
    body = f"transform(array({sums}), sums -> {body})[0]"
    body = f"transform(array({blocks}), blocks -> {body})[0]"
    body = f"case when size(steps) = 0 then {empty} else {body} end"
    body = f"transform(array({steps}), steps -> {body})[0]"
    body = f"transform(array(regexp_extract_all({text}, {p}, 0)), ms -> case when size(ms) = 0 then {empty} else {body} end)[0]"
    # short matches are many in prose: look for one that is long enough first
    quick = _quick_test(rule)
    return f"case when {text} rlike {_literal(quick)} then {body} else {empty} end" if quick else body


def _quick_test(rule: Rule) -> str | None:
    """For ``[class]+`` rules on the whole match, a test that some match counts."""
    if rule.group == 0 and rule.pattern.startswith("[") and rule.pattern.endswith("]+") and rule.pattern.count("[") == 1:
        return rule.pattern[:-1] + f"{{{rule.least}}}"
    return None


def scan(docs: DataFrame, rules=RULES, into: str = "secret_spans") -> DataFrame:
    """``docs`` with a column ``into``: all spans by start, then in the
    order of ``rules``, as structs (start, rank, kind, stop); stop is exclusive."""
    full = [r.kind for r in rules if not trigram_query(r.pattern)]
    found = candidates(postings(docs, rules), rules).select(F.col("doc_id").alias("__cand_id"), F.col("kinds").alias("__kinds"))
    joined = docs.join(found, docs["doc_id"] == F.col("__cand_id"), "left")
    body = F.coalesce(docs["text"], F.lit(""))
    lists: list[Column] = []
    named = joined.withColumn("__body", body)
    for i, r in enumerate(rules):
        spans = _spans_sql(r, i, "__body")
        if r.kind in full:
            lists.append(F.expr(spans))
        else:
            asked = f"(doc_id is null or coalesce(array_contains(__kinds, '{r.kind}'), false))"
            lists.append(F.expr(f"case when {asked} then {spans} else cast(array() as {SPAN}) end"))
    out = named.withColumn(into, F.array_sort(F.concat(*lists)))
    return out.drop("__cand_id", "__kinds", "__body")


def span_text(spans: str, kinds=None) -> str:
    """SQL for ``kind:start:end`` of the spans (of some kinds), comma-joined."""
    held = spans
    if kinds is not None:
        held = f"filter({spans}, s -> s.kind in ({', '.join(map(_literal, kinds))}))"
    return f"array_join(transform({held}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of the query ``op3``."""
    spans = scan(docs.select("doc_id", "text")).select("doc_id", "secret_spans")
    base = tuple(r.kind for r in BASE_RULES)
    counts = [
        F.expr(f"cast(size(filter(secret_spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in base
    ]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(span_text("secret_spans", base)), 256).alias("base_sha256"),
        F.expr(span_text("secret_spans")).alias("spans"),
    )


#: Code points of the chunks from which kept text is cut.
CHUNK = 1024


def _bound(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for a value computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _furthest_before(spans: str) -> str:
    """SQL for the largest ``stop`` of the spans before each span and, last, of
    all: running maxima by blocks of about the root of the spans' number, so that
    no long array is copied for every span."""
    size = "cast(ceil(sqrt(size(stops))) as int)"
    grow = "(acc, x) -> struct(greatest(acc.high, x) as high, concat(acc.got, array(acc.high)) as got)"
    start = "struct({} as high, cast(array() as array<bigint>) as got)"
    blocks = "transform(sequence(0, (size(stops) - 1) div width), k -> slice(stops, k * width + 1, width))"
    heads = f"aggregate(transform(blocks, b -> array_max(b)), {start.format('0L')}, {grow}).got"
    runs = f"flatten(zip_with(blocks, {heads}, (b, h) -> aggregate(b, {start.format('h')}, {grow}).got))"
    body = f"concat({runs}, array(array_max(stops)))"
    return _bound("stops", f"transform({spans}, s -> s.stop)", _bound("width", size, _bound("blocks", blocks, body)))


def _kept(begin: str, stop: str) -> str:
    """SQL for the text between two places, cut from ``chunks``."""
    first, last = f"cast({begin} div {CHUNK} as int)", f"cast({stop} div {CHUNK} as int)"
    offset, rest = f"cast({begin} % {CHUNK} as int)", f"cast({stop} % {CHUNK} as int)"
    return (
        f"case when {begin} >= {stop} then '' "
        f"when {first} = {last} then substring(chunks[{first}], {offset} + 1, {rest} - {offset}) "
        f"else concat(substring(chunks[{first}], {offset} + 1), array_join(slice(chunks, {first} + 2, {last} - {first} - 1), ''), "
        f"case when {rest} = 0 then '' else substring(chunks[{last}], 1, {rest}) end) end"
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span replaced by ``mark``; overlapping spans
    become one mark. Texts without spans stay as they are, null included. Kept
    text is cut from chunks, so the work grows with the text and its spans, not
    with their product."""
    cols = docs.columns
    got = scan(docs, into="__spans")
    piece = f"case when s.start < h then '' else concat({_kept('h', 's.start')}, {_literal(mark)}) end"
    body = (
        f"concat(array_join(zip_with(slice(highs, 1, size(__spans)), __spans, (h, s) -> {piece}), ''), "
        f"{_kept('highs[size(__spans)]', 'cast(length(text) as bigint)')})"
    )
    body = _bound("highs", _furthest_before("__spans"), body)
    body = _bound("chunks", f"regexp_extract_all(text, '(?s).{{1,{CHUNK}}}', 0)", body)
    text = F.expr(f"case when size(__spans) = 0 then text else {body} end")
    return got.withColumn("text", text).select(*cols)
