"""Expressions for line and word splitting.

Written once as Spark SQL text (``*_sql`` take a column name or SQL
expression); the Column forms wrap it with ``F.expr``. All are built-in
expressions, so they run inside whole-stage codegen with no Python in the
hot path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import WORD_SEPARATOR

# Line terminators as the Hadoop line reader sees them; `\r\n` is one break.
LINE_BREAK_REGEX = r"\r\n|\r|\n"
# The same alternation spelt with the characters themselves, so the SQL text
# holds no backslash (the meaning of one depends on the session's escape
# setting).
_CR, _LF = "chr(13)", "chr(10)"
# Spark's chr() only covers 0-255: the byte-order mark goes in as itself.
_BOM = "\ufeff"
_LINE_BREAK_SQL = f"concat({_CR}, {_LF}, '|', {_CR}, '|', {_LF})"
assert WORD_SEPARATOR == " "


def split_lines_sql(text: str) -> str:
    r"""array<string> of the lines of a text, with the text-file reader's rules.

    ``\n``, ``\r\n`` and ``\r`` end a line; empty lines are kept; a final
    line break does not open an extra empty line; an empty text has no lines
    (like an empty file); one leading byte-order mark (U+FEFF) is dropped, as
    the reader drops it at the start of a file. A null text gives null (no
    rows after explode).

    The final break is cut with ``endswith`` checks (a regex anchored at the
    end would still be tried at every character), and a text without ``\r``
    is split on ``\n`` alone, which Java splits without the regex engine.
    """
    no_bom = f"substring({text}, 2)"
    # The mark is tested once; each branch then works on a plain expression.
    return (
        f"CASE WHEN startswith({text}, '{_BOM}') THEN {_split_lines_rules(no_bom)} "
        f"ELSE {_split_lines_rules(text)} END"
    )


def _split_lines_rules(t: str) -> str:
    body = (
        f"CASE WHEN endswith({t}, concat({_CR}, {_LF})) THEN left({t}, length({t}) - 2) "
        f"WHEN endswith({t}, {_LF}) OR endswith({t}, {_CR}) THEN left({t}, length({t}) - 1) "
        f"ELSE {t} END"
    )
    return (
        f"CASE WHEN {t} = '' THEN CAST(array() AS array<string>) "
        f"WHEN instr({t}, {_CR}) = 0 THEN split({body}, {_LF}, -1) "
        f"ELSE split({body}, {_LINE_BREAK_SQL}, -1) END"
    )


def split_words_sql(line: str) -> str:
    """array<string> of the words of one line, split on single ASCII spaces.

    Same result as Java's ``line.split(" ")``: a tab does not split, empty
    words between two spaces and a leading empty word are kept, trailing empty
    words are dropped, ``""`` gives ``[""]`` and an all-space line gives ``[]``.
    Spark's ``split`` keeps trailing empties, so trailing spaces are removed
    first (``rtrim`` removes ASCII spaces only).
    """
    return (
        f"CASE WHEN {line} = '' THEN array('') "
        f"WHEN rtrim({line}) = '' THEN CAST(array() AS array<string>) "
        f"ELSE split(rtrim({line}), ' ', -1) END"
    )


def pair_text_sql(key: str, count: str) -> str:
    """``(key,count)``: the text form of a key/count pair (tuple form, no
    quotes, no space)."""
    return f"concat('(', {key}, ',', CAST({count} AS string), ')')"


def split_lines(text: str) -> Column:
    return F.expr(split_lines_sql(text))


def split_words(line: str) -> Column:
    return F.expr(split_words_sql(line))


def pair_text(key: str, count: str) -> Column:
    return F.expr(pair_text_sql(key, count))
