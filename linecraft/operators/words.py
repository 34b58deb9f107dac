"""Word count: tokenise lines, count each word."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import quote
from ..functions.text import pair_text, split_words


def tokenize(lines: DataFrame, line_col: str = "line", keep: Iterable[str] = ()) -> DataFrame:
    """One row per word: the ``keep`` columns and ``word string``.

    Words come from splitting each line on single ASCII spaces with Java's
    ``String.split(" ")`` rules (see :func:`linecraft.functions.split_words`);
    no case folding, no punctuation removal.
    """
    return lines.select(*keep, F.explode(split_words(quote(line_col))).alias("word"))


def word_count(words: DataFrame, word_col: str = "word") -> DataFrame:
    """``word string, cnt bigint``: occurrences of each exact (case-sensitive)
    word.

    Planned as partial count per task → hash exchange on ``word`` → final
    count, so a word that makes up a third of the input still sends one row
    per map task, not one per occurrence.
    """
    return words.groupBy(F.col(word_col).alias("word")).agg(F.count(F.lit(1)).alias("cnt"))


def count_words(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """:func:`tokenize` then :func:`word_count`."""
    return word_count(tokenize(lines, line_col))


def count_words_and_marks(lines: DataFrame, line_col: str, marks: Column) -> DataFrame:
    """:func:`count_words` of a scan whose rows also carry ``marks``, an array of
    strings that are counted beside the words. No mark may look like a word:
    each holds a space."""
    marked = lines.select(quote(line_col), marks.alias("__marks"))
    tokens = F.concat(split_words(quote(line_col)), F.col("__marks"))
    return word_count(marked.select(F.explode(tokens).alias("word")))


def word_count_text(counts: DataFrame) -> DataFrame:
    """``value string``: each pair as ``(word,cnt)``, the text-file form."""
    return counts.select(pair_text("word", "cnt").alias("value"))
