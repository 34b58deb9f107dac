"""Property tests (hypothesis): each example is a batch of lines checked in
one Spark job against plain-Python models of the original semantics."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from linecraft.functions import split_lines, split_words
from linecraft.operators import access_log_counts, tag_access_log

from test_text import hadoop_lines, java_split_space

LINE_CHARS = st.sampled_from(["a", "b", " ", " ", "\t", "\u00a0", "é", "\u0085"])
lines_st = st.lists(st.text(LINE_CHARS, max_size=10), min_size=1, max_size=25)
TEXT_CHARS = st.sampled_from(["a", " ", "\n", "\r", "x"])
texts_st = st.lists(st.text(TEXT_CHARS, max_size=12), min_size=1, max_size=25)
SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(lines=lines_st)
def test_split_words_is_java_split(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    got = {r.i: r.w for r in df.select("i", split_words("line").alias("w")).collect()}
    assert all(got[i] == java_split_space(s) for i, s in enumerate(lines))


@settings(**SETTINGS)
@given(texts=texts_st)
def test_split_lines_is_file_reader(spark, texts):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, text string")
    got = {r.i: r.l for r in df.select("i", split_lines("text").alias("l")).collect()}
    assert all(got[i] == hadoop_lines(s) for i, s in enumerate(texts))


PIECES = st.sampled_from(
    ["h", " ", "-", "[01/Aug/1995:00:00:01 -0400]", '"GET /a HTTP/1.0"', '"GET /a"', "200", "404",
     "12", "-", "x", "\u0001", '"', "[", "]"]
)
log_lines_st = st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=1, max_size=30)

_P = re.compile(r'(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)', re.ASCII)


@settings(**SETTINGS)
@given(lines=log_lines_st)
def test_tag_matches_whole_line_regex_and_counts_add_up(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
    tagged = tag_access_log(df)
    rows = {r.i: r for r in tagged.collect()}
    for i, s in enumerate(lines):
        m = _P.fullmatch(s)
        assert (rows[i].reject_reason == "no_match") == (m is None), repr(s)
        if m is not None:
            assert rows[i].remote_host == m.group(1) and rows[i].endpoint == m.group(6)
    c = access_log_counts(tagged).first()
    assert c.total == len(lines) == c.failed + c.ok


SIZE_CHARS = st.sampled_from(["0", "1", "9", "+", "-", ".", "x", " ", "\u0085", "\u0001", "٣"])
sizes_st = st.lists(
    st.one_of(st.text(SIZE_CHARS, min_size=1, max_size=6),
              st.integers(min_value=-(2**64), max_value=2**64).map(str)),
    min_size=1, max_size=25,
)


def java_long_or_none(s):
    """Plain-Python model of the size rule: '-' is 0, else Long.parseLong
    restricted to ASCII digits (null when it would throw)."""
    if s == "-":
        return 0
    if not re.fullmatch(r"[+-]?[0-9]+", s, re.ASCII):
        return None
    v = int(s)
    return v if -(2**63) <= v < 2**63 else None


@settings(**SETTINGS)
@given(sizes=sizes_st)
def test_content_size_is_java_long(spark, sizes):
    from linecraft.functions import content_size

    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", content_size("s").alias("v")).collect()}
    assert all(got[i] == java_long_or_none(s) for i, s in enumerate(sizes)), [
        (s, got[i]) for i, s in enumerate(sizes) if got[i] != java_long_or_none(s)
    ]
