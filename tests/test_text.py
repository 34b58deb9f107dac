"""Line splitting and Java-style word splitting."""

import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import write_bytes
from linecraft.functions import pair_text, split_lines, split_words
from linecraft.operators import count_words, tokenize, widen, word_count, word_count_text
from linecraft.sources import lines_of, read_lines

# Expected words per line, from Java's String.split(" ").
TOKEN_CASES = [
    ("", [""]),
    (" ", []),
    ("   ", []),
    (" a", ["", "a"]),
    ("a ", ["a"]),
    ("a  b", ["a", "", "b"]),
    ("a b  ", ["a", "b"]),
    ("\ta b", ["\ta", "b"]),
    ("a\t", ["a\t"]),
    ("a b", ["a b"]),
]


def java_split_space(s):
    """Plain-Python model of Java's s.split(" ")."""
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def hadoop_lines(text):
    """Plain-Python model of the text-file line reader on one file's content."""
    if text.startswith("\ufeff"):
        text = text[1:]
    if text == "":
        return []
    body = re.sub(r"(\r\n|\r|\n)\Z", "", text)
    return re.split(r"\r\n|\r|\n", body)


def test_java_model_matches_cases():
    for line, want in TOKEN_CASES:
        assert java_split_space(line) == want, line


def test_split_words_cases(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(TOKEN_CASES)], "i int, line string")
    got = {r.i: r.w for r in df.select("i", split_words("line").alias("w")).collect()}
    for i, (line, want) in enumerate(TOKEN_CASES):
        assert got[i] == want, repr(line)


def test_split_words_random_lines(spark):
    rnd = random.Random(7)
    alphabet = ["a", "b", " ", " ", "\t", "é", " "]
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    got = {r.i: r.w for r in df.select("i", split_words("line").alias("w")).collect()}
    for i, s in enumerate(lines):
        assert got[i] == java_split_space(s), repr(s)


def test_read_lines_breaks(spark, tmp_path):
    p = write_bytes(tmp_path / "a.txt", b"a b\r\nc\rd\n\ne")
    assert [r.value for r in read_lines(spark, p).collect()] == ["a b", "c", "d", "", "e"]


def test_split_lines_matches_file_reader(spark, tmp_path):
    texts = ["a b\r\nc\rd\n\ne", "x\n", "x\n\n", "\n", "\r\n\r\n", "one", "a\r\rb", "", "tail\r",
             "\ufeffa b\nc\n", "\ufeff", "\ufeff\n", "\ufeff\ufeffx\n", "a\ufeff\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.lines for r in df.select("i", split_lines("text").alias("lines")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == hadoop_lines(t), repr(t)
        p = write_bytes(tmp_path / f"f{i}.txt", t.encode())
        assert [r.value for r in read_lines(spark, p).collect()] == got[i], repr(t)


def test_lines_of_null_text(spark):
    df = spark.createDataFrame([(1, None), (2, "a\nb")], "doc_id int, text string")
    assert sorted(tuple(r) for r in lines_of(df, "text", keep=["doc_id"]).collect()) == [(2, "a"), (2, "b")]


def test_gzip_and_glob(spark, tmp_path):
    with gzip.open(tmp_path / "x.log.gz", "wb") as f:
        f.write(b"a a\nb\n")
    write_bytes(tmp_path / "y.log", b"a c\n")
    df = read_lines(spark, str(tmp_path / "*.log*"))
    assert sorted(r.value for r in df.collect()) == ["a a", "a c", "b"]
    counts = {r.word: r.cnt for r in count_words(df, "value").collect()}
    assert counts == {"a": 3, "b": 1, "c": 1}


def test_word_count_sum_equals_tokens(spark):
    rnd = random.Random(11)
    words = ["the", "The", "a", "", "x.y", "é"]
    lines = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame([(s,) for s in lines], "line string")
    counts = word_count(tokenize(df)).collect()
    expected = {}
    for s in lines:
        for w in java_split_space(s):
            expected[w] = expected.get(w, 0) + 1
    assert {r.word: r.cnt for r in counts} == expected
    assert dict(word_count(tokenize(df)).dtypes) == {"word": "string", "cnt": "bigint"}


def test_word_count_text_form(spark):
    df = spark.createDataFrame([("b a b",)], "line string")
    out = sorted(r.value for r in word_count_text(count_words(df)).collect())
    assert out == ["(a,1)", "(b,2)"]
    assert spark.range(1).select(pair_text("'x'", "3").alias("v")).first().v == "(x,3)"


def test_word_count_plan_has_partial_aggregate(spark):
    df = spark.createDataFrame([("a b",)], "line string")
    plan = count_words(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "hashpartitioning(word" in plan


def test_widen_only_when_narrow(spark):
    one = spark.range(0, 1000, numPartitions=1)
    wide = spark.range(0, 1000, numPartitions=16)
    assert widen(one, 4).rdd.getNumPartitions() == 4
    assert widen(wide, 4) is wide
    assert sorted(r.id for r in widen(one, 4).collect()) == list(range(1000))


@pytest.mark.parametrize("mode", ["errorifexists"])
def test_pairs_sink_refuses_existing(spark, tmp_path, mode):
    from linecraft.sinks import write_pairs_text

    df = count_words(spark.createDataFrame([("a b a",)], "line string"))
    out = str(tmp_path / "out")
    write_pairs_text(df, out, mode=mode)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["(a,2)", "(b,1)"]
    assert (tmp_path / "out" / "_SUCCESS").exists()
    with pytest.raises(Exception):
        write_pairs_text(df, out, mode=mode)
