"""Phrase mining against counting of all phrases, on small awkward tables."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from linecraft.llm import phrases

from .fixtures_llm import CLASH, empty, prose, same

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top, inside=50):
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for n in (1, 2, 3):
                for i in range(len(w) - n + 1):
                    count[lang, *w[i : i + n]] += 1
    often = {k: a for k, a in count.items() if len(k) > 2 and a >= least}
    out = []
    for (lang, *w), a in often.items():
        if len(w) == 2 and any(
            100 * b >= inside * a for (m, *v), b in often.items() if m == lang and len(v) == 3 and w in (v[:2], v[1:])
        ):
            continue
        cuts = [(a * a * 10**6 // (count[lang, *w[:k]] * count[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, count[lang, *w[:k]], count[lang, *w[k:]], total[lang], score))
    ranked = []
    for lang in total:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(x[0], i, *x[1:]) for i, x in enumerate(own[:top], 1)]
    return ranked


def table(spark, rows):
    kinds = ", ".join(f"`{k}` {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'int'}" for k, v in CLASH.items())
    full = [(i, *r, *CLASH.values()) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, f"doc_id bigint, lang string, text string, {kinds}").repartition(5)


ROWS = [
    ("en", "New York, New York! new york city"),
    ("en", "new york city. New\tYork  city\nnew york"),
    ("en", None), ("en", ""), ("en", " \n,. "), (None, "a a a a a a"), ("und", "a a a b a a"),
    ("de", "new york"), ("de", "new york"), ("de", "new york"),
    ("", "x y x y x y"), ("fr", "\u00c9t\u00e9 \u00e9t\u00e9 \u00c9t\u00e9 \u00e9t\u00e9"), ("fr", "\u00e9t\u00e9\u00a0\u00e9t\u00e9 \u00e9t\u00e9"),
    ("es", prose(7, 20000)), ("es", "x" * 5000 + " y " + "x" * 5000 + " y"), ("es", "x" * 5000 + " y"),
]


@pytest.mark.parametrize("budget", [phrases.BUDGET, 64])
def test_equal_to_counting_all_phrases(spark, budget):
    got = phrases.mine(table(spark, ROWS), least=2, top=500, budget=budget).collect()
    same(got, plain(ROWS, 2, 500))


def test_least_count_and_ties(spark):
    rows = [("en", f"w{i} v{i}") for i in range(30) for _ in range(10 if i % 2 else 9)]
    got = phrases.mine(table(spark, rows), top=7).collect()
    same(got, plain(rows, 10, 7))
    assert [r["rank"] for r in sorted(got, key=lambda r: r["phrase"])] == list(range(1, 8))


def test_empty_table(spark):
    docs = empty(spark, "doc_id bigint, lang string, text string")
    assert phrases.mine(docs).collect() == []
    assert phrases.mine(table(spark, [("en", None), ("en", ".")])).collect() == []


def suffixes(texts, most):
    found = Counter()
    for data, off, first, core in phrases.windows(pa.array(texts), most):
        h, starts, _, owner, linked, _ = phrases.tokens(data, off, 1)
        linked = np.append(linked, False)
        for i in np.flatnonzero(starts < core):
            two = linked[i]
            three = two and linked[i + 1]
            found[int(first + owner[i]), int(h[i]), int(h[i + 1]) if two else 0, int(h[i + 2]) if three else 0] += 1
    return found


@pytest.mark.parametrize("most", [1, 7, 64, 1000])
def test_windows_lose_and_repeat_nothing(most):
    texts = ["", prose(3, 400), "a b", "one two three. four five\n six", "z" * 300 + " y " + "q" * 90, None, " . ", prose(4, 50)]
    assert suffixes(texts, most) == suffixes(texts, 1 << 20)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_017, 5_000_000_000_003, 7_000_000_000_009
    df = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint")
    assert df.select(phrases._score("a", "l", "r")).first()[0] == a * a * 10**6 // (left * right)


def test_groups_stay_within_the_budget():
    loads = np.array([5.0, 1, 1, 9, 4, 3, 2, 2])
    group = phrases.packed(loads, 6)
    held = np.bincount(group, loads)
    assert all(x <= 6 or x == 9 for x in held)
    assert group[3] != group[0]


def test_a_clash_of_hashes_runs_another_seed(spark, monkeypatch):
    true = phrases.tokens

    def clashing(data, off, seed):
        h, *rest = true(data, off, seed)
        return (np.ones_like(h) if seed == 1 else h), *rest

    monkeypatch.setattr(phrases, "tokens", clashing)
    rows = [("en", "a b a b a b")]
    same(phrases.mine(table(spark, rows), least=2).collect(), plain(rows, 2, 10))
