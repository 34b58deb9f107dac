import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from linecraft.llm import _words, fm_index

from .fixtures_llm import awkward, empty, prose, same

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [(1, prose(1, 30)), (2, prose(2, 14)), (3, "Short item, three"), (4, None), (5, "..."), (10, prose(1, 12)), (7, "ünï"), (3, "Short item, three")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, items=ITEMS, size=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[j : j + size]), set()).add(str(i))
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                who = windows.get(tuple(w[j : j + n]))
                if who:
                    hit.update(range(j, j + n))
                    found |= who
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield (doc, len(w), len(hit), len(found), digest, bool(hit))


def documents():
    item, other = prose(1, 30), prose(2, 14)
    return [
        (0, prose(50, 40)),
        (1, "x " + item + " y"),
        (2, prose(51, 20) + "; " + item.upper().replace(" ", ", ") + " " + other),
        (3, " ".join(item.split()[:9])),
        (4, " ".join(item.split()[3:13]) + " gap " + " ".join(item.split()[5:20])),
        (5, "a SHORT-item three and short item three short item"),
        (6, "ünï ün ünï"),
        (7, (other + " ") * 30),
        (8, prose(52, 20)),
        (9, prose(52, 20)),
    ]


def tables(spark):
    df, rows = awkward(spark, documents())
    bench = spark.createDataFrame([(*i, 0) for i in ITEMS], "item_id bigint, text string, shard int")
    return df, rows, bench


def test_digest_equals_brute_force(spark):
    df, rows, bench = tables(spark)
    got = fm_index.digest(df, bench)
    same(got.collect(), brute(rows))
    assert dict(got.dtypes)["contaminated"] == "boolean"


def test_blocks_and_small_shards(spark, monkeypatch):
    df, rows, bench = tables(spark)
    monkeypatch.setattr(fm_index, "SHARD_WORDS", 150)
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", 120)
    monkeypatch.setattr(fm_index, "PIECE_WORDS", 7)
    monkeypatch.setattr(fm_index, "PASS_BLOCKS", 2)
    blocks, n = fm_index.phrase_blocks(bench)
    assert n > 3
    got = blocks.selectExpr("block", "octet_length(hashes) + octet_length(item) as size").collect()
    last = 8 * (7 + 9) + 2  # a block may end beyond its bound by one piece
    assert all(sum(r["size"] for r in got if r["block"] == k) <= 120 + last for k in range(n))
    same(fm_index.digest(df, bench).collect(), brute(rows))


def test_benchmark_stays_off_the_driver(spark, monkeypatch):
    """A long item is cut into pieces that share the words of a window; what the
    driver collects does not grow with the benchmark."""
    monkeypatch.setattr(fm_index, "PIECE_WORDS", 100)
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", 4096)
    from pyspark.sql import DataFrame

    collected = []
    plain = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(plain(self)) or collected[-1])
    items = [(i, prose(i, 3000), 0) for i in range(20, 24)] + [(24, prose(24, 109), 0), (25, prose(25, 110), 0)]
    bench = spark.createDataFrame(items, "item_id bigint, text string, shard int")
    docs = [(0, "a " + items[0][1] + " b"), (1, " ".join(items[1][1].split()[95:105])), (2, items[4][1]), (3, prose(7, 50))]
    found = fm_index.digest(spark.createDataFrame(docs, "doc_id bigint, text string"), bench)
    assert sum(map(len, collected)) <= 2
    same(plain(found), brute(docs, [i[:2] for i in items]))


def test_decontaminate(spark):
    df, rows, bench = tables(spark)
    out = fm_index.decontaminate(df, bench)
    assert out.columns == df.columns
    clean = [r for r, b in zip(rows, brute(rows), strict=True) if not b[-1]]
    same(out.select("doc_id", "text").collect(), clean)


def test_empty_tables(spark):
    docs, bench = empty(spark, "doc_id bigint, text string"), empty(spark, "item_id bigint, text string")
    assert fm_index.digest(docs, bench).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    same(fm_index.digest(one, bench).collect(), brute([(1, "a b")], []))


@pytest.mark.parametrize("seed", range(4))
def test_suffix_order(seed):
    g = np.random.default_rng(seed)
    text = np.append(g.integers(1, 4 if seed % 2 else 3000, 900), 0)
    if seed > 1:
        text[100:400] = text[500:800]  # a long repeat
    expected = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert fm_index.suffix_order(text).tolist() == expected


def test_shard_search_and_locate():
    g = np.random.default_rng(5)
    docs = [g.integers(0, 6, n).astype(np.uint64) * np.uint64(7919) for n in (0 + 40, 1, 200, 13)]
    shard = fm_index.Shard.build(docs)
    again = fm_index.Shard.load(shard.size, *(shard.dump()[k] for k in ("vocabulary", "begin", "tree", "marks", "places")))
    for n in (1, 2, 3):
        for _ in range(25):
            p = g.integers(0, 7, n).astype(np.uint64) * np.uint64(7919)
            table = np.zeros((1, 4), np.uint64)
            table[0, :n] = p
            lo, hi = again.search(table, np.array([n]))
            rows = np.arange(lo[0], hi[0])
            at = again.locate(rows)
            slot = np.searchsorted(again.begin, at, side="right") - 1
            got = sorted(zip(slot.tolist(), (at - again.begin[slot]).tolist(), strict=True))
            expected = [(d, j) for d, x in enumerate(docs) for j in range(len(x) - n + 1) if (x[j : j + n] == p).all()]
            assert got == expected


def test_alphabet():
    w = _words.words_of(pa.array(["A-b_c9é", "{x}"]), fm_index.WORD)
    assert np.diff(w.first).tolist() == [3, 1]
