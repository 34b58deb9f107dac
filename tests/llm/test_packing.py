import functools
import zlib

import numpy as np
import pytest

from linecraft.llm import packing, token_counts

from .fixtures_llm import awkward, empty, prose, same

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@functools.cache
def tokenizer():
    return tokenizers.Tokenizer.from_file(packing.default_tokenizer()[0])


def ids_of(text):
    return np.array(tokenizer().encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def check(rows, pieces, length=1024):
    """Every id lies in one piece; sequences are gapless, full or a power of two."""
    want = {}
    for doc, text in rows:
        ids = ids_of(text)
        want.setdefault(doc, []).append((len(ids), zlib.crc32(ids)))
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert by_doc.keys() == want.keys()
    for doc, parts in by_doc.items():
        assert sum(p["length"] for p in parts) == sum(n for n, _ in want[doc])
        if len(want[doc]) == 1:
            ids, at = ids_of(dict(rows)[doc]), 0
            for p in sorted(parts, key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(ids)
                assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]])
                at += p["length"]
            assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


def test_pack(spark):
    texts = [(i, prose(i, 5 + 37 * i % 900)) for i in range(60)] + [(70, "a <|endoftext|> b"), (71, "x" * 9000)]
    df, rows = awkward(spark, texts)
    got = packing.digest(df)
    assert set(dict(got.dtypes).values()) == {"bigint"}
    assert check(rows, got.collect()) == 0


def test_many_short_and_equal(spark):
    rows = [(i, "word " * (i % 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert check(rows, packing.digest(df).collect()) == 0


def test_empty_table(spark):
    assert packing.digest(empty(spark, "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_patterns_fill_exactly_and_use_what_there_is(seed):
    g = np.random.default_rng(seed)
    sizes = g.integers(1, 1024, (5, 300, 4000, 60000, 8)[seed]) if seed % 2 else g.geometric(1 / 300, 5000).clip(1, 1023)
    counts = {int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True), strict=True)}
    used = {}
    for times, fill in packing.patterns(counts, most=60):
        assert times > 0 and sum(k * n for k, n in fill.items()) == 1024
        for k, n in fill.items():
            used[k] = used.get(k, 0) + n * times
    assert all(used[k] <= counts[k] for k in used)


def test_linear_program_finds_the_whole():
    # 3 x 300 + 124 and 2 x 512: no pairs, so every column must be priced
    counts = {300: 3000, 124: 1000, 512: 600}
    total = sum(k * n for k, n in counts.items())
    assert sum(t for t, _ in packing.patterns(counts)) * 1024 == total


def test_best_fill_is_optimal():
    g = np.random.default_rng(0)
    lengths, price = np.array([3, 5, 7]), g.random(3)
    cost, fill = packing.best_fill(price, lengths, 16)
    best = min(
        a * price[0] + b * price[1] + c * price[2]
        for a in range(6)
        for b in range(4)
        for c in range(3)
        if 3 * a + 5 * b + 7 * c == 16
    )
    assert cost == pytest.approx(best)
    assert sum(lengths[i] * n for i, n in fill.items()) == 16
    assert packing.best_fill(price, np.array([5, 10, 15]), 16)[1] == {}


# --- counts under edits ---


def applied(text, edits):
    text = text or ""
    for _, start, removed, inserted in sorted(edits, key=lambda e: tuple((x is not None, x) for x in e)):
        start = min(max(start or 0, 0), len(text))
        text = text[:start] + (inserted or "") + text[min(start + max(removed or 0, 0), len(text)) :]
    return text


def test_edited_counts(spark):
    texts = [(i, prose(i, 10 + 200 * i)) for i in range(12)] + [(30, "don't  stop\n\n it's"), (31, "a" * 4000)]
    df, rows = awkward(spark, texts)
    edits = []
    for i in range(12):
        edits += [(i, 1, 40 * i, 30, " new words"), (i, 3, 5, 0, "'s"), (i, 2, 10**6, 5, "end "), (i, 2, 0, 1, None)]
    edits += [(30, 1, 5, 1, ""), (30, None, 3, 1, " "), (31, 1, 2000, 0, " cut " * 900), (None, 1, 0, 1, "x"), (99, 1, 0, 1, "x")]
    edits += [(5, k, 7 * k, 3, f" w{k}") for k in range(10, 60)]
    log = spark.createDataFrame([(*e, 1) for e in edits], "doc_id bigint, seq int, start bigint, removed int, inserted string, text int")
    got = token_counts.edited_counts(df, log)

    def expected():
        for doc, text in rows:
            own = [e[1:] for e in edits if e[0] == doc and doc is not None]
            after = applied(text, own)
            yield (doc, len(ids_of(text)) - 1, len(ids_of(after)) - 1, len(own), len(after))

    same(got.drop("chars_encoded").collect(), expected())
    # a small edit of a long text re-encodes a small part of it
    r = got.where("doc_id = 11").first()
    assert 0 < r["chars_encoded"] < 4 * 3 * token_counts.LEAF


def test_query_of_counts(spark):
    df, rows = awkward(spark, [(i, prose(i, 60)) for i in range(20)])
    log = {}
    for e in token_counts.sample_edits(df).collect():
        log.setdefault(e["doc_id"], []).append((e["seq"], e["start"], e["removed"], e["inserted"]))
    assert {len(x) for x in log.values()} == {4} and None not in log
    got = token_counts.digest(df)
    want = [(d, len(ids_of(applied(t, log.get(d, []) if d is not None else []))) - 1) for d, t in rows]
    same(got.select("doc_id", "tokens_after").collect(), want)


def test_cuts_never_change_counts():
    encode = packing.encoder(packing.default_tokenizer())
    for text in ("a  b\n\nc 'll  d\t\te's", " " * 50 + "x" + "\n" * 9 + "y", "été  x  \U0001f600 1234 a1b2"):
        for size in (1, 2, 5):
            parts = token_counts.leaves_of(text, size)
            assert "".join(parts) == text
            assert sum(len(encode(p)) for p in parts) == len(encode(text))


def test_repeated_rows_of_one_document(spark):
    df = spark.createDataFrame([(1, "some words here " * 5)] * 10_000, "doc_id bigint, text string")
    got = token_counts.digest(df).select("n_edits").distinct().collect()
    assert [r[0] for r in got] == [4]


def test_counts_of_an_empty_table(spark):
    assert token_counts.digest(empty(spark, "doc_id bigint, text string")).collect() == []


LONG = 5_000_000
RUNS = ["x" + " " * LONG + "y", "\n" * LONG, "a\t" + "\t" * LONG + "<|endoftext|>", "q" * (LONG // 10), "a  b\n" * 50_000 + " " * 70_000 + "z"]


@pytest.mark.parametrize("text", RUNS, ids=["blanks", "newlines", "tabs", "letters", "mixed"])
def test_long_runs_are_encoded_alike(text):
    want = tokenizer().encode(text, add_special_tokens=False).ids
    assert packing.encoder(packing.default_tokenizer())(text) == want


def test_long_runs_in_the_queries(spark):
    rows = [(1, "x" + " " * 2_000_000 + "y"), (2, "\n" * 1_200_000), (3, "short")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {i: len(ids_of(t)) for i, t in rows}
    got = packing.digest(df).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r[0]: r[1] for r in got} == want
    assert {r["doc_id"]: r["tokens_before"] + 1 for r in token_counts.digest(df).collect()} == want


def test_parts_are_cut_only_where_pre_tokens_end():
    encode = packing.encoder(packing.default_tokenizer())
    for text in ("a!\x1c b \x1d\x85 c", "\u00a0 a\u2003 b", "it's 'll \t 'x  ", "\x1f \x1f a"):
        for size in (1, 2, 3):
            parts = packing.cut(text, size)
            assert "".join(parts) == text
            assert [x for p in parts for x in encode(p)] == encode(text)


def test_trees_kept_between_batches(spark, tmp_path):
    docs, rows = awkward(spark, [(i, prose(i, 10 + 300 * i)) for i in range(12)])
    path = str(tmp_path / "leaves")
    token_counts.plant(docs).write.parquet(path)
    leaves = spark.read.parquet(path)
    assert leaves.agg({"encoded": "sum"}).first()[0] == sum(len(t or "") for _, t in rows)
    batches = [
        [(i, 1, 50 * i, 30, " new words") for i in range(12)] + [(5, k, 7 * k, 3, f" w{k}") for k in range(2, 60)] + [(None, 1, 0, 1, "x")],
        [(11, 1, 2000, 4, "'s"), (11, 2, 0, 0, "Start "), (3, 1, 0, 10**6, None), (99, 1, 0, 0, "none"), (13, 1, 5, 0, "was empty")],
        [(3, 1, 0, 0, prose(40, 900)), (11, 1, 10, 0, " cut " * 900)],
    ]
    texts = list(rows)
    for version, edits in enumerate(batches, 1):
        log = spark.createDataFrame([(*e, "z") for e in edits], "doc_id bigint, seq int, start bigint, removed int, inserted string, text string")
        token_counts.grow(spark.read.parquet(path), log, version).write.mode("append").parquet(path)
        texts = [(d, applied(t, [e[1:] for e in edits if e[0] == d and d is not None])) for d, t in texts]
        leaves = spark.read.parquet(path)
        same(
            token_counts.totals(leaves).select("doc_id", "chars", "tokens").collect(),
            [(d, len(t), len(ids_of(t)) - 1) for d, t in texts],
        )
        own = leaves.where(f"version = {version}")
        if version == 2:
            # a few leaves of the documents with edits, not the documents
            encoded = {r[0]: r[1] for r in own.groupBy("doc_id").agg({"encoded": "sum"}).collect()}
            assert set(encoded) == {3, 11, 13} and encoded[11] < 8 * token_counts.LEAF < len(texts[11][1])
            assert own.where("doc_id = 11").count() < 8 < leaves.where("doc_id = 11 and version = 0").count()
    back = {}
    for r in token_counts.current(leaves).collect():
        back.setdefault((r["doc_id"], r["tree"]), {})[r["slot"]] = r["text"]
    assert sorted((str(d), "".join(x[k] for k in sorted(x))) for (d, _), x in back.items()) == sorted((str(d), t) for d, t in texts)


def test_no_trees_and_no_edits(spark):
    none = token_counts.plant(empty(spark, "doc_id bigint, text string"))
    log = empty(spark, "doc_id bigint, seq int, start bigint, removed int, inserted string")
    assert token_counts.totals(none).collect() == []
    assert token_counts.grow(none, log, 1).collect() == []
