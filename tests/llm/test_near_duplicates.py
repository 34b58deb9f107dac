import random
import re

import numpy as np
import pyarrow as pa
import pytest

from linecraft.llm import _words, superminhash

from .fixtures_llm import awkward, empty, prose, same

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, size, percent=80):
    """(doc_id, n_shingles, component_id) per row, by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None:
                both = len(a & b)
                if 100 * both >= percent * len(a | b):
                    parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return [(d, len(sets[i]), None if d is None else low[find(i)]) for i, (d, _) in enumerate(rows)]


def edited(text, n, seed):
    r = random.Random(seed)
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def corpus(copies=40):
    base = [prose(i, 80) for i in range(30)]
    texts = [(i, t) for i, t in enumerate(base)]
    for i in range(copies):  # a group in which not every pair is linked
        texts.append((100 + i, edited(base[0], i % 12, i)))
    for i in range(1, 12):
        texts.append((200 + i, edited(base[i], i // 2, i)))
        texts.append((300 + i, base[i].upper() if i % 2 else base[i].replace(" ", "\n ")))
    return texts + [(400, "one"), (401, "ONE"), (402, "one two"), (403, "one two "), (404, "two one")]


@pytest.mark.parametrize("size", [2, 5])
def test_groups_equal_brute_force(spark, size):
    df, rows = awkward(spark, corpus())
    got = superminhash.groups(df, size=size).select("doc_id", "n_shingles", "component_id").collect()
    same(got, brute(rows, size))


def test_digest_types_and_kept(spark):
    df, rows = awkward(spark, corpus(5))
    got = superminhash.digest(df)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}
    same(got.collect(), [(d, n, c, True if d is None else d == c) for d, n, c in brute(rows, 2)])


def test_deduplicate_keeps_one_row_of_each_group(spark):
    df, rows = awkward(spark, [*corpus(12), (500, prose(500, 30)), (500, prose(501, 30))])
    out = superminhash.deduplicate(df)
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    worded = [r for r in rows if r[0] is not None and shingles(r[1], 5)]
    expected = {(d, c) for (d, _, c) in brute(worded, 5) if d == c}
    got = [k for k in kept if k[0] is not None and shingles(k[1], 5)]
    assert {d for d, _ in got} == {d for d, _ in expected}
    assert len(got) == len(expected) + 1  # doc 500 holds two groups
    others = lambda x: sorted(map(str, (r for r in x if r[0] is None or not shingles(r[1], 5))))
    assert others(kept) == others(rows)


def test_empty_table(spark):
    df = empty(spark, "doc_id bigint, text string")
    assert superminhash.digest(df).collect() == []
    assert superminhash.deduplicate(df).collect() == []


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    common, a, b = (r.integers(1, 2**63, n).astype(np.uint64) for n in (300, 60, 40))
    sets = [np.concatenate([common, a]), np.concatenate([common, b])]
    first = np.array([0, 360, 700])
    s = superminhash.signatures(np.concatenate(sets), first)
    estimate = (s[0] == s[1]).mean()
    assert abs(estimate - 300 / 400) < 0.12
    # early stopping gives the same as dealing all ranks to a single set
    alone = superminhash.signatures(sets[0], np.array([0, 360]))
    assert (alone[0] == s[0]).all()


def test_smallest_sets_share_a_band():
    n = 20000
    sets = np.random.default_rng(5).integers(0, 2**64, (n, 5), np.uint64)
    whole = superminhash.band_keys(superminhash.signatures(sets.ravel(), np.arange(n + 1) * 5))
    part = superminhash.band_keys(superminhash.signatures(sets[:, 1:].ravel(), np.arange(n + 1) * 4))
    assert (whole == part).any(axis=1).all()


def test_words_equal_regular_expression():
    texts = ["", "A b\tC", "é É x", "  lead", "a" * 70000 + " b", "\x0b\x0c z", "one"]
    w = _words.words_of(pa.array(texts), superminhash.WORD)
    spelled = [re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER)) for t in texts]
    assert np.diff(w.first).tolist() == [len(x) for x in spelled]
    flat = [x for s in spelled for x in s]
    by_hash = {}
    for word, h in zip(flat, w.hashes.tolist(), strict=True):
        assert by_hash.setdefault(word, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def test_components_of_a_path(spark):
    n = 60
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(n)], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in superminhash.components(links).collect()}
    assert got == {bytes([i]): b"\x00" for i in range(1, n + 1)}


def test_nodes_sort_as_their_ids(spark):
    ids = [0, 1, -1, 255, 256, 2**31, -(2**31), 2**63 - 1, -(2**63), 12345678901]
    df = spark.createDataFrame([(i, b"c") for i in ids], "doc_id bigint, class binary")
    got = df.select("doc_id", superminhash._node("doc_id", "class").alias("node")).select(
        "doc_id", "node", superminhash._id_of("node").alias("back")
    )
    rows = got.collect()
    assert all(r["back"] == r["doc_id"] and len(r["node"]) == 9 for r in rows)
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: bytes(r["node"]))] == sorted(ids)


def family(n, frame, own, seed):
    """Texts that share a frame; every tenth is a close copy of the one before."""
    r = np.random.default_rng(seed)
    words = lambda k: " ".join(f"w{x}" for x in r.integers(0, 10**9, k))
    head, out = words(frame), []
    for i in range(n):
        out.append(out[-1].rsplit(" ", 1)[0] + " end" if i % 10 == 9 else f"{head} {words(own)}")
    return out


@pytest.mark.parametrize(("frame", "own"), [(60, 30), (60, 12), (0, 12), (3, 0)])
def test_classes_left_apart_meet_by_rare_elements(spark, frame, own):
    texts = family(150, frame, own, frame + own) + [prose(i, 4) for i in range(40)]
    texts = list({frozenset(shingles(t, 2)): t for t in texts}.values())
    names = [i.to_bytes(4, "big") for i in range(len(texts))]
    rows = spark.createDataFrame([(1, c, c) for c in names], "bucket bigint, class binary, root binary")
    held = spark.createDataFrame(list(zip(names, texts, strict=True)), "class binary, text string")
    sets = [set(shingles(t, 2)) for t in texts]
    want = {
        (names[i], names[j])
        for i in range(len(sets))
        for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    }
    got = {tuple(sorted((bytes(r["a"]), bytes(r["b"])), reverse=True)) for r in superminhash._among_rest(rows, held, 2, 80).collect()}
    assert got == want
    if own == 30:
        # a frame alone brings nobody together
        rare = superminhash._by_rare_elements(rows, held, 2, 80)
        assert rare.groupBy("bucket").count().agg({"count": "max"}).first()[0] <= 40
