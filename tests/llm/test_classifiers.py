import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linecraft.llm import byte_cnn, weak_toxicity

from .fixtures_llm import awkward, empty, prose


def junk(i):
    r = random.Random(i)
    return " ".join(w + r.choice(("***", "###", "&&&")) for w in prose(i, 60).split())


def rude(i):
    w = prose(i, 80).split()
    r = random.Random(i)
    for word in r.sample(("oafish", "dimwit", "buffoon", "rotter"), 3):
        w.insert(r.randrange(len(w)), word + r.choice(("", ",", ".")))
    return " ".join(w)


def labelled(spark, bad, n=240):
    """(documents, labels): every third text is of label ``bad``."""
    texts = [(i, (junk(i) if bad == "quality" else rude(i)) if i % 3 == 0 else prose(i, 80)) for i in range(n)]
    df, rows = awkward(spark, texts)
    good = {"quality": lambda i: int(i % 3 != 0), "toxic": lambda i: int(i % 3 == 0)}[bad]
    labels = [(i, good(i), "x") for i in range(0, n, 2)] + [(None, 1, "x"), (1, None, "x"), (10**6, 1, "x")]
    return df, rows, spark.createDataFrame(labels, f"doc_id bigint, {bad} int, text string"), good


CASES = [("quality", byte_cnn.digest, 5, 0, 0.3), ("toxic", weak_toxicity.digest, 3, 1, 0.7)]


@pytest.mark.parametrize(("column", "digest", "by", "rest", "least"), CASES)
def test_held_out_accuracy_and_columns(spark, column, digest, by, rest, least):
    df, rows, labels, good = labelled(spark, column)
    got = digest(df, labels)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    out = got.collect()
    assert len(out) == len(rows)
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(d) for d, _ in rows)
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= least)
        own = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % by == rest
        assert r["held_out"] == own
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 240 and (r["held_out"] or r["doc_id"] % 2)]
    assert np.mean([r["predicted"] == good(r["doc_id"]) for r in held]) > 0.95


@pytest.mark.parametrize(("column", "digest", "by", "rest", "least"), CASES)
def test_held_out_labels_change_nothing(spark, column, digest, by, rest, least):
    df, _, labels, _ = labelled(spark, column, 60)
    df = df.where("doc_id < 60")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % by == rest
    wrong = labels.withColumn(column, F.when(held, 1 - F.col(column)).otherwise(F.col(column)))
    scores = lambda x: sorted((r["doc_id"], r["score"]) for r in digest(df, x).collect())
    assert scores(labels) == scores(wrong)


@pytest.mark.parametrize(("column", "digest", "by", "rest", "least"), CASES)
def test_nothing_to_learn(spark, column, digest, by, rest, least):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    none = empty(spark, f"doc_id bigint, {column} int")
    assert len({r["score"] for r in digest(docs, none).collect()}) == 1
    one = spark.createDataFrame([(i, 1) for i in range(9)], f"doc_id bigint, {column} int")
    assert {r["score"] for r in digest(docs, one).collect()} == {1.0}
    assert digest(empty(spark, "doc_id bigint, text string"), one).collect() == []


def test_keep_filters_whole_rows(spark):
    df, rows, labels, good = labelled(spark, "quality")
    model = byte_cnn.fit(df, labels.select("doc_id", F.col("quality").alias("label")))
    out = byte_cnn.keep(df, model)
    assert out.schema == df.schema
    scores = {r["doc_id"]: r["score"] for r in df.mapInArrow(byte_cnn.scorer(model), "doc_id bigint, score double").collect()}
    kept = {r["doc_id"] for r in out.collect()}
    assert kept - {None} == {d for d, s in scores.items() if d is not None and s >= 0.3}


def convolved(w, text):
    """Chunk maxima by their definition, position by position."""
    data = np.concatenate([text if len(text) else np.zeros(1, np.uint8), np.zeros(byte_cnn.WIDTH - 1, np.uint8)])
    n = len(data) - byte_cnn.WIDTH + 1
    r = np.array([w["embed"][data[i : i + byte_cnn.WIDTH]].ravel() @ w["filters"] + w["bias"] for i in range(n)])
    return np.array([r[i : i + byte_cnn.CHUNK].max(0) for i in range(0, n, byte_cnn.CHUNK)])


def test_chunks_cover_whole_texts():
    w = byte_cnn.start_weights()
    g = np.random.default_rng(1)
    sizes = (0, 1, 7, 8, byte_cnn.CHUNK - 1, byte_cnn.CHUNK, byte_cnn.CHUNK + 1, 3 * byte_cnn.CHUNK + 5)
    texts = [g.integers(32, 127, n).astype(np.uint8) for n in sizes]
    maxima, owner, _ = byte_cnn.chunk_maxima(w, texts)
    for i, t in enumerate(texts):
        assert np.allclose(maxima[owner == i], convolved(w, t), atol=1e-5)
    # alone or together, and over several slices, a text scores the same
    long = g.integers(32, 127, byte_cnn.SLICE * 2 + 77).astype(np.uint8)
    alone = byte_cnn.score_texts(w, [long])
    assert np.allclose(alone, byte_cnn.score_texts(w, [texts[3], long])[1], atol=1e-6)
    assert len(byte_cnn.chunk_maxima(w, [long])[0]) == -(-len(long) // byte_cnn.CHUNK)


def test_label_model_finds_accuracies():
    g = np.random.default_rng(2)
    truth = g.random(20000) < 0.2
    hit = np.array([0.7, 0.5, 0.6, 0.5, 0.3])
    miss = np.array([0.02, 0.01, 0.05, 0.5, 0.3])  # the last two tell nothing
    votes = np.where(truth[:, None], g.random((20000, 5)) < hit, g.random((20000, 5)) < miss)
    combos, count = np.unique(votes, axis=0, return_counts=True)
    seen, label = votes[:150], truth[:150].astype(int)
    model = weak_toxicity.fit_label_model(combos, count.astype(float), seen, label, 0.2)
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93


def test_repeated_votes_weigh_less():
    g = np.random.default_rng(3)
    a, b = g.random(5000) < 0.3, g.random(5000) < 0.3
    votes = np.stack([a, a, a, b], 1)
    weight = weak_toxicity._weights(votes, np.ones((2, 5000)))
    assert np.allclose(weight[:3], 1 / 3, atol=0.05) and weight[3] > 0.9


def test_found_words():
    texts = pa.array(["One two oNE", "", "three, two", "twofold"])
    words = np.unique(weak_toxicity.words_of(pa.array(["one two"]), weak_toxicity.WORD).hashes)
    text, word = weak_toxicity.found_words(texts, words)
    assert np.bincount(text, minlength=4).tolist() == [2, 0, 1, 0]


@pytest.mark.parametrize(("fit", "module"), [(byte_cnn.fit, byte_cnn), (weak_toxicity.fit, weak_toxicity)])
def test_a_class_of_long_texts_is_learned(spark, fit, module):
    long = -(-module.TRAIN_BYTES // 200)
    texts = [(i, " ".join(rude(i * long + k) for k in range(long)) if i % 2 else prose(i, 80)) for i in range(16)]
    assert all(len(t) > module.TRAIN_BYTES for i, t in texts if i % 2)
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(16)], "doc_id bigint, label int")
    assert not isinstance(fit(docs, labels), float)


def test_sample_is_bounded_by_all_its_bytes(spark):
    texts = [(i, "x" * n) for i, n in enumerate((900, 10, 20, 30, 2000, 0))] + [(1, "x" * 10), (None, "x"), (5, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    ids = spark.range(6).withColumnRenamed("id", "doc_id")
    size = lambda ids, rows, most: sorted(len(t) for t in byte_cnn.sampled(docs, ids, rows, most))
    assert size(ids, 9, 10**6) == [0, 0, 10, 10, 20, 30, 900, 2000]
    assert len(size(ids, 3, 10**6)) == 3
    assert size(ids, 9, 100) == [0, 0, 10, 10, 20, 30]
    assert size(ids.where("doc_id in (0, 4)"), 9, 100) == [900]
    assert size(ids.where("doc_id > 9"), 9, 100) == []


def test_steps_hold_as_many_bytes_as_of_usual_texts():
    most = byte_cnn.BATCH * byte_cnn.TRAIN_BYTES
    size = np.array([byte_cnn.TRAIN_BYTES] * 100 + [3 * most] + [most // 2] * 3)
    runs = list(byte_cnn._batches(np.arange(len(size)), size))
    assert np.concatenate(runs).tolist() == list(range(len(size)))
    assert len(runs[0]) == byte_cnn.BATCH
    assert all(len(r) == 1 or size[r].sum() <= most for r in runs)


def test_pooled_score_equals_a_plain_one():
    w = byte_cnn.start_weights(3)
    g = np.random.default_rng(8)
    texts = [g.integers(0, 256, n, np.uint8).astype(np.uint8) for n in (0, 1, 5, 511, 512, 513, 1300, 40000)]
    got = byte_cnn.score_texts(w, texts)
    for text, score in zip(texts, got, strict=True):
        body = text if len(text) else np.zeros(1, np.uint8)
        padded = np.concatenate([body, np.zeros(byte_cnn.WIDTH - 1, np.uint8)])
        chunks = []
        for head in range(0, len(body), byte_cnn.CHUNK):
            # windows that begin in the chunk, each filter by hand
            best = np.full(byte_cnn.FILTERS, -np.inf)
            for i in range(head, min(head + byte_cnn.CHUNK, len(body))):
                window = w["embed"][padded[i : i + byte_cnn.WIDTH]].ravel()
                best = np.maximum(best, window @ w["filters"] + w["bias"])
            chunks.append(np.maximum(best, 0))
        x = np.concatenate([np.max(chunks, axis=0), np.mean(chunks, axis=0)])
        want = 1 / (1 + np.exp(-(x @ w["top"] + w["shift"][0])))
        assert score == pytest.approx(want, abs=1e-4)


def test_label_model_equals_a_plain_one(monkeypatch):
    """Rounds of expectation and maximisation, document by document."""
    monkeypatch.setattr(weak_toxicity, "ROUNDS", 3)
    g = np.random.default_rng(2)
    votes = np.unique(g.random((30, 4)) < 0.3, axis=0)
    count = g.integers(1, 9, len(votes)).astype(float)
    seen, label, prior = g.random((12, 4)) < 0.4, np.array([0, 1] * 6), 0.2
    got = weak_toxicity.fit_label_model(votes, count, seen, label, prior)
    docs = [v for v, n in zip(votes, count, strict=True) for _ in range(int(n))]
    rate = [[(sum(s[k] for s, y in zip(seen, label, strict=True) if y == c) + 0.5) / (6 + 1) for k in range(4)] for c in (0, 1)]
    weight = [1.0] * 4

    def chance(v):
        odds = [1 - prior, prior]
        for c in (0, 1):
            for k in range(4):
                odds[c] *= (rate[c][k] if v[k] else 1 - rate[c][k]) ** weight[k]
        return odds[1] / sum(odds)

    for _ in range(3):
        p = [chance(v) for v in docs]
        pull = len(docs) / 12
        soft = [[1 - x for x in p], p]
        rate = [
            [
                (sum(x * v[k] for x, v in zip(soft[c], docs, strict=True)) + pull * sum(s[k] for s, y in zip(seen, label, strict=True) if y == c) + 0.5)
                / (sum(soft[c]) + pull * 6 + 1)
                for k in range(4)
            ]
            for c in (0, 1)
        ]
        near = np.zeros((4, 4))
        for c in (0, 1):
            n = sum(soft[c])
            mean = [sum(x * v[k] for x, v in zip(soft[c], docs, strict=True)) / n for k in range(4)]
            cov = [[sum(x * (v[i] - mean[i]) * (v[j] - mean[j]) for x, v in zip(soft[c], docs, strict=True)) / n for j in range(4)] for i in range(4)]
            for i in range(4):
                for j in range(4):
                    if i != j:
                        near[i, j] += max(cov[i][j] / (max(cov[i][i], 1e-12) * max(cov[j][j], 1e-12)) ** 0.5, 0) * n / len(docs)
        weight = [1 / (1 + near[k].sum()) for k in range(4)]
    assert np.allclose(got.rate, rate) and np.allclose(got.weight, weight)
    assert np.allclose(got.posterior(votes), [chance(v) for v in votes])


def test_rows_without_a_label_teach_new_words(spark):
    """Few labels, all of one slang; unlabelled texts mix it with a second one,
    which alone marks the held-out texts. A text with one of two slangs stays
    below one half, so the test is how well scores separate the labels."""
    g = np.random.default_rng(4)
    first, second = ["grobnik", "stulper", "vrakkod", "mizzler"], ["hurflep", "dwonkus", "plibber", "zagmoot"]

    def text(i, *slangs):
        return " ".join([prose(i, 40), *(w for s in slangs for w in g.choice(s, 3, replace=False))])

    rows = [(i, text(i, first) if i < 12 else text(i)) for i in range(60)]
    rows += [(i, text(i, first, second) if i % 4 == 0 else text(i)) for i in range(60, 460)]
    held = [(i, text(i, second) if i % 2 else text(i)) for i in range(1000, 1100)]
    docs = spark.createDataFrame(rows + held, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 12)) for i in range(60)], "doc_id bigint, label int")
    others = docs.where("doc_id < 1000")

    def separated(n):
        """Share of pairs of a toxic and a clean text in the right order."""
        score = weak_toxicity.fit(docs, labels, others=others, rows_unlabelled=n).score(pa.array([t for _, t in held], pa.large_string()))
        toxic = np.array([i % 2 == 1 for i, _ in held])
        return (score[toxic][:, None] > score[~toxic][None]).mean()

    assert separated(0) < 0.65
    assert separated(2500) > 0.99


def test_rows_without_a_label_are_bounded(spark, monkeypatch):
    drawn = []
    plain = weak_toxicity.sampled
    monkeypatch.setattr(weak_toxicity, "sampled", lambda *a: drawn.append(plain(*a)) or drawn[-1])
    docs = spark.createDataFrame([(i, prose(i, 20)) for i in range(60)] + [(None, "x"), (59, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2 if i < 8 else None) for i in range(10)], "doc_id bigint, label int")
    weak_toxicity.fit(docs, labels, rows_unlabelled=7)
    assert [len(x) for x in drawn] == [4, 4, 7]
    named = {t: i for i, t in docs.collect()}
    # a row whose label is unknown is named in labels, and not drawn
    assert all(named[t] is not None and named[t] > 9 for t in drawn[2] if t)
