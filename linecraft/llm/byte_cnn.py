"""Quality classifier: a convolutional network over bytes, in numpy.

Each byte has a learned vector; learned filters slide over every position of
the text. The text is cut into chunks of ``CHUNK`` positions; the windows of a
chunk reach into the next one, so chunks overlap and no position is left out.
Each filter is max-pooled within a chunk; the text's features are the largest
and the mean of its chunks' maxima, and a logistic layer turns them into one
probability. Scoring takes whole texts of any length, slice by slice.

Training runs on the driver over a bounded sample: at most ``ROWS_PER_CLASS``
labelled rows of each class, those with the smallest hashes, and at most
``TRAIN_BYTES`` bytes a row on average. A text of any length is learned from
whole: only one that does not fit into what is left of the bytes is passed
over, and where none fits the shortest is taken. The output is calibrated to the class counts over all
labelled rows.

Null and empty texts are scored as a text of padding only. Without labelled
rows, or with one class only, every score is the share of label 1 (0.5 if
there is no label). Repeated rows are scored alike. Rows with a null doc_id
are never trained on and count as not held out. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import tidy
from ._words import buffers

ROWS_PER_CLASS = 1500
TRAIN_BYTES = 16384
FILTERS, WIDTH, DEPTH, CHUNK = 16, 8, 6, 512
EPOCHS, STEP, BATCH = 6, 0.01, 64
#: A small sample is gone over more often, for this many steps at least.
LEAST_STEPS = 280
#: Bytes convolved at a time.
SLICE = 1 << 15
THRESHOLD = 0.3
SEED = 7


def start_weights(seed: int = SEED) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    return {
        "embed": g.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
        "filters": g.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "top": g.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "shift": np.zeros(1, np.float32),
    }


def _convolve(w, data: np.ndarray) -> np.ndarray:
    """Filter responses of all windows that begin in data[: len(data) - WIDTH + 1]."""
    x = w["embed"][data]
    windows = np.lib.stride_tricks.as_strided(
        x, (len(data) - WIDTH + 1, WIDTH * DEPTH), (x.strides[0], x.strides[1]), writeable=False
    )
    return windows @ w["filters"] + w["bias"]


def chunk_maxima(w, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maxima of all chunks of some texts, the text of each chunk, and for each
    maximum the position of its window within the padded concatenation."""
    pad = np.zeros(WIDTH - 1, np.uint8)
    parts, heads, owner, at = [], [], [], 0
    for i, t in enumerate(texts):
        body = t if len(t) else pad[:1]
        heads.append(at + np.arange(0, len(body), CHUNK))
        owner.append(np.full(len(heads[-1]), i))
        parts += [body, pad]
        at += len(body) + WIDTH - 1
    data = np.concatenate(parts)
    heads, owner = np.concatenate(heads), np.concatenate(owner)
    maxima = np.empty((len(heads), FILTERS), np.float32)
    where = np.empty((len(heads), FILTERS), np.int64)
    # windows that begin in a text's padding see a few of its last bytes again
    # or the next text's first; they are cut off by ending each chunk in time
    ends = np.append(heads[1:], len(data) - WIDTH + 1)
    last = np.append(owner[1:] != owner[:-1], False)
    ends = np.where(last, ends - (WIDTH - 1), ends)
    first = 0
    while first < len(heads):
        stop = max(first + 1, int(np.searchsorted(ends, heads[first] + SLICE, side="right")))
        lo, hi = heads[first], ends[stop - 1]
        r = _convolve(w, data[lo : hi + WIDTH - 1])
        for c in range(first, stop):
            own = r[heads[c] - lo : ends[c] - lo]
            k = own.argmax(axis=0)
            where[c] = k + heads[c]
            maxima[c] = own[k, np.arange(FILTERS)]
        first = stop
    return maxima, owner, where


def _features(maxima: np.ndarray, owner: np.ndarray, n: int):
    """ReLU of the maxima, pooled: largest and mean over each text's chunks."""
    on = np.maximum(maxima, 0)
    first = np.searchsorted(owner, np.arange(n))
    most = np.maximum.reduceat(on, first, axis=0)
    count = np.bincount(owner, minlength=n).astype(np.float32)[:, None]
    return on, np.hstack([most, np.add.reduceat(on, first, axis=0) / count]), first, count


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score_texts(w, texts: list[np.ndarray]) -> np.ndarray:
    maxima, owner, _ = chunk_maxima(w, texts)
    _, x, _, _ = _features(maxima, owner, len(texts))
    return _sigmoid(x @ w["top"] + w["shift"])


def _batches(order: np.ndarray, size: np.ndarray):
    """Runs of ``BATCH`` texts, or of fewer that have as many bytes."""
    first = 0
    while first < len(order):
        run = order[first : first + BATCH]
        n = max(1, int(np.searchsorted(np.cumsum(size[run]), BATCH * TRAIN_BYTES, side="right")))
        yield run[:n]
        first += n


def train(texts: list[np.ndarray], labels: np.ndarray, prior: float, seed: int = SEED) -> dict:
    """Adam on the logistic loss. Max-pooling sends each gradient to one window."""
    w = start_weights(seed)
    m1 = {k: np.zeros_like(v) for k, v in w.items()}
    m2 = {k: np.zeros_like(v) for k, v in w.items()}
    g = np.random.default_rng(seed)
    labels = labels.astype(np.float32)
    share = float(labels.mean())
    step = 0
    size = np.array([len(t) for t in texts])
    # texts of a step, fewer if they are long
    usual = BATCH * min(1.0, TRAIN_BYTES / max(1.0, float(size.mean())))
    epochs = max(EPOCHS, int(np.ceil(LEAST_STEPS * usual / len(texts))))
    for epoch in range(epochs):
        order = g.permutation(len(texts))
        for pick in _batches(order, size):
            batch = [texts[i] for i in pick]
            maxima, owner, where = chunk_maxima(w, batch)
            on, x, first, count = _features(maxima, owner, len(batch))
            p = _sigmoid(x @ w["top"] + w["shift"])
            d = (p - labels[pick])[:, None] / len(batch)
            grad = {"top": (d * x).sum(0) + 1e-4 * w["top"], "shift": d.sum(0)}
            dx = d * w["top"][None]
            dmax, dmean = dx[:, :FILTERS], dx[:, FILTERS:] / count
            back = dmean[owner]
            top = np.maximum.reduceat(on, first, axis=0)[owner] == on
            shared = np.add.reduceat(top.astype(np.float32), first, axis=0)[owner]
            back = (back + dmax[owner] * top / shared) * (maxima > 0)
            data = _joined(batch)
            c, f = np.nonzero(back)
            value = back[c, f].astype(np.float32)
            at = where[c, f]
            bytes_at = data[at[:, None] + np.arange(WIDTH)]
            seen = w["embed"][bytes_at].reshape(len(at), WIDTH * DEPTH)
            grad["filters"] = np.zeros_like(w["filters"])
            grad["bias"] = np.bincount(f, value, FILTERS).astype(np.float32)
            for k in range(FILTERS):
                own = f == k
                grad["filters"][:, k] = value[own] @ seen[own]
            down = (value[:, None] * w["filters"].T[f]).reshape(-1, DEPTH)
            flat = bytes_at.ravel()
            grad["embed"] = np.stack([np.bincount(flat, down[:, j], 256) for j in range(DEPTH)], 1).astype(np.float32)
            step += 1
            rate = STEP * (1 - epoch / epochs * 0.8)
            for k in w:
                m1[k] = 0.9 * m1[k] + 0.1 * grad[k]
                m2[k] = 0.999 * m2[k] + 0.001 * grad[k] ** 2
                fix = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                w[k] = (w[k] - fix * m1[k] / (np.sqrt(m2[k]) + 1e-7)).astype(np.float32)
    if 0 < share < 1 and 0 < prior < 1:
        w["shift"] = w["shift"] + np.float32(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return w


def _joined(texts: list[np.ndarray]) -> np.ndarray:
    pad = np.zeros(WIDTH - 1, np.uint8)
    return np.concatenate([x for t in texts for x in (t if len(t) else pad[:1], pad)])


def sampled(docs: DataFrame, ids: DataFrame, rows: int, most: int) -> list[str]:
    """Texts of at most ``rows`` rows of the documents ``ids`` and of ``most``
    bytes in all, by the hash of doc_id; the shortest if each has more bytes."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"), F.octet_length(text).alias("size"))
    found = (
        keyed.select("doc_id", "key", "size")
        .join(F.broadcast(ids.select("doc_id")), "doc_id")
        .groupBy("doc_id", "key", "size")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "key")
        .limit(2 * rows)
        .collect()
    )
    chosen: dict[tuple, int] = {}
    for r in found:
        n = min(r["n"], rows, most // max(1, r["size"]))
        if n:
            chosen[r["doc_id"], r["key"]] = n
            rows, most = rows - n, most - n * r["size"]
    if found and not chosen:
        r = min(found, key=lambda r: r["size"])
        chosen[r["doc_id"], r["key"]] = 1
    if not chosen:
        return []
    wanted = docs.sparkSession.createDataFrame(list(chosen), ids.select("doc_id", F.lit(0).cast("bigint").alias("key")).schema)
    got = keyed.join(F.broadcast(wanted), ["doc_id", "key"]).groupBy("doc_id", "key").agg(F.min("text").alias("text")).toArrow()
    text_of = dict(zip(zip(got["doc_id"].to_pylist(), got["key"].to_pylist(), strict=True), got["text"].to_pylist(), strict=True))
    return [text_of[k] for k, n in chosen.items() for _ in range(n)]


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> dict | float:
    """Weights, or a constant score where there is nothing to learn.

    ``labels`` has ``doc_id, label`` (0, 1; others are left out). Class counts
    cover all its rows; texts of a bounded sample come to the driver.
    """
    named = labels.where("doc_id is not null and label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    total = sum(counts.values())
    if total == 0 or len(counts) < 2:
        return counts.get(1, 0) / total if total else 0.5
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    texts, marks = [], []
    for label in (0, 1):
        # a few thousand ids: small by the limit, whatever the input
        ids = named.where(F.col("label") == label).orderBy(*by_hash).limit(2 * rows_per_class)
        for t in sampled(docs, ids, rows_per_class, rows_per_class * TRAIN_BYTES):
            texts.append(np.frombuffer(t.encode(), np.uint8))
            marks.append(label)
    if len(set(marks)) < 2:
        return counts[1] / total
    return train(texts, np.array(marks), counts[1] / total)


def _scores(model, texts: pa.Array) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(texts), model)
    data, off = buffers(texts)
    got = np.empty(len(texts))
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE, side="right")) - 1)
        got[i:j] = score_texts(model, [data[off[k] : off[k + 1]] for k in range(i, j)])
        i = j
    return got


def scorer(model):
    """mapInArrow function: ``doc_id, text`` to ``doc_id, score``."""

    def run(batches):
        for b in batches:
            got = _scores(model, b["text"])
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(got, pa.float64())], ["doc_id", "score"])

    return run


def keep(docs: DataFrame, model, least: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``least`` or more."""

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_scores(model, b["text"]) >= least))

    return docs.mapInArrow(tidy(run), docs.schema)


def remainder(doc_id, by: int):
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % by


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns of the query ``op7``."""
    learn = labels.select("doc_id", F.col("quality").alias("label")).where(remainder(F.col("doc_id"), 5) != 0)
    model = fit(docs, learn)
    scored = docs.select("doc_id", "text").mapInArrow(tidy(scorer(model)), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
