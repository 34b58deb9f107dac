"""Toxicity by weak supervision.

Voters are lexicons and patterns; each fires on a text or not. Lexicons are
mined from labelled texts: words and stems far more frequent in toxic ones, dealt over
``LEXICONS`` voters. Patterns look at the shape of the text. One pass over all
documents counts how often each combination of votes occurs.

A generative label model explains these counts: a hidden label with the
training rows' share of toxic ones, and for each voter its rates of firing on
either label (its accuracy). Expectation-maximisation starts from the rates on
labelled texts, which also stay in as prior counts. From the expected counts
follow the voters' correlations given the label; votes that say the same thing
again weigh less. The model's posterior labels the texts of two bounded samples,
of labelled rows and of rows without a label, and a logistic classifier over
words and patterns is trained on these labels. It alone scores the texts.

Bounds: ``ROWS_PER_CLASS`` labelled rows of each class, ``ROWS_UNLABELLED``
others, those with the smallest hashes, and ``TRAIN_BYTES`` bytes a row on
average come to the driver, whole texts of any length (``byte_cnn.sampled``);
others weigh as much as labelled rows if there are as many; combinations
of votes are at most 2 ** (LEXICONS + patterns).

Null and empty texts have no words and no pattern; they get the score of a text
on which nothing fires. Without labelled rows of both classes every score is
the share of label 1 (0 if there is no label). Repeated rows are scored alike;
rows with a null doc_id are never trained on and are not held out. Extra
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import tidy
from ._words import alphabet, buffers, slices, words_of
from .byte_cnn import remainder, sampled

ROWS_PER_CLASS = 2500
ROWS_UNLABELLED = 2500
TRAIN_BYTES = 32768
LEXICONS = 10
#: A lexicon word: this many toxic texts at least, and this often as many of
#: them (as shares) as of the others.
LEAST_TEXTS, LEAST_RATIO = 4, 12.0
MOST_LEXICON = 400
#: Words of the classifier.
FEATURES = 3000
#: Words also count by their first bytes.
STEM = 5
THRESHOLD = 0.7
ROUNDS, STEPS = 25, 400
SLICE = 1 << 20
WORD = alphabet(r"[A-Za-z]")
PATTERNS = ("shouting", "capitals", "symbols", "bars", "short")


# --- what is seen in a text --------------------------------------------------


def patterns_of(texts: pa.Array) -> np.ndarray:
    """One line per text, one column per pattern: fires or not."""
    data, off = buffers(texts)
    n = len(off) - 1
    size = np.diff(off)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return (total[off[1:]] - total[off[:-1]]) / np.maximum(size, 1)

    capital = (data >= 65) & (data <= 90)
    small = (data >= 97) & (data <= 122)
    symbol = np.isin(data, np.frombuffer(b"#$%&*@^~", np.uint8))
    out = np.zeros((n, len(PATTERNS)), bool)
    out[:, 0] = share(data == 33) > 0.02
    out[:, 1] = share(capital) > share(small)
    out[:, 2] = share(symbol) > 0.03
    out[:, 3] = share(data == 124) > 0.02
    out[:, 4] = (size > 0) & (size < 200)
    return out


def found_words(texts: pa.Array, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (text, place in ``words``); ``words`` are sorted hashes."""
    if len(words) == 0:
        z = np.zeros(0, np.int64)
        return z, z
    w = words_of(texts, WORD, STEM)
    pairs = []
    for h in (w.hashes, w.stems):
        at = np.minimum(np.searchsorted(words, h), len(words) - 1)
        hit = np.flatnonzero(words[at] == h)
        text = np.searchsorted(w.first, hit, side="right") - 1
        pairs.append(text * len(words) + at[hit])
    pair = np.unique(np.concatenate(pairs))
    return pair // len(words), pair % len(words)


class Voters:
    """Lexicons and patterns. A text's votes are bits of one number."""

    def __init__(self, words: np.ndarray, voter: np.ndarray):
        order = np.argsort(words)
        self.words, self.voter = words[order], voter[order]
        self.size = LEXICONS + len(PATTERNS)

    def votes(self, texts: pa.Array) -> np.ndarray:
        bits = np.zeros(len(texts), np.int64)
        text, word = found_words(texts, self.words)
        np.bitwise_or.at(bits, text, np.int64(1) << self.voter[word].astype(np.int64))
        p = patterns_of(texts)
        for k in range(p.shape[1]):
            bits |= p[:, k].astype(np.int64) << (LEXICONS + k)
        return bits


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (text, hash of a word or a word's stem)."""
    out: tuple[list, list] = ([np.zeros(0, np.int32)], [np.zeros(0, np.uint64)])
    for at, part in slices(texts, SLICE):
        w = words_of(part, WORD, STEM)
        text = np.repeat(np.arange(len(part)), np.diff(w.first))
        long = w.stems != 0
        text, h = np.concatenate([text, text[long]]), np.concatenate([w.hashes, w.stems[long]])
        order = np.lexsort((h, text))
        text, h = text[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        out[0].append((text[new] + at).astype(np.int32))
        out[1].append(h[new])
    return np.concatenate(out[0]), np.concatenate(out[1])


def mine(text: np.ndarray, word: np.ndarray, label: np.ndarray) -> Voters:
    """Words far more frequent in texts of label 1, by their ratio of shares."""
    vocabulary, at = np.unique(word, return_inverse=True)
    ones = np.bincount(at, label[text] == 1, len(vocabulary))
    zeros = np.bincount(at, label[text] == 0, len(vocabulary))
    n1, n0 = max(1, int((label == 1).sum())), max(1, int((label == 0).sum()))
    ratio = ((ones + 0.1) / n1) / ((zeros + 0.5) / n0)
    good = np.flatnonzero((ones >= LEAST_TEXTS) & (ratio >= LEAST_RATIO))
    good = good[np.lexsort((vocabulary[good], -ones[good]))][:MOST_LEXICON]
    return Voters(vocabulary[good], np.arange(len(good)) % LEXICONS)


# --- label model -------------------------------------------------------------


class LabelModel:
    """Naive Bayes over voters with weights against repetition."""

    def __init__(self, prior: float, rate: np.ndarray, weight: np.ndarray):
        # rate[y, voter]: share of texts of label y on which it fires
        self.prior, self.rate, self.weight = prior, rate, weight

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.log(self.rate), np.log1p(-self.rate)
        each = np.where(votes[:, None, :], log[0][None], log[1][None]) * self.weight
        score = each.sum(-1) + np.log([1 - self.prior, self.prior])
        return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -40, 40)))


def unpack(bits: np.ndarray, size: int) -> np.ndarray:
    return (bits[:, None] >> np.arange(size)) & 1 == 1


def fit_label_model(votes: np.ndarray, count: np.ndarray, seen: np.ndarray, label: np.ndarray, prior: float) -> LabelModel:
    """EM over counted combinations of votes (all documents), from labelled
    votes (``seen``, ``label``) whose counts stay in as a prior."""
    size = votes.shape[1]
    own = np.stack([(label == 0), (label == 1)]).astype(float)
    fired, total = own @ seen, own.sum(1)
    weight = np.ones(size)
    rate = (fired + 0.5) / (total[:, None] + 1)
    model = LabelModel(prior, rate, weight)
    for _ in range(ROUNDS):
        p = model.posterior(votes)
        soft = np.stack([(1 - p) * count, p * count])
        # labelled texts count as much as all others together
        pull = count.sum() / max(1.0, total.sum())
        rate = (soft @ votes + pull * fired + 0.5) / (soft.sum(1) + pull * total + 1)[:, None]
        model = LabelModel(prior, rate, weight)
        weight = _weights(votes, soft)
        model.weight = weight
    return model


def _weights(votes: np.ndarray, soft: np.ndarray) -> np.ndarray:
    """1 / (1 + the sum of a voter's positive correlations given the label)."""
    v = votes.astype(float)
    total = np.zeros((v.shape[1], v.shape[1]))
    for w in soft:
        n = w.sum()
        if n < 1:
            continue
        mean = w @ v / n
        cov = (v * w[:, None]).T @ v / n - np.outer(mean, mean)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        total += np.maximum(cov / np.outer(sd, sd), 0) * (n / soft.sum())
    np.fill_diagonal(total, 0)
    return 1 / (1 + total.sum(1))


# --- classifier --------------------------------------------------------------


class Classifier:
    """Logistic regression over distinct words and patterns of a text."""

    def __init__(self, words: np.ndarray, weight: np.ndarray, shape: np.ndarray, shift: float):
        self.words, self.weight, self.shape, self.shift = words, weight, shape, shift

    def score(self, texts: pa.Array) -> np.ndarray:
        text, word = found_words(texts, self.words)
        z = np.bincount(text, self.weight[word], len(texts)) if len(self.words) else np.zeros(len(texts))
        z = z + patterns_of(texts) @ self.shape + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(text, word, shapes: np.ndarray, target: np.ndarray, weight: np.ndarray) -> Classifier:
    """Words by how much their texts' posterior differs; then Adam on the
    weighted logistic loss with soft labels."""
    n = len(target)
    vocabulary, at = np.unique(word, return_inverse=True)
    df = np.bincount(at, minlength=len(vocabulary))
    mean = np.bincount(at, target[text], len(vocabulary)) / df
    base = target.mean()
    z = np.abs(mean - base) * np.sqrt(df)
    able = np.flatnonzero(df >= 3)
    pick = np.sort(able[np.lexsort((vocabulary[able], -z[able]))][:FEATURES])
    column = np.full(len(vocabulary), -1)
    column[pick] = np.arange(len(pick))
    col = column[at]
    row, col = text[col >= 0], col[col >= 0]
    size = len(pick) + shapes.shape[1]
    w, shift = np.zeros(size), float(np.log(max(base, 1e-6) / max(1 - base, 1e-6)))
    m1, m2 = np.zeros(size + 1), np.zeros(size + 1)
    shapes = shapes.astype(float)
    for step in range(1, STEPS + 1):
        s = np.bincount(row, w[col], n) + shapes @ w[len(pick) :] + shift
        d = (1 / (1 + np.exp(-np.clip(s, -40, 40))) - target) * weight / weight.sum()
        g = np.empty(size + 1)
        g[: len(pick)] = np.bincount(col, d[row], len(pick))
        g[len(pick) : size] = shapes.T @ d
        g[:size] += 2e-5 * w
        g[size] = d.sum()
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-9)
        w, shift = w - move[:size], shift - move[size]
    return Classifier(vocabulary[pick], w[: len(pick)], w[len(pick) :], shift)


# --- the operator ------------------------------------------------------------


def _vote_counter(voters: Voters):
    def run(batches):
        for b in batches:
            got = [voters.votes(part) for _, part in slices(b["text"], SLICE)]
            bits = np.concatenate(got) if got else np.zeros(0, np.int64)
            votes, count = np.unique(bits, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(votes), pa.array(count.astype(np.int64))], ["votes", "n"])

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows_per_class: int = ROWS_PER_CLASS,
    others: DataFrame | None = None,
    rows_unlabelled: int = ROWS_UNLABELLED,
) -> Classifier | float:
    """``labels`` has ``doc_id, label`` (0, 1; others are left out). ``others``:
    the doc_ids that may be learned from without a label (all documents'); those
    in ``labels`` are left out."""
    named = labels.where("doc_id is not null and label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return counts.get(1, 0) / total if total else 0.0
    prior = counts[1] / total
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen, marks = [], []
    for label in (0, 1):
        # small by the limit, whatever the input
        ids = named.where(F.col("label") == label).orderBy(*by_hash).limit(2 * rows_per_class)
        got = sampled(docs, ids, rows_per_class, rows_per_class * TRAIN_BYTES)
        chosen += got
        marks += [label] * len(got)
    label = np.array(marks)
    if len(set(marks)) < 2:
        return prior
    labelled = len(chosen)
    if rows_unlabelled:
        pool = (docs if others is None else others).select("doc_id").where("doc_id is not null")
        ids = pool.join(labels.select("doc_id"), "doc_id", "left_anti").distinct().orderBy(*by_hash).limit(2 * rows_unlabelled)
        chosen += sampled(docs, ids, rows_unlabelled, rows_unlabelled * TRAIN_BYTES)
    texts = pa.array(chosen, pa.large_string())
    text, word = text_words(texts)
    known = text < labelled
    voters = mine(text[known], word[known], label)
    counted = docs.select("text").mapInArrow(tidy(_vote_counter(voters)), "votes bigint, n bigint")
    combos = counted.groupBy("votes").agg(F.sum("n").alias("n")).toArrow()
    votes = unpack(combos["votes"].to_numpy(), voters.size)
    drawn = unpack(np.concatenate([voters.votes(part) for _, part in slices(texts, SLICE)]), voters.size)
    shapes = np.concatenate([patterns_of(part) for _, part in slices(texts, SLICE)])
    model = fit_label_model(votes, combos["n"].to_numpy().astype(float), drawn[:labelled], label, prior)
    # labelled rows have classes of the sample's own sizes and weigh as in the
    # whole; the others are as they come
    share = np.array([(label == 0).mean(), (label == 1).mean()])
    weight = np.append((np.array([1 - prior, prior]) / share)[label], np.ones(len(chosen) - labelled))
    return train(text, word, shapes, model.posterior(drawn), weight)


def scorer(model):
    def run(batches):
        for b in batches:
            if isinstance(model, float):
                got = np.full(b.num_rows, model)
            else:
                parts = [model.score(part) for _, part in slices(b["text"], SLICE)]
                got = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(got, pa.float64())], ["doc_id", "score"])

    return run


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns of the query ``op9``."""
    learn = labels.select("doc_id", F.col("toxic").alias("label")).where(remainder(F.col("doc_id"), 3) != 1)
    # held-out documents are not learned from at all, not even without a label
    pool = docs.where(remainder(F.col("doc_id"), 3) != 1).join(labels.select("doc_id"), "doc_id", "left_anti")
    model = fit(docs, learn, others=pool)
    scored = docs.select("doc_id", "text").mapInArrow(tidy(scorer(model)), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
