"""Quality classifier: supervised subword embeddings.

Features of a text are its words, pairs of neighbouring words (a repeated word counts as the same mark
whatever the word) and character n-grams, hashed into ``BUCKETS`` rows of a learned table.  The document
vector is the average of its features' vectors; a linear layer with softmax gives the class
probabilities.  Table and layer are learned together by stochastic gradient descent in numpy, in one
task, from a sample of about ``PER_CLASS`` rows per class; the class prior is restored afterwards
from all labelled rows.  As the score is linear in the average, a model is kept as one logit per bucket and
class (``BUCKETS`` x classes floats, broadcast).

Whole texts are scored in one Arrow pass without shuffle.

Edge cases: null and empty texts have no features and get the score of the bias alone; labels that are null
are not learned from; without a labelled row, or with one class only, the score is that class's share (0.5
without any); repeated rows are scored alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import class_counts, class_sample, fold
from .textbatch import Chunk, chunks, code_points, combine, gram_hashes, run_hashes, runs, window_owner

BUCKETS = 1 << 17
DIM = 8
GRAMS = (3, 4)
PER_CLASS = 1500
EPOCHS = 6
RATE, TABLE_RATE = 0.5, 40.0
SEED = 7
_SAME = np.uint64(0x51ED270B0A1F39C5)


def spaces(points: np.ndarray) -> np.ndarray:
    return (points == 32) | ((points >= 9) & (points <= 13))


def features(c: Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
    """(owner text, bucket) arrays of a chunk's features, each in text order."""
    wide = code_points(c)
    s, e = runs(~spaces(wide.data))
    words = run_hashes(wide.data, s, e)
    owner = np.searchsorted(wide.starts, s, "right") - 1
    out = [(owner, words)]
    if len(words) > 1:
        inside, first = window_owner(owner, 2)
        pairs = np.where(words[:-1] == words[1:], _SAME, combine(words, 2))
        out.append((first[inside], pairs[inside]))
    text = np.repeat(np.arange(wide.n), np.diff(wide.starts))
    for n in GRAMS:
        h = gram_hashes(wide.data, n)
        if len(h):
            inside = text[: len(h)] == text[n - 1:]
            inside &= np.arange(len(h)) + n < wide.starts[1:][text[: len(h)]]  # not over the separator
            out.append((text[: len(h)][inside], h[inside]))
    return [(o, (h & np.uint64(BUCKETS - 1)).astype(np.int64)) for o, h in out]


def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: distinct buckets and their shares."""
    out = []
    for c in chunks(texts):
        owner, bucket = (np.concatenate(x) for x in zip(*features(c)))
        key, times = np.unique(owner * BUCKETS + bucket, return_counts=True)
        at = np.searchsorted(key, np.arange(c.n + 1) * BUCKETS)
        for a, b in zip(at[:-1], at[1:]):
            out.append((key[a:b] % BUCKETS, times[a:b] / max(1, times[a:b].sum())))
    return out


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int) -> np.ndarray:
    """Logits per bucket and class, with the bias in a last row."""
    rng = np.random.default_rng(SEED)
    table = rng.normal(0, 0.1, (BUCKETS, DIM))
    layer = rng.normal(0, 0.5, (DIM, n_classes))
    bias = np.zeros(n_classes)
    total, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            ids, share = docs[i]
            rate = 1 - done / total
            done += 1
            rows = table[ids]
            hidden = share @ rows
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            down = layer @ p
            layer -= rate * RATE * np.outer(hidden, p)
            bias -= rate * 0.02 * p
            table[ids] = rows - (rate * TABLE_RATE) * share[:, None] * down
    return np.vstack((table @ layer, bias[None, :]))


def fit(sample: DataFrame, counts: dict[int, int], classes: tuple[int, ...] = (0, 1)) -> np.ndarray:
    """Model (float32, BUCKETS + 1 rows, one column per class) of a bounded sample (text, label), trained in one task.

    ``counts``: rows of each class in the whole labelled table."""
    def run(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["label", "text"], kind="stable", na_position="first")  # whatever order the rows arrive in
        model = train(bags(pa.array(table["text"], pa.string())), np.searchsorted(classes, table["label"].to_numpy()), len(classes))
        for k, v in enumerate(classes):
            held = int((table["label"] == v).sum())
            model[-1, k] += np.log(counts[v] / held) if held and counts.get(v) else -30.0
        return pd.DataFrame({"model": [model.astype(np.float32).tobytes()]})

    rows = sample.filter(F.col("label").isin(*classes)).select("text", F.col("label").cast("int").alias("label"), F.lit(1).alias("one"))
    found = rows.groupBy("one").applyInPandas(run, "model binary").collect()
    if not found:
        return np.zeros((BUCKETS + 1, len(classes)), dtype=np.float32)
    return np.frombuffer(found[0][0], dtype=np.float32).reshape(BUCKETS + 1, len(classes))


def probabilities(model: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Class probabilities (texts x classes)."""
    n_classes = model.shape[1]
    out = np.zeros((len(texts), n_classes))
    for c in chunks(texts):
        total, n = np.zeros((c.n, n_classes)), np.zeros(c.n)
        for owner, bucket in features(c):
            n += np.bincount(owner, minlength=c.n)
            for k in range(n_classes):
                total[:, k] += np.bincount(owner, weights=model[bucket, k], minlength=c.n)
        out[c.first: c.first + c.n] = total / np.maximum(n, 1)[:, None]
    out += model[-1]
    out = np.exp(out - out.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def with_score(docs: DataFrame, model: np.ndarray, column: str = "score", which: int = 1) -> DataFrame:
    """docs with the probability of class number ``which`` of its text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(probabilities(shared.value, texts)[:, which])

    return docs.withColumn(column, score(F.col("text")))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learned from the labelled rows outside the held-out fold."""
    known = labels.filter("quality IS NOT NULL").filter(fold(F.col("doc_id"), 3) != 1).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    known = known.filter("label IN (0, 1)")
    counts = class_counts(known, "label")
    picked = F.broadcast(class_sample(known, "label", "id", PER_CLASS, counts))  # about 2 * PER_CLASS rows of two numbers
    sample = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("id"))
    return with_score(docs.select("doc_id", "text"), fit(sample, counts)).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
