"""Toxicity: class-conditional Kneser-Ney models of word bigrams in toxic and ordinary texts.

The likelihoods of a bigram (previous word, word) in the two classes are compared by Kneser-Ney estimates on three levels:

    bigram  occurrences of the pair in each class
    word    continuation counts: the distinct previous words of the word in each class
    stem    continuation counts of the word's first ``STEM`` letters

From every count an absolute discount is taken, n1 / (n1 + 2 n2) of the counts of counts of the level.  What it frees, and
``BACKOFF`` counts that both classes share, are dealt to the classes as the next level deals them, the stem's as
the whole corpus is.  With f(class) the counts of a class, d the discount and t the classes that hold the unit:

    share(unit) = (max(f(toxic) - d, 0) + (BACKOFF + d t) share(unit's backoff)) / (f(toxic) + f(ordinary) + BACKOFF)

By Bayes' rule log(share / (1 - share)) less the same of the corpus is log P(unit | toxic) - log P(unit | ordinary), so a bigram
of one occurrence says about what its word says, an unknown word what its stem says, and what neither class knows
says nothing.  Words are lower-cased letter runs under 64-bit keys (40 bits of the stem, 24 of the word); within the
bigrams of a word the previous one goes by 32 bits.

A text's statistic is the sum over its distinct bigrams of what their log ratio has above ``MARGIN``, normalised by their number (plus ``PAD``,
for short texts).  A logistic curve, fitted on about ``PER_CLASS`` learned rows per class and corrected to their
true shares, turns it into a score.

All learned rows are counted.  Bigram rows are combined per chunk, before the shuffle and after it; no key is gathered anywhere.  The model is a table
of the units whose clipped log ratio differs from their backoff's, as differences, so a bigram's value is the sum of up to
three rows: it grows with the input.  Up to ``MODEL_ROWS`` rows are broadcast; a larger table is joined to the bigrams of the texts,
with the same sums.  The operator counts the bigrams of both classes (``every``): those of ordinary texts alone have shares below their word's and count for the
discount like any others.  Without ``every`` the functions keep to bigrams that toxic texts hold and leave others to their word.

Edge cases: null and empty texts and texts without letters have a statistic of 0; null labels are not learned
from; without learned rows of both classes all scores are 0; repeated rows count as often as they stand there; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .folds import class_counts, class_sample, fold
from .language_id import folded
from .textbatch import Chunk, chunks, code_points, mix, run_hashes, runs

STEM = 4
BACKOFF = 20.0
DISCOUNTS = 0.1, 0.95  # bounds of the discount that the counts of counts give
MARGIN = 1.0
PAD = 40
PER_CLASS = 2000
MODEL_ROWS = 1 << 23
LABEL_ROWS = 1 << 22  # up to so many labels are broadcast to the texts; more are merged with them
COUNT_BYTES = 1 << 22
THRESHOLD = 0.7
SCALE = 10.0  # of the statistic in the curve
_WORD_BITS = 24
_SPREAD = 2654435761  # odd; times a 32-bit number it stays within 64 bits


def words(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(owner text, key) of every word; the key's upper 40 bits are the stem's."""
    wide = code_points(c)
    data, is_letter = folded(wide.data)
    s, e = runs(is_letter)
    low = np.uint64((1 << _WORD_BITS) - 1)
    key = (run_hashes(data, s, np.minimum(e, s + STEM)) & ~low) | (run_hashes(data, s, e) & low)
    return np.searchsorted(wide.starts, s, "right") - 1, key


def before(owner: np.ndarray, word: np.ndarray) -> np.ndarray:
    """32-bit hash of the word before each word, 0 for a text's first."""
    out = np.concatenate(([0], mix(word[:-1]) >> np.uint64(32))).astype(np.uint32)
    out[np.concatenate(([True], owner[1:] != owner[:-1]))] = 0
    return out


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, before, ordinary, toxic) of a chunk: how often each bigram occurs in its texts of either class."""
    for batch in batches:
        label = batch.column(1).to_numpy().astype(bool)
        for c in chunks(batch.column(0), COUNT_BYTES):
            owner, word = words(c)
            if len(owner):
                toxic, prev = label[c.first + owner], before(owner, word)
                order = np.lexsort((prev, word))
                w, p = word[order], prev[order]
                new = np.concatenate(([True], (w[1:] != w[:-1]) | (p[1:] != p[:-1])))
                which = np.cumsum(new) - 1
                counts = [np.bincount(which, weights=k[order]).astype(np.int64) for k in (~toxic, toxic)]
                yield pa.RecordBatch.from_arrays([pa.array(w[new].view(np.int64)), pa.array(p[new].view(np.int32)), *map(pa.array, counts)],
                                                 names=["word", "before", "ordinary", "toxic"])


def unit_counts(rows: DataFrame, every: bool = False) -> DataFrame:
    """(word, before, ordinary, toxic) of rows (text, label), written to the scratch folder: the bigrams with their occurrences (those of toxic texts,
    or every one), and every word (before is null) with its continuation counts."""
    pairs = (rows.select("text", F.col("label").cast("bigint").alias("label"))
             .mapInArrow(_grams, "word bigint, before int, ordinary bigint, toxic bigint")
             .groupBy("word", "before").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")))
    named = pairs.groupBy("word").agg(F.lit(None).cast("int").alias("before"), F.count_if(F.col("ordinary") > 0).alias("ordinary"),
                                      F.count_if(F.col("toxic") > 0).alias("toxic"))
    folder = scratch_path(rows.sparkSession, "bigrams")
    named.unionByName(pairs if every else pairs.filter("toxic > 0")).write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _totals(counts: DataFrame) -> tuple[float, float]:
    """(discount n1 / (n1 + 2 n2) of the counts of both classes, the toxic share of all counts)."""
    once, twice = (F.sum((F.col("ordinary") == k).cast("bigint") + (F.col("toxic") == k).cast("bigint")) for k in (1, 2))
    n1, n2, toxic, ordinary = counts.agg(once, twice, F.sum("toxic"), F.sum("ordinary")).first()
    if not n1 and not n2:
        return DISCOUNTS[1], 0.5
    return min(max(n1 / max(1, n1 + 2 * n2), DISCOUNTS[0]), DISCOUNTS[1]), toxic / (toxic + ordinary)


def _share(discount: float, up: Column) -> Column:
    held = (F.col("ordinary") > 0).cast("int") + (F.col("toxic") > 0).cast("int")
    return ((F.greatest(F.col("toxic") - discount, F.lit(0.0)) + (held * discount + BACKOFF) * up)
            / (F.col("toxic") + F.col("ordinary") + BACKOFF))


def shares(rows: DataFrame, every: bool = False) -> tuple[float, list[DataFrame]]:
    """The toxic share of the corpus, and tables (unit, share, up) of the stems, words and bigrams of rows (text, label): toxic shares of the units and of their backoffs."""
    counts = unit_counts(rows, every)
    named = counts.filter("before IS NULL").select("word", F.shiftrightunsigned("word", _WORD_BITS).alias("stem"), "ordinary", "toxic")
    pairs = counts.filter("before IS NOT NULL")
    stems = named.groupBy("stem").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    (d_stem, corpus), (d_word, _), (d_pair, _) = _totals(stems), _totals(named), _totals(pairs)
    stems = stems.select(F.col("stem").alias("unit"), _share(d_stem, F.lit(corpus)).alias("share"), F.lit(corpus).alias("up"))
    named = (named.join(stems.select(F.col("unit").alias("stem"), F.col("share").alias("up")), "stem")
             .select(F.col("word").alias("unit"), _share(d_word, F.col("up")).alias("share"), "up", "toxic"))
    known = (named if every else named.filter("toxic > 0")).select(F.col("unit").alias("word"), F.col("share").alias("up"))
    pairs = pairs.join(known, "word").select(_bigram().alias("unit"), _share(d_pair, F.col("up")).alias("share"), "up")
    return corpus, [stems, named.drop("toxic"), pairs]


def _bigram() -> Column:
    """One key of word and before, the same as ``unit_keys`` gives."""
    return F.col("word").bitwiseXOR(F.col("before").cast("bigint") * F.lit(_SPREAD))


def model_table(rows: DataFrame, every: bool = False) -> DataFrame:
    """(level, unit, extra): what a stem (0), a word (1) or a bigram (2) adds to the clipped log ratio of its backoff, where that is not 0."""
    corpus, tables = shares(rows, every)

    def value(share: str) -> Column:
        return F.greatest(F.log(F.col(share) / (1 - F.col(share))) - float(np.log(corpus / (1 - corpus))) - MARGIN, F.lit(0.0))

    parts = [t.select(F.lit(level).alias("level"), "unit", (value("share") - value("up")).alias("extra")) for level, t in enumerate(tables)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("extra <> 0")


@dataclass
class Model:
    units: list[np.ndarray]  # of each level, in order
    extra: list[np.ndarray]

    def values(self, word: np.ndarray, prev: np.ndarray) -> np.ndarray:
        """Clipped log ratio of each bigram."""
        out = np.zeros(len(word))
        for units, extra, key in zip(self.units, self.extra, unit_keys(word, prev)):
            if len(units):
                at = np.minimum(np.searchsorted(units, key), len(units) - 1)
                out += np.where(units[at] == key, extra[at], 0)
        return out


def unit_keys(word: np.ndarray, prev: np.ndarray) -> list[np.ndarray]:
    """Stem, word and bigram of each bigram as the table has them."""
    return [(word >> np.uint64(_WORD_BITS)).view(np.int64), word.view(np.int64), word.view(np.int64) ^ (prev.view(np.int32).astype(np.int64) * _SPREAD)]


def collected(table: DataFrame) -> Model:
    found = table.toArrow()
    level, unit, extra = (found[c].to_numpy() for c in ("level", "unit", "extra"))
    parts = [np.flatnonzero(level == k) for k in range(3)]
    parts = [p[np.argsort(unit[p])] for p in parts]
    return Model([unit[p] for p in parts], [extra[p] for p in parts])


def distinct_bigrams(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner text, word, hash of the word before) of the distinct bigrams of each text."""
    owner, word = words(c)
    if not len(owner):
        return owner, word, word.astype(np.uint32)
    prev = before(owner, word)
    pair = mix(word + prev)
    order = np.lexsort((pair, owner))
    new = np.concatenate(([True], (np.diff(owner[order]) != 0) | (pair[order][1:] != pair[order][:-1])))
    order = order[new]
    return owner[order], word[order], prev[order]


def statistic(model: Model, texts: pa.Array) -> np.ndarray:
    """Sum of the clipped log ratios of each text's distinct bigrams over their number."""
    out = np.zeros(len(texts))
    for c in chunks(texts):
        owner, word, prev = distinct_bigrams(c)
        total = np.bincount(owner, weights=model.values(word, prev), minlength=c.n)
        out[c.first : c.first + c.n] = total / (np.bincount(owner, minlength=c.n) + PAD)
    return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, level, unit, share) of the distinct bigrams of each text; share is one over the normaliser."""
    for batch in batches:
        row = batch.column(0).to_numpy()
        for c in chunks(batch.column(1)):
            owner, word, prev = distinct_bigrams(c)
            share = 1 / (np.bincount(owner, minlength=c.n) + PAD)
            for level, key in enumerate(unit_keys(word, prev)):
                yield pa.RecordBatch.from_arrays([pa.array(row[c.first + owner]), pa.array(np.full(len(owner), level, dtype=np.int32)), pa.array(key),
                                                  pa.array(share[owner])], names=["row", "level", "unit", "share"])


def with_statistic(docs: DataFrame, table: DataFrame, column: str, model: Model | None) -> DataFrame:
    """docs (doc_id, text, any others) with the statistic; ``model`` is the collected table, None if it is too large for that."""
    if model is not None:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        @F.arrow_udf("double")
        def value(texts: pa.Array) -> pa.Array:
            return pa.array(statistic(shared.value, texts))

        return docs.withColumn(column, value(F.col("text")))
    row = f"{column}_row"
    docs = docs.withColumn(row, F.monotonically_increasing_id())
    units = docs.select(F.col(row).alias("row"), "text").mapInArrow(_units, "row bigint, level int, unit bigint, share double")
    sums = (units.join(table, ["level", "unit"]).groupBy(F.col("row").alias(row)).agg(F.sum(F.col("extra") * F.col("share")).alias(column)))
    return docs.join(sums, row, "left").drop(row).fillna(0.0, [column])


def calibrate(x: np.ndarray, y: np.ndarray, odds: float) -> tuple[float, float]:
    """Slope and intercept of a lightly regularised logistic curve; ``odds`` moves it from the sample's to the true class shares."""
    w = np.array([1.0, 0.0])
    design = np.stack((x, np.ones_like(x)), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + np.array([1e-2, 1e-3]) * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-2, 1e-3])
        w = w - np.linalg.solve(curve, slope)
    return float(w[0]), float(w[1] + odds)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learned from the labelled rows outside the held-out fold."""
    known = (labels.filter("toxic IN (0, 1)").filter(fold(F.col("doc_id"), 3) != 1)
             .select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")).distinct())
    texts = docs.select("doc_id", "text")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    rows = class_counts(known, "label")
    if len(rows) < 2:
        return texts.select("doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    wide = known.hint("broadcast" if sum(rows.values()) <= LABEL_ROWS else "merge")
    table = model_table(texts.join(wide, F.col("doc_id") == F.col("id")), every=True).checkpoint()
    model = collected(table) if table.count() <= MODEL_ROWS else None
    picked = class_sample(known, "label", "id", PER_CLASS, rows)  # about 2 * PER_CLASS rows of two numbers: ids are distinct
    points = with_statistic(texts.join(F.broadcast(picked), F.col("doc_id") == F.col("id")), table, "x", model).select("x", "label").toPandas()
    held = points["label"].value_counts()
    score = F.lit(0.0)
    if len(held) == 2:
        odds = np.log(rows[1] / held[1]) - np.log(rows[0] / held[0])
        a, b = calibrate(SCALE * points["x"].to_numpy(), points["label"].to_numpy().astype(float), float(odds))
        score = 1 / (1 + F.exp(-(SCALE * F.col("_x") * a + b)))
    return with_statistic(texts, table, "_x", model).select("doc_id", held_out, score.alias("score"), F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted"))
