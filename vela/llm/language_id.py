"""Language identification with bit-sliced Bloom filters.

The filters of all languages share one array of ``SLOTS`` bit masks, one bit per language (64
languages to a word).  Looking an n-gram up in ``PROBES`` slots and intersecting the masks returns every
language that contains it.  A text's bits are counted per language; the count expected from false
positives (the language's fill to the power of PROBES, for every n-gram) is taken off; the largest
corrected count decides, ties going to the smaller language name.  The score is its share of all
corrected counts.

A language's set holds its ``TOP`` n-grams by number of sampled texts, from about ``PER_LANGUAGE`` texts
of each language picked by hash; an n-gram that is much rarer in a language than in another (by LEAST_SHARE)
is left out there, as it stems from foreign passages and wrong labels.  n-grams are taken within letter runs (one separator kept on
either side), lower-cased, for n in ``GRAMS``.

Whole texts are scored in one Arrow pass without shuffle.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; a text none of whose n-grams is known
is the largest language with score 0; null languages are not learned from; without any learned language all is ``und``; repeated
rows are scored alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .folds import class_counts, class_sample, fold
from .textbatch import Chunk, chunks, code_points, gram_hashes

GRAMS = (1, 2, 3, 4)
PER_LANGUAGE = 600
TOP = 20_000
LEAST_TEXTS = 2
LEAST_SHARE = 0.25
SLOTS = 1 << 20
PROBES = 2

_PLANE = 1 << 16
_IS_LETTER = np.array([chr(i).isalpha() for i in range(_PLANE)])
_LOWER = np.array([ord(chr(i).lower()) if len(chr(i).lower()) == 1 else i for i in range(_PLANE)], dtype=np.uint32)


def letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    out = _IS_LETTER[np.minimum(points, _PLANE - 1)]
    high = np.flatnonzero(points >= _PLANE)
    if len(high):
        out[high] = [chr(p).isalpha() for p in points[high]]
    return out


def folded(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with 0 for all but letters, and which are letters."""
    is_letter = letters(points)
    lower = np.where(points < _PLANE, _LOWER[np.minimum(points, _PLANE - 1)], points)
    return np.where(is_letter, lower, 0).astype(np.uint32), is_letter


def grams(c: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner text, hash) of the n-grams that hold letters, separators only at their ends."""
    wide = code_points(c)
    data, is_letter = folded(wide.data)
    owner = np.repeat(np.arange(wide.n), np.diff(wide.starts))
    upto = np.concatenate(([0], np.cumsum(is_letter)))
    for n in GRAMS:
        h = gram_hashes(data, n)
        if not len(h):
            continue
        held = upto[n:] - upto[:-n]
        ends = is_letter[: len(h)].astype(np.int64) + is_letter[n - 1:] if n > 1 else 0
        inner = held - ends if n > 1 else held
        good = (inner == max(n - 2, 1)) if n != 2 else (held > 0)
        good &= owner[: len(h)] == owner[n - 1:]
        yield owner[: len(h)][good], h[good] ^ np.uint64(n)


@dataclass
class Filters:
    languages: list[str]
    slots: np.ndarray  # words x SLOTS, uint64
    false_rate: np.ndarray  # per language

    def masks(self, word: int, h: np.ndarray) -> np.ndarray:
        out = self.slots[word][(h & np.uint64(SLOTS - 1)).astype(np.int64)]
        for k in range(1, PROBES):
            out = out & self.slots[word][((h >> np.uint64(20 * k)) & np.uint64(SLOTS - 1)).astype(np.int64)]
        return out


def build(sets: dict[str, np.ndarray]) -> Filters:
    """Filters of n-gram hash sets by language."""
    names = sorted(sets)
    slots = np.zeros((max(1, -(-len(names) // 64)), SLOTS), dtype=np.uint64)
    fill = np.zeros(len(names))
    for k, name in enumerate(names):
        bit = np.uint64(1 << (k % 64))
        for probe in range(PROBES):
            slots[k // 64][((sets[name] >> np.uint64(20 * probe)) & np.uint64(SLOTS - 1)).astype(np.int64)] |= bit
        fill[k] = ((slots[k // 64] & bit) != 0).mean()
    return Filters(names, slots, fill ** PROBES)


def counted(filters: Filters, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Corrected counts (texts x languages) and whether a text has a letter."""
    n_lang = len(filters.languages)
    out, lettered = np.zeros((len(texts), n_lang)), np.zeros(len(texts), dtype=bool)
    for c in chunks(texts):
        hits, total = np.zeros((c.n, n_lang)), np.zeros(c.n)
        for owner, h in grams(c):
            total += np.bincount(owner, minlength=c.n)
            for word in range(len(filters.slots)):
                mask = filters.masks(word, h)
                some = np.flatnonzero(mask)
                for k in range(64 * word, min(n_lang, 64 * word + 64)):
                    at = some[(mask[some] >> np.uint64(k % 64)) & np.uint64(1) == 1]
                    hits[:, k] += np.bincount(owner[at], minlength=c.n)
        rows = slice(c.first, c.first + c.n)
        lettered[rows] = total > 0
        out[rows] = np.maximum(0, hits - total[:, None] * filters.false_rate) / (1 - filters.false_rate)
    return out, lettered


def fit(sample: DataFrame) -> Filters:
    """Filters of a bounded sample (text, lang): texts per n-gram are counted in Spark, TOP rows per language come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for c in chunks(batch.column(0)):
                owner, h = (np.concatenate(x) for x in zip(*grams(c)))
                order = np.lexsort((h, owner))
                owner, h = owner[order], h[order]
                new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, dtype=bool)
                name = langs[c.first: c.first + c.n][owner[new]]
                for lang in np.unique(name.astype(str)) if len(name) else []:
                    key, n = np.unique(h[new][name == lang], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array(key.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    counts = (sample.select("text", "lang").mapInArrow(run, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TEXTS))
    size = sample.groupBy(F.col("lang").alias("lang_")).agg(F.count(F.lit(1)).alias("texts"))
    shares = counts.join(size, F.col("lang") == F.col("lang_")).withColumn("share", F.col("n") / F.col("texts"))
    counts = shares.withColumn("most", F.max("share").over(W.partitionBy("gram"))).filter(F.col("share") >= LEAST_SHARE * F.col("most"))
    best = W.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = counts.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= TOP).select("lang", "gram").toPandas()
    return build({lang: rows["gram"].to_numpy().view(np.uint64) for lang, rows in top.groupby("lang")})


def with_language(docs: DataFrame, filters: Filters) -> DataFrame:
    """docs with a struct column _l of lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        f = shared.value
        if not f.languages:
            return pa.StructArray.from_arrays([pa.array(["und"] * len(texts), pa.string()), pa.array([0.0] * len(texts))], names=["lang_pred", "score"])
        counts, lettered = counted(f, texts)
        best = counts.argmax(axis=1)
        total = counts.sum(axis=1)
        score = np.where(lettered & (total > 0), counts.max(axis=1) / np.maximum(total, 1e-12), 0.0)
        names = [f.languages[k] if ok else "und" for k, ok in zip(best, lettered)]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], names=["lang_pred", "score"])

    return docs.withColumn("_l", predict(F.col("text")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the rows outside the held-out fold."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(fold(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang")
    filters = fit(class_sample(known, "lang", "doc_id", PER_LANGUAGE, class_counts(known.select("lang"), "lang")))
    return with_language(docs.select("doc_id", "text"), filters).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "_l.lang_pred", "_l.score")
