"""Quality rules whose cutoffs come from the corpus: mergeable quantile sketches per language and source.

Two steps:

1. ``text_stats``: word, symbol, line, repeated-line and repeated-window counts of each
   whole text, one Arrow pass, no shuffle.
2. ``thresholds`` / ``judge``: each rate is put in a logarithmic bucket (buckets grow
   by ``GROWTH``, as in relative-error quantile sketches); the sketch of a group is the
   count per bucket, so sketches merge by adding.  A (lang, source) group's quantiles are blended with those of its language, as
   if these were ``WEIGHT`` more texts of the group, and the language's likewise with the whole corpus'.  The upper cutoff of a rate lies
   ``spreads`` times the distance from the median to its upper quantile above that quantile (``RATES``), the lower one of the word length
   mirrors it; that distance counts as ``FLOOR`` of the median at least.  A text fails a rule when its count lies above cutoff times base by more
   than ``slack``: one window that occurs twice, one line, three symbols.

Sketches are counts: their merge is exact and does not depend on order or
partitioning.  A hot group only ever sends one row per bucket and task.

Edge cases: null and empty texts have no words, fail the base rule (``n_words`` below
50) and stay out of the sketches; null languages and sources form groups of their
own; an empty table gives an empty result; repeated rows are judged alike; extra
columns pass through whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .folds import unused
from .textbatch import SPACE, chunks, combine, run_hashes, runs, window_owner

MIN_WORDS = 50
WEIGHT = 200
GROWTH = 1.02
FLOOR = 0.02
WINDOW = 3
ZERO = -100000  # the bucket of rate 0, below all others

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_STATS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in STATS) + ">"


@dataclass(frozen=True)
class Rate:
    """count / base of a text, judged by its group's quantile ``upper`` (per cent)."""

    name: str
    count: str
    base: str
    upper: int
    spreads: float
    slack: int
    below: bool = False  # whether too low a rate fails as well


RATES = (Rate("word_length", "word_chars", "n_words", 90, 4.0, 0, True), Rate("symbol_rate", "n_symbols", "n_words", 90, 4.0, 3),
         Rate("dup_lines", "n_dup_lines", "n_lines", 98, 0.5, 1), Rate("repeat_rate", "n_repeat_words", "n_words", 98, 0.5, 6))


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier one, and lines with a word."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines)), len(lines)


def _repeat_words(words: np.ndarray, owner: np.ndarray, n_docs: int) -> np.ndarray:
    """Per text: words in a window of WINDOW words that its text holds twice or more."""
    out = np.zeros(n_docs, dtype=np.int64)
    one, doc = window_owner(owner, WINDOW)
    if not one.any():
        return out
    at = np.flatnonzero(one)
    key = combine(words, WINDOW)[at] ^ (doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    found = at[times[which] > 1]
    mark = np.zeros(len(words), dtype=bool)
    for k in range(WINDOW):
        mark[found + k] = True
    return np.bincount(owner[mark], minlength=n_docs).astype(np.int64)


def _stats(texts: pa.Array) -> pa.Array:
    out = np.zeros((len(STATS), len(texts)), dtype=np.int64)
    for c in chunks(texts):
        rows = slice(c.first, c.first + c.n)
        s, e = runs(~SPACE[c.data])
        owner = np.searchsorted(c.starts, s, "right") - 1
        visible = ~SPACE[c.data] & ((c.data & 0xC0) != 0x80)
        out[0, rows] = np.bincount(owner, minlength=c.n)
        for k, hit in ((1, visible), (2, _SYMBOL[c.data])):
            out[k, rows] = np.add.reduceat(hit, c.starts[:-1], dtype=np.int64)
        out[4, rows] = _repeat_words(run_hashes(c.data, s, e), owner, c.n)
        raw = c.data.tobytes()
        out[[3, 5], rows] = np.array([_lines(raw[a:b - 1]) for a, b in zip(c.starts[:-1], c.starts[1:])]).T
    return pa.StructArray.from_arrays([pa.array(x) for x in out], names=list(STATS))


def text_stats(text: Column) -> Column:
    """Struct of the counts of a text."""
    @F.arrow_udf(_STATS_TYPE)
    def stats(texts: pa.Array) -> pa.Array:
        return _stats(texts)

    return stats.asNondeterministic()(text)  # evaluated once, never repeated by a filter that moves below it


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Too short, or mostly made of repeated windows."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def _bucket(rate: Column) -> Column:
    """Logarithmic bucket of a rate."""
    return F.when(rate <= 0, F.lit(ZERO)).otherwise(F.ceil(F.log(rate) / F.lit(float(np.log(GROWTH))))).cast("int")


def sketches(stats: DataFrame, s: str = "_s") -> DataFrame:
    """Counts per (lang, source, rate, bucket) of the texts that pass the base rule; stats has lang, source and the counts in ``s``."""
    rates = F.array(*[F.struct(F.lit(r.name).alias("rate"), _bucket(F.col(f"{s}.{r.count}") / F.col(f"{s}.{r.base}")).alias("bucket")) for r in RATES])
    return (stats.filter(~base_failed(F.col(f"{s}.n_words"), F.col(f"{s}.n_repeat_words")))
            .select("lang", "source", F.explode(rates).alias("r"))
            .groupBy("lang", "source", F.col("r.rate").alias("rate"), F.col("r.bucket").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def _quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and rate: row count, median, upper quantile and the lower one that mirrors it, from the merged counts."""
    merged = sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))
    by = W.partitionBy(*keys, "rate")
    ranked = merged.select(*keys, "rate", "bucket", F.sum("n").over(by).alias("rows"), F.sum("n").over(by.orderBy("bucket")).alias("upto"))
    value = F.when(F.col("bucket") == ZERO, 0.0).otherwise(F.pow(F.lit(GROWTH), F.col("bucket") - 0.5))
    upper = F.lit(0)
    for r in RATES:
        upper = F.when(F.col("rate") == r.name, r.upper).otherwise(upper)
    picks = [F.min(F.when(F.col("upto") * 100 >= F.col("rows") * k, value)).alias(n) for n, k in (("low", 100 - upper), ("mid", F.lit(50)), ("high", upper))]
    return ranked.groupBy(*keys, "rate").agg(F.max("rows").alias("rows"), *picks)


def _blended(own: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Quantiles of the groups with WEIGHT rows' worth of those of the groups they are part of."""
    up = parent.select(*[F.col(k).alias(f"up_{k}") for k in (*keys, "rate")], *[F.col(q).alias(f"up_{q}") for q in ("low", "mid", "high")])
    on = F.col("rate") == F.col("up_rate")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"up_{k}"))
    mixed = [((F.col("rows") * F.col(q) + F.lit(WEIGHT) * F.col(f"up_{q}")) / (F.col("rows") + WEIGHT)).alias(q) for q in ("low", "mid", "high")]
    return own.join(up, on).select(*[c for c in own.columns if c not in ("low", "mid", "high")], *mixed)


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): the lower and upper cutoff of each rate, as a struct column ``cut``."""
    lang = _blended(_quantiles(sketch, ["lang"]), _quantiles(sketch, []), [])
    own = _blended(_quantiles(sketch, ["lang", "source"]), lang.drop("rows"), ["lang"])
    cuts = []
    for r in RATES:
        mid, low, high = (F.max(F.when(F.col("rate") == r.name, F.col(q))) for q in ("mid", "low", "high"))
        least = FLOOR * mid
        cuts.append((low - r.spreads * F.greatest(mid - low, least) if r.below else F.lit(-1.0)).alias(f"{r.name}_low"))
        cuts.append((high + r.spreads * F.greatest(high - mid, least)).alias(f"{r.name}_high"))
    return own.groupBy("lang", "source").agg(F.struct(*cuts).alias("cut"))


def judge(stats: DataFrame, cuts: DataFrame, s: str = "_s") -> tuple[DataFrame, Column, Column]:
    """stats joined with the cutoffs under free names, whether the base rule failed, and whether the text is kept; rows of groups without a sketch fail the base rule."""
    lang, source, cut = (unused(stats, x) for x in ("cut_lang", "cut_source", "cut"))
    named = cuts.select(F.col("lang").alias(lang), F.col("source").alias(source), F.col("cut").alias(cut))
    joined = stats.join(named, F.col("lang").eqNullSafe(F.col(lang)) & F.col("source").eqNullSafe(F.col(source)), "left")
    fails = F.lit(False)
    for r in RATES:
        count, base = F.col(f"{s}.{r.count}"), F.col(f"{s}.{r.base}")
        fails = fails | (count < F.col(f"{cut}.{r.name}_low") * base - r.slack) | (count > F.col(f"{cut}.{r.name}_high") * base + r.slack)
    base_fails = base_failed(F.col(f"{s}.n_words"), F.col(f"{s}.n_repeat_words"))
    return joined, base_fails, ~base_fails & F.coalesce(~fails, F.lit(True))


def _written(cuts: DataFrame) -> DataFrame:
    """The cutoffs as a table of known size, so that the planner broadcasts them only below its own threshold."""
    path = scratch_path(cuts.sparkSession, "cutoffs")
    cuts.write.parquet(path)
    return cuts.sparkSession.read.schema(cuts.schema).parquet(path)


def filter_docs(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, unchanged.  Reads docs twice: once for the sketches, once to judge."""
    sketch = sketches(docs.select("lang", "source", text_stats(F.col("text")).alias("_s"))).checkpoint()
    s = unused(docs, "stats")
    joined, _, kept = judge(docs.withColumn(s, text_stats(F.col("text"))), _written(thresholds(sketch)), s)
    return joined.filter(kept).select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed and kept of every row; texts are read once."""
    stats = docs.select("doc_id", "lang", "source", text_stats(F.col("text")).alias("_s")).checkpoint()
    joined, base_fails, kept = judge(stats, thresholds(sketches(stats).checkpoint()))
    return joined.select("doc_id", *[F.col(f"_s.{c}").alias(c) for c in STATS[:5]], base_fails.alias("base_failed"), kept.alias("kept"))
