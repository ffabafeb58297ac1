"""Ranked lexical search: the highest-scoring documents of every query text, by integer impact scores.

Queries are taken in blocks of about ``QUERY_BYTES`` of text.  For a block, one pass over the documents keeps the counts of
the block's terms (a row per document, in a table in the shared scratch folder); N, L and each term's df come from that
table by partial aggregates.  A second pass reads the table split by split: the documents of a split are indexed
``BLOCK_POSTINGS`` postings at a time (``impact_index``) and every query is searched in each index, with the
k-th score so far carried on from one index to the next.  A task returns k rows a query at most; a
window with a partial limit merges them.  Nothing but the queries, their terms and df goes through the driver, all
bounded by QUERY_BYTES; postings are never shuffled, so a word that all documents hold
is split like any other.

Terms: ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.  A score sums over the query's terms, repeats
included, w * ((1000000000 * tf) div (1000 * tf + 8 * m)), w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 25 + (75 * n * N) div L.

Edge cases: null and empty texts are no documents and match nothing; every row is a document, repeated ones too; equal
scores go by doc_id, a null doc_id after all others; rows of one item_id and text are one query, a null or empty
query finds nothing; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .impact_index import Best, Index

TOP = 10
QUERY_BYTES = 1 << 25
BLOCK_POSTINGS = 1 << 20
#: The same characters on UTF-8 bytes: every byte of a character beyond ASCII belongs to a term.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode("utf-8").lower())


def counts_of_terms(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: its length and the counts of the terms in ``number``."""
    held = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value
        known = number.keys()
        for batch in batches:
            keep, n, bounds, terms, tfs = [], [], [0], [], []
            for k, text in enumerate(batch.column(1)):
                count = Counter(TERM.findall(text.as_buffer().to_pybytes().lower())) if text.is_valid else None
                if count:
                    some = sorted((number[t], count[t]) for t in count.keys() & known)
                    keep.append(k)
                    n.append(count.total())
                    terms += [t for t, _ in some]
                    tfs += [c for _, c in some]
                    bounds.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), *lists],
                                             names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


def _indexes(batches: Iterator[pa.RecordBatch], n_terms: int, n_docs: int, n_words: int) -> Iterator[tuple[Index, np.ndarray, np.ndarray]]:
    """Indexes of about BLOCK_POSTINGS postings each, with the ids of their documents."""
    held, size = [], 0

    def index() -> tuple[Index, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        ids = table["doc_id"].combine_chunks()
        tf = table["tfs"].combine_chunks()
        doc = np.repeat(np.arange(len(ids)), np.diff(tf.offsets.to_numpy()))
        m = 25 + (75 * table["n"].to_numpy() * n_docs) // n_words
        tfs = tf.flatten().to_numpy().astype(np.int64)
        impact = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[doc])
        found = Index(len(ids), n_terms, table["terms"].combine_chunks().flatten().to_numpy(), doc, impact)
        return found, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            held.append(batch.slice(at, 1024))
            size += len(held[-1].column(2).flatten())
            if size >= BLOCK_POSTINGS:
                yield index()
                held, size = [], 0
    if held:
        yield index()


def _search_block(docs: DataFrame, queries: list[tuple[int | None, list[bytes]]], first: int, top: int) -> DataFrame:
    """(query, item_id, doc_id, score): the best of every split for every query."""
    spark = docs.sparkSession
    number = {t: k for k, t in enumerate(sorted({t for _, terms in queries for t in terms}))}
    folder = scratch_path(spark, "terms")
    counts_of_terms(docs, number).write.parquet(folder)
    counts = spark.read.parquet(folder)
    n_docs, n_words = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r[0]: r[1] for r in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # of the block's terms only
    plans = []
    for item, terms in queries:
        repeats = Counter(number[t] for t in terms)
        used = [t for t in sorted(repeats) if t in df]
        weight = [repeats[t] * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in used]
        plans.append((item, np.array(used, dtype=np.int64), np.array(weight, dtype=np.int64)))
    held = spark.sparkContext.broadcast((plans, len(number)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans, n_terms = held.value
        best = [Best(top) for _ in plans]
        for index, ids, null in _indexes(batches, n_terms, n_docs, n_words):
            for (_, terms, weights), found in zip(plans, best):
                index.search(terms, weights, ids, null, found)
        rows = [(first + q, plans[q][0], None if none else i, -score) for q, found in enumerate(best) for score, none, i in found.rows]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["query", "item_id", "doc_id", "score"])

    return counts.mapInArrow(run, "query bigint, item_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents (doc_id, text) of every item (item_id, text) with a score above 0."""
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / QUERY_BYTES))
    found = None
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        queries = [(r.item_id, terms_of(r.text)) for r in sorted(rows, key=lambda r: (r.item_id is None, r.item_id or 0, r.text))]
        part = _search_block(docs, queries, block << 32, top)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))
