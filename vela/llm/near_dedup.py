"""Near-duplicate groups by an LSH forest over MinHash signatures, links confirmed on full shingle sets.

1. Every text's distinct word shingles are hashed to 48 bits; HASHES minimum hashes are its
   signature.  Texts with equal sets (a 128-bit digest) form a class; one document stands for it.
2. The signature is cut into TREES paths of DEPTH values.  Each tree is one sorted order of the
   paths; a document's candidates are the documents next to it, up to NEAR and then NEIGHBOURS on
   either side, that share LEAST_PREFIX values at least.  Where few documents share a prefix that reaches all of them;
   in a crowded region the nearest in the order are those with the longest common prefix, so the
   depth that counts adapts to the region.  Orders are range-partitioned by (tree, path, document), so even
   equal paths spread over tasks.  Documents whose prefix nobody shares are left out before the sort.
3. Candidates are compared on an 8-bit sketch of the signature; pairs clearly below the threshold go, and so do pairs
   whose set sizes alone rule a link out.
4. Links are confirmed on full sets, in two rounds: first the FIRST best candidates of every document among the
   NEAR next ones; then all candidates among the NEIGHBOURS next ones whose ends are in different components so
   far.  A large group of near copies thus costs a few checks a document, not all its pairs.  Sets are
   computed again from the texts of candidate documents only; a fixed-size bitmap of their ids tells
   which, so texts are not shuffled.
5. The windows of 4 cannot see all of a prefix that more than NEIGHBOURS + 1 documents share.  The documents of such
   prefixes that lie in different components go through an exact join (``crowded``): shingles are ordered by how few of
   these documents hold them, those held in one component only first; linked documents share one of the first
   n - ceil(0.75 n) + 1, whatever the order, and at the first that they share enough of both sets is still to come.  Documents whose rare shingles suffice leave at once; holders of the same
   shingle are compared in blocks of BLOCK, each pair of blocks in a task of its own.
6. Components by alternating star steps; a class takes the component of its document.

Edge cases: null and empty texts and texts without words have no set, are linked with nothing and kept; texts
with fewer than SHINGLE words have one shingle, the whole sequence; a null doc_id is linked with nothing,
gets a null component and is kept; rows that repeat a doc_id are judged alike when their texts are equal;
ties go to the smaller doc_id; an empty table gives an empty result; extra columns pass through ``filter_docs``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .components import components
from .folds import release, unused
from .idbitmap import bitmap, held, position
from .textbatch import LOWER, SPACE, chunks, combine, mix, run_hashes, runs

SHINGLE = 5
TREES, DEPTH = 16, 8
HASHES = TREES * DEPTH
NEAR, NEIGHBOURS = 4, 32
LEAST_PREFIX = 2
FIRST = 3
#: Links: 100 * intersection >= SIMILAR * union.
SIMILAR = 75
#: Sketch values that must agree, of HASHES; a pair at the threshold has 96 on average, with a deviation of 5.
LEAST_AGREE = 78
#: The same for the exact join: five deviations and more below a pair at the threshold.
CROWD_AGREE = 70
#: Holders of one shingle that are compared at a time.
BLOCK = 1000
_BITS = np.uint64(48)
_MASK = np.uint64((1 << 48) - 1)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:HASHES] | np.uint64(1), seeds[HASHES:]


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk: first row, and for its n texts the distinct 48-bit shingle hashes (ascending per text) with n + 1 offsets."""
    for c in chunks(texts, rows=1 << 15):
        data = LOWER[c.data]
        s, e = runs(~SPACE[data])
        first = np.searchsorted(s, c.starts)
        words = run_hashes(data, s, e)
        owner = np.repeat(np.arange(c.n), np.diff(first))
        n_words = np.diff(first)
        h = combine(words, SHINGLE)
        inside = owner[: len(h)] == owner[SHINGLE - 1:] if len(h) else np.zeros(0, dtype=bool)
        keys = [(owner[: len(h)][inside].astype(np.uint64) << _BITS) | (h[inside] >> np.uint64(16))]
        for k in range(1, SHINGLE):  # shorter texts: the whole sequence
            short = np.flatnonzero(n_words == k)
            if len(short):
                whole = combine(words, k)[first[short]]
                keys.append((short.astype(np.uint64) << _BITS) | (mix(whole + np.uint64(k)) >> np.uint64(16)))
        key = np.unique(np.concatenate(keys))
        offsets = np.searchsorted(key >> _BITS, np.arange(c.n + 1))
        yield c.first, key & _MASK, offsets


def signatures(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """uint32 MinHash values (texts x HASHES); texts without shingles get the greatest value."""
    n = len(offsets) - 1
    out = np.full((HASHES, n), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        at = offsets[full]
        for k, (a, b) in enumerate(zip(*_multipliers())):
            v = ((shingles * a + b) >> np.uint64(32)).astype(np.uint32)
            out[k, full] = np.minimum.reduceat(v, at)
    return out.T


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (k1, k2) and signature of every row."""
    schema = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, shingles, offsets in shingle_sets(batch.column(1)):
                n = len(offsets) - 1
                k1, k2 = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
                full = np.flatnonzero(np.diff(offsets))
                if len(full):
                    k1[full] = np.add.reduceat(mix(shingles), offsets[full])
                    k2[full] = np.bitwise_xor.reduceat(mix(shingles + np.uint64(0x632BE59BD9B4E019)), offsets[full])
                sig = np.ascontiguousarray(signatures(shingles, offsets).astype(">u4"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(np.diff(offsets), pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                     pa.array([row.tobytes() for row in sig], pa.binary())], names=["doc_id", "n_shingles", "k1", "k2", "signature"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer() for x in column), dtype=np.uint8).reshape(-1, width)


def _neighbours(width: int, least: int):
    """Candidate pairs of rows (region, doc, side, root, n, room, sketch) in sorted order: up to ``width`` on in the region.

    Sides and roots differ, and what the two can have in common at most, the smaller ``room``, allows a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = *(batch.column(k).to_numpy() for k in range(6)), _matrix(batch.column(6), HASHES)
            old = 0 if held is None else len(held[0])
            region, doc, side, root, size, room, sketch = now if held is None else (np.concatenate(x) for x in zip(held, now))
            out = []
            for shift in range(1, min(width, len(doc) - 1) + 1):
                low = max(0, old - shift)  # pairs within the rows held were given before
                same = np.flatnonzero(region[low:len(doc) - shift] == region[low + shift:]) + low
                if not len(same):
                    break
                most = np.minimum(room[same], room[same + shift])
                fits = (100 + SIMILAR) * most >= SIMILAR * (size[same] + size[same + shift])
                same = same[fits & (root[same] != root[same + shift]) & (side[same] != side[same + shift])]
                for part in np.array_split(same, len(same) // 50_000 + 1):
                    agree = (sketch[part] == sketch[part + shift]).sum(axis=1)
                    part = part[agree >= least]
                    out.append((doc[part], doc[part + shift], agree[agree >= least]))
            if out:
                a, b, agree = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(agree.astype(np.int32))], names=["a", "b", "agree"])
            last = int(np.flatnonzero(region != region[-1])[-1]) + 1 if region[0] != region[-1] else 0
            keep = min(width, len(doc) - last)  # rows of finished regions have no more neighbours
            held = tuple(x[-keep:] for x in (region, doc, side, root, size, room, sketch))

    return run


def _region(tree: str, path: str) -> Column:
    return F.xxhash64(F.col(tree), F.substring(path, 1, 4 * LEAST_PREFIX))


def forest(reps: DataFrame) -> DataFrame:
    """Rows (tree, crowd, path, doc, sketch, n) of the documents (doc, signature, n) that share a prefix in the tree; crowd: with more than a window holds."""
    trees = F.sequence(F.lit(0), F.lit(TREES - 1))

    def path(t, n):
        return F.substring(F.col("signature"), t * (4 * DEPTH) + 1, F.lit(4 * n))

    keys = reps.select("doc", F.explode(F.transform(trees, lambda t: F.struct(t.alias("tree"), F.xxhash64(t, path(t, LEAST_PREFIX)).alias("key")))).alias("k"))
    keys = keys.select("doc", "k.tree", "k.key")
    shared = keys.groupBy(F.col("key").alias("shared")).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    used = (keys.join(shared, F.col("key") == F.col("shared")).groupBy(F.col("doc").alias("used"))
            .agg(F.collect_list(F.struct("tree", (F.col("times") > NEIGHBOURS + 1).alias("crowd"))).alias("trees")))
    low_bytes = F.concat(*[F.substring(F.col("signature"), 4 * k + 4, 1) for k in range(HASHES)])
    return (reps.join(used, F.col("doc") == F.col("used")).withColumn("sketch", low_bytes)
            .select(F.explode("trees").alias("at"), "signature", "doc", "sketch", "n").select("at.tree", "at.crowd", "signature", "doc", "sketch", "n")
            .select("tree", "crowd", path(F.col("tree"), DEPTH).alias("path"), "doc", "sketch", "n"))


def candidates(rows: DataFrame, width: int, roots: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b, agree) with a < b of forest rows; with ``roots`` (node, root) only pairs of different components."""
    rows = rows.withColumn("root", F.col("doc")) if roots is None else _rooted(rows, roots)
    order = ["tree", "path", "doc"]
    return (rows.select(*order, "sketch", "root", "n").repartitionByRange(*order).sortWithinPartitions(*order)
            .select(_region("tree", "path"), "doc", F.col("doc").alias("side"), "root", "n", F.col("n").alias("room"), "sketch")
            .mapInArrow(_neighbours(width, LEAST_AGREE), PAIRS).dropDuplicates(["a", "b"]))


PAIRS = "a bigint, b bigint, agree int"


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, F.col("doc") == F.col("node"), "left").withColumn("root", F.coalesce("root", "doc"))


def _sized(df: DataFrame, name: str) -> DataFrame:
    """df as a table of known size: the planner broadcasts it below its own threshold and merge-joins it beyond."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crowded(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(doc, root, n, sketch) of the documents that share a prefix with more others than a window holds, not all of one component."""
    crowd = _rooted(rows.filter("crowd").select(_region("tree", "path").alias("region"), "doc", "n", "sketch"), roots).select("region", "doc", "root", "n", "sketch").checkpoint()
    mixed = _sized(crowd.groupBy(F.col("region").alias("mixed")).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("mixed"), "crowd")
    return crowd.join(mixed, F.col("region") == F.col("mixed"), "left_semi").select("doc", "root", "n", "sketch").dropDuplicates(["doc"]).checkpoint()


def crowd_pairs(crowd: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of crowded documents of different components; no link between them is missing."""
    held = sets.join(crowd.select(F.col("doc").alias("d"), "root", "n"), F.col("doc") == F.col("d"))
    held = held.select("doc", "root", "n", F.explode(_whole("high", "low")).alias("shingle"))

    def between(t: DataFrame) -> DataFrame:
        """How many documents hold a shingle, for those held in two components or more."""
        seen = t.groupBy(F.col("shingle").alias("common")).agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("times"))
        return _sized(seen.filter("lo < hi").select("common", "times"), "shingles")

    first = F.expr(f"int(n * {100 - SIMILAR} div 100)") + 1  # n - ceil(0.75 n) + 1
    own = (held.join(between(held), F.col("shingle") == F.col("common")).groupBy("doc", "root", "n")
           .agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("shared")))
    left = first - (F.col("n").cast("int") - F.size("shared"))
    rare = (own.filter(left > 0).select("doc", "root", "n", F.size("shared").alias("m"), F.posexplode(F.slice("shared", F.lit(1), left)).alias("at", "s"))
            .select("doc", "root", "n", (F.col("m") - F.col("at")).cast("bigint").alias("room"), "s.shingle").checkpoint())
    blocks = F.ceil(F.col("times") / BLOCK).cast("int")
    dealt = (rare.join(between(rare), F.col("shingle") == F.col("common")).withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("shingle", F.least("block", "other"), F.greatest("block", "other")).alias("region"), "doc",
                     F.when(F.col("block") == F.col("other"), F.col("doc")).otherwise(F.col("block")).alias("side"), "root", "n", "room"))
    dealt = dealt.join(crowd.select(F.col("doc").alias("d"), "sketch"), F.col("doc") == F.col("d")).drop("d")
    return (dealt.repartition("region").sortWithinPartitions("region", "doc")
            .select("region", "doc", "side", "root", "n", "room", "sketch").mapInArrow(_neighbours(1 << 30, CROWD_AGREE), PAIRS).select("a", "b").distinct())


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc, high, low) of the documents whose id is in ids (column x), and a few more where hashes meet.

    The 48-bit shingles are kept as 16 and 32 bits: 6 bytes each where sets are shuffled, not 8."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(bitmap(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bits.value
        for batch in batches:
            batch = batch.filter(pa.array(held(words, batch.column(2).to_numpy())))
            for first, shingles, offsets in shingle_sets(batch.column(1)):
                at = pa.array(offsets, pa.int32())
                high = pa.ListArray.from_arrays(at, pa.array((shingles >> np.uint64(32)).astype(np.uint16).view(np.int16)))
                low = pa.ListArray.from_arrays(at, pa.array(shingles.astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(offsets) - 1), high, low], names=["doc", "high", "low"])

    hashed = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", position(F.col("doc_id")).alias("at"))
    return hashed.mapInArrow(run, "doc bigint, high array<smallint>, low array<int>")


def _whole(high: str, low: str) -> Column:
    return F.zip_with(high, low, lambda h, l: h.cast("bigint") * F.lit(1 << 32) + l.cast("bigint"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with whether they are linked by their full sets."""
    left = sets.select(F.col("doc").alias("a_"), F.col("high").alias("xh"), F.col("low").alias("xl"))
    right = sets.select(F.col("doc").alias("b_"), F.col("high").alias("yh"), F.col("low").alias("yl"))

    counted = (pairs.join(left, F.col("a") == F.col("a_")).join(right, F.col("b") == F.col("b_"))
               .select("a", "b", (F.size("xl") + F.size("yl")).alias("sizes"), F.size(F.array_intersect(_whole("xh", "xl"), _whole("yh", "yl"))).alias("both")))
    return counted.select("a", "b", (100 * F.col("both") >= SIMILAR * (F.col("sizes") - F.col("both"))).alias("linked")).checkpoint()


def _links(edges: DataFrame) -> DataFrame:
    return edges.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))


def linked_components(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, root) of the documents that links join; rows is a materialised forest."""
    pairs = candidates(rows, NEAR).checkpoint()
    in_rows = rows.select(F.col("doc").alias("x")).distinct()
    sets = full_sets(docs, in_rows).join(in_rows, F.col("doc") == F.col("x"), "left_semi").dropDuplicates(["doc"]).checkpoint()
    sided = pairs.select("a", "b", "agree", F.explode(F.array("a", "b")).alias("x"))
    best = W.partitionBy("x").orderBy(F.col("agree").desc(), "a", "b")
    first = sided.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= FIRST).select("a", "b").distinct()
    tried = _confirmed(first, sets)
    found = components(_links(tried))
    release(docs.sparkSession)
    more = _confirmed(_untried(candidates(rows, NEIGHBOURS, found), tried), sets)
    found = components(_joined(found, more))
    release(docs.sparkSession)
    crowd = crowded(rows, found)
    if crowd.isEmpty():
        return found
    last = _confirmed(_untried(crowd_pairs(crowd, sets), tried.unionByName(more)), sets)
    return components(_joined(found, last))


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    tried = tried.select(F.col("a").alias("ta"), F.col("b").alias("tb"))
    return pairs.join(tried, (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")), "left_anti").select("a", "b")


def _joined(found: DataFrame, more: DataFrame) -> DataFrame:
    return found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(_links(more))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    every = signed(docs).checkpoint()
    classes = (every.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2")
               .agg(F.min(F.struct("doc_id", "signature", "n_shingles")).alias("r"))
               .select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("r.doc_id").alias("doc"), F.col("r.signature").alias("signature"), F.col("r.n_shingles").alias("n")).checkpoint())
    roots = linked_components(docs, forest(classes.select("doc", "signature", "n")).checkpoint())
    known = (classes.select("c1", "c2", "doc").join(roots, F.col("doc") == F.col("node"), "left")
             .select("c1", "c2", F.coalesce("root", "doc").alias("root")))
    return (every.select("doc_id", "n_shingles", "k1", "k2")
            .join(known, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"),
                    F.coalesce(F.coalesce(F.col("root"), F.col("doc_id")) == F.col("doc_id"), F.lit(True)).alias("kept")))


def filter_docs(docs: DataFrame) -> DataFrame:
    """The rows of docs but for those whose group has a smaller doc_id."""
    name = unused(docs, "gone")
    gone = _sized(groups(docs).filter("NOT kept").select(F.col("doc_id").alias(name)).distinct(), "near-dedup")
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
