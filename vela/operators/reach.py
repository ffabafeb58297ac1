"""Which nodes of a directed graph a set of seeds reaches, and at what distance.

A breadth-first search takes one join per hop, so a long chain or ring of datasets (each read by one run and
written by one) costs as many rounds as it has nodes.  ``reach`` condenses such stretches first:

* ``condense``: nodes with one way in and one way out that are no seeds are replaced by one edge of summed length for
  each stretch of them.  Every such node points to the one before it and each round doubles how far it points, so a
  stretch of n nodes is settled after log n rounds of one join of the nodes still open.
  A ring shrinks to a loop at its seeds; one that no seed is on and no edge enters disappears.
* semi-naive evaluation over what is left: each round extends only pairs that are new or became shorter.  A seed that is
  back at itself is not extended, so a pair can only come again at a node with several ways in: those alone are compared.
* removed nodes come back by one join: each has one node of the condensed graph before it, at a known distance.

Rounds follow the depth of the condensed graph plus the logarithm of the longest stretch.  State grows with the edges and with
the (seed, reached node) pairs that are the result; each round is a checkpoint in the shared folder.

Edge cases: null nodes take no part; repeated edges and seeds count once; a seed that is on a cycle reaches itself, at the
cycle's length; a seed without edges reaches nothing; no seeds or no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def condense(edges: DataFrame, pinned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(src, dst, length) edges and (node) to keep -> condensed edges; removed nodes as (node, anchor, offset)."""
    pins = pinned.select("node").distinct().checkpoint()
    edges = _loops_of(edges.groupBy("src", "dst").agg(F.min("length").alias("length")), pins).checkpoint()
    removed: list[DataFrame] = []
    while True:
        inner = _inner(edges, pins).checkpoint()
        if inner.isEmpty():
            break
        gone = _anchored(inner)
        removed.append(gone)
        start = gone.select(F.col("node").alias("src"), "anchor", "offset")
        bridged = (edges.join(inner.select(F.col("node").alias("dst")), "dst", "left_anti").join(start, "src", "left")
                   .select(F.coalesce("anchor", "src").alias("src"), "dst", (F.col("length") + F.coalesce("offset", F.lit(0))).alias("length")))
        edges = _loops_of(bridged.groupBy("src", "dst").agg(F.min("length").alias("length")), pins).checkpoint()
    return edges, _anchors(removed, edges)


def _loops_of(edges: DataFrame, pins: DataFrame) -> DataFrame:
    """Loops at a node matter to a seed only: they are its way back to itself."""
    loops = edges.where("src = dst").join(pins.withColumnRenamed("node", "src"), "src", "left_semi").select("src", "dst", "length")
    return edges.where("src <> dst").unionByName(loops)


def _inner(edges: DataFrame, pins: DataFrame) -> DataFrame:
    """(node, before, into): the nodes of stretches, with the node before each."""
    one, none = F.lit(1), F.lit(0)
    ends = (edges.select(F.col("dst").alias("node"), one.alias("i"), none.alias("o"))
            .unionByName(edges.select(F.col("src").alias("node"), none.alias("i"), one.alias("o"))))
    names = (ends.groupBy("node").agg(F.sum("i").alias("i"), F.sum("o").alias("o")).where("i = 1 AND o = 1").select("node")
             .join(pins, "node", "left_anti"))
    return names.join(edges.select(F.col("dst").alias("node"), F.col("src").alias("before"), F.col("length").alias("into")), "node")


def _anchored(inner: DataFrame) -> DataFrame:
    """(node, anchor, offset): for each node of a stretch the node that the stretch starts behind, and how far back it is.

    Each round doubles how far back the nodes still open point.  Where a round settles none, what is open lies on rings without an entry.
    """
    names = inner.select(F.col("node").alias("before"), F.lit(True).alias("open"))
    found = (inner.join(names, "before", "left")
             .select("node", F.col("before").alias("anchor"), F.col("into").alias("offset"), F.coalesce("open", F.lit(False)).alias("open")).checkpoint())
    done, left = found.where("NOT open"), found.where("open")
    while not left.isEmpty():
        back = done.unionByName(left).select(F.col("node").alias("anchor"), F.col("anchor").alias("further"), F.col("offset").alias("more"), F.col("open").alias("still"))
        step = (left.join(back, "anchor")
                .select("node", F.col("further").alias("anchor"), (F.col("offset") + F.col("more")).alias("offset"), F.col("still").alias("open")).checkpoint())
        settled = step.where("NOT open")
        if settled.isEmpty():
            break
        done, left = done.unionByName(settled), step.where("open")
    return done.select("node", "anchor", "offset")


def _anchors(removed: list[DataFrame], edges: DataFrame) -> DataFrame:
    """(node, anchor, offset): for each removed node the node of the condensed graph before it.

    The anchor of a round may itself go in a later one, so rounds are resolved from the last to the first.
    """
    done = edges.limit(0).select(F.col("src").alias("node"), F.col("dst").alias("anchor"), F.col("length").alias("offset"))
    for gone in reversed(removed):
        later = done.select(F.col("node").alias("anchor"), F.col("anchor").alias("first"), F.col("offset").alias("more"))
        here = gone.join(later, "anchor", "left").select(
            "node", F.coalesce("first", "anchor").alias("anchor"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
        done = done.unionByName(here).checkpoint()
    return done


def reach(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(src, dst) edges and (origin) seeds -> (origin, node, depth): each node a seed reaches, at its smallest number of hops."""
    seeds = seeds.select("origin").where(F.col("origin").isNotNull()).distinct().checkpoint()
    hops = edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull()).withColumn("length", F.lit(1).cast("bigint"))
    short, removed = condense(hops, seeds.select(F.col("origin").alias("node")))
    start = seeds.select("origin", F.col("origin").alias("node"), F.lit(0).cast("bigint").alias("depth"))
    known: DataFrame | None = None
    front = start
    several = short.groupBy(F.col("dst").alias("node")).count().where("count > 1").select("node").checkpoint()
    met = not several.isEmpty()
    while True:
        step = (front.join(short, front["node"] == short["src"])
                .groupBy("origin", F.col("dst").alias("node")).agg(F.min(F.col("depth") + F.col("length")).alias("depth")))
        if met and known is not None:
            old = known.join(several, "node", "left_semi").select(F.col("origin").alias("o"), F.col("node").alias("n"), F.col("depth").alias("d"))
            step = step.join(old, (step["origin"] == old["o"]) & (step["node"] == old["n"]) & (old["d"] <= step["depth"]), "left_anti")
        step = step.checkpoint()
        if step.isEmpty():
            break
        known = step if known is None else known.unionByName(step)
        front = step.where("node <> origin")
    if known is None:
        return start.limit(0).withColumn("depth", F.col("depth").cast("int"))
    reached = known.groupBy("origin", "node").agg(F.min("depth").alias("depth"))
    base = reached.where("node <> origin").unionByName(start)  # a stretch behind a seed starts at the seed itself
    inner = (base.join(removed, base["node"] == removed["anchor"])
             .select("origin", removed["node"], (F.col("depth") + F.col("offset")).alias("depth")))
    return reached.unionByName(inner).select("origin", "node", F.col("depth").cast("int").alias("depth"))
