"""Mixes sources to target weights: weighted pivotal rounding of copy numbers, combined in a tree.

Size is the number of words.  Sources, by code point with null last, weigh 5, 2, 1,
5, 2, 1, ...; together they get ``SHARE`` times all words, a source at most ``CAP`` times
its own, the excess going to the others by weight (the water level is found from running
sums over the sources).  A document of a source with target t and size s has t / s
copies in expectation: the whole part is certain, the fraction is rounded.

Rounding pairs two fractional documents and moves word mass between them, up or down at
random so that expectations hold, until one of them is whole; the other goes on as
the residual.  Blocks of about ``FAN`` documents of one source and size class (power of two)
are rounded by one array fold each, their residuals form the blocks of the next
level, and so on until every size class of a source has one residual.  The residuals of a source,
one per size class, are then rounded from the largest down, each to the side that leaves the
smaller word debt, so a source ends within about one small document of its target.
A hot source is spread over all its blocks.  Only DataFrame functions are used.
Random numbers are hashes of the two documents' keys: reruns agree.

Edge cases: a null text has size 0 and takes 0 words; sources without words have target 0;
repeated rows (same doc_id) are rounded one by one; an empty table gives an empty result;
extra columns pass through ``mix`` and are ignored by ``report``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .folds import unused

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
FAN = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target: one row per source of a table with source and size."""
    by = W.orderBy(F.col("source").asc_nulls_last())
    sources = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
               .withColumn("at", (F.row_number().over(by) - 1) % len(WEIGHTS))
               .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), F.col("at") + 1))
               .withColumn("cap", F.col("source_size") * CAP).withColumn("level", F.col("cap") / F.col("weight")))
    up_to = W.orderBy("level", F.col("source").asc_nulls_last())
    every = W.partitionBy()
    # with the k lowest caps full, the water level of the others
    free = (F.sum("weight").over(every) - F.sum("weight").over(up_to) + F.col("weight"))
    full = F.sum("cap").over(up_to) - F.col("cap")
    water = sources.withColumn("water", (F.sum("source_size").over(every) * SHARE - full) / free)
    first = F.min(F.when(F.col("water") <= F.col("level"), F.struct("level", "water"))).over(every)
    return water.select("source", "source_size", F.least("cap", F.coalesce(F.col("weight") * first["water"], F.col("cap"))).alias("target"))


def _uniform(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _let(values: dict[str, Column], then) -> Column:
    """then(struct of values): binds values inside an array function once."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), then)[0]


def _step(acc: Column, e: Column) -> Column:
    """Pairs the residual ``acc.rest`` with document ``e``; one becomes whole and joins ``acc.done``."""
    a = acc["rest"]
    zero, one = F.lit(0.0), F.lit(1.0)

    def move(x: Column) -> Column:
        up = F.when(x["up"] + x["down"] <= 0, F.lit(False)).otherwise(_uniform(a["key"], e["key"]) * (x["up"] + x["down"]) < x["down"])
        return F.struct(
            F.when(up, x["up"]).otherwise(-x["down"]).alias("m"),
            F.when(up, F.when(x["a_up"] <= x["b_down"], one).when(F.lit(True), F.lit(-1.0)))
            .otherwise(F.when(x["a_down"] <= x["b_up"], zero).otherwise(F.lit(-1.0))).alias("a_whole"),
            F.when(up, zero).otherwise(one).alias("b_whole"))

    def pair(x: Column) -> Column:
        a_whole = x["a_whole"] >= 0
        whole = F.struct((F.when(a_whole, a["key"]).otherwise(e["key"])).alias("key"),
                         F.when(a_whole, x["a_whole"]).otherwise(x["b_whole"]).cast("int").alias("take"))
        rest = F.when(a_whole, F.struct(e["key"].alias("key"), e["w"].alias("w"), F.greatest(zero, F.least(one, e["p"] - x["m"] / e["w"])).alias("p"))
                      ).otherwise(F.struct(a["key"].alias("key"), a["w"].alias("w"), F.greatest(zero, F.least(one, a["p"] + x["m"] / a["w"])).alias("p")))
        return F.struct(rest.alias("rest"), F.concat(acc["done"], F.array(whole)).alias("done"))

    room = {"a_up": (1 - a["p"]) * a["w"], "a_down": a["p"] * a["w"], "b_up": (1 - e["p"]) * e["w"], "b_down": e["p"] * e["w"]}
    return _let(room, lambda r: _let(
        {"up": F.least(r["a_up"], r["b_down"]), "down": F.least(r["a_down"], r["b_up"]),
         "a_up": r["a_up"], "a_down": r["a_down"], "b_up": r["b_up"], "b_down": r["b_down"]},
        lambda x: _let({"mv": move(x)}, lambda y: pair(y["mv"]))))


_KEY = "struct<id:bigint,nth:int>"
_STATE = f"struct<rest:struct<key:{_KEY},w:double,p:double>,done:array<struct<key:{_KEY},take:int>>>"


def _round_block(docs: Column) -> Column:
    """Folds an array of (key, w, p): the residual and the whole documents."""
    first = F.struct(docs[0].alias("rest"), F.lit(None).cast(f"array<struct<key:{_KEY},take:int>>").alias("done"))
    start = F.struct(first["rest"].alias("rest"), F.array().cast(f"array<struct<key:{_KEY},take:int>>").alias("done")).cast(_STATE)
    return F.aggregate(F.slice(docs, 2, F.size(docs)), start, lambda acc, e: _step(acc, e).cast(_STATE))


def _settle(residuals: Column) -> Column:
    """Rounds a source's residuals, largest first, each to the side that leaves the smaller debt of words."""
    start = F.struct(F.lit(0.0).alias("debt"), F.array().cast(f"array<struct<key:{_KEY},take:int>>").alias("done"))

    def step(acc: Column, e: Column) -> Column:
        owed = acc["debt"] + e["p"] * e["w"]
        take = F.when(owed * 2 >= e["w"], 1).otherwise(0)
        return F.struct((owed - take * e["w"]).alias("debt"),
                        F.concat(acc["done"], F.array(F.struct(e["key"].alias("key"), take.cast("int").alias("take")))).alias("done"))

    state = f"struct<debt:double,done:array<struct<key:{_KEY},take:int>>>"
    return F.aggregate(residuals, start.cast(state), lambda acc, e: step(acc, e).cast(state))["done"]


def copies(sized: DataFrame) -> DataFrame:
    """key, size, source, source_size, target, copies of every row of a materialised table (doc_id, source, size)."""
    nth = F.row_number().over(W.partitionBy("doc_id").orderBy("size", "source")).cast("int")
    rows = sized.select("source", "size", F.struct(F.col("doc_id").alias("id"), nth.alias("nth")).alias("key"))
    mass = targets(sized).withColumnRenamed("source", "source_")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    expected = (rows.join(mass, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
                .withColumn("sure", F.floor(rate).cast("int")).withColumn("p", rate - F.floor(rate))
                .withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1).cast("int")).checkpoint())
    open_ = expected.filter("p > 0 AND size > 0")
    groups = open_.groupBy("source", "class").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("source").alias("source_"), F.col("class").alias("class_"), F.ceil(F.col("n") / FAN).alias("blocks"))
    top = groups.agg(F.max("blocks")).first()[0]  # one number
    level = (open_.join(groups, F.col("source").eqNullSafe(F.col("source_")) & (F.col("class") == F.col("class_")))
             .select("source", "class", "key", F.col("size").cast("double").alias("w"), "p",
                     F.pmod(F.xxhash64("key"), F.col("blocks")).alias("block")))
    decided = []
    while top is not None:
        docs = F.sort_array(F.collect_list(F.struct("key", "w", "p")))
        level = (level.groupBy("source", "class", "block").agg(docs.alias("docs"))
                 .select("source", "class", "block", _round_block(F.col("docs")).alias("r")).checkpoint())
        decided.append(level.select(F.explode("r.done").alias("d")))
        level = level.select("source", "class", "r.rest.key", "r.rest.w", "r.rest.p", F.floor(F.col("block") / FAN).alias("block"))
        if top <= 1:
            break
        top = -(-top // FAN)
    if decided:
        rest = level.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("w", "key", "p")), asc=False).alias("docs"))
        decided.append(rest.select(F.explode(_settle(F.col("docs"))).alias("d")))
        taken = decided[0]
        for d in decided[1:]:
            taken = taken.unionByName(d)
        taken = taken.select(F.col("d.key.id").alias("id_"), F.col("d.key.nth").alias("nth_"), F.col("d.take").alias("take"))
        on = F.col("key.id").eqNullSafe(F.col("id_")) & (F.col("key.nth") == F.col("nth_"))
        expected = expected.join(taken, on, "left").drop("id_", "nth_")
    else:
        expected = expected.withColumn("take", F.lit(None).cast("int"))
    return expected.select("key", "size", "source", "source_size", "target", (F.col("sure") + F.coalesce("take", F.lit(0))).alias("copies"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size")).checkpoint()


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    return copies(_sized(docs)).select(F.col("key.id").alias("doc_id"), "size", "source_size", F.col("target").cast("double").alias("target"),
                                       (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of docs as often as the mix takes them, with the columns of docs."""
    id_, of, times, nth, copy = (unused(docs, x) for x in ("mix_id", "mix_of", "mix_times", "mix_nth", "mix_copy"))
    number = copies(_sized(docs)).select(F.col("key.id").alias(id_), F.col("key.nth").alias(of), F.col("copies").alias(times))
    place = F.row_number().over(W.partitionBy("doc_id").orderBy(word_count(F.col("text")), "source", F.xxhash64("text"))).cast("int")
    return (docs.withColumn(nth, place).join(number, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(nth) == F.col(of)))
            .filter(F.col(times) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
            .select(*docs.columns))
