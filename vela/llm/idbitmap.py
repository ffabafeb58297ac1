"""A bitmap of fixed size over hashed ids: tells which rows may belong to a set of any size without a shuffle.

A small set lets few other rows through, a huge one lets all through; an exact join follows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def position(id_: Column) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(BITS))


def bitmap(ids: DataFrame) -> np.ndarray:
    """Bits at the positions of ids (column x); at most BITS / 64 words reach the driver."""
    at = ids.select(position(F.col("x")).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))
    words = at.groupBy(F.floor(F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(BITS // 64, dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def held(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bit at each position is set."""
    return ((words[at >> 6] >> (at & 63)) & 1).astype(bool)


def may_hold(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be in ids (column x)."""
    bits = rows.sparkSession.sparkContext.broadcast(bitmap(ids))

    @F.arrow_udf("boolean")
    def member(at: pa.Array) -> pa.Array:
        return pa.array(held(bits.value, at.to_numpy()))

    return rows.filter(F.col(key).isNotNull()).filter(member(F.coalesce(position(F.col(key)), F.lit(0).cast("bigint"))))
