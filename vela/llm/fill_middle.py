"""Fill-in-the-middle: every text cut into prefix, middle and suffix at token boundaries.

Tokens are ``[A-Za-z]+|[^A-Za-z]``.  The ends of a text's tokens form a Roaring-style set of code-point offsets
(``boundary_set``); both cuts are found by select: the cardinalities before the containers, then the
container's own select.  The cuts and the form come from a hash of the seed and doc_id, so reruns and
lost tasks give the same rows.  Texts are cut in one pass over the scan partitions, nothing is shuffled;
memory holds a chunk of about 1 MB or the longest text.

Edge cases: null and empty texts have no tokens and the form ``plain``; texts that hold a marker are ``plain``, so
every output can be restored; a null doc_id hashes as no digits; repeated rows are cut each, alike; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boundary_set import BoundarySet
from .textbatch import chunks, code_points

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
SEED = "1:"
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def token_ends(wide: np.ndarray) -> np.ndarray:
    """Whether a token ends after each code point; the last one must be no letter."""
    letter = (wide - 65 < 26) | (wide - 97 < 26)  # unsigned: smaller code points wrap around
    ends = ~letter
    ends[:-1] |= letter[:-1] & ~letter[1:]
    return ends


def cut_offsets(ends: BoundarySet, units: int) -> int:
    """Code points in the first ``units`` tokens."""
    return ends.select(units - 1) if units else 0


def rearranged(text: str, form: str, a: int, b: int) -> str:
    if form == "plain":
        return text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    first = PREFIX + prefix + SUFFIX + suffix if form == "psm" else SUFFIX + suffix + PREFIX + prefix
    return first + MIDDLE + middle


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` in ``form`` was made of; its parts hold no marker, so the three markers are found."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        draws = [batch.column(k).to_numpy().tolist() for k in range(2, 6)]
        for c in chunks(batch.column(1)):
            wide = code_points(c)
            ends = token_ends(wide.data)
            rows = []
            for k in range(c.n):
                s, e = int(wide.starts[k]), int(wide.starts[k + 1]) - 1
                text = c.data[c.starts[k] : c.starts[k + 1] - 1].tobytes().decode("utf-8")
                h1, h2, h3, h4 = (h[c.first + k] for h in draws)
                found = BoundarySet(np.flatnonzero(ends[s:e]) + 1)
                n = len(found)
                form = "plain"
                if n and h3 % 100 < 100 - PLAIN_PERCENT and not any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
                    form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
                a = b = None
                if form != "plain":
                    a, b = (cut_offsets(found, u) for u in sorted((h1 % (n + 1), h2 % (n + 1))))
                rows.append((ids[c.first + k], n, form, a, None if b is None else b - a, rearranged(text, form, a, b)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _TYPES)], names=_NAMES)


_NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def transform(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of a table with doc_id and text."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *draws).mapInArrow(_cut, SCHEMA)


def report(docs: DataFrame) -> DataFrame:
    """Cuts of every row, with digests of the output and of the text restored from it."""
    return transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
