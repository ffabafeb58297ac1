"""SentencePiece encoding and decoding of whole texts for merge-type vocabularies.

Texts are encoded by the score-ordered agenda of ``piece_agenda``, chunk by chunk of an Arrow batch, and the ids are checked
against the sentencepiece library in the same batch: ``agrees`` tells for every row whether the library gives the
same ids.  The text is decoded from the ids by the library's decode.  One pass over the scan partitions,
nothing is shuffled; memory holds a chunk of about ``CHUNK_CHARS`` characters or the longest text.

Edge cases: null and empty texts have no ids and decode to the empty text; a null doc_id stays null; repeated rows are
encoded each; an empty table gives an empty result; extra columns are ignored; a vocabulary of another kind (unigram, normalising,
with user-defined pieces) raises ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .piece_agenda import Pieces

MODEL = "piece_bpe_32k.model"
CHUNK_CHARS = 1 << 21
SCHEMA = "doc_id bigint, ids array<int>, decoded string, agrees boolean"

_loaded: dict[str, tuple] = {}


def _model(path: str) -> tuple:
    """(merge tables, library processor) of a model file, read once per worker."""
    if path not in _loaded:
        import sentencepiece

        _loaded[path] = Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    return _loaded[path]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of the chunks of a batch."""
    first, texts, size = 0, [], 0
    for k, text in enumerate(batch.column(1)):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= CHUNK_CHARS:
            yield first, texts
            first, texts, size = k + 1, [], 0
    if texts:
        yield first, texts


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded, agrees) of every row of a table with doc_id and text.

    ``model`` is the path of a sentencepiece file of merge type, by default the installed one; executors read it."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, library = _model(model)
        for batch in batches:
            for first, texts in _parts(batch):
                ids, begin = pieces.encode(texts)
                each = [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])]
                agrees = [a == b for a, b in zip(each, library.encode(texts, num_threads=1))]
                decoded = library.decode(each, num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids)),
                     pa.array(decoded, pa.string()), pa.array(agrees)], names=["doc_id", "ids", "decoded", "agrees"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def report(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Number and digest of every row's ids, digest of the text decoded from them, and the library's word on the ids."""
    return encode(docs, model).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees")
