"""SentencePiece ids of documents, and their way back (see ``pieces``).

One pass without a shuffle; the model is one broadcast bounded by its
vocabulary.

Defined cases: a null or empty text has no ids; a null id is carried; repeated
rows give repeated results; an empty table gives an empty result; other
columns are not read; a text that holds U+2581 itself does not come back, as
the model takes it for a space.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from crawlstats.llm.common import documents, map_batches, pick
from crawlstats.llm.pieces import PieceModel, read_model

_WORKER: dict[int, PieceModel] = {}


class SharedModel:
    """A model file as one broadcast; a worker builds its tables once."""

    def __init__(self, spark, path: str):
        spec = read_model(path)
        self.key, self.data = hash((path, len(spec["pieces"]))), spark.sparkContext.broadcast(spec)

    def model(self) -> PieceModel:
        if self.key not in _WORKER:
            _WORKER.clear()
            _WORKER[self.key] = PieceModel(self.data.value)
        return _WORKER[self.key]


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip): ids as little-endian unsigned 32-bit integers, and whether they decode to the text."""
    shared = SharedModel(docs.sparkSession, model)

    def run(batches):
        m = shared.model()
        for b in batches:
            ids, same = [], []
            for t in b.column(1):
                text = t.as_py()
                own = m.encode(text)
                ids.append(own)
                same.append(m.decode(own) == text)
            n = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), n, pa.array(same, pa.bool_())], ["doc_id", "ids", "n_tokens", "round_trip"])

    return map_batches(documents(docs, id_col, text_col), run, "doc_id long, ids binary, n_tokens long, round_trip boolean")


def decode(encoded: DataFrame, model: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with ids; a null stays null."""
    shared = SharedModel(encoded.sparkSession, model)

    def run(batches):
        m = shared.model()
        for b in batches:
            texts = [m.decode(i.as_py()) if i.is_valid else None for i in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(pick(encoded, doc_id=id_col, ids=ids_col), run, "doc_id long, text string")
