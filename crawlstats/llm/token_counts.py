"""Token counts per document by the whole-token shortcut (see ``byte_bpe``).

One pass, no shuffle: each Arrow batch of texts becomes one batch of counts.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); a null id
stays null; repeated rows give repeated results; ties do not arise; an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstats.llm.byte_bpe import SharedBpe
from crawlstats.llm.common import documents, map_batches

SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def token_counts(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; ``tokenizer`` is the path of a byte-level BPE JSON."""
    bpe = SharedBpe(docs.sparkSession, tokenizer)

    def count(batches):
        enc = bpe.encoder()
        for b in batches:
            texts = b.column(1)
            n = np.fromiter((enc.count(t.as_py()) for t in texts), np.int64, len(texts))
            size = pa.compute.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    return map_batches(documents(docs, id_col, text_col), count, SCHEMA)


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    """The counts with ``over_limit``: more than ``limit`` tokens."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
