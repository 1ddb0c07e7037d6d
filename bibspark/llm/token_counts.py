"""Token counts: huge documents in overlapping chunks, spliced where both sides agree."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.encoding import encoder
from bibspark.llm.rows import texts

CHUNK = 1 << 15  # characters; longer texts are spliced
OVERLAP = 256
LIMIT = 1024


def _count(path: str, chunk: int, overlap: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in parts:
            values = texts(batch).to_pylist()
            n = np.zeros(len(values), np.int64)
            for i, text in enumerate(values):
                packed = [own.ids(text)] if len(text) <= chunk else own.spliced(text, chunk, overlap)
                n[i] = sum(map(len, packed))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n // own.dtype.itemsize)],
                names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``.

    ``tokenizer`` is the path of a byte-level tokenizers file on every machine. A
    NULL text counts as empty: no bytes, no tokens. Repeated rows and ids are counted
    each by itself; other columns are ignored. A text without any blank is encoded
    whole, the overlap having grown to its end.
    """
    frame = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    counted = frame.mapInArrow(_count(tokenizer, chunk, overlap), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
