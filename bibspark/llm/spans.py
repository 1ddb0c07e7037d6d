"""Cutting marked parts out of texts."""

from __future__ import annotations

from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.rows import KEY, Sink, keyed, on_key, rows_of

Cut = Callable[[list[bytes], list[list[int]]], Iterator[tuple[int, int, bytes]]]


def cut_texts(docs: DataFrame, marks: DataFrame, cut: Cut, size: str, gone: str) -> DataFrame:
    """doc_id, ``size``, ``gone``, text of every row of ``docs``.

    ``marks`` has an array of numbers for some row keys; ``cut`` turns texts and their
    numbers into their size, how much of it goes, and what is left. A NULL text stays.
    """
    schema = pa.schema([("doc_id", pa.int64()), (size, pa.int64()), (gone, pa.int64()), ("text", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sink(schema)
        for batch in parts:
            texts = rows_of(batch)
            numbers = [n or [] for n in batch.column("marks").to_pylist()]
            missing = batch.column("text").is_null().to_pylist()
            for doc_id, none, result in zip(batch.column("doc_id").to_pylist(), missing, cut(texts, numbers), strict=True):
                n, less, text = result
                out.add(doc_id, n, less, None if none else text.decode())
                yield from out.full()
        yield from out.rest()

    rows = keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    rows = on_key(rows, marks.select("doc_id", KEY, "marks")).select("doc_id", "text", "marks")
    return rows.mapInArrow(run, f"doc_id bigint, {size} bigint, {gone} bigint, text string")


def without(text: bytes, parts: list[tuple[int, int]]) -> bytes:
    """``text`` without byte ranges, which are in order and do not overlap."""
    left, at = [], 0
    for a, b in parts:
        left.append(text[at:a])
        at = b
    return b"".join([*left, text[at:]])
