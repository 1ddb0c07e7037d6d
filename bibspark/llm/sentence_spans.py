"""Substring dedup by sliding sentence spans."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.rows import KEY, keyed, rows_of, written
from bibspark.llm.spans import cut_texts, without
from bibspark.llm.words import SPACED, U64, _powers, doc_words, mix

SENTENCES = 3  # in a span
LONGEST = 16  # words of a sentence; a longer one is taken as several

_ENDS = np.zeros(256, bool)
_ENDS[[ord("."), ord("!"), ord("?")]] = True


def sentences(text: bytes, hashes: np.ndarray, start: np.ndarray, end: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Numbers of the words that begin a sentence, and the number of words at the end.

    A sentence ends with a word that ends in a full stop, ! or ?, and before a line feed.
    """
    n = len(hashes)
    if not n:
        return np.zeros(1, np.int64)
    data = np.frombuffer(text, np.uint8)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    last = _ENDS[data[end - 1]]
    last[:-1] |= lines[start[1:]] > lines[end[:-1]]
    first = np.concatenate([[True], last[:-1]])
    begin = np.flatnonzero(first)
    inside = np.arange(n) - begin[np.cumsum(first) - 1]
    return np.append(np.flatnonzero(inside % longest == 0), n)


def span_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes for every run of ``width`` sentences."""
    if len(bounds) <= width:
        return np.zeros(0, U64), np.zeros(0, U64)
    up, down = _powers(max(len(hashes), 1))
    low, high = bounds[:-width], bounds[width:]
    out = []
    for salt in (U64(0), U64(0x5851F42D4C957F2D)):
        sums = np.zeros(len(hashes) + 1, U64)
        np.cumsum((mix(hashes + salt) if salt else hashes) * up, out=sums[1:])
        out.append(mix((sums[high] - sums[low]) * down[low] + (high - low).astype(U64)))
    return out[0], out[1]


def _spans(width: int, longest: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            documents = rows_of(batch)
            rows, places, one, two = [], [], [], []
            for i, (text, words) in enumerate(zip(documents, doc_words(documents, SPACED), strict=True)):
                a, b = span_hashes(words[0], sentences(text, *words, longest), width)
                rows.append(np.full(len(a), i))
                places.append(np.arange(len(a), dtype=np.int32))
                one.append(a)
                two.append(b)
            if rows:
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(row), batch.column(KEY).take(row), pa.array(np.concatenate(places)),
                     pa.array(np.concatenate(one).view(np.int64)), pa.array(np.concatenate(two).view(np.int64))],
                    names=["doc_id", KEY, "place", "a", "b"])

    return run


def _cut(width: int, longest: int):
    def cut(documents: list[bytes], marks: list[list[int]]):
        for text, own, words in zip(documents, marks, doc_words(documents, SPACED), strict=True):
            bounds = sentences(text, *words, longest)
            n = len(bounds) - 1
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, np.array(own, np.int64), 1)
            np.add.at(cover, np.minimum(np.array(own, np.int64) + width, n), -1)
            gone = np.flatnonzero(np.cumsum(cover)[:n] > 0)
            edges = np.append(words[1][bounds[:-1]], len(text)) if n else np.array([len(text)])
            yield n, len(gone), without(text, [(int(edges[j]), int(edges[j + 1])) for j in gone])

    return cut


def span_dedup(docs: DataFrame, width: int = SENTENCES, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_sentences, n_removed, text of every row of ``docs``.

    A span is a run of ``width`` sentences, compared by its words, capitals as small
    letters. Of all equal spans the first by doc_id, row key and place stays; sentences
    under any other are removed. A text with fewer sentences has no span. A NULL text
    has none and stays NULL. Rows equal in id and text are one document.
    """
    rows = keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    spans = rows.mapInArrow(_spans(width, longest), f"doc_id bigint, {KEY} bigint, place int, a bigint, b bigint")
    here = F.struct("doc_id", KEY, "place")
    repeated = spans.groupBy("a", "b").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    repeated = written(repeated.filter("first <> last").select("a", "b", "first"), "repeated")
    again = spans.join(repeated, ["a", "b"]).filter(here != F.col("first"))
    marks = written(again.groupBy("doc_id", KEY).agg(F.collect_set("place").alias("marks")), "marks")
    return cut_texts(docs, marks, _cut(width, longest), "n_sentences", "n_removed")
