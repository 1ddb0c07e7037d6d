"""Benchmark decontamination: test n-grams in a broadcast set, scanned by hash and verified by word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.llm.rows import bounded, rows_of
from bibspark.llm.spans import without
from bibspark.llm.words import ALNUM, doc_words, runs

WINDOW = 13
SLICE_BYTES = 16 << 20  # benchmark text whose windows are broadcast at a time


class Windows:
    """The windows of some benchmark items, by length: sorted hashes, words and items."""

    def __init__(self, items: list[tuple[int | None, bytes]], size: int):
        found: dict[int, dict[int, dict[bytes, set]]] = {}
        for (item, text), (hashes, start, end) in zip(items, doc_words([t for _, t in items], ALNUM), strict=True):
            n = len(hashes)
            if not n:
                continue
            low, width = text.lower(), min(size, n)
            words = [low[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)]
            for i, h in enumerate(runs(hashes, width).tolist()):
                same = found.setdefault(width, {}).setdefault(h, {})
                same.setdefault(b" ".join(words[i : i + width]), set()).add(item)
        self.by_width = {w: (np.sort(np.fromiter(d, np.uint64, len(d))), d) for w, d in found.items()}

    def hits(self, text: bytes, hashes: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Word intervals [from, to) that are windows of an item, and those items."""
        spans, items, low = [], set(), None
        for width, (known, words) in self.by_width.items():
            if len(hashes) < width:
                continue
            own = runs(hashes, width)
            place = np.minimum(np.searchsorted(known, own), len(known) - 1)
            for i in np.flatnonzero(known[place] == own).tolist():
                low = text.lower() if low is None else low
                said = b" ".join(low[start[k] : end[k]] for k in range(i, i + width))
                if said in words[int(own[i])]:
                    spans.append((i, i + width))
                    items |= words[int(own[i])][said]
        return spans, items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.LongType())),  # word from, word to, byte from, byte to, ...
    T.StructField("items", T.ArrayType(T.StringType())),
])
_FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


_FOUND_NAME = "_windows_found"


def _scan(windows, finish=None):
    """Adds what the windows find to each row, or hands the rows and it to ``finish``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Windows = windows.value
        for batch in bounded(parts):
            documents, found = rows_of(batch), []
            earlier = _FOUND_NAME in batch.schema.names
            before = batch.column(_FOUND_NAME).to_pylist() if earlier else [None] * len(batch)
            for text, old, (hashes, start, end) in zip(documents, before, doc_words(documents, ALNUM), strict=True):
                spans, items = index.hits(text, hashes, start, end)
                if old:
                    spans += list(zip(old["spans"][::4], old["spans"][1::4], strict=True))
                    items |= set(old["items"])
                flat = [x for a, b in _merged(spans) for x in (a, b, int(start[a]), int(end[b - 1]))]
                found.append({"n_words": len(hashes), "spans": flat, "items": sorted(items)})
            names = [n for n in batch.schema.names if n != _FOUND_NAME]
            rows = batch.select(names)
            if finish:
                yield finish(rows, documents, found)
            else:
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, _FOUND_ARROW)], names=[*names, _FOUND_NAME])

    return run


def _scanned(docs: DataFrame, benchmark: DataFrame, size: int, slice_bytes: int = SLICE_BYTES, finish=None) -> DataFrame:
    """``docs`` with the words of every row and the spans and items hit in it, or, with
    ``finish``, with what that makes of the rows and these.

    The benchmark's size is measured; it is dealt by a hash of its rows to as many
    slices of about ``slice_bytes`` as that takes. A scan per slice adds to what the
    scans before it found; the last one finishes, so with one slice the rows go through
    Python once.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-total // slice_bytes) or 1
    frame, with_found = docs, T.StructType([*docs.schema.fields, T.StructField(_FOUND_NAME, _FOUND)])
    for k in range(slices):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k).toArrow()
        pairs = list(zip(part["item"].to_pylist(), [t.encode() for t in part["text"].to_pylist()], strict=True))
        sent = spark.sparkContext.broadcast(Windows(pairs, size))
        last = finish if k == slices - 1 else None
        frame = frame.mapInArrow(_scan(sent, last), docs.schema if last else with_found)
    return frame


def find_windows(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, text, found) of every row: its words and the spans and items hit."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _scanned(texts, benchmark, size, slice_bytes).withColumnRenamed(_FOUND_NAME, "found")


def _digest() -> F.Column:
    return F.sha2(F.array_join(F.array_sort("found.items"), ","), 256)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, percent: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``.

    A NULL or blank text has no words and is clean. Items without words have no
    window; an item of fewer than ``size`` words is one window. Repeated documents
    are judged alike; an item that is listed twice counts once; an item without id
    counts under the name null. An empty benchmark finds nothing.
    """
    found = find_windows(docs, benchmark, size).select("doc_id", "found")
    pairs = F.sequence(F.lit(0), (F.size("found.spans") / 4 - 1).cast("int"))
    n_hit = F.when(F.size("found.spans") > 0, F.aggregate(
        pairs, F.lit(0).cast("bigint"),
        lambda total, i: total + F.get("found.spans", (4 * i + 1).cast("int")) - F.get("found.spans", (4 * i).cast("int"))
    )).otherwise(F.lit(0).cast("bigint"))
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"), _digest().alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words")))


def _judge(percent: int, spans: bool):
    """Drops contaminated rows, or cuts the spans out of their texts."""

    def finish(rows: pa.RecordBatch, documents: list[bytes], found: list[dict]) -> pa.RecordBatch:
        hit = [sum(f["spans"][1::4]) - sum(f["spans"][::4]) for f in found]
        dirty = [h > 0 and 100 * h >= percent * f["n_words"] for h, f in zip(hit, found, strict=True)]
        if not spans:
            return rows.filter(pa.array([not d for d in dirty]))
        texts = rows.column("text").to_pylist()
        for i in np.flatnonzero(dirty).tolist():
            flat = found[i]["spans"]
            texts[i] = without(documents[i], list(zip(flat[2::4], flat[3::4], strict=True))).decode()
        place = rows.schema.get_field_index("text")
        return rows.set_column(place, rows.schema.field(place), pa.array(texts, rows.schema.field(place).type))

    return finish


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = WINDOW,
                  percent: int = 5) -> DataFrame:
    """``docs`` without contaminated rows, or with only the spans cut from their texts.

    All columns are kept whatever their names; clean rows are unchanged.
    """
    return _scanned(docs, benchmark, size, finish=_judge(percent, remove == "spans"))


def digest_of(items: set[str]) -> str:
    """The digest of a set of item ids, as the query gives it."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
