"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.rows import KEY, keyed, on_key, rows_of, written
from bibspark.llm.words import _BASE, U64, _powers, mix, slices

BUCKETS = 1 << 16
MAX_LABELS = 40_000  # labelled rows that the fit uses, those of the smallest hash
LENGTH = 100  # n-grams of the reference length that weights are brought to
_BINS = 4096

_BYTE = np.arange(256)
_SPACE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_WORD = ((_BYTE >= 48) & (_BYTE <= 57)) | _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_KIND = np.where(_SPACE, 0, np.where(_WORD, 1, 2)).astype(np.uint8)
_VALUE = np.where(_SPACE, U64(0), mix((_BYTE + 1).astype(U64) * U64(_BASE)) | U64(1)).astype(U64)
_CAPITALS, _REPEAT = U64(0x51ED270B7A14F9C5), U64(0xA24BAED4963EE407)


def ngrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every n-gram of one and two tokens.

    A token is a run of letters and digits or a run of other signs. Words in
    capitals stand as one token, and so does a token that repeats the one before.
    """
    n = len(data)
    kind = _KIND[data]
    change = np.ones(n + 1, bool)
    change[1:n] = kind[1:] != kind[:-1]
    change[bounds[bounds < n]] = True
    start = np.flatnonzero(change[:n] & (kind != 0))
    edges = np.flatnonzero(change)
    end = edges[np.searchsorted(edges, start) + 1] if len(start) else start
    up, down = _powers(max(n, 1))
    sums = np.zeros(n + 1, U64)
    np.cumsum(_VALUE[data] * up, out=sums[1:])
    token = mix((sums[end] - sums[start]) * down[start])
    capitals = np.concatenate([[0], np.cumsum(_UPPER[data])])
    token = np.where(capitals[end] - capitals[start] >= 2, _CAPITALS, token)
    doc = np.searchsorted(bounds, start, "right") - 1
    together = doc[1:] == doc[:-1]
    again = np.zeros(len(token), bool)
    again[1:] = together & (token[1:] == token[:-1])
    token = np.where(again, _REPEAT, token)
    pairs = (token[:-1] * U64(0x9FB21C651E98DF25) + token[1:])[together]
    both = mix(np.concatenate([token, pairs])) % U64(BUCKETS)
    return both.astype(np.int64), np.concatenate([doc, doc[1:][together]])


def _count(target):
    """Bucket counts of a task's documents: all of them, and those of the target."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = target.value
        raw, wanted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in parts:
            ids = batch.column("doc_id").fill_null(-1).to_numpy()
            chosen = np.isin(ids, good) & ~batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            for first, data, bounds in slices(rows_of(batch), _VALUE):
                bucket, doc = ngrams(data, bounds)
                raw += np.bincount(bucket, minlength=BUCKETS)
                wanted += np.bincount(bucket[chosen[doc + first]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(wanted[seen])],
                                         names=["bucket", "raw", "target"])

    return run


def _weigh(ratio):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratio.value
        for batch in parts:
            total, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for first, data, bounds in slices(rows_of(batch), _VALUE):
                bucket, doc = ngrams(data, bounds)
                size = len(bounds) - 1
                total[first : first + size] += np.bincount(doc, table[bucket], minlength=size)
                n[first : first + size] += np.bincount(doc, minlength=size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column(KEY), pa.array(n),
                 pa.array(LENGTH * total / np.maximum(n, 1))], names=["doc_id", KEY, "n_grams", "log_weight"])

    return run


def log_ratio(docs: DataFrame, good: np.ndarray) -> np.ndarray:
    """log(target / raw) per bucket, counted over every row of ``docs``, add-one smoothed."""
    sent = docs.sparkSession.sparkContext.broadcast(good)
    counts = docs.select("doc_id", "text").mapInArrow(
        _count(sent), "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()  # at most BUCKETS rows
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    place = counts["bucket"].to_numpy()
    raw[place] += counts["raw"].to_numpy()
    target[place] += counts["target"].to_numpy()
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight that parts two samples best; the middle of the gap where there is one."""
    if not len(good) or not len(bad):
        return -np.inf
    values = np.unique(np.concatenate([good, bad]))
    kept = 1 - np.searchsorted(np.sort(good), values) / len(good)
    dropped = np.searchsorted(np.sort(bad), values) / len(bad)
    at = int(np.argmax(kept + dropped))
    return float(values[at] if at == 0 else (values[at] + values[at - 1]) / 2)


def kth_largest(rows: DataFrame, name: str, k: int) -> float:
    """The k-th largest value of a column, by histograms that close in on it."""
    value = F.col(name)
    low, high = rows.agg(F.min(value), F.max(value)).first()
    above = 0
    while True:
        inside = rows.filter((value >= low) & (value <= high))
        width = (high - low) / _BINS
        if width == 0 or low + width == low:
            return low
        place = F.least(F.floor((value - low) / width), F.lit(_BINS - 1))
        bins = inside.groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).orderBy(F.desc("bin"))
        for row in bins.collect():  # at most _BINS rows
            if above + row.n >= k:
                low, high = row.low, row.high
                break
            above += row.n
        if low == high:
            return low


def weights(docs: DataFrame, labels: DataFrame, seed: int = 0, keep: int | None = None,
            max_labels: int = MAX_LABELS) -> DataFrame:
    """doc_id, n_grams, log_weight, gumbel_key, kept, and a row key, for every row of ``docs``.

    The target model counts the documents labelled quality 1, of at most
    ``max_labels`` labelled rows; the raw model counts every document. A row's
    weight is the ratio of both, brought to a length of LENGTH n-grams. The ``keep``
    rows of the largest log weight plus Gumbel noise are sampled; without ``keep``,
    as many as have a weight above the cut that parts the labelled rows best.

    The noise hangs on the row's id and text, so equal rows share a fate (ties at the
    k-th place are all kept). Of rows that share a labelled id, the largest weight
    counts for the cut. A NULL or empty text has log weight 0. Where labels of
    one kind are missing, everything is kept. A text over a megabyte is counted in
    pieces; the pair of tokens around a cut is left out.
    """
    spark = docs.sparkSession
    docs = keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    sample = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels).toArrow()
    ids, quality = sample["doc_id"].to_numpy(), sample["quality"].to_numpy()
    ratio = log_ratio(docs, np.sort(ids[quality == 1]))
    sent = spark.sparkContext.broadcast(ratio)
    scored = docs.mapInArrow(_weigh(sent), f"doc_id bigint, {KEY} bigint, n_grams bigint, log_weight double")
    unit = (F.pmod(F.xxhash64(F.lit(seed), KEY, "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    scored = written(scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(unit))), "weights")
    if keep is None:
        labelled = spark.createDataFrame(sample.to_pandas(), "doc_id bigint, quality int")
        # one row for each labelled id, so at most max_labels
        seen = scored.join(labelled, "doc_id").groupBy("doc_id").agg(
            F.max("log_weight").alias("log_weight"), F.first("quality").alias("quality")).toArrow()
        w, q = seen["log_weight"].to_numpy(), seen["quality"].to_numpy()
        keep = scored.filter(F.col("log_weight") >= best_cut(w[q == 1], w[q == 0])).count()
    if keep <= 0:
        return scored.withColumn("kept", F.lit(False))
    return scored.withColumn("kept", F.col("gumbel_key") >= kth_largest(scored, "gumbel_key", keep)
                             if not scored.isEmpty() else F.lit(True))


def resample(docs: DataFrame, labels: DataFrame, seed: int = 0, keep: int | None = None) -> DataFrame:
    """The rows of ``docs`` that the sampling keeps, with all their columns."""
    kept = weights(docs, labels, seed, keep).filter("kept").select("doc_id", KEY).distinct()
    return on_key(keyed(docs), kept, "left_semi").select(*docs.columns)
