"""Runs of words that repeat with a period, found by recursive frequency splitting.

A qualifying run of period q has at least ``max(least, 2 q)`` words, so it holds each
of its words twice or more. A word that occurs once in its segment can therefore be in
no run of that segment and cuts it in two; words that were frequent enough before may
now be too rare, so the parts are cut again until nothing changes, and parts of fewer
than ``least`` words go. The lags are scanned in what survives: a run of period q
covers two neighbouring multiples of q, so only these places are compared at each lag
(m/1 + m/2 + ... pairs), and equal ones are extended to both sides by block ranks.

Cases: a NULL or blank text has no words, no runs and an empty collapsed text; a NULL
doc_id is kept; repeated rows each get their own result; further columns are not read.
A document is the work of one task: memory is about 40 bytes a word plus 4 bytes a word
and level of the longest repeat's logarithm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.llm.rows import Sink, rows_of

LEAST = 12
_PAIRS = 1 << 20  # places compared at a time
_WORD_GAP = "[\\x20\\x09-\\x0D]+"


def surviving(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Segments of at least ``least`` words in which every word occurs twice or more."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    earlier, later = np.full(n, -1), np.full(n, n)
    earlier[order[1:][same]] = order[:-1][same]
    later[order[:-1][same]] = order[1:][same]
    stable, low, high = [], np.array([0]), np.array([n])
    while len(low):
        whole = high - low >= least
        low, high = low[whole], high[whole]
        if not len(low):
            break
        size = high - low
        first = np.cumsum(size) - size
        place = np.arange(size.sum()) + np.repeat(low - first, size)
        rare = (earlier[place] < np.repeat(low, size)) & (later[place] >= np.repeat(high, size))
        changed = np.add.reduceat(rare, first) > 0
        stable += zip(low[~changed].tolist(), high[~changed].tolist(), strict=True)
        # the next segments lie between the cuts and the ends of the changed ones
        cuts = place[rare]
        begin = np.sort(np.concatenate([low[changed], cuts + 1]))
        low, high = begin, np.sort(np.concatenate([cuts, high[changed]]))
    return sorted(stable)


class _Blocks:
    """Numbers for the blocks of 1, 2, 4, ... words: equal blocks, equal numbers."""

    def __init__(self, ids: np.ndarray):
        self.levels = [ids]

    def get(self, level: int) -> np.ndarray:
        while len(self.levels) <= level:
            last, width = self.levels[-1], 1 << (len(self.levels) - 1)
            pairs = last[:-width].astype(np.int64) * (int(last.max()) + 1) + last[width:]
            self.levels.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
        return self.levels[level]

    def extend(self, left: np.ndarray, lag: np.ndarray, step: int) -> np.ndarray:
        """How many words from ``left`` on (``step`` 1) or before it (-1) recur ``lag`` later."""
        n = len(self.levels[0])
        far = np.zeros(len(left), np.int64)

        def equal(some: np.ndarray, level: int) -> np.ndarray:
            width = 1 << level
            a = left[some] + far[some] if step > 0 else left[some] - far[some] - width
            b = a + lag[some]
            inside = (a >= 0) & (b + width <= n)
            found = np.zeros(len(some), bool)
            if inside.any():
                blocks = self.get(level)
                found[inside] = blocks[a[inside]] == blocks[b[inside]]
            return found

        going, level = np.arange(len(left)), 0
        top = np.zeros(len(left), np.int64)  # one past the last level that matched
        while len(going):  # gallop: blocks twice as long after each match
            going = going[equal(going, level)]
            far[going] += 1 << level
            level += 1
            top[going] = level
        for level in range(int(top.max(initial=0)), -1, -1):
            some = np.flatnonzero(top >= level)
            more = some[equal(some, level)]
            far[more] += 1 << level
        return far


def segment_runs(ids: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, end, period) of the runs of one segment, each once with its least period."""
    n = len(ids)
    blocks = _Blocks(np.unique(ids, return_inverse=True)[1].astype(np.int32))
    words, found, lag = blocks.levels[0], [], 1
    # per place the long run known so far that reaches furthest
    reach, beat = np.zeros(n, np.int64), np.ones(n, np.int64)
    while 2 * lag <= n:
        # as many lags as fit the bound, one at least
        lags = np.arange(lag, min(n // 2, lag + max(0, _PAIRS * lag // n)) + 1)
        lag = int(lags[-1]) + 1
        places = (n - 1) // lags
        q = np.repeat(lags, places)
        p = (np.arange(len(q)) - np.repeat(np.cumsum(places) - places, places)) * q
        hit = np.flatnonzero(words[p] == words[p + q])
        # two places within one run, a whole number of periods apart, give that run again
        hit = hit[(p[hit] + q[hit] >= reach[p[hit]]) | (q[hit] % beat[p[hit]] != 0)]
        p, q = p[hit], q[hit]
        if not len(p):
            continue
        start = p - blocks.extend(p, q, -1)
        end = p + q + blocks.extend(p, q, 1)
        good = end - start >= np.maximum(least, 2 * q)
        if good.any():
            found.append(np.unique(np.stack([start[good], end[good], q[good]], 1), axis=0))
            for a, b, period in found[-1][::-1].tolist():
                if b - a >= 4 * period:
                    further = reach[a:b] <= b
                    reach[a:b][further], beat[a:b][further] = b, period
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    # a stretch is found at multiples of its period too; the least comes first
    once = np.ones(len(rows), bool)
    once[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[once]


def word_runs(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """(start, length, period) of all qualifying runs, by start and then period."""
    if len(words) < least:
        return np.zeros((0, 3), np.int64)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    parts = [segment_runs(ids[a:b], least) + [a, a, 0] for a, b in surviving(ids, least)]
    rows = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
    rows[:, 1] -= rows[:, 0]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those in no run beyond its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:n]) == 0


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("start", pa.list_(pa.int64())), ("length", pa.list_(pa.int64())),
    ("period", pa.list_(pa.int64())), ("text", pa.string()),
])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the text
    with each run collapsed to its first period, words joined by one blank."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sink(_SCHEMA)
        for batch in parts:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, rows_of(batch), strict=True):
                words = text.split()
                rows = word_runs(words, least)
                if len(rows):
                    kept = [w for w, k in zip(words, kept_words(len(words), rows), strict=True) if k]
                else:
                    kept = words
                out.add(doc_id, len(words), *rows.T.tolist(), b" ".join(kept).decode())
                yield from out.full()
        yield from out.rest()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, start array<bigint>, length array<bigint>, period array<bigint>, text string"
    )
    runs = F.arrays_zip("start", "length", "period")
    return rows.select("doc_id", "n_words", runs.alias("runs"), "text")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a periodic tail in every tenth document, by the crc32 of its id.

    From word a on, word i becomes word a + (i - a) % p; the words of such a document are
    joined by one blank. A NULL doc_id plants nothing.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, _WORD_GAP), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", a + 1, p), times))
    planted = F.array_join(F.slice(F.concat(F.slice("words", 1, a), tail), 1, n), " ")
    return rows.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """The runs of ``periodic_runs`` as counts, the longest run and digests."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))

    def line(r: Column) -> Column:
        return F.concat_ws(",", r["start"], r["length"], r["period"])

    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    length, period = F.col("best")["length"], -F.col("best")["col3"]
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best")["col2"]).alias("start"),
        length.alias("length"), period.alias("period"), F.floor(length * 1000 / period).cast("bigint").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
