"""Sparse suffix arrays: suffixes at minimiser positions, sorted, compared with their neighbours."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.rows import KEY, keyed, on_key, rows_of, written
from bibspark.llm.spans import cut_texts, without
from bibspark.llm.words import SPACED, doc_words, runs

LEAST = 50  # words of a match
SEED = 16  # words that a minimiser stands for
#: Of so many neighbouring seeds one is kept: every match of LEAST words holds all seeds
#: of at least one window, so both its copies keep the same seed there.
WINDOW = LEAST - SEED + 1 - 3
REACH = LEAST - SEED  # words that a match is followed to each side of a seed


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds that are smallest in some window."""
    if len(words) < SEED + WINDOW - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    seeds = runs(words, SEED)
    window = np.lib.stride_tricks.sliding_window_view(seeds, WINDOW)
    places = np.unique(window.argmin(1) + np.arange(len(window)))
    # of one word again and again, every WINDOW-th seed and the last will do
    same = np.zeros(len(places) + 1, bool)
    same[1:-1] = (places[1:] == places[:-1] + 1) & (seeds[places[1:]] == seeds[places[:-1]])
    begin = np.flatnonzero(~same[:-1])
    inside = np.arange(len(places)) - begin[np.cumsum(~same[:-1]) - 1]
    places = places[(inside % WINDOW == 0) | ~same[1:]]
    return places, seeds[places]


def _anchor_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        rows, places, seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for i, (words, _, _) in enumerate(doc_words(rows_of(batch), SPACED)):
            place, seed = anchors(words)
            rows.append(np.full(len(place), i))
            places.append(place)
            seeds.append(seed)
        row = pa.array(np.concatenate(rows))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(row), batch.column(KEY).take(row),
             pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(seeds).view(np.int64))],
            names=["doc_id", KEY, "place", "seed"])


_SUFFIX = pa.schema([("seed", pa.int64()), ("doc_id", pa.int64()), (KEY, pa.int64()), ("place", pa.int32()),
                     ("low", pa.int32()), ("high", pa.int32()), ("open", pa.int64()), ("left", pa.binary()), ("right", pa.binary())])
_SUFFIX_DDL = (f"seed bigint, doc_id bigint, {KEY} bigint, place int, low int, high int, open bigint,"
               " left binary, right binary")


def _side(words: np.ndarray) -> bytes:
    """Up to REACH words as four bytes each, that sort as they are stored."""
    return (words[:REACH] & np.uint64(0xFFFFFFFF)).astype(">u4").tobytes()


def neighbours(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """The extents of one seed's suffixes that match earlier ones, and the suffixes with what did not match.

    A match of LEAST words holds a number of words before the seed and the rest behind
    it. For each such split the suffixes with equal words there are neighbours in the
    order by them, and all but the first of them match; so every suffix gets the union
    of its matches with all earlier ones, be these matched themselves or not. The splits
    at which a suffix was the first are its open bits; without any it need not be
    compared again, as an earlier one stands for it at every split.
    """
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen: list[set[bytes]] = [set() for _ in range(REACH + 1)]
    found, rest = [], []
    for r in rows:
        left, right = r[7], r[8]
        most, least = len(left) // 4, max(0, REACH - len(right) // 4)
        open_, low, high = 0, None, None
        for n in range(least, most + 1):
            words = left[: 4 * n] + right[: 4 * (REACH - n)]
            if words not in seen[n]:
                seen[n].add(words)
                open_ |= 1 << n
            else:
                low, high = r[3] - n, r[3] + LEAST - n if high is None else high
        if low is not None:
            found.append((*r[:4], low, high, None, None, None))
        if open_:
            rest.append((*r[:6], open_, left, right))
    return found, rest


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SUFFIX)], schema=_SUFFIX)


def _suffixes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes at the marked places; those of one batch are compared at once, so a
    frequent passage leaves the batch about once."""
    for batch in parts:
        ids, keys = batch.column("doc_id").to_pylist(), batch.column(KEY).to_pylist()
        by_seed: dict[int, list[tuple]] = {}
        marks = batch.column("marks").to_pylist()
        for i, (words, _, _) in enumerate(doc_words(rows_of(batch), SPACED)):
            seeds = runs(words, SEED).view(np.int64)
            for place in marks[i]:
                by_seed.setdefault(int(seeds[place]), []).append(
                    (int(seeds[place]), ids[i], keys[i], place, None, None, None,
                     _side(words[max(0, place - REACH) : place][::-1]), _side(words[place + SEED :])))
        out: list[tuple] = []
        for rows in by_seed.values():
            found, rest = neighbours(rows)
            out += found
            out += rest
            if len(out) > 20_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)


def _across(rest: DataFrame) -> DataFrame:
    """doc_id, row key, low and high of what earlier suffixes of any batch match, from those with open splits.

    As :func:`neighbours`. Of suffixes equal over the whole reach the first stands for
    all, at every split; only seeds with several of these are then looked at split by
    split, a row for each open one. What is frequent leaves each task once.
    """
    here = F.struct("doc_id", KEY, "place")
    rest = rest.withColumn("whole", F.xxhash64("left", "right"))
    firsts = written(rest.groupBy("seed", "whole").agg(F.min(here).alias("first"), F.count("*").alias("times")), "firsts")
    copies = rest.join(firsts.filter("times > 1").select("seed", "whole", "first"), ["seed", "whole"]).filter(
        here != F.col("first"))
    before, behind = F.length("left") / 4, F.length("right") / 4
    copies = copies.select("doc_id", KEY, (F.col("place") - before).cast("int").alias("low"),
                           (F.col("place") + SEED + behind).cast("int").alias("high"))
    several = firsts.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    sought = firsts.join(several, "seed").select("seed", "whole", "first")
    splits = F.array(*[F.when(F.getbit("open", F.lit(n)) == 1, F.xxhash64(
        F.lit(n), F.substring("left", 1, 4 * n), F.substring("right", 1, 4 * (REACH - n)))) for n in range(REACH + 1)])
    rows = rest.join(sought, ["seed", "whole"]).filter(here == F.col("first")).select(
        "seed", "doc_id", KEY, "place", F.posexplode(splits).alias("n", "words")).filter("words is not null")
    again = rows.groupBy("seed", "n", "words").agg(F.min(here).alias("first"), F.max(here).alias("last")).filter("first <> last")
    again = written(again.select("seed", "n", "words", "first"), "repeated")
    low = F.col("place") - F.col("n")
    matched = rows.join(again, ["seed", "n", "words"]).filter(here != F.col("first")).groupBy("doc_id", KEY, "place").agg(
        F.min(low).alias("low"), (F.max(low) + LEAST).alias("high")).drop("place")
    return copies.unionByName(matched)


def _cut(documents: list[bytes], marks: list[list[int]]):
    for text, own, (hashes, start, end) in zip(documents, marks, doc_words(documents, SPACED), strict=True):
        n = len(hashes)
        cover = np.zeros(n + 1, np.int64)
        if own:
            np.add.at(cover, np.array(own[::2], np.int64), 1)
            np.add.at(cover, np.array(own[1::2], np.int64), -1)
        gone = np.cumsum(cover)[:n] > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        begin = np.append(start, len(text))
        yield n, int(gone.sum()), without(text, [(int(begin[a]), int(begin[b])) for a, b in zip(edge[::2], edge[1::2], strict=True)])


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, text of every row of ``docs``.

    A passage of LEAST words or more that occurs earlier, by doc_id, row key and place,
    is cut; capitals count as small letters and blanks alike. The occurrence that comes
    first stays, and of one word again and again up to WINDOW words. A shorter text has no such passage; a NULL text stays NULL. Rows equal
    in id and text are one document, so they keep or lose the same words.
    """
    rows = keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    places = rows.mapInArrow(_anchor_rows, f"doc_id bigint, {KEY} bigint, place int, seed bigint")
    shared = places.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    marked = written(places.join(shared, "seed").groupBy("doc_id", KEY).agg(F.collect_set("place").alias("marks")), "marks")
    # a row that occurs twice is looked at once
    texts = on_key(rows, marked, "inner").dropDuplicates(["doc_id", KEY])
    local = written(texts.select("doc_id", KEY, "text", "marks").mapInArrow(_suffixes, _SUFFIX_DDL), "suffixes")
    rest = local.filter("open is not null")
    across = _across(rest)
    ranges = local.filter("low is not null").select("doc_id", KEY, "low", "high").unionByName(across).groupBy("doc_id", KEY).agg(
        F.flatten(F.collect_set(F.array("low", "high"))).alias("marks"))
    return cut_texts(docs, written(ranges, "ranges"), _cut, "n_words", "n_removed")
