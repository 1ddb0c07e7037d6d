"""LM scoring: prediction by partial matching over byte contexts, beside a word model.

A symbol is one of all 256 byte values, a context the ORDER bytes before it. Both
together are one whole number, so the trie is a table with a row for every byte string
of ORDER + 1 bytes that occurs, and each shorter level is the sums of the one above it by
its last bytes. Counts come from the whole training text, and a context counts from
LEAST occurrences on, whatever the size of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibspark.llm.rows import bounded, rows_of, written
from bibspark.llm.words import SPACED, doc_words, slices

ORDER = 6  # bytes of the longest context; with its symbol it fits into 63 bits
LEAST = 2  # a context that occurred less often is passed over for the shorter one
HELD_OUT = (7, 2)  # a document is held out where crc32(doc_id) modulo the first is the second
_STOP = 0xFF  # in no UTF-8 text
_SENT = 1 << 21  # at most so many of the commonest byte strings are sent to all tasks; the rest is joined
_SPREAD = 1 << 18  # words so frequent that at most this many can be are sent to all tasks
_FRESH = 1 << 19  # keys that a task holds before it counts them
_TALLY = 3 << 20  # keys that a task counts before it gives them out
_ROWS = 1 << 16  # of a batch given out


def is_training(doc_id: int | None, rule: tuple[int, int] = HELD_OUT) -> bool:
    """A document without id belongs to the training part."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % rule[0] != rule[1]


def _lower_space() -> np.ndarray:
    table = np.arange(256)
    table[65:91] += 32
    table[9:14] = 32
    return table.astype(np.uint8)


_LOWER = _lower_space()


def _single_gaps(text: bytes) -> np.ndarray:
    """The text's bytes with one gap between words, none at a stop or at the end."""
    low = _LOWER[np.frombuffer(text, np.uint8)]
    blank = low == 32
    keep = ~blank
    keep[:-1] |= ~blank[1:] & (low[1:] != _STOP)
    low = low[keep]
    keep = np.ones(len(low), bool)
    keep[1:] = ~((low[1:] == 32) & (low[:-1] == _STOP))
    return low[keep]


def coded(documents: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """About a megabyte at a time: first document, bytes, places of those that count, whose they are.

    Words are parted by one gap. ORDER ends stand before the first document and after
    each; the first end after a document belongs to it. A text that comes in pieces has
    one end, and each piece stands after the last ORDER bytes of the one before.
    """
    stop = bytes([_STOP]) * ORDER
    tail, done = stop, 0
    for first, data, bounds in slices(documents, SPACED):
        cut = data.tobytes()
        if len(cut) + done < len(documents[first]) or done:  # a piece
            done += len(cut)
            last = done == len(documents[first])
            low = _single_gaps(tail + b" " + cut + (stop if last else b""))
            where = np.arange(ORDER, len(low) - (ORDER - 1 if last else 0))
            yield first, low, where, np.zeros(len(where), np.int64)
            tail, done = (stop, 0) if last else (low[-ORDER:].tobytes(), done)
            continue
        low = _single_gaps(stop + b"".join([cut[a:b] + stop for a, b in zip(bounds[:-1], bounds[1:], strict=True)]))
        ends = low == _STOP
        counts = ~ends
        counts[1:] |= ends[1:] & ~ends[:-1]
        # an empty document has its end among the stops of the one before
        where = np.flatnonzero(counts)
        owner = np.cumsum(ends) // ORDER - 1
        owner = np.where(ends, (np.cumsum(ends) - 1) // ORDER - 1, owner)
        empty = np.setdiff1d(np.arange(len(bounds) - 1), owner[where][ends[where]])
        if len(empty):
            where = np.concatenate([where, np.flatnonzero(ends)[(empty + 1) * ORDER]])
        yield first, low, where, owner[where]


def grams(low: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The byte at each place and the ORDER before it, the last one lowest."""
    code = low.astype(np.int64)
    for k in range(1, ORDER + 1):
        code[k:] |= low[:-k].astype(np.int64) << (8 * k)
    return code[where]


class _Tally:
    """Counts of keys, in training documents and in all, given out when they are many."""

    def __init__(self, word: bool):
        self.word, self.fresh, self.size = word, [], 0
        self._clear()

    def _clear(self) -> None:
        self.keys, self.n, self.times = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def add(self, keys: np.ndarray, learnt: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """Keys of one step; without ``learnt``, all are of training documents."""
        self.fresh.append(keys << 1 | learnt if learnt is not None else keys)
        self.size += len(keys)
        if self.size >= _FRESH:
            self._fold()
            if len(self.keys) >= _TALLY:
                yield from self.rest()

    def _fold(self) -> None:
        keys, times = np.unique(np.concatenate([np.zeros(0, np.int64), *self.fresh]), return_counts=True)
        self.fresh, self.size = [], 0
        times = times.astype(np.int32)
        n = times
        if not self.word:
            n, keys = times * (keys & 1).astype(np.int32), keys >> 1
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        n, times = np.concatenate([self.n, n])[order], np.concatenate([self.times, times])[order]
        if len(first):
            keys, n, times = keys[first], np.add.reduceat(n, first), np.add.reduceat(times, first)
        self.keys, self.n, self.times = keys, n, times

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._fold()
        for at in range(0, len(self.keys), _ROWS):
            here = slice(at, at + _ROWS)
            yield _counted(self.word, self.keys[here], self.n[here], self.times[here])
        self._clear()


def _counted(word: bool, keys: np.ndarray, n: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), word)), pa.array(keys), pa.array(n.astype(np.int64)), pa.array(times.astype(np.int64))],
        names=["is_word", "key", "n", "times"])


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte strings of all documents with how often training ones hold them, and training words."""
    strings, words, ends = _Tally(False), _Tally(True), 0
    for batch in bounded(parts):
        documents = rows_of(batch)
        learnt = ~np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool)
        ends += int(learnt.sum())
        for first, low, where, owner in coded(documents):
            yield from strings.add(grams(low, where), learnt[first + owner])
        for hashes, _, _ in doc_words([d for d, own in zip(documents, learnt, strict=True) if own], SPACED):
            yield from words.add(hashes.view(np.int64))
    yield from strings.rest()
    yield from words.rest()
    if ends:
        yield _counted(True, np.zeros(1, np.int64), np.array([ends]), np.array([ends]))  # the end token's word is 0


def _last(code: Column, size: int) -> Column:
    """The last ``size`` bytes of a byte string."""
    return code.bitwiseAND(F.lit((1 << 8 * size) - 1))


def probabilities(counts: DataFrame) -> DataFrame:
    """``counts`` (gram, n, any more) without n, and p: how likely the last byte of gram is after those before it.

    A context of N occurrences of q different symbols gives one seen n times the share
    (2n - 1) / 2N and escapes with q / 2N. After an escape, the symbols it has seen are
    excluded from the shorter context; where these are all that this one allows, there is
    no escape and the share is n / N. A context seen less than LEAST times is
    the shorter one, and below the empty context all 256 byte values are equally likely.

    ``gram`` is unique, n may be 0. A context has 256 symbols at most, so no group grows.
    """
    levels = [counts]
    for size in range(ORDER, 0, -1):
        shorter = levels[-1].groupBy(_last(F.col("gram"), size).alias("gram")).agg(F.sum("n").alias("n"))
        levels.append(written(shorter, f"strings_{size}"))
    found = None
    for depth, level in enumerate(reversed(levels)):
        if found is None:
            rows = level.withColumn("lower", F.lit(1 / 256))
        else:
            shorter = found.select(F.col("gram").alias("_short"), F.col("p").alias("lower"))
            rows = level.join(shorter, _last(F.col("gram"), depth) == F.col("_short")).drop("_short")
        context = Window.partitionBy(F.shiftright("gram", 8))
        seen = F.col("n") > 0
        more = [c for c in level.columns if c not in ("gram", "n")]
        rows = rows.select(
            "gram", "n", "lower", *more, F.sum("n").over(context).alias("all"),
            F.sum(seen.cast("int")).over(context).alias("kinds"),
            (1 - F.sum(F.when(seen, F.col("lower")).otherwise(0.0)).over(context)).alias("open"))
        shut = F.col("open") < 1e-12
        share = F.when(seen & shut, F.col("n") / F.col("all")).when(
            seen, (2 * F.col("n") - 1) / (2 * F.col("all"))).otherwise(
            F.col("kinds") / (2 * F.col("all")) * F.col("lower") / F.greatest("open", "lower", F.lit(1e-300)))
        known = F.col("all") >= (LEAST if depth else 1)
        found = written(rows.select("gram", *more, F.when(known, share).otherwise(F.col("lower")).alias("p")), f"level_{depth}")
    return found


def _commonest(strings: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The byte strings that occur most, _SENT at most, in order, and log10 of their p."""
    grade = F.floor(F.log2("times") * 16)
    sizes = strings.groupBy(grade.alias("grade")).count().orderBy(F.desc("grade")).collect()  # 16 a power of two
    least, total = None, 0
    for row in sizes:
        total += row["count"]
        if total > _SENT:
            break
        least = row["grade"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0)
    rows = strings.filter(grade >= least).select("gram", F.log10("p").alias("bits")).toArrow()
    code, bits = rows["gram"].to_numpy(), rows["bits"].to_numpy()
    order = np.argsort(code)
    return code[order], bits[order]


def _looked_up(keys: np.ndarray, known: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are known, and their values, 0 for others."""
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    sure = known[place] == keys
    return sure, np.where(sure, value[place], 0.0)


def _lists(owner: np.ndarray, keys: np.ndarray, documents: int) -> tuple[pa.Array, pa.Array]:
    """Each document's keys, each once, and how often it has them."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(fresh)
    times = np.diff(np.append(first, len(keys))).astype(np.int32)
    offsets = pa.array(np.searchsorted(owner[first], np.arange(documents + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(keys[first])), pa.ListArray.from_arrays(offsets, pa.array(times))


def _score(strings, frequent):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (codes, bits), (known, value, end_value) = strings.value, frequent.value
        number = TaskContext.get().partitionId() << 36
        for batch in bounded(parts):
            documents = rows_of(batch)
            size = len(documents)
            score, base, found, tokens = np.zeros(size), np.zeros(size), np.zeros(size, np.int64), np.ones(size, np.int64)
            rare, words = [(np.zeros(0, np.int64),) * 2], [(np.zeros(0, np.int64),) * 2]
            for first, low, where, owner in coded(documents):
                unique, back = np.unique(grams(low, where), return_inverse=True)
                sure, own = _looked_up(unique, codes, bits)
                sums = np.bincount(owner, own[back])
                score[first : first + len(sums)] += sums
                left = np.flatnonzero(~sure[back])
                rare.append((first + owner[left], unique[back[left]]))
            for i, (hashes, _, _) in enumerate(doc_words(documents, SPACED)):
                keys = hashes.view(np.int64)
                sure, own = _looked_up(keys, known, value)
                tokens[i] += len(keys)
                found[i] = sure.sum() + (end_value is not None)
                base[i] = own.sum() + (end_value or 0.0)
                words.append((np.full(len(keys) - int(sure.sum()), i), keys[~sure]))
            rare = _lists(*(np.concatenate(x) for x in zip(*rare, strict=True)), size)
            words = _lists(*(np.concatenate(x) for x in zip(*words, strict=True)), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + size)), batch.column("doc_id"), batch.column("held_out"),
                 pa.array(tokens), pa.array(found), pa.array(base), pa.array(score), *words, *rare],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "sum_known", "score", "words", "times",
                       "grams", "gram_times"])
            number += size

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Both models learn from the documents that are not held out: the base counts words
    and ends; the other codes the words, parted by single blanks and closed by an end,
    byte by byte. A NULL or empty text is the end alone. Rows that repeat an id are
    scored each by itself. With nothing to learn from, every token is unknown and all
    bytes are equally likely. A text over a megabyte is coded in pieces that carry
    their context on, with one end.

    What is common is looked up where the text is; all other words and byte strings
    are joined with their tables, so the result does not depend on what is sent.
    """
    context = docs.sparkSession.sparkContext
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(HELD_OUT[0])) == HELD_OUT[1]
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn(
        "held_out", F.coalesce(held, F.lit(False)))
    # tasks give every key once or a few times, so rows go to their key without another sum before
    counts = docs.select("held_out", "text").mapInArrow(_count, "is_word boolean, key bigint, n bigint, times bigint")
    counts = written(counts.repartition("is_word", "key").groupBy("is_word", "key").agg(
        F.sum("n").alias("n"), F.sum("times").alias("times")), "counts")
    strings = probabilities(counts.filter("not is_word").select(F.col("key").alias("gram"), "n", "times"))
    vocabulary = counts.filter("is_word").select(F.col("key").alias("word"), F.col("n").alias("c"))
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    scale = float(total + distinct + 1)
    often = vocabulary.filter(F.col("c") * _SPREAD > total).orderBy("word").toArrow()  # under _SPREAD rows
    value = np.log10((often["c"].to_numpy() + 1) / scale)
    word = often["word"].to_numpy()
    found = vocabulary.filter("word = 0").first()
    frequent = context.broadcast((word, value, float(np.log10((found["c"] + 1) / scale)) if found else None))
    rows = written(docs.mapInArrow(
        _score(context.broadcast(_commonest(strings)), frequent),
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, sum_known double, score double,"
        " words array<bigint>, times array<int>, grams array<bigint>, gram_times array<int>"), "scored")

    def rest(keys: str, times: str) -> DataFrame:
        return rows.select("row", F.explode(F.arrays_zip(F.col(keys).alias("key"), F.col(times).alias("by"))).alias("w")).select(
            "row", "w.key", "w.by")

    none = F.lit(0).cast("bigint")
    met = rest("words", "times").join(vocabulary, F.col("key") == F.col("word")).select(
        "row", F.col("by").cast("bigint").alias("rare"),
        (F.col("by") * F.log10((F.col("c") + 1) / scale)).alias("rare_sum"), F.lit(0.0).alias("bits"))
    met = met.unionByName(rest("grams", "gram_times").join(strings, F.col("key") == F.col("gram")).select(
        "row", none.alias("rare"), F.lit(0.0).alias("rare_sum"), (F.col("by") * F.log10("p")).alias("bits")))
    met = met.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("rare", "rare_sum", "bits")))
    known = F.col("n_known") + F.coalesce("rare", none)
    return rows.drop("words", "times", "grams", "gram_times").join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("sum_known") + F.coalesce("rare_sum", F.lit(0.0))
         + (F.col("n_tokens") - known) * float(np.log10(1 / scale))).alias("base_score"),
        (F.col("score") + F.coalesce("bits", F.lit(0.0))).alias("score"))
