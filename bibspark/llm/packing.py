"""Mixture-controlled packing: deficit round-robin over source queues.

The queues' sizes fix which source fills which places of which window. They are
known once the tokens are written, and they are few; so every task replays the round
robin for just those windows that its own documents fall in, and no token moves.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibspark.llm.encoding import encoder
from bibspark.llm.rows import Sink, texts, written

LENGTH = 2048
END = 1
QUEUES = 1024  # of more sources, those that no target names share queues by hash
SPAN = 1024  # windows that are replayed together, fewer where there are many queues
_CELLS = 1 << 16  # windows times queues of a replay
_SCALE = 1 << 80


class Schedule:
    """Which tokens of each queue every window holds.

    The round robin is replayed window by window with the targets: every queue that
    still has tokens earns its target's share of the window, gives whole tokens and
    carries the rest; what a queue that runs dry leaves goes to the others by their
    targets. The windows come in spans, whose beginnings are checkpoints: how many
    tokens of each queue lie ahead of one follows from the queue sizes alone, by drawing
    all queues in proportion to their targets, and what that rounds off are the deficits.
    """

    def __init__(self, sizes: list[int], targets: list[int], length: int = LENGTH, span: int | None = None):
        self.sizes, self.length = sizes, length
        self.span = span or max(8, min(SPAN, _CELLS // max(1, len(sizes))))
        self.targets = [max(1, t) for t in targets]
        self.total = sum(sizes)
        self._top = max((_SCALE * (s + 1) // t + 1 for s, t in zip(sizes, self.targets, strict=True)), default=1)
        self._spans: dict[int, tuple] = {}

    def _drawn(self, clock: int) -> list[int]:
        half = _SCALE
        return [min(s, (2 * t * clock + half) // (2 * _SCALE)) for s, t in zip(self.sizes, self.targets, strict=True)]

    def ahead(self, tokens: int) -> tuple[list[int], list[float]]:
        """How many of the first ``tokens`` tokens each queue gives, and its deficit."""
        low, high = 0, self._top
        while low < high:
            middle = (low + high) // 2
            if sum(self._drawn(middle)) >= tokens:
                high = middle
            else:
                low = middle + 1
        drawn, before = self._drawn(low), self._drawn(max(low - 1, 0))
        extra = sum(drawn) - tokens
        for q in reversed(range(len(drawn))):
            back = min(extra, drawn[q] - before[q])
            drawn[q] -= back
            extra -= back
        return drawn, [min(t * low / _SCALE, s) - d for t, s, d in zip(self.targets, self.sizes, drawn, strict=True)]

    def span_of(self, queue: int, place: int) -> int:
        """The span that holds a queue's token."""
        clock = ((2 * place + 1) * _SCALE) // (2 * self.targets[queue])
        at = max(0, min(self.total - 1, sum(self._drawn(clock)))) // (self.span * self.length)
        while self.replay(at)[0][0, queue] > place:
            at -= 1
        while self.replay(at)[0][-1, queue] <= place:
            at += 1
        return at

    def replay(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """For a span: each queue's tokens before every window (and after the last), and
        where in the window its part begins."""
        if at in self._spans:
            return self._spans[at]
        first, carried = self.ahead(min(self.total, at * self.span * self.length))
        last, _ = self.ahead(min(self.total, (at + 1) * self.span * self.length))
        left = np.array(last, np.int64) - np.array(first, np.int64)
        tokens = int(left.sum())
        deficit, weight = np.array(carried, float), np.array(self.targets, float)
        takes = []
        while tokens:
            size = min(self.length, tokens)
            live, earned = left > 0, float(size)
            deficit = np.where(live, deficit, 0.0)
            while live.any():  # each turn but the last finds a queue that runs dry
                deficit = deficit + np.where(live, weight, 0.0) / weight[live].sum() * earned
                dry = live & (deficit >= left)
                earned = float((deficit - left)[dry].sum())
                deficit, live = np.where(dry, left, deficit), live & ~dry
                if not dry.any():
                    break
            take = np.clip(np.floor(deficit).astype(np.int64), 0, left)
            short = size - int(take.sum())
            while short:  # the largest deficits give one more, or the smallest one less
                gap = deficit - take
                able = left > take if short > 0 else take > 0
                order = np.argsort(-gap if short > 0 else gap, kind="stable")
                order = order[able[order]][: abs(short)]
                take[order] += 1 if short > 0 else -1
                short = size - int(take.sum())
            takes.append(take)
            deficit, left, tokens = deficit - take, left - take, tokens - size
        takes = np.array(takes, np.int64).reshape(-1, len(left))
        before = np.concatenate([[first], first + np.cumsum(takes, axis=0)])
        inside = np.cumsum(takes, axis=1) - takes
        if len(self._spans) >= 64:
            self._spans.clear()
        self._spans[at] = before, inside
        return before, inside

    def pieces(self, queue: int, place: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, window, offset) of a document's tokens at ``place`` of its queue."""
        done, at = 0, self.span_of(queue, place)
        while done < n:
            before, inside = self.replay(at)
            edges = before[:, queue]
            row = int(np.searchsorted(edges, place + done, "right")) - 1
            while done < n and row < len(inside):
                size = min(int(edges[row + 1]) - place - done, n - done)
                if size > 0:
                    yield from self._cut(done, size, at * self.span + row,
                                         int(inside[row, queue]) + place + done - int(edges[row]))
                    done += size
                row += 1
            at += 1

    def _cut(self, start: int, size: int, window: int, offset: int) -> Iterator[tuple[int, int, int, int]]:
        """The last window, if short, becomes sequences whose lengths are powers of two."""
        short = self.total - window * self.length
        if short >= self.length:
            yield start, size, window, offset
            return
        low = 0
        for bit in reversed(range(short.bit_length())):
            if short >> bit & 1:
                a, b = max(offset, low), min(offset + size, low + (1 << bit))
                if a < b:
                    yield start + a - offset, b - a, window, a - low
                low += 1 << bit
                window += 1


_TOKENS = "doc_id bigint, source string, block int, place bigint, n bigint, ids binary"
_PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint,"
           " offset bigint, source string")


def _tokenize(path: str, end: int):
    """Rows with their packed ids and their place among the task's tokens of their source."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _TOKENS.split(", ")])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out, place, block = encoder(path), Sink(schema), {}, TaskContext.get().partitionId()
        last = np.array([end], own.dtype).tobytes()
        for batch in parts:
            ids, sources = batch.column("doc_id").to_pylist(), batch.column("source").to_pylist()
            for i, text in enumerate(texts(batch).to_pylist()):
                packed = own.ids(text) + last
                n = len(packed) // own.dtype.itemsize
                out.add(ids[i], sources[i], block, place.get(sources[i], 0), n, packed)
                place[sources[i]] = place.get(sources[i], 0) + n
                yield from out.full()
        yield from out.rest()

    return run


def _lay_out(schedule, dtype: str):
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _PIECES.split(", ")])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, out = schedule.value, Sink(schema, 1 << 20)
        for batch in parts:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source", "queue", "at", "n", "ids")), strict=True)
            for doc_id, source, queue, at, n, packed in rows:
                wide = memoryview(np.frombuffer(packed, dtype).astype("<u4").tobytes())
                for start, size, window, offset in plan.pieces(queue, at, n):
                    out.add(doc_id, start, size, zlib.crc32(wide[4 * start : 4 * (start + size)]), n, window, offset,
                            source)
                yield from out.full()
        yield from out.rest()

    return run


def pack(docs: DataFrame, tokenizer: str, targets: dict[str | None, int] | None = None, length: int = LENGTH,
         end: int = END) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source of every piece.

    Each source is a queue. Without ``targets`` (source to weight) the proportions are
    those of the whole table, so that every window mirrors it and all queues end
    together; with them, a queue that has run dry leaves its part to the others. Every
    window is full but the last, which is cut into sequences of a power of two tokens.

    A NULL or empty text is the end token alone. Rows that repeat an id are documents
    of their own; a NULL source is a source. An empty table gives no pieces. Each
    source that a target names is a queue, at any number; a source without target comes
    after those with one. Of more than QUEUES sources, those without share queues by hash.
    """
    spark = docs.sparkSession
    frame = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("source").cast("string").alias("source"))
    tokens = written(frame.mapInArrow(_tokenize(tokenizer, end), _TOKENS), "tokens")
    blocks = tokens.groupBy("source", "block").agg(F.sum("n").alias("n"))
    few = tokens.select("source").distinct().count() <= QUEUES
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    wanted = {"null" if t is None else f"={t}": w for t, w in (targets or {}).items()}
    queue = named if few else F.when(named.isin(list(wanted)), named).otherwise(
        F.pmod(F.xxhash64("source"), F.lit(QUEUES)).cast("string"))
    before = Window.partitionBy("name").orderBy(F.col("source").asc_nulls_first(), "block").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = written(blocks.withColumn("name", queue).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))),
                     "queues")
    sizes = {r["name"]: r["n"] for r in placed.groupBy("name").agg(F.sum("n").alias("n")).collect()}  # at most QUEUES and the targets
    names = sorted(sizes)
    scale = (1 << 40) / max([1e-9, *wanted.values()])
    plan = Schedule([sizes[n] for n in names], [int(wanted.get(n, 0) * scale) if targets else sizes[n] for n in names],
                    length)
    sent = spark.sparkContext.broadcast(plan)
    numbers = spark.createDataFrame([*enumerate(names)], "queue int, name string")
    base = placed.join(numbers, "name").select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "base", "queue")
    rows = tokens.join(base, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    rows = rows.select("doc_id", "source", "queue", (F.col("base") + F.col("place")).alias("at"), "n", "ids")
    return rows.mapInArrow(_lay_out(sent, encoder(tokenizer).dtype.str), _PIECES)
