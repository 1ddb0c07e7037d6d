"""Written stages, row keys and Arrow batches that the operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.session import fresh_path, shuffles_freed

KEY = "_row_key"
_PART_BYTES = 4 << 20  # text taken out of an Arrow batch at a time
MARKS = 1 << 24  # bits of a set of marks, 2 MB, whatever the input size


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    This cuts the lineage, so a lost executor costs its running tasks only. The
    job's shuffle files go when it has ended.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key made of doc_id and text.

    Rows that are equal in both are copies of one row and share its result; rows
    that share a doc_id only are told apart. The key needs no numbering, so it is
    the same whenever and wherever a row is read again.
    """
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text", F.coalesce(F.length("text"), F.lit(-1))))


def on_key(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on row key and doc_id, NULL ids included; ``right`` has one row per key."""
    other = right.withColumnsRenamed({"doc_id": "_other_id", KEY: "_other_key"})
    same = (F.col(KEY) == F.col("_other_key")) & F.col("doc_id").eqNullSafe(F.col("_other_id"))
    joined = left.join(other, same, how)
    return joined.drop("_other_id", "_other_key")


def mark_of(hash_: Column) -> Column:
    """The bit that a 64-bit hash has among MARKS."""
    return F.pmod(hash_, F.lit(MARKS)).cast("int")


def _mark_words(rows: DataFrame, mark: Column) -> DataFrame:
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("mark").bitwiseAND(F.lit(63)).cast("int"))
    return rows.select(mark.alias("mark")).groupBy(F.shiftright("mark", 6).cast("bigint").alias("at")).agg(F.bit_or(bit).alias("word"))


def marks(rows: DataFrame, mark: Column) -> DataFrame:
    """One row, ``words``: MARKS bits in 64-bit words, those set that ``mark`` has.

    A row whose bit is not set is surely none of ``rows``; one whose bit is set may be.
    """
    every = rows.sparkSession.range(MARKS // 64).select(F.col("id").alias("at")).join(_mark_words(rows, mark), "at", "left")
    whole = every.agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("word", F.lit(0).cast("bigint")).alias("word")))).alias("words"))
    return written(whole.select(F.transform("words", lambda x: x["word"]).alias("words")), "marks")


def is_marked(mark: Column, words: DataFrame) -> Column:
    """Whether the bit of ``mark`` is set in what ``marks`` gave."""
    return F.getbit(F.get(words.scalar(), F.shiftright(mark, 6)), mark.bitwiseAND(F.lit(63))) == 1


def mark_bytes(rows: DataFrame, mark: Column) -> bytes:
    """The bits of ``marks`` on the driver, for ``marked_in``."""
    found = _mark_words(rows, mark).toArrow()  # at most MARKS / 64 rows
    words = np.zeros(MARKS // 64, "<i8")
    words[found["at"].to_numpy()] = found["word"].to_numpy()
    return words.tobytes()


def marked_in(bits: bytes, mark: np.ndarray) -> np.ndarray:
    return np.frombuffer(bits, np.uint8)[mark >> 3] >> (mark & 7).astype(np.uint8) & 1 > 0


def texts(batch: pa.RecordBatch, name: str = "text") -> pa.StringArray:
    """The texts of a batch, NULL as empty."""
    return pc.fill_null(pc.cast(batch.column(name), pa.string()), "")


def rows_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8, NULL as empty."""
    return pc.cast(texts(batch, name), pa.binary()).to_pylist()


def bounded(parts: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches in parts of about _PART_BYTES of text, one row at least."""
    for batch in parts:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(name)), 0))
        part = np.cumsum(size) // _PART_BYTES
        at = 0
        for to in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]:
            if to > at:
                yield batch.slice(at, to - at)
            at = to


def batches(columns: dict[str, Sequence], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


class Sink:
    """Collects output rows and gives them out in batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit: int = 8 << 20):
        self.schema, self.limit = schema, limit
        self._clear()

    def _clear(self):
        self.rows, self.size = {f.name: [] for f in self.schema}, 0

    def add(self, *values) -> None:
        for name, value in zip(self.schema.names, values, strict=True):
            self.rows[name].append(value)
            self.size += 8 + (len(value) if isinstance(value, (bytes, str, list)) else 0)

    def full(self) -> Iterator[pa.RecordBatch]:
        if self.size >= self.limit:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            batch = batches(self.rows, self.schema)
            self._clear()
            yield batch


__all__ = ["KEY", "MARKS", "Sink", "batches", "bounded", "is_marked", "keyed", "mark_bytes", "mark_of", "marked_in", "marks",
           "on_key", "rows_of", "table", "texts", "written"]
