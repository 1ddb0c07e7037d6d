"""Global row numbers, exact parts, pages and the best rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibspark import catalogue
from bibspark.session import fresh_path, shuffles_freed

_ROW_BITS = 33  # low bits of monotonically_increasing_id: position in partition
SALTS = 64
DIRECT = 5000  # rows that one task may sort for a page


def _placed(df: DataFrame, order: Sequence[str | Column]) -> tuple[DataFrame, DataFrame]:
    """``df`` written in ranges of ``order``, each row with its place there, and what stands before each range.

    One range-partitioned Parquet write to the shared folder: the place is computed in
    the sorted plan and stored, so it is settled whoever reads the rows again, and
    nothing is kept on a local disk: the shuffle files go when the ranges are written.
    The second frame has one row per range.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "ordered")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.withColumn("_place", F.monotonically_increasing_id())
    with shuffles_freed(spark):
        ordered.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(ordered.schema).parquet(path)
    sizes = stored.groupBy(F.shiftright("_place", _ROW_BITS).alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return stored, sizes.select("_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))


def _within() -> Column:
    return F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def with_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """Number all rows 1, 2, ... under a total order, without one task seeing all.

    Each range of the order is shifted by the row counts of those before it; what is
    broadcast has one row per range. The input is computed twice, for the bounds of the
    ranges and for the rows: hand in stored rows where that is dear.
    """
    stored, offsets = _placed(df, order)
    return (
        stored.withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .join(F.broadcast(offsets.select("_part", "_before")), "_part")
        .withColumn(name, F.col("_before") + _within() + 1)
        .drop("_place", "_part", "_before")
    )


def with_part_id(df: DataFrame, order: Sequence[str | Column],
                 rows_per_part: int = catalogue.ROWS_PER_PART) -> DataFrame:
    """Part 1, 2, ... of each row; every part is full but the last."""
    numbered = with_row_number(df, order, "_row")
    part = F.floor((F.col("_row") - 1) / rows_per_part) + 1
    return numbered.withColumn("part_id", part.cast("bigint")).drop("_row")


def page_slice(df: DataFrame, order: Sequence[Column], start: int = 0,
               count: int = catalogue.PAGE_SIZE, direct: int = DIRECT) -> DataFrame:
    """``count`` rows from position ``start`` of a total order, in that order.

    Up to ``direct`` rows deep an ordered top-k: each task sorts out its own first ``start +
    count`` rows and no other row moves. A deeper page does not go through one task: the
    rows are sorted in ranges, the sizes of the ranges tell which of them hold the page,
    and only its rows are read back.
    """
    if start + count <= direct:
        return df.orderBy(*order).offset(start).limit(count)
    stored, offsets = _placed(df, order)
    held = offsets.filter((F.col("_before") < start + count) & (F.col("_before") + F.col("_n") > start)).orderBy("_part").collect()
    # a page lies in few ranges, and in each of them between two places
    base = [(r["_part"] << _ROW_BITS, max(0, start - r["_before"]), min(r["_n"], start + count - r["_before"])) for r in held]
    wanted = F.lit(False)
    for low, first, last in base:
        wanted = wanted | ((F.col("_place") >= low + first) & (F.col("_place") < low + last))
    return stored.filter(wanted).orderBy("_place").drop("_place")


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column],
                  spread_by: Sequence[str], limit: int,
                  salts: int = SALTS) -> DataFrame:
    """The first ``limit`` rows of every group.

    Groups are cut in salted slices first; what reaches the task of one group
    is at most ``salts * limit`` rows however large the group is.
    """
    slices = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    in_slice = Window.partitionBy(*groups, "_salt").orderBy(*order)
    in_group = Window.partitionBy(*groups).orderBy(*order)
    return (
        slices.withColumn("_rank", F.row_number().over(in_slice))
        .filter(F.col("_rank") <= limit)
        .withColumn("_rank", F.row_number().over(in_group))
        .filter(F.col("_rank") <= limit)
        .drop("_rank", "_salt")
    )
