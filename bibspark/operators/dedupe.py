"""De-duplication under an explicit order, and its counts.

First and last are only defined by ``order``: a list of columns that together
rank the rows of a key totally. The rank-one filter is applied by Spark inside
every map task before the shuffle, so a key that holds a large share of all rows
leaves each map task as a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str],
          ranking: list[Column], carry_order: bool) -> DataFrame:
    if not order:
        raise ValueError("de-duplication needs the columns that order the rows")
    kept = [c for c in df.columns if c in keys or carry_order or c not in order]
    if set(kept) == set(keys):
        return df.select(*kept).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).select(*kept)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry_order: bool = False) -> DataFrame:
    """One row per key, the first by ``order``; NULL keys are one key.

    The ``order`` columns are dropped unless ``carry_order``.
    """
    return _pick(df, keys, order, [F.asc(c) for c in order], carry_order)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry_order: bool = False) -> DataFrame:
    """One row per key, the last by ``order``; NULL keys are one key.

    The ``order`` columns are dropped unless ``carry_order``.
    """
    return _pick(df, keys, order, [F.desc(c) for c in order], carry_order)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of one column."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def dedupe_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after de-duplication on ``keys``."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return groups.agg(
        total.alias("rows_before"),
        F.count("*").alias("rows_after"),
        (total - F.count("*")).alias("rows_dropped"),
    )
