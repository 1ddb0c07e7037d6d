"""The declared tables as keyed tables in buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.catalogue import Table
from bibspark.functions.dates import year_at_load
from bibspark.operators.dedupe import keep_last
from bibspark.operators.frames import conform
from bibspark.operators.quality import any_null
from bibspark.session import fresh_path, shuffles_freed
from bibspark.sinks.buckets import BUCKETS, current, merge, read_buckets
from bibspark.sources.files import read_stored

YEAR = "publication_year"


def read_current(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The newest version, or no rows before the first."""
    return read_buckets(spark, root, current(spark, root), table.schema)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Rows that loads have set aside beside the table."""
    return read_stored(spark, f"{root}/rejects", "_none string")


def prepare(source: DataFrame, table: Table, order: Sequence[str]) -> DataFrame:
    """Rows fit for ``table``: its columns and types, the last row per key. A missing
    publication year becomes its stand-in."""
    ranked = [f"_order_{i}" for i in range(len(order))]
    kept = source.select("*", *[source[c].alias(n) for c, n in zip(order, ranked)])
    typed = conform(kept, {**table.types, **{n: kept.schema[n].dataType.simpleString() for n in ranked}})
    last = keep_last(typed, table.key, ranked).select(*table.columns)
    if YEAR not in table.columns:
        return last
    return last.withColumn(YEAR, year_at_load(F.col(YEAR)))


def split_null_keys(source: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """Rows with a whole key, and rows that miss a part of it they must have."""
    broken = any_null([c for c in table.key if c not in table.nullable_key])
    return source.filter(~broken), source.filter(broken)


def load_table(source: DataFrame, root: str, table: Table, order: Sequence[str], rejects: str | None = None,
               buckets: int = BUCKETS) -> str:
    """Upsert ``source`` into the table at ``root``; returns the path of the new version.

    Rows without a whole key are not loaded: they are added to ``rejects`` beside the
    table, or replace what is at the place that ``rejects`` names.
    table, or replace what is at the place that ``rejects`` names. ``source`` is computed
    once, into the shared folder: both kinds of rows are read from there.
    """
    spark = source.sparkSession
    staged = fresh_path(spark, table.name)
    with shuffles_freed(spark):
        source.write.option("compression", "zstd").parquet(staged)
    whole, broken = split_null_keys(spark.read.schema(source.schema).parquet(staged), table)
    if rejects:
        broken.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(rejects)
    elif not broken.isEmpty():
        broken.write.mode("append").parquet(f"{root}/rejects")
    return merge(prepare(whole, table, order), root, table.key, table.schema, buckets)
