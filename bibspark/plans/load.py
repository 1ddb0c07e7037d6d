"""Normalized rows into the published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.catalogue import TABLES, Table
from bibspark.operators.quality import any_null, key_violations, row_counts
from bibspark.session import fresh_path
from bibspark.sinks.tables import load_table, read_current, read_rejects


def _whole(table):
    return ~any_null([c for c in table.key if c not in table.nullable_key])


def load_all(tables: dict[str, DataFrame], root: str, order: dict[str, Sequence[str]] | None = None,
             rejects: str | None = None) -> dict[str, str]:
    """Upsert every given table below ``root``; returns the paths of the new versions.

    A table without an ``order`` must be unique by key, else the load is refused: which
    of its rows is the last would be anyone's guess. Every table is computed once, into
    the shared folder; nothing is loaded before all are known to be fit. Rows without a
    whole key are set aside, beside each table or below ``rejects``.
    """
    order = order or {}
    staged = {}
    for name, df in tables.items():
        path = fresh_path(df.sparkSession, name)
        df.write.parquet(path)
        staged[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    for name, df in staged.items():
        if name not in order and not key_violations(df, TABLES[name].key).filter(_whole(TABLES[name])).isEmpty():
            raise ValueError(f"{name} repeats keys: name the columns that rank its rows")
    return {
        name: load_table(df, f"{root}/{name}", TABLES[name], order.get(name) or df.columns, rejects and f"{rejects}/{name}")
        for name, df in staged.items()
    }


def load_counts(source: DataFrame, root: str, table: Table) -> DataFrame:
    """One row: what a first load of ``source`` was given, and where it is: rows set aside,
    rows that a later one of their key replaced, and rows of the table."""
    spark = source.sparkSession
    frames = {"n_source": source, "n_rejected": read_rejects(spark, root), "n_loaded": read_current(spark, root, table)}
    counts = row_counts(frames).groupBy().pivot("table_name", list(frames)).agg(F.sum("n_rows"))
    return counts.withColumn("n_replaced", F.col("n_source") - F.col("n_rejected") - F.col("n_loaded"))
