"""Joins by key that hold when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _whole(keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def join_unique(rows: DataFrame, unique: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``rows`` to ``unique``, which has one row per key.

    A plain join by key: it computes each side once, and where a key carries a large
    share of the rows the adaptive skew join splits them and repeats their partner.
    """
    return rows.join(unique, list(keys), how)


def not_in(rows: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Rows whose key does not occur in ``done``; rows without a key stay."""
    seen = done.select(F.col(f"`{done_key or key}`").alias(key)).filter(_whole([key])).distinct()
    return join_unique(rows, seen, [key], "left_anti")


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    """NULL-safe equality on all keys."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with new keys inserted and known keys overwritten.

    ``source`` holds one row per key. Where a table consists of its key only,
    known keys are left alone. Both sides are unique by key, so no key is hot.
    """
    if set(target.columns) == set(keys):
        return target.unionByName(source.join(target, same_key(source, target, keys), "left_anti"))
    kept = target.join(source, same_key(target, source, keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))
