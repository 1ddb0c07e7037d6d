"""Slices of landed search records and the refresh of a year."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark import catalogue
from bibspark.operators.dedupe import keep_last
from bibspark.operators.frames import union_by_name
from bibspark.operators.ranking import page_slice, top_per_group
from bibspark.sinks.files import overwrite_years
from bibspark.sources.files import backfill_month, read_stored


def select_slice(records: DataFrame, affiliation: str, year: int, document_type: str) -> DataFrame:
    """Records of one affiliation, publication year and document type.

    The year is asked of the cover date as a range, which reaches the scan.
    """
    day = F.col("prism_coverdate")
    return records.filter(
        (F.col("affiliation") == affiliation)
        & (F.col("subtypedescription") == document_type)
        & (day >= F.lit(dt.date(year, 1, 1))) & (day < F.lit(dt.date(year + 1, 1, 1)))
    )


def by_citations(tie_break: Sequence[str] = ("dc_identifier",)) -> list:
    """Most cited first, ties by identifier."""
    return [F.desc_nulls_last("citedby_count"), *[F.col(c) for c in tie_break]]


def search(records: DataFrame, affiliation: str, year: int, document_type: str, start: int = 0,
           count: int = catalogue.PAGE_SIZE, tie_break: Sequence[str] = ("dc_identifier",)) -> DataFrame:
    """One page of a slice in citation order."""
    found = select_slice(records, affiliation, year, document_type)
    return page_slice(found, by_citations(tie_break), start, count)


def results_of_types(records: DataFrame, types: Sequence[str] = tuple(catalogue.DOCUMENT_TYPES)) -> DataFrame:
    """The results of all given document types together, in one pass."""
    return records.filter(F.col("subtypedescription").isin(list(types)))


def capped_results(records: DataFrame, limit: int, tie_break: Sequence[str] = ("dc_identifier",)) -> DataFrame:
    """At most ``limit`` results per year and document type, most cited first."""
    return top_per_group(
        records, ["publication_year", "subtypedescription"], by_citations(tie_break),
        spread_by=list(tie_break), limit=limit,
    )


def merge_results(existing: DataFrame, new: DataFrame, order: Sequence[str],
                  keys: Sequence[str] = ("dc_identifier",)) -> DataFrame:
    """Earlier and new results by identifier; the newest fetch wins.

    Any new row ranks after any earlier one; ``order`` ranks the rows within
    each of the two.
    """
    both = union_by_name([
        backfill_month(existing).withColumn("_fetch", F.lit(0)),
        new.withColumn("_fetch", F.lit(1)),
    ])
    return keep_last(both, keys, ["_fetch", *order], carry_order=True).drop("_fetch")


def refresh_years(spark: SparkSession, path: str, new: DataFrame, order: Sequence[str],
                  years: Sequence[int] | None = None) -> None:
    """Merge new results into the stored years they belong to and rewrite only those.

    The years are those that occur in ``new``; given ``years``, a new row outside them
    is refused. A row without a year is kept under the stand-in for an unknown one, in
    which later refreshes find it. Columns of either side are kept. The rewrite replaces each partition
    after all of them have been computed. Years are kept apart: a record that moved to
    another year stays in both.
    """
    year = F.col("publication_year")
    new = new.withColumn("publication_year", F.coalesce(year, F.lit(catalogue.NO_YEAR)))
    found = [r[0] for r in new.select(year).distinct().collect()]  # a calendar's worth of years
    outside = [y for y in found if years is not None and y not in years]
    if outside:
        raise ValueError(f"new results of years that are not refreshed: {sorted(map(str, outside))}")
    stored = backfill_month(read_stored(spark, path, new.schema))
    merged = merge_results(
        stored.filter(year.isin(found)), new, order, keys=["publication_year", "dc_identifier"]
    )
    overwrite_years(merged, path)
