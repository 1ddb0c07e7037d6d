"""Publication year and month with their stand-ins for a missing date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bibspark import catalogue


def publication_year(day: Column) -> Column:
    return F.coalesce(F.year(day), F.lit(catalogue.NO_YEAR))


def publication_month(day: Column) -> Column:
    return F.coalesce(F.month(day), F.lit(catalogue.NO_MONTH))


def year_at_load(year: Column) -> Column:
    return F.coalesce(year, F.lit(catalogue.NO_YEAR_AT_LOAD))
