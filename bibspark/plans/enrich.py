"""Search rows joined to looked-up work records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark import catalogue
from bibspark.functions import status as st
from bibspark.operators.dedupe import keep_last
from bibspark.operators.frames import enriched_layout
from bibspark.operators.keyed import join_unique, not_in
from bibspark.operators.works import work_columns, work_record


def unprocessed(rows: DataFrame, processed: DataFrame, retry_statuses: Sequence[str] = ()) -> DataFrame:
    """Rows with a doi that an earlier output does not have yet.

    A failed lookup counts as processed unless its status starts with one of
    ``retry_statuses``.
    """
    done = processed
    for prefix in retry_statuses:
        done = done.filter(~F.coalesce(F.col("oa_status").startswith(prefix), F.lit(False)))
    return not_in(rows.filter(F.col("doi").isNotNull()), done, "doi")


def latest_responses(responses: DataFrame, order: Sequence[str]) -> DataFrame:
    """One response per doi, the newest by ``order``."""
    return keep_last(responses, ["doi"], order)


def join_responses(rows: DataFrame, responses: DataFrame) -> DataFrame:
    """Every row with a doi, with the status and the body of its lookup.

    ``responses`` holds one row per doi; rows without one stay, as not found.
    """
    valid = rows.filter(F.col("doi").isNotNull())
    columns = [c for c in ("doi", "http_status", "error_kind", "error_message", "body")]
    joined = join_unique(valid, responses.select(*columns), ["doi"], "left")
    state = st.lookup_status(
        F.col("http_status"), F.col("error_kind"), F.col("error_message"), F.col("body")
    )
    return joined.select(
        *rows.columns, state.alias("oa_status"),
        F.when(state == st.SUCCESS, F.col("body")).alias("body"),
    )


def enrich(rows: DataFrame, responses: DataFrame) -> DataFrame:
    """Rows with a doi in the enriched layout: status and flat work columns."""
    joined = join_responses(rows, responses)
    flat = joined.withColumn("_work", work_record(F.col("body"))).select(
        *rows.columns, "oa_status", *work_columns("_work")
    )
    return flat.select(*enriched_layout(rows.columns, [*catalogue.WORK_FIELDS, *catalogue.WORK_LISTS]))
