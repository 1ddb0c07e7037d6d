"""Outcome of a looked-up record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status texts. The two patterns take a code and a message.
SUCCESS = "Success"
NOT_FOUND = "DOI Not Found (pyalex)"
NOT_FOUND_404 = "DOI Not Found (API 404)"
HTTP_ERROR = "HTTP Error %d - Skipped: %s"
RATE_LIMIT = "Rate Limit Error - Skipped"
NETWORK = "Network Error - Skipped: %s"
UNEXPECTED = "Processing Error - Skipped: %s"

RESPONSE_DDL = (
    "doi string, http_status int, error_kind string, error_message string,"
    " body string"
)

_FIELD = r'^\s*\{\s*"'  # how a valid object with a field begins


def lookup_status(
    http_status: Column, error_kind: Column, error_message: Column, body: Column
) -> Column:
    """Status of a lookup from what was landed for it.

    ``error_kind`` is NULL, ``rate_limit``, ``network`` or anything else for an
    unexpected failure; a key nothing was landed for counts as not found. A body is a
    record if it is a JSON object with a field; it is parsed once, and only where none
    of the other columns decides.
    """
    message = F.coalesce(error_message, F.lit(""))
    return (
        F.when(http_status == 404, F.lit(NOT_FOUND_404))
        .when(error_kind == "rate_limit", F.lit(RATE_LIMIT))
        .when(http_status >= 400, F.format_string(HTTP_ERROR, http_status, message))
        .when(error_kind == "network", F.format_string(NETWORK, message))
        .when(error_kind.isNotNull(), F.format_string(UNEXPECTED, message))
        .when(body.isNull() | (F.trim(body) == ""), F.lit(NOT_FOUND))
        .when(F.try_parse_json(body).isNull(), F.lit(UNEXPECTED % "response is no JSON"))
        .when(body.rlike(_FIELD), F.lit(SUCCESS))
        .otherwise(F.lit(NOT_FOUND))
    )
