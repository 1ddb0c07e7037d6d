import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from bibspark.functions import cells, coerce, dates, status
from bibspark.functions.identifiers import format_doi
from bibspark.functions.names import clean_name


def apply(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}").coalesce(1)
    return [r[0] for r in frame.select(expression(F.col("v"))).collect()]


def test_format_doi(spark):
    cases = {
        "10.1/AbC": "https://doi.org/10.1/abc",
        " https://doi.org/10.2/X ": "https://doi.org/10.2/x",
        "HTTP://DOI.ORG/10.3/y": "https://doi.org/10.3/y",
        "https://dx.doi.org/10.4/z": None,
        "invalid": None, "10.5": None, "": None, None: None, "   ": None,
        "\xa010.6/q\t": "https://doi.org/10.6/q",
        "　\x1c10.6/r\x85\n": "https://doi.org/10.6/r",
        "https://doi.org/ 10.7/x": None,
        "https://doiXorg/10.8/k": "https://doi.org/10.8/k",
    }
    assert apply(spark, list(cases), format_doi) == list(cases.values())


def test_whole_numbers(spark):
    cases = {"5.0": 5, "5.7": 5, "-5.7": -5, "x": None, "7": 7, " 8 ": 8, "": None, None: None,
             "1e3": 1000, "inf": None, "99999999999": None, "5d": None}
    assert apply(spark, list(cases), coerce.to_int) == list(cases.values())


def test_doubles(spark):
    cases = {"1e3": 1000.0, " 7 ": 7.0, "0x10": None, "1,000": None, "5d": None, "5f": None,
             "NaN": None, ".5": 0.5, "5.": 5.0, "-inf": -math.inf, None: None}
    assert apply(spark, list(cases), coerce.to_double) == list(cases.values())


def test_booleans(spark):
    cases = {"T": True, "F": False, "1": True, "0": False, "TRUE": True, "yes": None, "1.0": None,
             " t": None, None: None}
    assert apply(spark, list(cases), coerce.to_boolean) == list(cases.values())
    assert apply(spark, [1, 0, 2, None], coerce.to_boolean, "int") == [True, False, None, None]
    assert apply(spark, [1.0, 0.0], coerce.to_boolean, "double") == [None, None]


def test_dates(spark):
    cases = {"2024-01-01": dt.date(2024, 1, 1), "2024-02-01T05:00:00": dt.date(2024, 2, 1),
             "2024": None, "01/02/2024": None, "2024-13-01": None, "2024-01-01x": None, None: None}
    assert apply(spark, list(cases), coerce.to_date) == list(cases.values())


def test_timestamps(spark):
    cases = {"2024-01-01": dt.datetime(2024, 1, 1), "2024-02-01T05:06:07.5": dt.datetime(2024, 2, 1, 5, 6, 7, 500000),
             "2024": None, "x": None}
    assert apply(spark, list(cases), coerce.to_timestamp) == list(cases.values())


def test_stand_ins_for_missing_dates(spark):
    days = [dt.date(2021, 3, 4), None]
    assert apply(spark, days, dates.publication_year, "date") == [2021, 2100]
    assert apply(spark, days, dates.publication_month, "date") == [3, 0]
    assert apply(spark, [2020, None], dates.year_at_load, "int") == [2020, 9999]


def test_nan_is_null(spark):
    assert apply(spark, [1.5, math.nan, None], coerce.nan_to_null, "double") == [1.5, None, None]


@pytest.mark.parametrize("raw, clean", [
    ("dc:identifier", "dc_identifier"), ("citedby-count", "citedby_count"),
    ("prism:coverDate", "prism_coverdate"), ("@_fa", "fa"), ("a__b", "a_b"),
])
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_join_texts(spark):
    assert apply(spark, [["a", "b"], [], None], cells.join_texts, "array<string>") == ["a, b", None, None]


def test_compact_item(spark):
    items = ['["a", null, "", "b"]', '{"x": "a", "y": null}', "plain", '"quoted"', None]
    assert apply(spark, items, cells.compact_item) == [["a", "b"], ["a"], ["plain"], ["quoted"], []]


def test_lookup_status(spark):
    rows = [
        (200, None, None, '{"id": "W"}', "Success"),
        (200, None, None, "{ }", "DOI Not Found (pyalex)"),
        (None, None, None, None, "DOI Not Found (pyalex)"),
        (404, None, "gone", None, "DOI Not Found (API 404)"),
        (503, None, "busy", None, "HTTP Error 503 - Skipped: busy"),
        (429, "rate_limit", "slow down", None, "Rate Limit Error - Skipped"),
        (None, "network", "no route", None, "Network Error - Skipped: no route"),
        (None, "other", "odd", None, "Processing Error - Skipped: odd"),
        (200, None, None, "[1]", "DOI Not Found (pyalex)"),
    ]
    frame = spark.createDataFrame(rows, "h int, k string, m string, b string, want string").coalesce(1)
    got = frame.select(status.lookup_status(F.col("h"), F.col("k"), F.col("m"), F.col("b"))).collect()
    assert [r[0] for r in got] == [r[4] for r in rows]
