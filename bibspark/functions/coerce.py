"""Typed parsing of loosely typed columns; whatever does not parse is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DoubleType, FloatType, StringType,
)

from bibspark import catalogue

# Accepted spellings.
TRUE_WORDS = ["true", "t", "1"]
FALSE_WORDS = ["false", "f", "0"]
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NUMBER_OR_INFINITE = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"
ISO_DAY = r"^\s*\d{4}-\d{2}-\d{2}([T ][0-9:.]*\s*(Z|[+-]\d{2}(:?\d{2})?)?)?\s*$"


def to_double(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_OR_INFINITE), text.try_cast("double"))


def to_bigint(text: Column) -> Column:
    """Whole number by way of double: a fraction is cut off."""
    return F.when(text.rlike(NUMBER), text.try_cast("double").try_cast("bigint"))


def to_int(text: Column) -> Column:
    return to_bigint(text).try_cast("int")


def to_date(text: Column) -> Column:
    return F.when(text.rlike(ISO_DAY), text.try_cast("date"))


def to_timestamp(text: Column) -> Column:
    return F.when(text.rlike(ISO_DAY), text.try_cast("timestamp_ntz"))


def to_boolean(value: Column) -> Column:
    word = F.lower(value.cast("string"))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(
        word.isin(FALSE_WORDS), F.lit(False)
    )


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def tokens_to_null(text: Column, tokens: list[str] | None = None) -> Column:
    """NULL for every text that stands for a missing value in delimited files."""
    return F.when(~text.isin(tokens or catalogue.NULL_TOKENS), text)


_PARSERS = {
    "int": to_int,
    "bigint": to_bigint,
    "double": to_double,
    "date": to_date,
    "timestamp_ntz": to_timestamp,
}


def to_type(value: Column, source: DataType, target: str) -> Column:
    """``value`` of type ``source`` as declared type ``target``."""
    if target == "boolean":
        return value if source.simpleString() == "boolean" else to_boolean(value)
    if isinstance(source, (DoubleType, FloatType)):
        value = nan_to_null(value)
    if source.simpleString() == target:
        return value
    if isinstance(source, StringType) and target in _PARSERS:
        return _PARSERS[target](value)
    if target == "int":
        return value.try_cast("bigint").try_cast("int")
    return value.try_cast(target)
