"""Column-level shaping of whole frames."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType, _parse_datatype_string

from bibspark.functions.cells import json_text
from bibspark.functions.coerce import to_type, tokens_to_null
from bibspark.functions.names import clean_name


def _leaves(schema: StructType, path: tuple[str, ...] = ()):
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested records as dotted columns; arrays stay whole."""
    return df.select(*[
        F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path))
        for path in _leaves(df.schema)
    ])


def clean_columns(df: DataFrame) -> DataFrame:
    """Database-friendly column names; two names that clean to one are refused."""
    names = [clean_name(c) for c in df.columns]
    clashes = [n for n, times in Counter(names).items() if times > 1]
    if clashes:
        raise ValueError(f"column names clash after cleaning: {sorted(clashes)}")
    return df.toDF(*names)


def ensure_columns(df: DataFrame, ddl: str) -> DataFrame:
    """Add declared columns that are missing, filled with NULL."""
    present = set(df.columns)
    missing = {
        f.name: F.lit(None).cast(f.dataType)
        for f in _parse_datatype_string(ddl).fields
        if f.name not in present
    }
    return df.withColumns(missing) if missing else df


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Restrict to ``columns`` in their order."""
    return df.select(*columns)


def project_available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Restrict to those of ``columns`` the frame has, in their order."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def null_tokens(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Missing-value texts of delimited input as NULL in every text column."""
    return df.select(*[
        tokens_to_null(F.col(f"`{f.name}`"), tokens).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def coerce_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns to their declared types in one projection."""
    return df.select(*[
        to_type(F.col(f"`{f.name}`"), f.dataType, types[f.name]).alias(f.name)
        if f.name in types else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Exactly the declared columns, in order, typed; absent ones NULL."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in types.items())
    return coerce_columns(ensure_columns(df, ddl).select(*types), types)


def nested_to_json(df: DataFrame) -> DataFrame:
    """Arrays, records and maps as JSON text, the form delimited files carry."""
    return df.select(*[
        json_text(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


_STATUS_GROUP = ("doi", "oa_status")


def enriched_layout(search: Sequence[str], work: Sequence[str], raw_doi: str = "prism_doi") -> list[str]:
    """Columns of enriched rows: the search columns, the status group, the work columns.

    The status group follows the raw identifier, or the search columns where these
    hold no raw identifier. A name belongs to the first group that declares it, the
    status group before the others.
    """
    plain = [c for c in search if c not in _STATUS_GROUP]
    place = plain.index(raw_doi) + 1 if raw_doi in plain else len(plain)
    has_key = raw_doi in plain or "doi" in search
    group = _STATUS_GROUP if has_key else _STATUS_GROUP[1:]
    rest = [c for c in work if c not in {*plain, *_STATUS_GROUP}]
    return [*plain[:place], *group, *plain[place:], *rest]
