"""Nested work and abstract records as flat columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bibspark import catalogue
from bibspark.functions import cells, coerce
from bibspark.session import methods_compiled


def _text_schema(paths: Iterable[str]) -> StructType:
    """The record type that holds every dotted path as text."""
    tree: dict = {}
    for path in paths:
        node = tree
        for name in path.split("."):
            node = node.setdefault(name, {})

    def build(node: dict) -> StructType:
        return StructType([
            StructField(name, build(inner) if inner else StringType()) for name, inner in node.items()
        ])

    return build(tree)


WORK_SCHEMA = _text_schema([*catalogue.WORK_FIELDS.values(), *catalogue.WORK_LISTS.values()])


def work_record(body: Column) -> Column:
    """JSON text of a work with the fields that are read, each as text.

    A field of an unexpected kind is NULL by itself. Lists are kept as JSON
    text, so a list nobody asks for is never taken apart.
    """
    return F.from_json(body, WORK_SCHEMA)


def work_columns(record: str) -> list[Column]:
    """The 38 scalar columns, typed, and the 3 list columns of a work."""
    types = catalogue.TABLES["publications"].types
    scalars = [
        coerce.to_type(F.col(f"{record}.{path}"), StringType(), types[name]).alias(name)
        for name, path in catalogue.WORK_FIELDS.items()
    ]
    lists = [
        cells.parse_list(F.col(f"{record}.{path}"), catalogue.LIST_CELLS[name]).alias(name)
        for name, path in catalogue.WORK_LISTS.items()
    ]
    return scalars + lists


def flatten_work(df: DataFrame, body: str = "body") -> DataFrame:
    """Replace a JSON work column by its flat ``oa_`` columns."""
    methods_compiled(df.sparkSession)
    others = [c for c in df.columns if c != body]
    return df.withColumn("_work", work_record(F.col(body))).select(*others, *work_columns("_work"))


def project_abstract(df: DataFrame, body: str = "body") -> DataFrame:
    """Twelve core fields, affiliations and authors of abstract records."""
    others = [c for c in df.columns if c != body]
    record = F.try_variant_get(F.try_parse_json(F.col(body)), "$", catalogue.ABSTRACT_TYPE)
    parsed = df.withColumn("_abstract", record).select(
        *others,
        F.col("_abstract.`abstracts-retrieval-response`.coredata").alias("_core"),
        F.col("_abstract.`abstracts-retrieval-response`.affiliation").alias("_affiliation"),
    )
    affiliations = F.transform(F.col("_affiliation"), lambda a: F.struct(
        a["affilname"].alias("name"),
        a["affiliation-city"].alias("city"),
        a["affiliation-country"].alias("country"),
    ))
    authors = F.transform(F.col("_core.`dc:creator`.author"), lambda a: F.struct(
        a["ce:indexed-name"].alias("name"),
        a["affiliation"]["@id"].alias("affiliation"),
    ))
    return parsed.select(
        *others,
        *[F.col(f"_core.`{f}`").alias(f) for f in catalogue.ABSTRACT_FIELDS],
        F.coalesce(affiliations, F.array()).alias("affiliations"),
        F.coalesce(authors, F.array()).alias("authors"),
    )
