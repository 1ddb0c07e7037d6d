"""Abstracts of searched publications into their keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.catalogue import ABSTRACT_TABLE
from bibspark.operators.dedupe import keep_last
from bibspark.operators.frames import clean_columns, nested_to_json
from bibspark.operators.works import project_abstract
from bibspark.sinks.tables import load_table, read_current


def abstract_rows(search: DataFrame, bodies: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per ``prism_doi`` of ``search`` that a landed body answers.

    ``bodies`` holds ``prism_doi``, ``body`` and the columns of ``order``, by which the
    newest body of a DOI counts. Affiliations and authors become JSON text. A body that
    cannot be read gives a row that has its ``requested_doi`` only.
    """
    asked = search.select("prism_doi").dropna().distinct()
    found = asked.join(keep_last(bodies, ["prism_doi"], order), "prism_doi")
    named = found.select(F.col("prism_doi").alias("requested_doi"), "body")
    return nested_to_json(clean_columns(project_abstract(named)))


def refresh_abstracts(search: DataFrame, bodies: DataFrame, order: Sequence[str], root: str,
                      rejects: str | None = None) -> str:
    """Upsert the abstracts of ``search`` below ``root``; unreadable ones go to ``rejects``.

    Of two DOIs that name one identifier the greater one is kept.
    """
    return load_table(abstract_rows(search, bodies, order), root, ABSTRACT_TABLE, ["requested_doi"], rejects)


def read_abstracts(spark: SparkSession, root: str) -> DataFrame:
    return read_current(spark, root, ABSTRACT_TABLE)
