"""Enriched rows to ten keyed tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bibspark import catalogue
from bibspark.functions.cells import json_text, parse_cell, parse_list
from bibspark.operators import explode as ex
from bibspark.operators.dedupe import keep_first, keep_last
from bibspark.operators.frames import conform, project_available
from bibspark.operators.quality import judged_cells, rejected_cells
from bibspark.session import shuffles_freed
from bibspark.sinks.files import save, write_table_parts


def _text_cells(enriched: DataFrame) -> list[str]:
    return [
        name for name in catalogue.LIST_CELLS
        if name in enriched.columns and isinstance(enriched.schema[name].dataType, StringType)
    ]


_JUDGED = "_judged_cells"


def typed_rows(enriched: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Rows that have a ``doi``, their list cells as typed arrays.

    A cell that is already an array stays as it is. ``types`` may give a cell a type of
    fewer fields, where a reader takes no others: the rest is parsed but not made.
    """
    types = catalogue.LIST_CELLS | (types or {})
    parsed = {name: parse_list(F.col(name), types[name]) for name in _text_cells(enriched)}
    valid = enriched.filter(F.col("doi").isNotNull())
    return valid.withColumns(parsed) if parsed else valid


def judged_rows(enriched: DataFrame) -> DataFrame:
    """``typed_rows`` with what is wrong with their cells; each cell is parsed once for both."""
    cells = _text_cells(enriched)
    variants = {name: f"_variant_{name}" for name in cells}
    valid = enriched.filter(F.col("doi").isNotNull()).withColumns({v: parse_cell(F.col(c)) for c, v in variants.items()})
    typed = {c: F.try_variant_get(v, "$", catalogue.LIST_CELLS[c]) for c, v in variants.items()}
    judged = judged_cells(cells, {c: F.col(v) for c, v in variants.items()})
    return valid.withColumns({**typed, _JUDGED: judged}).drop(*variants.values())


def _first(rows: DataFrame, table: str, order: Sequence[str]) -> DataFrame:
    spec = catalogue.TABLES[table]
    return keep_first(rows, spec.dedupe_key, order).select(*spec.columns)


def raw_search(rows: DataFrame, order: Sequence[str], unique_identifier: bool = False) -> DataFrame:
    """Search columns, the first row per doi.

    ``unique_identifier`` first takes the newest row per search identifier,
    so that the result also satisfies the primary key of the table.
    """
    spec = catalogue.TABLES["raw_scopus_search"]
    picked = rows.select(
        *[c for c in spec.columns if c in rows.columns],
        *[F.col(c).alias(f"_{c}") for c in order],
    )
    ranked = [f"_{c}" for c in order]
    if unique_identifier:
        picked = keep_last(picked, spec.key, ranked, carry_order=True)
    return conform(keep_first(picked, spec.dedupe_key, ranked), spec.types)


def publications(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Flat work columns, the first row per doi."""
    spec = catalogue.TABLES["publications"]
    picked = project_available(rows, [*spec.columns, *order])
    lineage = "oa_primary_location_source_host_org_lineage_names"
    if lineage in picked.columns and not isinstance(picked.schema[lineage].dataType, StringType):
        picked = picked.withColumn(lineage, json_text(F.col(lineage)))
    return conform(keep_first(picked, spec.dedupe_key, order), spec.types)


def publication_authorships(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return _first(ex.authorships(rows, order), "publication_authorships", [*order, "a_pos"])


def authors(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return _first(ex.authors(rows, order), "authors", [*order, "a_pos"])


def authorship_institutions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    found = ex.authorship_institutions(rows, order)
    return _first(found, "authorship_institutions", [*order, "a_pos", "i_pos"])


def institutions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return _first(ex.institutions(rows, order), "institutions", [*order, "a_pos", "i_pos"])


def authorship_countries(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return ex.authorship_countries(rows).distinct()


def publication_funding(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return ex.funding(rows).distinct()


def funders(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return _first(ex.funders(rows, order), "funders", [*order, "g_pos"])


def publication_citation_counts(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    found = ex.citation_counts(rows, order)
    return _first(found, "publication_citation_counts", [*order, "c_pos"])


BUILDERS = {
    "raw_scopus_search": raw_search,
    "publications": publications,
    "authors": authors,
    "institutions": institutions,
    "funders": funders,
    "publication_authorships": publication_authorships,
    "authorship_institutions": authorship_institutions,
    "authorship_countries": authorship_countries,
    "publication_funding": publication_funding,
    "publication_citation_counts": publication_citation_counts,
}
#: The tables made of authorships.
OF_AUTHORSHIPS = ("authors", "institutions", "publication_authorships", "authorship_institutions", "authorship_countries")


def normalize(enriched: DataFrame, order: Sequence[str]) -> dict[str, DataFrame]:
    """The ten tables of ``enriched``.

    ``order`` names the columns that rank the input rows totally; the positions
    inside the list cells are appended where a table comes out of a list.
    """
    rows = typed_rows(enriched)
    tables = {name: build(rows, order) for name, build in BUILDERS.items()}
    # search rows fit for loading: unique by the identifier too
    return {**tables, "raw_scopus_search": raw_search(rows, order, unique_identifier=True)}


def _staged(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` stored and read back. Zstandard, as stages are the larger part of the disk."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stage_authorships(rows: DataFrame, order: Sequence[str], path: str) -> DataFrame:
    """Every authorship stored at ``path``, for all tables of ``OF_AUTHORSHIPS``: each cell is parsed once."""
    return _staged(ex.all_authorships(rows, order), path)


def write_normalized(enriched: DataFrame, order: Sequence[str], root: str, staging: str | None = None,
                     rows_per_part: int | None = None, format: str = "parquet", jobs: int = 4,
                     rejects: str | None = None) -> dict[str, str]:
    """Write all ten tables below ``root``, ``jobs`` of them at a time.

    With ``staging`` the parsed rows are written there once as Parquet and every
    table reads back only the columns it needs; the authorships, of which five tables are
    made, are exploded once beside them. Without it each table parses its own cells. With ``rows_per_part`` a table comes in parts of exactly that
    many rows, and an empty table is left out. With ``rejects`` the list cells that
    cannot be used are written there, with the order columns and the reason.
    """
    spark = enriched.sparkSession
    cells, named = _text_cells(enriched), list(dict.fromkeys(["doi", *order]))
    if rejects and cells and not staging:
        save(rejected_cells(enriched.filter(F.col("doi").isNotNull()), cells, named), rejects)
    rows = typed_rows(enriched)
    if staging:
        # what is wrong with a cell is found where it is parsed, and stored beside the result
        stored = _staged(judged_rows(enriched) if rejects and cells else rows, staging)
        if rejects and cells:
            found = stored.select(*named, F.explode(_JUDGED).alias("r"))
            save(found.select(*named, "r.*"), rejects)
        rows = spark.read.schema(rows.schema).parquet(staging)
    sources = dict.fromkeys(BUILDERS, rows)
    if staging and "oa_authorships" in rows.columns:
        sources |= dict.fromkeys(OF_AUTHORSHIPS, stage_authorships(rows, order, f"{staging}-authorships"))

    def write(name: str) -> tuple[str, str]:
        spec, path = catalogue.TABLES[name], f"{root}/{name}"
        table = BUILDERS[name](sources[name], order)
        if rows_per_part:
            write_table_parts(table, path, spec.columns, spec.dedupe_key, rows_per_part, format)
        else:
            save(table, path, format)
        return name, path

    with shuffles_freed(spark), ThreadPoolExecutor(jobs) as pool:
        tasks = [pool.submit(inheritable_thread_target(spark)(write), name) for name in BUILDERS]
        return dict(task.result() for task in tasks)
