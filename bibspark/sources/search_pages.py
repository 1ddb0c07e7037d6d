"""Landed pages of search responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark import catalogue
from bibspark.functions.coerce import to_boolean, to_date, to_double
from bibspark.functions.dates import publication_month, publication_year
from bibspark.operators.frames import clean_columns, ensure_columns, flatten_structs
from bibspark.session import fresh_path


def entries(pages: DataFrame, body: str = "body", entry_type: str = catalogue.SEARCH_ENTRY_TYPE) -> DataFrame:
    """One row per entry of a response page; a page without entries has none.

    ``entry`` holds the fields of ``entry_type``, ``entry_json`` all that the page says.
    """
    found = F.try_variant_get(
        F.try_parse_json(F.col(body)), "$['search-results'].entry", "array<variant>"
    )
    others = [c for c in pages.columns if c != body]
    return (
        pages.select(*others, F.posexplode_outer(found).alias("entry_pos", "_entry"))
        .select(*others, "entry_pos", F.try_variant_get("_entry", "$", entry_type).alias("entry"),
                F.to_json("_entry").alias("entry_json"))
        .filter(F.col("entry").isNotNull())
    )


def search_records(pages: DataFrame, body: str = "body", entry_type: str = catalogue.SEARCH_ENTRY_TYPE) -> DataFrame:
    """Entries as cleaned, typed search rows with publication year and month."""
    rows = entries(pages, body, entry_type).select("*", "entry.*").drop("entry")
    flat = flatten_structs(rows)
    return type_search_records(clean_columns(flat))


def type_search_records(df: DataFrame) -> DataFrame:
    """Expected columns present, citations numeric, cover date a date, the full-access
    mark a truth value, and the publication year and month with their stand-ins."""
    full = ensure_columns(df, catalogue.SEARCH_FIELDS)
    day = to_date(F.col("prism_coverdate").cast("string"))
    marks = {"fa": to_boolean(F.col("fa").cast("string"))} if "fa" in full.columns else {}
    return full.withColumns({
        **marks,
        "citedby_count": to_double(F.col("citedby_count").cast("string")),
        "prism_coverdate": day,
        "publication_year": publication_year(day),
        "publication_month": publication_month(day),
    })


def next_links(pages: DataFrame, body: str = "body") -> DataFrame:
    """The address of the page that follows each page; NULL on the last."""
    links = F.try_variant_get(
        F.try_parse_json(F.col(body)), "$['search-results'].link", catalogue.SEARCH_LINK_TYPE
    )
    following = F.filter(links, lambda l: l["@ref"] == "next")
    others = [c for c in pages.columns if c != body]
    return pages.select(*others, F.get(following, F.lit(0))["@href"].alias("next_url"))


def missing_pages(links: DataFrame, url: str = "url") -> DataFrame:
    """Pages that a landed page points to and that were not landed."""
    wanted = links.select(F.col("next_url").alias(url)).dropna()
    return wanted.join(links.select(url), url, "left_anti")


def page_chains(links: DataFrame, url: str = "url") -> DataFrame:
    """Where each landed page stands in its chain: (url, start, position, state).

    A chain begins with a page that no other points to; ``position`` counts from 0 there.
    ``state`` is ``first``, ``linked``, or ``loop`` for a page that no first page leads
    to, whose ``start`` and ``position`` are NULL. Where several pages point to one, the
    least of them precedes it. ``links`` holds one row per page, or equal ones.

    By pointer doubling: each page knows a page 1, 2, 4, ... steps before it, and takes
    over that one's knowledge in one join a round, so a chain of n pages takes log2(n)
    rounds. Each round is a table in the shared folder; nothing is gathered in one task.
    """
    pages = links.select(F.col(url).alias("url"), F.col("next_url").alias("next")).filter(F.col("url").isNotNull())
    before = pages.filter(F.col("next").isNotNull()).groupBy(F.col("next").alias("url")).agg(F.min("url").alias("ahead"))
    known = pages.select("url").distinct().join(before, "url", "left")
    # ``ahead`` is NULL once ``start`` is known: ``steps`` lie between the page and ``reached``
    known = known.select(
        "url", F.coalesce("ahead", "url").alias("reached"), F.col("ahead").isNotNull().cast("bigint").alias("steps"),
        F.col("ahead").isNull().alias("done"))
    known = _stored(known, "chains")
    for _ in range(max(1, known.count()).bit_length()):
        if known.filter("not done").isEmpty():
            break
        there = known.select(F.col("url").alias("reached"), F.col("reached").alias("_far"), F.col("steps").alias("_more"),
                             F.col("done").alias("_done"))
        known = _stored(known.join(there, "reached", "left").select(
            "url", F.when(F.col("done"), F.col("reached")).otherwise(F.col("_far")).alias("reached"),
            F.when(F.col("done"), F.col("steps")).otherwise(F.col("steps") + F.col("_more")).alias("steps"),
            (F.col("done") | F.col("_done")).alias("done")), "chains")
    state = F.when(~F.col("done"), F.lit("loop")).when(F.col("steps") == 0, F.lit("first")).otherwise(F.lit("linked"))
    return known.select(
        "url", F.when(F.col("done"), F.col("reached")).alias("start"), F.when(F.col("done"), F.col("steps")).alias("position"),
        state.alias("state"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
