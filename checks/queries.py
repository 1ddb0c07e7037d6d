"""One registered query per operator, run over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark import catalogue
from bibspark.catalogue import TABLES
from bibspark.functions import cells, coerce, dates, status
from bibspark.functions.identifiers import format_doi
from bibspark.operators import explode, frames, keyed, quality, ranking, works
from bibspark.operators import dedupe
from bibspark.plans import enrich as enriching
from bibspark.plans import abstracts, load, normalize, search
from bibspark.session import fresh_path
from bibspark.sinks import files as sink
from bibspark.sinks import tables as stored
from bibspark.sources import files as source
from bibspark.sources import search_pages
from bibspark.streaming import incremental
from checks import feed
from checks.feed import LINE_ORDER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def shown(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that both engines render them alike."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("string").alias(f.name)
        if f.dataType.simpleString() in ("date", "timestamp_ntz") else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


search_rows = feed.prepared_rows


def latest_responses(spark, sf):
    return enriching.latest_responses(feed.responses(spark, sf), LINE_ORDER)


# --- sources ---------------------------------------------------------------

SEARCH_CSV = (
    "ingest_seq bigint, prism_doi string, note string, affiliation string,"
    " citedby_count string"
)


def _landed_csv(spark, sf):
    """Search rows as delimited files: quotes, line breaks, missing-value texts."""
    path = fresh_path(spark, "search-csv")
    feed.search_rows(spark, sf).selectExpr(
        "ingest_seq", "prism_doi",
        "'said \"' || subtypedescription || '\",\\nthen ' || ingest_seq as note",
        "case affiliation when 'P' then 'N/A' when 'O' then 'null' else affiliation end as affiliation",
        "cast(citedby_count as string) as citedby_count",
    ).write.options(header=True, quote='"', escape='"').csv(path)
    return path


@query
def scan_csv(spark, sf):
    return source.scan_search_csv(spark, _landed_csv(spark, sf), SEARCH_CSV)


@query
def scan_pruned_keys(spark, sf):
    path = fresh_path(spark, "enriched")
    search_rows(spark, sf).write.parquet(path)
    return source.processed_keys(spark, path)


@query
def union_parts(spark, sf):
    rows = search_rows(spark, sf).select("ingest_seq", "doi", "citedby_count")
    old, new = fresh_path(spark, "part"), fresh_path(spark, "part")
    rows.filter("citedby_count < 250").drop("citedby_count").write.parquet(old)
    rows.filter("citedby_count >= 250").write.parquet(new)
    return source.scan_parts(spark, [old, new])


@query
def union_csv_parts(spark, sf):
    """Delimited parts of three headers; what no one declared is kept as text."""
    rows = search_rows(spark, sf).select("ingest_seq", "doi", "citedby_count", "affiliation")
    paths = []
    for state, columns in (("F", ["ingest_seq", "doi"]), ("O", ["citedby_count", "ingest_seq"]),
                           ("P", ["affiliation", "doi", "ingest_seq"])):
        paths.append(fresh_path(spark, "part"))
        rows.filter(F.col("affiliation") == state).select(*columns).write.options(header=True, escape='"').csv(paths[-1])
    return source.scan_csv_parts(spark, paths, "ingest_seq bigint, doi string", rescued="rest")


@query
def csv_rejects(spark, sf):
    """Records of two, three and four values below a header of three; notes hold line breaks."""
    path = fresh_path(spark, "records")
    note = "'\"note, of\n' || o_orderkey || '\"'"
    table(spark, sf, "orders").selectExpr(f"""
      case o_orderkey % 3 when 0 then o_orderkey || ',' || {note} when 1 then o_orderkey || ',' || {note} || ',x'
        else o_orderkey || ',' || {note} || ',y,z' end as value""").write.text(path)
    head = fresh_path(spark, "records")
    # the header is the first line of each file, so the records are read and written below one
    lines = spark.read.option("lineSep", "\u0001").text(path)
    lines.select(F.concat(F.lit("k,note,mark\n"), F.col("value")).alias("value")).write.option("lineSep", "\u0001").text(head)
    return source.csv_rejects(spark, head).filter("record <> '\u0001'").select("record", "reason")


@query
def null_tokens(spark, sf):
    texts = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case o_orderpriority when '1-URGENT' then 'NA' when '2-HIGH' then ''"
        " when '3-MEDIUM' then '-1.#IND' else o_orderpriority end as a",
        "case o_orderstatus when 'F' then 'NaN' when 'O' then 'nAn' else 'n/a ' end as b",
    )
    return frames.null_tokens(texts)


@query
def explode_entries(spark, sf):
    found = search_pages.entries(feed.search_pages(spark, sf))
    return found.select(
        "page_no", "entry_pos", F.col("entry.`dc:identifier`").alias("dc_identifier"),
        F.col("entry.`prism:doi`").alias("prism_doi"),
        F.col("entry.`citedby-count`").alias("citedby_count"),
    )


@query
def search_feed_records(spark, sf):
    return shown(search_pages.search_records(feed.search_pages(spark, sf)).drop("url", "entry_json"))


@query
def next_link(spark, sf):
    return search_pages.next_links(feed.search_pages(spark, sf))


@query
def missing_pages(spark, sf):
    return search_pages.missing_pages(search_pages.next_links(feed.search_pages(spark, sf)))


@query
def page_chain(spark, sf):
    """The landed pages with one link cut, a ring of five pages, and a page that is pointed to from nowhere."""
    links = search_pages.next_links(feed.search_pages(spark, sf)).selectExpr(
        "url", "if(page_no = 7, null, next_url) as next_url")
    ring = table(spark, sf, "region").selectExpr(
        "'ring/' || r_regionkey as url", "'ring/' || ((r_regionkey + 1) % 5) as next_url")
    alone = table(spark, sf, "region").filter("r_regionkey = 0").selectExpr("'alone' as url", "cast(null as string) as next_url")
    return search_pages.page_chains(links.unionByName(ring).unionByName(alone))


@query
def backfill_month(spark, sf):
    rows = feed.search_rows(spark, sf).selectExpr(
        "ingest_seq",
        "case affiliation when 'P' then 'n.d.' else cast(prism_coverdate as string) end as prism_coverdate",
    )
    return shown(source.backfill_month(rows))


# --- sinks -----------------------------------------------------------------


@query
def sink_append(spark, sf):
    path = fresh_path(spark, "append")
    rows = search_rows(spark, sf)
    columns = ["ingest_seq", "doi", "citedby_count"]
    sink.append_batch(rows.filter("affiliation = 'F'"), path, columns)
    sink.append_batch(rows.filter("affiliation <> 'F'"), path, columns)
    return spark.read.parquet(path)


@query
def sink_append_csv(spark, sf):
    path = fresh_path(spark, "append-csv")
    rows = feed.responses(spark, sf).select(
        *LINE_ORDER, F.array(F.struct("doi", "http_status")).alias("cells"))
    sink.append_batch(rows, path, [*LINE_ORDER, "cells"], format="csv")
    back = source.scan_csv(
        spark, path, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint,"
        " l_extendedprice double, cells string")
    cell = cells.parse_list(F.col("cells"), "array<struct<doi: string, http_status: int>>")
    return back.withColumn("cell", cell[0]).select(*LINE_ORDER, "cell.doi", "cell.http_status")


YEAR_COLUMNS = ["dc_identifier", "ingest_seq", "citedby_count", "publication_year"]


@query
def sink_overwrite_year(spark, sf):
    """All years written, then one of them rewritten from its newest rows."""
    path = fresh_path(spark, "years")
    rows = feed.search_rows(spark, sf).select(*YEAR_COLUMNS)
    sink.overwrite_years(rows, path)
    newest = dedupe.keep_last(
        rows.filter("publication_year = 1997"), ["dc_identifier"], ["ingest_seq"], carry_order=True)
    sink.overwrite_years(newest.select(*YEAR_COLUMNS), path)
    return spark.read.parquet(path).select(*YEAR_COLUMNS)


@query
def split_part_ids(spark, sf):
    return ranking.with_part_id(table(spark, sf, "lineitem").select(*LINE_ORDER), LINE_ORDER)


def _authorships(spark, sf):
    rows = normalize.typed_rows(
        feed.authorship_cells(spark, sf), {"oa_authorships": catalogue.AUTHORSHIP_LINKS_TYPE})
    return normalize.publication_authorships(rows, LINE_ORDER)


@query
def sink_table_parts(spark, sf):
    path = fresh_path(spark, "parts")
    spec = TABLES["publication_authorships"]
    sink.write_table_parts(_authorships(spark, sf), path, spec.columns, spec.key)
    return spark.read.parquet(path).select(*spec.key, F.col("part_id").cast("bigint").alias("part_id"))


@query
def split_verify_counts(spark, sf):
    path = fresh_path(spark, "split")
    lines = table(spark, sf, "lineitem").select(*LINE_ORDER)
    sink.write_parts(lines, path, LINE_ORDER)
    return sink.verify_parts(lines, sink.part_counts(spark, path))


def _digest(df, name):
    """Rows of a table, and a sum over them that tells their contents, columns by name."""
    cells_ = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns) if c not in LINE_ORDER]
    part = F.conv(F.substring(F.md5(F.concat_ws("|", *cells_).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(part), F.lit(0)).alias("digest")).select(
        F.lit(name).alias("table_name"), "n_rows", "digest")


@query
def sink_fanout(spark, sf):
    rejects = fresh_path(spark, "rejects")
    paths = normalize.write_normalized(
        feed.enriched_rows(spark, sf), LINE_ORDER, fresh_path(spark, "normalized"),
        staging=fresh_path(spark, "typed"), rejects=rejects)
    frames = {n: spark.read.parquet(p) for n, p in {**paths, "rejects": rejects}.items()}
    return reduce(DataFrame.unionByName, [_digest(shown(df), n) for n, df in frames.items()])


TARGET = ["dc_identifier", "citedby_count", "affiliation"]


def _upsert_sides(spark, sf):
    rows = feed.search_rows(spark, sf).select(*TARGET, "ingest_seq")
    older = dedupe.keep_last(rows.filter("affiliation <> 'F'"), ["dc_identifier"], ["ingest_seq"])
    newer = dedupe.keep_last(rows.filter("affiliation = 'F'"), ["dc_identifier"], ["ingest_seq"])
    return older, newer


@query
def upsert_update(spark, sf):
    return keyed.upsert(*_upsert_sides(spark, sf), ["dc_identifier"])


@query
def upsert_do_nothing(spark, sf):
    older, newer = (side.select("dc_identifier") for side in _upsert_sides(spark, sf))
    return keyed.upsert(older, newer, ["dc_identifier"])


@query
def upsert_null_keys(spark, sf):
    """Funding rows in two loads; the award is part of the key and may be NULL."""
    rows = normalize.typed_rows(feed.grant_cells(spark, sf))
    first = normalize.publication_funding(rows.filter("l_linenumber <= 3"), LINE_ORDER)
    second = normalize.publication_funding(rows.filter("l_linenumber > 2"), LINE_ORDER)
    return keyed.upsert(first, second, TABLES["publication_funding"].key)


@query
def load_tables(spark, sf):
    """Two loads of the search table through published snapshots."""
    spec = TABLES["raw_scopus_search"]
    root = fresh_path(spark, "loaded")
    rows = search_rows(spark, sf)
    for batch in (rows.filter("affiliation <> 'F'"), rows.filter("affiliation = 'F'")):
        load.load_all({spec.name: batch}, root, {spec.name: ["ingest_seq"]})
    return shown(stored.read_current(spark, f"{root}/{spec.name}", spec))


@query
def load_counts(spark, sf):
    """A first load of rows of which some miss their key and many repeat it."""
    spec = TABLES["raw_scopus_search"]
    root = fresh_path(spark, "loaded")
    rows = search_rows(spark, sf).withColumn("dc_identifier", F.expr("if(ingest_seq % 5 = 0, null, dc_identifier)"))
    load.load_all({spec.name: rows}, root, {spec.name: ["ingest_seq"]})
    return load.load_counts(rows, f"{root}/{spec.name}", spec)


@query
def load_unknown_year(spark, sf):
    """Rows whose year is unknown get its stand-in when they are loaded."""
    spec = TABLES["raw_scopus_search"]
    root = fresh_path(spark, "loaded")
    rows = search_rows(spark, sf).withColumn("publication_year", F.expr("if(affiliation = 'P', null, publication_year)"))
    stored.load_table(rows, root, spec, ["ingest_seq"])
    return stored.read_current(spark, root, spec).select("dc_identifier", "publication_year")


@query
def parts_rewritten(spark, sf):
    """Parts of all customers, then of the few of one segment to the same place."""
    path = fresh_path(spark, "rewritten")
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    sink.write_parts(rows, path, ["c_custkey"], rows_per_part=100)
    sink.write_parts(rows.filter("c_mktsegment = 'BUILDING'"), path, ["c_custkey"], rows_per_part=100)
    return spark.read.parquet(path).select("c_custkey", "c_mktsegment", F.col("part_id").cast("bigint").alias("part_id"))


@query
def load_null_keys(spark, sf):
    """Rows without their key are set aside by a load, not merged."""
    spec = TABLES["raw_scopus_search"]
    root, rejects = fresh_path(spark, "loaded"), fresh_path(spark, "rejects")
    rows = search_rows(spark, sf).withColumn("dc_identifier", F.expr("if(ingest_seq % 5 = 0, null, dc_identifier)"))
    stored.load_table(rows, root, spec, ["ingest_seq"], rejects)
    loaded = stored.read_current(spark, root, spec).select(F.lit("loaded").alias("place"), "prism_url")
    return loaded.unionByName(spark.read.parquet(rejects).select(F.lit("rejected").alias("place"), "prism_url"))


@query
def stream_two_sources(spark, sf):
    """Two landing folders with their own checkpoints into one target, the second run twice."""
    target = fresh_path(spark, "enriched")
    rows = search_rows(spark, sf).select("ingest_seq", "prism_doi", "doi", "affiliation")
    kept = fresh_path(spark, "responses")
    latest_responses(spark, sf).write.parquet(kept)
    for part in ("affiliation <> 'F'", "affiliation = 'F'"):
        landing, log = fresh_path(spark, "landing"), fresh_path(spark, "log")
        rows.filter(part).write.parquet(landing)
        for _ in range(2):
            incremental.enrich_stream(
                spark, landing, rows.schema, spark.read.parquet(kept), target, log).awaitTermination()
    return incremental.enriched_so_far(spark, target).select("ingest_seq", "doi", "oa_status")


# --- projections and filters -----------------------------------------------


def _nested(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id",
        "named_struct('@id', user_id, 'dc:kind', event_type, 'geo',"
        " named_struct('value-x', value, 'props', props)) as `rec:head`",
    )


@query
def flatten_struct(spark, sf):
    return frames.flatten_structs(_nested(spark, sf))


@query
def clean_columns(spark, sf):
    return frames.clean_columns(frames.flatten_structs(_nested(spark, sf)))


@query
def ensure_columns(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "'SID:' || o_custkey as dc_identifier")
    return frames.ensure_columns(rows, catalogue.SEARCH_FIELDS)


@query
def project_schema(spark, sf):
    return shown(frames.project(search_rows(spark, sf), TABLES["raw_scopus_search"].columns))


def _lineage_as_list(df):
    """JSON text is compared by what it holds."""
    lineage = "oa_primary_location_source_host_org_lineage_names"
    names = cells.parse_list(F.col(lineage), "array<string>")
    return df.withColumn(lineage, F.array_join(names, "|"))


@query
def flatten_work(spark, sf):
    flat = works.flatten_work(feed.works(spark, sf)).drop("oa_authorships", "oa_grants")
    counts = F.element_at("oa_counts_by_year", 1)
    return shown(_lineage_as_list(
        flat.withColumn("n_counted", counts["cited_by_count"]).drop("oa_counts_by_year")))


@query
def enriched_layout(spark, sf):
    flat = works.flatten_work(feed.works(spark, sf)).selectExpr(
        *LINE_ORDER, "doi as prism_doi", "doi", "oa_id", "oa_title", "'Success' as oa_status")
    return flat.select(*frames.enriched_layout([*LINE_ORDER, "prism_doi"], ["oa_id", "oa_title"]))


@query
def project_abstract(spark, sf):
    flat = works.project_abstract(feed.abstracts(spark, sf))
    named = frames.clean_columns(flat)
    return named.select(
        *[c for c in named.columns if c not in ("affiliations", "authors")],
        F.size("affiliations").alias("n_affiliations"),
        F.get("affiliations", F.lit(0))["name"].alias("first_affiliation"),
        F.get("affiliations", F.lit(0))["city"].alias("first_city"),
        F.get("affiliations", F.lit(0))["country"].alias("first_country"),
        F.size("authors").alias("n_authors"),
        F.get("authors", F.lit(0))["name"].alias("first_author"),
        F.get("authors", F.lit(0))["affiliation"].alias("first_author_affiliation"),
        F.get("authors", F.lit(1))["affiliation"].alias("second_author_affiliation"),
    )


@query
def filter_valid_keys(spark, sf):
    return search_rows(spark, sf).filter(F.col("doi").isNotNull()).select("ingest_seq", "doi")


@query
def filter_element_ids(spark, sf):
    rows = normalize.typed_rows(feed.authorship_cells(spark, sf))
    found = explode.authorship_rows(rows, LINE_ORDER, {})
    return found.select(*LINE_ORDER, "a_pos", F.col("oa_author_id").alias("author_id"))


def _search_records(spark, sf):
    return feed.search_rows(spark, sf).select(
        "ingest_seq", "dc_identifier", "affiliation", "prism_coverdate", "subtypedescription",
        "publication_year", "citedby_count")


@query
def search_slice(spark, sf):
    found = search.select_slice(_search_records(spark, sf), "F", 1997, "1-URGENT")
    return shown(found)


@query
def array_compact(spark, sf):
    items = table(spark, sf, "orders").selectExpr("o_orderkey", """
      case o_orderstatus
        when 'F' then concat('["', o_orderpriority, '", null, "", 0, false, {}, "', o_custkey, '"]')
        when 'O' then concat('{"a": "', o_orderpriority, '", "b": null, "c": "", "d": 0.0, "e": []}')
        else o_orderpriority end as item""")
    kept = items.withColumn("kept", cells.compact_item(F.col("item")))
    return kept.select("o_orderkey", F.size("kept").alias("n_kept"),
                       F.array_join("kept", "|").alias("kept_text"))


# --- joins -----------------------------------------------------------------


@query
def resume_anti_join(spark, sf):
    rows = search_rows(spark, sf).select("ingest_seq", "doi", "affiliation")
    done = rows.filter("affiliation = 'F'").select("doi")
    return enriching.unprocessed(rows, done).select("ingest_seq", "doi")


@query
def enrich_left_join(spark, sf):
    rows = search_rows(spark, sf).select("ingest_seq", "prism_doi", "doi")
    full = enriching.enrich(rows, latest_responses(spark, sf))
    return shown(full.select(
        "ingest_seq", "doi", "oa_status", "oa_id", "oa_title", "oa_cited_by_count", "oa_fwci",
        "oa_publication_date", "oa_biblio_volume",
        F.get("oa_authorships", F.lit(0))["author"]["id"].alias("first_author_id")))


@query
def enrich_status(spark, sf):
    return feed.responses(spark, sf).select(
        *LINE_ORDER,
        status.lookup_status(F.col("http_status"), F.col("error_kind"), F.col("error_message"),
                             F.col("body")).alias("oa_status"))


@query
def exclude_existing(spark, sf):
    new = search_pages.search_records(feed.search_pages(spark, sf))
    existing = table(spark, sf, "events").filter("value > 250").selectExpr(
        "'EID:' || user_id || '-' || event_type as dc_identifier")
    left = keyed.not_in(new, existing, "dc_identifier")
    return left.select("page_no", "entry_pos", "dc_identifier")


@query
def star_join_read(spark, sf):
    cells_ = normalize.typed_rows(feed.authorship_cells(spark, sf))
    rows = normalize.stage_authorships(cells_, LINE_ORDER, fresh_path(spark, "authorships"))
    stored_as = {}
    for name in ("authorship_institutions", "authors", "institutions"):
        path = fresh_path(spark, name)
        normalize.BUILDERS[name](rows, LINE_ORDER).write.parquet(path)
        stored_as[name] = spark.read.parquet(path)
    links = stored_as["authorship_institutions"]
    named = keyed.join_unique(links, stored_as["authors"], ["oa_author_id"], "inner")
    full = keyed.join_unique(named, stored_as["institutions"], ["oa_institution_id"], "inner")
    return full.select("doi", "oa_author_id", "oa_author_name", "oa_institution_id",
                       "oa_institution_name", "oa_institution_country_code")


# --- nested normalization --------------------------------------------------


@query
def parse_json_cell(spark, sf):
    parsed = cells.parse_list(F.col("oa_authorships"), catalogue.AUTHORSHIPS_TYPE)
    rows = feed.authorship_cells(spark, sf).withColumn("parsed", parsed)
    ids = F.transform("parsed", lambda a: F.coalesce(a["author"]["id"], F.lit("-")))
    return rows.select(*LINE_ORDER, F.coalesce(F.array_size("parsed"), F.lit(0)).alias("n_elements"),
                       F.array_join(ids, "|").alias("author_ids"))


@query
def parse_quoted_cell(spark, sf):
    rows = feed.grant_cells(spark, sf)
    parsed = cells.parse_list(F.col("oa_grants"), catalogue.GRANTS_TYPE)
    first = F.get(parsed, F.lit(0))
    return rows.select(*LINE_ORDER, F.size(parsed).alias("n_elements"),
                       first["funder"].alias("funder"), first["award_id"].alias("award_id"))


@query
def norm_authorships(spark, sf):
    return _authorships(spark, sf)


def _norm(name, cells_of):
    def run(spark, sf):
        rows = normalize.typed_rows(cells_of(spark, sf))
        return normalize.BUILDERS[name](rows, LINE_ORDER)
    return run


QUERIES["norm_authors"] = _norm("authors", feed.authorship_cells)
QUERIES["norm_authorship_institutions"] = _norm("authorship_institutions", feed.authorship_cells)
QUERIES["norm_institutions"] = _norm("institutions", feed.authorship_cells)
QUERIES["norm_authorship_countries"] = _norm("authorship_countries", feed.authorship_cells)
QUERIES["norm_funding"] = _norm("publication_funding", feed.grant_cells)
QUERIES["norm_funders"] = _norm("funders", feed.grant_cells)
QUERIES["norm_citation_counts"] = _norm("publication_citation_counts", feed.count_cells)


@query
def norm_publications(spark, sf):
    flat = works.flatten_work(feed.works(spark, sf)).withColumn("oa_status", F.lit(status.SUCCESS))
    full = normalize.publications(normalize.typed_rows(flat), LINE_ORDER)
    return shown(_lineage_as_list(full))


@query
def norm_raw_search(spark, sf):
    rows = normalize.typed_rows(search_rows(spark, sf))
    return shown(normalize.raw_search(rows, ["ingest_seq"]))


@query
def norm_raw_search_keyed(spark, sf):
    rows = normalize.typed_rows(search_rows(spark, sf))
    return shown(normalize.raw_search(rows, ["ingest_seq"], unique_identifier=True))


@query
def join_affiliations(spark, sf):
    rows = explode.affiliations(normalize.typed_rows(feed.authorship_cells(spark, sf)), LINE_ORDER)
    return rows.select(*LINE_ORDER, "a_pos", F.col("oa_raw_affiliation_string").alias("affiliations"))


@query
def json_round_trip(spark, sf):
    """Nested cells to JSON text and back, then read field by field."""
    nested = feed.table(spark, sf, "lineitem").select(*LINE_ORDER, F.array(F.struct(
        F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("part"),
        F.col("l_tax").alias("tax"), F.col("l_linestatus").alias("state"))).alias("cell"))
    text = frames.nested_to_json(nested)
    back = F.try_variant_get(
        F.try_parse_json("cell"), "$", "array<struct<part: bigint, tax: double, state: string>>")[0]
    return text.select(*LINE_ORDER, back["part"].alias("part"), back["tax"].alias("tax"),
                       back["state"].alias("state"), F.contains("cell", F.lit("null")).alias("has_null"))


# --- distinct, de-duplication, counts --------------------------------------


def _keyed_events(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "if(event_type = 'error', null, user_id) as user_id", "event_type", "event_id", "value", "props")


@query
def dedupe_keep_first(spark, sf):
    return dedupe.keep_first(_keyed_events(spark, sf), ["user_id", "event_type"], ["event_id"], carry_order=True)


@query
def dedupe_keep_last(spark, sf):
    return dedupe.keep_last(_keyed_events(spark, sf), ["user_id", "event_type"], ["event_id"], carry_order=True)


@query
def distinct_keys(spark, sf):
    return dedupe.distinct_values(search_rows(spark, sf), "doi")


@query
def dedupe_report(spark, sf):
    return dedupe.dedupe_counts(_keyed_events(spark, sf), ["user_id", "event_type"])


@query
def table_counts(spark, sf):
    return quality.row_counts({n: table(spark, sf, n) for n in ("orders", "lineitem", "events", "documents")})


@query
def key_quality_counts(spark, sf):
    return quality.key_counts(search_rows(spark, sf))


@query
def any_null_profile(spark, sf):
    return quality.null_profile(search_rows(spark, sf))


# --- sort, limit, set operations -------------------------------------------


@query
def search_sorted(spark, sf):
    found = search.select_slice(_search_records(spark, sf), "F", 1997, "1-URGENT")
    numbered = ranking.with_row_number(found, search.by_citations(["dc_identifier", "ingest_seq"]), "place")
    return numbered.select("place", "dc_identifier", "ingest_seq", "citedby_count")


@query
def page_slice(spark, sf):
    return search.search(_search_records(spark, sf), "O", 1998, "2-HIGH", start=25,
                         tie_break=["dc_identifier", "ingest_seq"]
                         ).select("ingest_seq", "dc_identifier", "citedby_count")


@query
def page_slice_deep(spark, sf):
    """A page far inside the order."""
    return ranking.page_slice(
        table(spark, sf, "lineitem").select(*LINE_ORDER), [F.col(c) for c in LINE_ORDER], start=5500)


@query
def top_n_per_type(spark, sf):
    """The most cited thousand of every year and document type would be all of a
    small table, so ten are taken here."""
    best = search.capped_results(_search_records(spark, sf), 10, ["dc_identifier", "ingest_seq"])
    return best.select("publication_year", "subtypedescription", "ingest_seq", "citedby_count")


@query
def union_types(spark, sf):
    found = search.results_of_types(_search_records(spark, sf), ["1-URGENT", "3-MEDIUM"])
    return found.select("ingest_seq", "dc_identifier", "subtypedescription")


def _existing_and_new(spark, sf):
    rows = feed.search_rows(spark, sf).select(
        "ingest_seq", "dc_identifier", "citedby_count", "affiliation", "publication_year")
    return rows.filter("affiliation <> 'F'").drop("affiliation"), rows.filter("affiliation = 'F'")


@query
def union_existing_new(spark, sf):
    return frames.union_by_name(_existing_and_new(spark, sf))


# --- scalar functions ------------------------------------------------------


@query
def format_doi_values(spark, sf):
    rows = feed.search_rows(spark, sf)
    return rows.select("ingest_seq", format_doi(F.col("prism_doi")).alias("doi"))


QUERIES["format_doi"] = QUERIES.pop("format_doi_values")


def _texts(spark, sf):
    """Well and badly formed numbers, dates and truth values of every order."""
    return table(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey", "o_orderdate", """
      case o_orderkey % 8
        when 0 then cast(o_custkey as string) when 1 then o_custkey || '.7'
        when 2 then ' ' || o_custkey || ' ' when 3 then o_custkey || 'e1'
        when 4 then 'x' || o_custkey when 5 then o_custkey || 'd'
        when 6 then '-' || o_custkey when 7 then '1,' || o_custkey end as number_text""", """
      case o_orderkey % 6
        when 0 then date_format(o_orderdate, 'yyyy-MM-dd')
        when 1 then date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss")
        when 2 then date_format(o_orderdate, 'yyyy') when 3 then date_format(o_orderdate, 'dd/MM/yyyy')
        when 4 then date_format(o_orderdate, 'yyyy') || '-13-01' end as date_text""", """
      case o_orderkey % 9
        when 0 then 'T' when 1 then 'f' when 2 then '1' when 3 then '0' when 4 then 'TRUE'
        when 5 then 'False' when 6 then 'yes' when 7 then '1.0' end as truth_text""")


def _coerced(name, text, parse):
    def run(spark, sf):
        return shown(_texts(spark, sf).select("o_orderkey", parse(F.col(text)).alias("parsed")))
    QUERIES[name] = run


_coerced("coerce_double", "number_text", coerce.to_double)
_coerced("coerce_int", "number_text", coerce.to_int)
_coerced("coerce_date", "date_text", coerce.to_date)
_coerced("coerce_timestamp", "date_text", coerce.to_timestamp)
_coerced("coerce_boolean", "truth_text", coerce.to_boolean)
_coerced("pub_year", "date_text", lambda t: dates.year_at_load(dates.publication_year(coerce.to_date(t))))
_coerced("pub_month", "date_text", lambda t: dates.publication_month(coerce.to_date(t)))


@query
def nan_to_null(spark, sf):
    values = table(spark, sf, "lineitem").selectExpr(
        *LINE_ORDER, "if(l_tax = 0D, double('NaN'), l_tax) as tax")
    return values.withColumn("tax", coerce.nan_to_null(F.col("tax")))


@query
def coerce_table(spark, sf):
    loose = _texts(spark, sf).selectExpr(
        "o_orderkey", "number_text as oa_cited_by_count", "number_text as oa_fwci",
        "truth_text as oa_is_retracted", "date_text as oa_publication_date",
        "date_text as oa_updated_date", "number_text as oa_title")
    types = {**TABLES["publications"].types, "o_orderkey": "bigint"}
    kept = ["o_orderkey", "oa_cited_by_count", "oa_fwci", "oa_is_retracted", "oa_publication_date",
            "oa_updated_date", "oa_title", "oa_language"]
    return shown(frames.conform(loose, {c: types[c] for c in kept}))


@query
def abstract_refresh(spark, sf):
    """Abstracts of two runs of search rows; of each body an older, broken one has landed too."""
    root, rejects = fresh_path(spark, "abstracts"), fresh_path(spark, "rejects")
    rows = table(spark, sf, "documents").selectExpr("if(lang = 'es', null, '10.3000/D.' || doc_id) as prism_doi", "lang")
    whole = feed.abstracts(spark, sf).selectExpr("'10.3000/D.' || doc_id as prism_doi", "body", "1 as version")
    bodies = whole.unionByName(whole.selectExpr("prism_doi", "left(body, 40) as body", "0 as version"))
    for part in (rows.filter("lang <> 'de'"), rows):
        abstracts.refresh_abstracts(part, bodies, ["version"], root, rejects)
    return abstracts.read_abstracts(spark, root)


# --- incremental -----------------------------------------------------------


@query
def stream_incremental(spark, sf):
    """Two drops of search rows through the stream, one run each."""
    landing, target, log = (fresh_path(spark, n) for n in ("landing", "enriched", "log"))
    rows = search_rows(spark, sf).select("ingest_seq", "prism_doi", "doi", "affiliation")
    kept = fresh_path(spark, "responses")
    latest_responses(spark, sf).write.parquet(kept)
    for drop in ("affiliation <> 'F'", "affiliation = 'F'"):
        rows.filter(drop).write.mode("append").parquet(landing)
        incremental.enrich_stream(
            spark, landing, rows.schema, spark.read.parquet(kept), target, log,
        ).awaitTermination()
    return incremental.enriched_so_far(spark, target).select(
        "ingest_seq", "doi", "oa_status", "oa_id", "oa_cited_by_count")


@query
def incremental_refresh(spark, sf):
    """Stored years without their month, then all of them refreshed by newer results with more columns."""
    path = fresh_path(spark, "refreshed")
    existing, new = _existing_and_new(spark, sf)
    sink.overwrite_years(
        search.merge_results(existing.limit(0), existing, ["ingest_seq"], ["publication_year", "dc_identifier"]),
        path)
    search.refresh_years(spark, path, new, ["ingest_seq"])
    return spark.read.option("mergeSchema", "true").parquet(path).select(
        "ingest_seq", "dc_identifier", "citedby_count", "affiliation", "publication_year")


@query
def refresh_unknown_year(spark, sf):
    """A refresh with rows whose year is unknown, run twice."""
    path = fresh_path(spark, "refreshed")
    rows = feed.search_rows(spark, sf).select("ingest_seq", "dc_identifier", "citedby_count", "affiliation", "publication_year")
    rows = rows.withColumn("publication_year", F.expr("if(affiliation = 'P', null, publication_year)"))
    sink.overwrite_years(dedupe.keep_last(
        rows.filter("affiliation = 'O'"), ["publication_year", "dc_identifier"], ["ingest_seq"], carry_order=True), path)
    for _ in range(2):
        search.refresh_years(spark, path, rows.filter("affiliation <> 'O'"), ["ingest_seq"])
    return spark.read.parquet(path).select("ingest_seq", "dc_identifier", "citedby_count", "publication_year")


# --- data quality ----------------------------------------------------------


@query
def quarantine_rejects(spark, sf):
    _, rejected = quality.split_rejects(feed.authorship_cells(spark, sf), "oa_authorships")
    return rejected.select(*LINE_ORDER, "reject_reason")


@query
def schema_diff(spark, sf):
    return quality.schema_report(search_rows(spark, sf).drop("subtype"), TABLES["raw_scopus_search"])


@query
def pk_violations(spark, sf):
    spec = TABLES["raw_scopus_search"]
    picked = normalize.raw_search(normalize.typed_rows(search_rows(spark, sf)), ["ingest_seq"])
    return quality.key_violations(picked, spec.key)


@query
def pk_nulls(spark, sf):
    spec = TABLES["publication_funding"]
    rows = normalize.typed_rows(feed.grant_cells(spark, sf))
    return quality.key_nulls(normalize.publication_funding(rows, LINE_ORDER), spec.key)


@query
def too_long_texts(spark, sf):
    rows = search_rows(spark, sf).selectExpr("ingest_seq", "subtypedescription as oa_language")
    return quality.too_long(rows)
