"""Bibliographic inputs derived from the given tables.

The given tables hold no bibliographic data, so orders stand for search rows,
line items for works and looked-up responses, events for pages of search
responses and documents for abstracts. Every row of the source table yields
one row here, malformed shapes included.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.functions.identifiers import format_doi
from bibspark.session import fresh_path

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_LANDED: dict[tuple[str, str, str], str] = {}


def landed(build):
    """Write the derived input to the shared folder, once per session and table
    folder, and read it from there. For inputs of which many rows become one; an input
    that has a row for each source row is computed where it is read."""

    @wraps(build)
    def read(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf, build.__name__)
        if key not in _LANDED:
            path = fresh_path(spark, build.__name__)
            build(spark, sf).hint("rebalance").write.parquet(path)
            _LANDED[key] = path
        return spark.read.parquet(_LANDED[key])

    return read


LINES_PER_TASK = 400_000


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem")


def _dealt(lines: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Line items, joined to what their cells are made of, dealt out evenly before they grow:
    a cell of JSON is many times the size of its line, so the narrow rows move, and no cell
    is shuffled or stored."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-_lines(spark, sf).count() // LINES_PER_TASK))
    return lines.repartition(tasks, *LINE_ORDER)


# The shape of a raw DOI: four that are valid, two that are not, one missing.
RAW_DOI = """
case o_orderkey % 7
  when 0 then '10.1000/ORD.' || (o_orderkey div 2)
  when 1 then 'https://doi.org/10.1000/Ord.' || (o_orderkey div 2)
  when 2 then 'HTTP://DOI.ORG/10.1000/ord.' || (o_orderkey div 2)
  when 3 then '  10.1000/ord.' || (o_orderkey div 2) || '  '
  when 4 then 'https://dx.doi.org/10.1000/ord.' || (o_orderkey div 2)
  when 5 then 'ord-' || (o_orderkey div 2)
end"""


def search_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One search row per order; ``ingest_seq`` ranks them."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as ingest_seq",
        "'https://search.example/' || o_orderkey as prism_url",
        "'SID:' || o_custkey as dc_identifier",
        "'Journal ' || o_orderpriority as prism_publicationname",
        "cast(o_orderdate as date) as prism_coverdate",
        f"{RAW_DOI} as prism_doi",
        "cast(floor(o_totalprice / 1000) as int) as citedby_count",
        "o_orderstatus as affiliation",
        "lower(substr(o_orderpriority, 3, 2)) as subtype",
        "o_orderpriority as subtypedescription",
        "year(o_orderdate) as publication_year",
        "month(o_orderdate) as publication_month",
    )


def prepared_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Search rows with their canonical ``doi``, as the first stage leaves them."""
    rows = search_rows(spark, sf)
    return rows.withColumn("doi", format_doi(F.col("prism_doi")))


def works(spark: SparkSession, sf: str) -> DataFrame:
    """One work record as JSON text per line item."""
    body = """
    to_json(named_struct(
      'id', 'W' || l_orderkey,
      'doi', 'https://doi.org/10.1000/w' || l_orderkey,
      'title', 'Work ' || l_orderkey || '.' || l_linenumber,
      'display_name', 'Part ' || l_partkey,
      'publication_year', year(l_shipdate),
      'publication_date', date_format(l_shipdate, 'yyyy-MM-dd'),
      'language', lower(l_returnflag),
      'type', 'article',
      'cited_by_count', cast(l_quantity as int),
      'fwci', l_discount,
      'is_retracted', l_linestatus = 'F',
      'updated_date', date_format(l_shipdate, "yyyy-MM-dd'T'HH:mm:ss"),
      'created_date', date_format(l_shipdate, 'yyyy'),
      'primary_location', if(l_returnflag = 'R', null, named_struct(
        'is_oa', l_tax > 0.04D,
        'landing_page_url', 'https://pages.example/' || l_partkey,
        'source', if(l_linestatus = 'F', null, named_struct(
          'id', 'S' || l_suppkey, 'display_name', 'Source ' || l_suppkey,
          'issn_l', lpad(cast(l_suppkey as string), 8, '0'), 'is_oa', l_tax = 0D,
          'is_indexed_in_scopus', l_tax > 0D,
          'host_organization_name', 'Host ' || l_suppkey,
          'host_organization_lineage_names', array('Host ' || l_suppkey, 'Group'),
          'type', 'journal')))),
      'biblio', named_struct('volume', l_linenumber, 'issue', cast(l_linenumber as string),
        'first_page', cast(l_partkey as string), 'last_page', cast(null as string)),
      'primary_topic', named_struct('id', 'T' || l_linenumber,
        'display_name', 'Topic ' || l_linenumber, 'score', l_tax,
        'subfield', if(l_returnflag = 'A', null, named_struct('display_name', 'Sub ' || l_linenumber)),
        'field', named_struct('display_name', 'Field ' || l_linenumber),
        'domain', named_struct('display_name', 'Domain ' || l_linestatus)),
      'citation_normalized_percentile', named_struct('value', l_discount,
        'is_in_top_1_percent', l_discount > 0.09D, 'is_in_top_10_percent', l_discount > 0.05D),
      'cited_by_percentile_year', named_struct('min', l_linenumber, 'max', cast(l_quantity as int)),
      'counts_by_year', array(named_struct('year', year(l_shipdate), 'cited_by_count', l_linenumber))
    ))"""
    return _dealt(_lines(spark, sf), spark, sf).selectExpr(
        *LINE_ORDER,
        "if(l_returnflag = 'R' and l_linestatus = 'O', null,"
        " 'https://doi.org/10.1000/w' || l_orderkey) as doi",
        f"{body} as body",
    )


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """One landed lookup per line item, several for most keys."""
    body = """
    to_json(named_struct('id', 'W' || l_orderkey, 'title', 'Work ' || l_partkey,
      'cited_by_count', cast(l_quantity as int), 'fwci', l_discount,
      'publication_date', date_format(l_shipdate, 'yyyy-MM-dd'),
      'biblio', named_struct('volume', l_linenumber),
      'authorships', array(named_struct('author', named_struct('id', 'S' || l_suppkey)))))"""
    return _dealt(_lines(spark, sf), spark, sf).selectExpr(
        *LINE_ORDER,
        "'https://doi.org/10.1000/ord.' || (l_orderkey div 2) as doi",
        "case when l_returnflag <> 'R' then 200 when l_linenumber = 1 then 404"
        " when l_linenumber = 2 then 429 when l_linenumber = 3 then 503"
        " when l_linenumber < 6 then null else 200 end as http_status",
        "case when l_returnflag <> 'R' then null when l_linenumber = 2 then 'rate_limit'"
        " when l_linenumber = 4 then 'network' when l_linenumber = 5 then 'other' end as error_kind",
        "case when l_returnflag = 'R' then 'line ' || l_linenumber end as error_message",
        f"case when l_returnflag <> 'R' then {body} when l_linenumber >= 6 then '{{}}' end as body",
    )


def _enriched(lines: DataFrame, *cells: str) -> DataFrame:
    return lines.selectExpr(
        *LINE_ORDER,
        "if(l_returnflag = 'R' and l_linestatus = 'O', null,"
        " 'https://doi.org/10.1000/w' || l_orderkey) as doi",
        *cells,
    )


AUTHORSHIPS = """
case
  when l_discount = 0.1D then 'not json'
  when l_discount = 0.09D then '{"author": {"id": "X"}}'
  when l_discount = 0.08D then null
  else concat('[', if(l_returnflag = 'N', '"stray"', '{"author": "oops"}'), ',',
    to_json(named_struct(
      'author', named_struct('id', 'S' || l_suppkey, 'display_name', s_name || ' ' || l_linenumber,
                             'orcid', if(l_tax = 0D, null, 'O-' || l_linenumber)),
      'author_position', 'first', 'is_corresponding', l_tax > 0.04D,
      'raw_author_name', s_name || ' on ' || l_partkey,
      'institutions', array(
        named_struct('id', 'N' || s_nationkey, 'display_name', n_name || ' ' || l_linenumber,
                     'ror', 'R-' || l_linenumber, 'country_code', 'C' || n_regionkey,
                     'type', 'education'),
        named_struct('id', if(l_tax > 0.06D, '', 'G' || n_regionkey), 'display_name', r_name,
                     'ror', cast(null as string), 'country_code', cast(null as string),
                     'type', 'group')),
      'raw_affiliation_strings', array(n_name, r_name || ' ' || l_linenumber),
      'countries', array(n_name, r_name, n_name, '')),
      map('ignoreNullFields', 'false')), ',',
    to_json(named_struct(
      'author', named_struct('id', 'P' || l_partkey, 'display_name', 'Part ' || l_linenumber),
      'author_position', 'last', 'is_corresponding', false,
      'raw_author_name', 'Part on ' || l_suppkey,
      'institutions', 'none', 'raw_affiliation_strings', array(), 'countries', 'XX')), ',',
    if(l_linestatus = 'F', '{"author": {"id": ""}}, null',
      to_json(named_struct('author', named_struct('id', 'S' || l_suppkey, 'display_name', 'again'),
        'author_position', 'middle', 'raw_author_name', 'again ' || l_linenumber,
        'institutions', array(named_struct('id', 'N' || s_nationkey, 'display_name', 'again'))))),
    ']')
end as oa_authorships"""

# Grants of lines returned as 'A' come quoted a second time.
GRANTS = """
case when l_returnflag = 'A' then '"' || replace(g, '"', '\\\\"') || '"' else g end as oa_grants"""

GRANT_LIST = """
concat('[', to_json(named_struct('funder', p_brand, 'funder_display_name', p_type || ' ' || l_linenumber,
  'award_id', if(l_returnflag = 'N', null, 'P' || l_partkey)), map('ignoreNullFields', 'false')),
  ', {"funder": ""}, null]') as g"""

COUNTS = """
concat('[', to_json(named_struct('year', year(l_shipdate), 'cited_by_count', cast(l_quantity as int))), ',',
  to_json(named_struct('year', year(l_shipdate) + 1,
    'cited_by_count', if(l_tax = 0D, null, l_linenumber)), map('ignoreNullFields', 'false')),
  ', "x"]') as oa_counts_by_year"""


def _suppliers(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "s_name", "s_nationkey", "n_name", "n_regionkey", "r_name")
    )


def authorship_cells(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf).join(
        _suppliers(spark, sf), F.col("l_suppkey") == F.col("s_suppkey"))
    return _enriched(_dealt(lines, spark, sf), AUTHORSHIPS)


def grant_cells(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    lines = _lines(spark, sf).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return _enriched(_dealt(lines, spark, sf).selectExpr("*", GRANT_LIST), GRANTS)


def count_cells(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(_dealt(_lines(spark, sf), spark, sf), COUNTS)


def enriched_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched rows with all three list cells and the search columns."""
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    lines = (
        _lines(spark, sf)
        .join(_suppliers(spark, sf), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )
    return _enriched(
        _dealt(lines, spark, sf).selectExpr("*", GRANT_LIST), AUTHORSHIPS, GRANTS, COUNTS,
        "'SID:' || l_orderkey || '.' || l_linenumber as dc_identifier",
        "cast(l_shipdate as date) as prism_coverdate",
        "cast(l_quantity as int) as citedby_count",
        "year(l_shipdate) as publication_year", "month(l_shipdate) as publication_month",
        "'Success' as oa_status", "'Work ' || l_orderkey || '.' || l_linenumber as oa_title",
        "cast(l_quantity as int) as oa_cited_by_count", "l_discount as oa_fwci",
    )


PAGE_SIZE = 25


@landed
def search_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Response pages of 25 events each; only a full page points onward."""
    entry = """
    named_struct(
      '@_fa', if(event_type = 'view', 'maybe', 'true'),
      'prism:url', 'https://entries.example/' || event_id, 'subtype', substr(event_type, 1, 2),
      'dc:identifier', 'EID:' || user_id || '-' || event_type,
      'prism:doi', if(event_type = 'error', null, '10.2000/E.' || event_id),
      'prism:coverDate', if(event_type = 'signup', 'n.d.', date_format(ts, 'yyyy-MM-dd')),
      'citedby-count', if(event_type = 'view', 'n/a', cast(floor(value) as string)),
      'prism:publicationName', 'Feed ' || event_type,
      'subtypeDescription', event_type)"""
    pages = (
        table(spark, sf, "events")
        .selectExpr(f"event_id div {PAGE_SIZE} as page_no", "event_id", f"{entry} as entry")
        # event_id is unique, so a page never collects more than PAGE_SIZE rows
        .groupBy("page_no")
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "entry"))).alias("found"))
    )
    link = f"""
    if(size(found) = {PAGE_SIZE},
      array(named_struct('@ref', 'self', '@href', 'page/' || page_no),
            named_struct('@ref', 'next', '@href', 'page/' || (page_no + 1))),
      array(named_struct('@ref', 'self', '@href', 'page/' || page_no)))"""
    return pages.selectExpr(
        "page_no", "'page/' || page_no as url",
        "to_json(named_struct('search-results', named_struct("
        f" 'entry', transform(found, f -> f.entry), 'link', {link}))) as body",
    )


def abstracts(spark: SparkSession, sf: str) -> DataFrame:
    """One abstract record as JSON text per document, its whole text the title."""
    return table(spark, sf, "documents").selectExpr("doc_id", """
    to_json(named_struct('abstracts-retrieval-response', named_struct(
      'coredata', named_struct(
        'dc:identifier', 'DOC:' || doc_id, 'dc:title', text, 'prism:doi', '10.3000/D.' || doc_id,
        'citedby-count', cast(n_chars as string), 'prism:publicationName', source,
        'subtypeDescription', lang, 'openaccess', n_chars % 2,
        'dc:creator', if(lang = 'de', null, named_struct('author', array(
          named_struct('ce:indexed-name', source, 'affiliation', named_struct('@id', 'A' || doc_id)),
          named_struct('ce:indexed-name', lang, 'affiliation', cast(null as struct<`@id`: string>)))))),
      'affiliation', if(lang = 'fr', null, array(
        named_struct('affilname', source, 'affiliation-city', lang)))))) as body""")
