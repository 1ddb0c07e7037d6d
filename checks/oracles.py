"""The registered queries stated relationally for DuckDB."""

from __future__ import annotations

from bibspark.catalogue import TABLES

ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
LAST = ", ".join(f"{c} desc" for c in ORDER.split(", "))

RAW_DOI = """
case o_orderkey % 7
  when 0 then '10.1000/ORD.' || (o_orderkey // 2)
  when 1 then 'https://doi.org/10.1000/Ord.' || (o_orderkey // 2)
  when 2 then 'HTTP://DOI.ORG/10.1000/ord.' || (o_orderkey // 2)
  when 3 then '  10.1000/ord.' || (o_orderkey // 2) || '  '
  when 4 then 'https://dx.doi.org/10.1000/ord.' || (o_orderkey // 2)
  when 5 then 'ord-' || (o_orderkey // 2)
end"""

SEARCH = f"""
search as (
  select o_orderkey as ingest_seq, 'https://search.example/' || o_orderkey as prism_url,
    'SID:' || o_custkey as dc_identifier, 'Journal ' || o_orderpriority as prism_publicationname,
    cast(o_orderdate as date) as day, {RAW_DOI} as prism_doi,
    cast(floor(o_totalprice / 1000) as integer) as citedby_count, o_orderstatus as affiliation,
    lower(substr(o_orderpriority, 3, 2)) as subtype, o_orderpriority as subtypedescription,
    cast(year(o_orderdate) as integer) as publication_year,
    cast(month(o_orderdate) as integer) as publication_month,
    case when o_orderkey % 7 < 4 then 'https://doi.org/10.1000/ord.' || (o_orderkey // 2) end as doi
  from orders)"""

RESPONSES = """
response as (
  select *, 'https://doi.org/10.1000/ord.' || (l_orderkey // 2) as doi,
    case when l_returnflag <> 'R' then 'Success'
      when l_linenumber = 1 then 'DOI Not Found (API 404)'
      when l_linenumber = 2 then 'Rate Limit Error - Skipped'
      when l_linenumber = 3 then 'HTTP Error 503 - Skipped: line 3'
      when l_linenumber = 4 then 'Network Error - Skipped: line 4'
      when l_linenumber = 5 then 'Processing Error - Skipped: line 5'
      else 'DOI Not Found (pyalex)' end as oa_status
  from lineitem)"""

LATEST = f"""{RESPONSES},
latest as (
  select * from response
  qualify row_number() over (partition by doi order by {LAST}) = 1)"""

DOI = ("case when not (l_returnflag = 'R' and l_linestatus = 'O')"
       " then 'https://doi.org/10.1000/w' || l_orderkey end")

# Authorships that survive: position, author, role and so on.
AUTHORSHIPS = f"""
whole as (
  select l.*, {DOI} as doi, s_name, s_nationkey, n_name, n_regionkey, r_name
  from lineitem l join supplier on s_suppkey = l_suppkey
  join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey),
line as (
  select * from whole where doi is not null and l_discount not in (0.08, 0.09, 0.1)),
authorship as (
  select line.*, 1 as a_pos, 'S' || l_suppkey as oa_author_id,
    s_name || ' ' || l_linenumber as oa_author_name,
    case when l_tax <> 0 then 'O-' || l_linenumber end as oa_author_orcid,
    'first' as oa_author_position, l_tax > 0.04 as oa_author_is_corresponding,
    s_name || ' on ' || l_partkey as oa_author_raw_name,
    n_name || ', ' || r_name || ' ' || l_linenumber as affiliations
  from line
  union all
  select line.*, 2, 'P' || l_partkey, 'Part ' || l_linenumber, null, 'last', false,
    'Part on ' || l_suppkey, null
  from line
  union all
  select line.*, 3, 'S' || l_suppkey, 'again', null, 'middle', null, 'again ' || l_linenumber, null
  from line where l_linestatus <> 'F'),
institution as (
  select {ORDER}, a_pos, doi, oa_author_id, affiliations, 0 as i_pos, 'N' || s_nationkey as id,
    case when a_pos = 1 then n_name || ' ' || l_linenumber else 'again' end as name,
    case when a_pos = 1 then 'R-' || l_linenumber end as ror,
    case when a_pos = 1 then 'C' || n_regionkey end as country,
    case when a_pos = 1 then 'education' end as kind
  from authorship where a_pos in (1, 3)
  union all
  select {ORDER}, a_pos, doi, oa_author_id, affiliations, 1, 'G' || n_regionkey, r_name, null, null, 'group'
  from authorship where a_pos = 1 and l_tax <= 0.06),
authors_t as (
  select oa_author_id, oa_author_name, oa_author_orcid from authorship
  qualify row_number() over (partition by oa_author_id order by {ORDER}, a_pos) = 1),
publication_authorships_t as (
  select doi, oa_author_id, oa_author_position, oa_author_is_corresponding, oa_author_raw_name
  from authorship qualify row_number() over (
    partition by doi, oa_author_id, oa_author_position order by {ORDER}, a_pos) = 1),
institutions_t as (
  select id as oa_institution_id, name as oa_institution_name, ror as oa_institution_ror,
    country as oa_institution_country_code, kind as oa_institution_type
  from institution qualify row_number() over (partition by id order by {ORDER}, a_pos, i_pos) = 1),
authorship_institutions_t as (
  select doi, oa_author_id, id as oa_institution_id, affiliations as oa_raw_affiliation_string
  from institution qualify row_number() over (
    partition by doi, oa_author_id, id order by {ORDER}, a_pos, i_pos) = 1),
authorship_countries_t as (
  select doi, oa_author_id, n_name as oa_country_code from authorship where a_pos = 1
  union
  select doi, oa_author_id, r_name from authorship where a_pos = 1)"""

GRANTS = f"""
gift as (
  select l.*, {DOI} as doi, p_brand as oa_funder_id, p_type || ' ' || l_linenumber as oa_funder_name,
    case when l_returnflag <> 'N' then 'P' || l_partkey end as oa_award_id
  from lineitem l join part on p_partkey = l_partkey),
grant_line as (select * from gift where doi is not null),
publication_funding_t as (select distinct doi, oa_funder_id, oa_award_id from grant_line),
funders_t as (
  select oa_funder_id, oa_funder_name from grant_line
  qualify row_number() over (partition by oa_funder_id order by {ORDER}) = 1)"""

COUNTS = f"""
tally as (
  select {ORDER}, {DOI} as doi, 0 as c_pos, cast(year(l_shipdate) as integer) as year,
    cast(l_quantity as integer) as cited_by_count from lineitem
  union all
  select {ORDER}, {DOI}, 1, cast(year(l_shipdate) + 1 as integer), l_linenumber
  from lineitem where l_tax <> 0),
publication_citation_counts_t as (
  select doi, year, cited_by_count from tally where doi is not null
  qualify row_number() over (partition by doi, year order by {ORDER}, c_pos) = 1)"""

WORKS = f"""
work as (
  select {ORDER}, {DOI} as doi, 'W' || l_orderkey as oa_id,
    'https://doi.org/10.1000/w' || l_orderkey as oa_doi,
    'Work ' || l_orderkey || '.' || l_linenumber as oa_title, 'Part ' || l_partkey as oa_display_name,
    cast(year(l_shipdate) as integer) as oa_publication_year,
    strftime(l_shipdate, '%Y-%m-%d') as oa_publication_date, lower(l_returnflag) as oa_language,
    'article' as oa_type, cast(l_quantity as integer) as oa_cited_by_count, l_discount as oa_fwci,
    l_linestatus = 'F' as oa_is_retracted,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as oa_updated_date,
    cast(null as varchar) as oa_created_date,
    case when l_returnflag <> 'R' then l_tax > 0.04 end as oa_primary_location_is_oa,
    case when l_returnflag <> 'R' then 'https://pages.example/' || l_partkey end
      as oa_primary_location_landing_page_url,
    case when src then 'S' || l_suppkey end as oa_primary_location_source_id,
    case when src then 'Source ' || l_suppkey end as oa_primary_location_source_name,
    case when src then lpad(cast(l_suppkey as varchar), 8, '0') end as oa_primary_location_source_issn_l,
    case when src then l_tax = 0 end as oa_primary_location_source_is_oa,
    case when src then l_tax > 0 end as oa_primary_location_source_is_indexed_in_scopus,
    case when src then 'Host ' || l_suppkey end as oa_primary_location_source_host_org_name,
    case when src then 'Host ' || l_suppkey || '|Group' end
      as oa_primary_location_source_host_org_lineage_names,
    case when src then 'journal' end as oa_primary_location_source_type,
    cast(l_linenumber as varchar) as oa_biblio_volume, cast(l_linenumber as varchar) as oa_biblio_issue,
    cast(l_partkey as varchar) as oa_biblio_first_page, cast(null as varchar) as oa_biblio_last_page,
    'T' || l_linenumber as oa_primary_topic_id, 'Topic ' || l_linenumber as oa_primary_topic_name,
    l_tax as oa_primary_topic_score,
    case when l_returnflag <> 'A' then 'Sub ' || l_linenumber end as oa_primary_topic_subfield_name,
    'Field ' || l_linenumber as oa_primary_topic_field_name,
    'Domain ' || l_linestatus as oa_primary_topic_domain_name, l_discount as oa_cnp_value,
    l_discount > 0.09 as oa_cnp_is_top_1_percent, l_discount > 0.05 as oa_cnp_is_top_10_percent,
    l_linenumber as oa_cbpy_min, cast(l_quantity as integer) as oa_cbpy_max
  from (select *, l_returnflag <> 'R' and l_linestatus <> 'F' as src from lineitem))"""

PAGES = """
entry as (
  select event_id // 25 as page_no, cast(event_id % 25 as integer) as entry_pos,
    'page/' || (event_id // 25) as url, 'EID:' || user_id || '-' || event_type as dc_identifier,
    case when event_type <> 'error' then '10.2000/E.' || event_id end as prism_doi,
    case when event_type <> 'signup' then cast(ts as date) end as day,
    case when event_type <> 'view' then cast(floor(value) as bigint) end as cited,
    event_type, 'https://entries.example/' || event_id as prism_url, substr(event_type, 1, 2) as subtype,
    case when event_type <> 'view' then true end as fa
  from events),
page as (select page_no, url, count(*) as n from entry group by all)"""

KEYED = """
keyed as (
  select case when event_type <> 'error' then user_id end as user_id, event_type, event_id, value, props
  from events)"""

TEXTS = """
texts as (
  select o_orderkey, o_custkey as c, cast(o_orderdate as date) as d, o_orderdate as t,
    o_orderkey % 8 as n, o_orderkey % 6 as m, o_orderkey % 9 as b from orders),
parsed as (
  select o_orderkey,
    case n when 0 then c when 1 then c + 0.7e0 when 2 then c when 3 then c * 10 when 6 then -c end as num,
    case n when 0 then c when 1 then c when 2 then c when 3 then c * 10 when 6 then -c end as whole,
    case when m in (0, 1) then d end as d, case when m in (0, 1) then t end as t,
    case when b in (0, 2, 4) then true when b in (1, 3, 5) then false end as flag,
    case n when 0 then cast(c as varchar) when 1 then c || '.7' when 2 then ' ' || c || ' '
      when 3 then c || 'e1' when 4 then 'x' || c when 5 then c || 'd' when 6 then '-' || c
      when 7 then '1,' || c end as raw
  from texts)"""

UPSERT = """
older as (select dc_identifier, citedby_count, affiliation from search where affiliation <> 'F'
  qualify row_number() over (partition by dc_identifier order by ingest_seq desc) = 1),
newer as (select dc_identifier, citedby_count, affiliation from search where affiliation = 'F'
  qualify row_number() over (partition by dc_identifier order by ingest_seq desc) = 1)"""

RAW_COLUMNS = """prism_url, dc_identifier, prism_publicationname, cast({day} as varchar) as prism_coverdate,
  prism_doi, citedby_count, subtype, subtypedescription, publication_year, publication_month, doi"""
RAW_SEARCH = RAW_COLUMNS.format(day="day")


def _report(names: list[str], source: str) -> str:
    return " union all ".join(
        f"select '{n}' as table_name, count(*) as n_rows from {source.format(n)}" for n in names
    )


#: The columns of the tables whose contents are compared, others being NULL.
DIGESTED = {**{t.name: t.columns for t in TABLES.values()}, "rejects": ["doi", "cell", "reject_reason", "value"]}
GIVEN = {
    "publications": {"doi", "oa_title", "oa_cited_by_count", "oa_fwci", "oa_status"},
    "raw_scopus_search": {"dc_identifier", "prism_coverdate", "citedby_count", "publication_year", "publication_month", "doi"},
}


def _digest(name: str) -> str:
    cells = ", ".join(
        f"coalesce(cast({c} as varchar), '-')" if c in GIVEN.get(name, DIGESTED[name]) else "'-'" for c in sorted(DIGESTED[name]))
    part = f"cast('0x' || substr(md5(concat_ws('|', {cells})), 1, 8) as bigint)"
    return (f"select '{name}' as table_name, count(*) as n_rows, cast(coalesce(sum({part}), 0) as bigint) as digest"
            f" from {name}_t")


def _profile(columns: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as column_name, count(*) > count({expr}) as has_null,"
        f" count(*) - count({expr}) as n_null from search"
        for name, expr in columns.items()
    )


SEARCH_COLUMNS = {
    c: "day" if c == "prism_coverdate" else c
    for c in (
        "ingest_seq prism_url dc_identifier prism_publicationname prism_coverdate prism_doi"
        " citedby_count affiliation subtype subtypedescription publication_year publication_month doi"
    ).split()
}

ORACLES: dict[str, str] = {
    "scan_csv": f"""with {SEARCH}
        select ingest_seq, trim(prism_doi) as prism_doi,
          'said "' || subtypedescription || '",' || chr(10) || 'then ' || ingest_seq as note,
          case when affiliation = 'F' then 'F' end as affiliation,
          cast(citedby_count as varchar) as citedby_count, doi from search""",
    "scan_pruned_keys": f"with {SEARCH} select distinct doi from search where doi is not null",
    "union_parts": f"""with {SEARCH} select ingest_seq, doi,
        case when citedby_count >= 250 then citedby_count end as citedby_count from search""",
    "union_csv_parts": f"""with {SEARCH} select ingest_seq, case when affiliation <> 'O' then doi end as doi,
        case affiliation when 'O' then '{{"citedby_count":"' || citedby_count || '"}}'
          when 'P' then '{{"affiliation":"P"}}' end as rest from search""",
    "csv_rejects": """with line as (select o_orderkey, o_orderkey % 3 as kind,
          o_orderkey || ',"note, of' || chr(10) || o_orderkey || '"' as begun from orders)
        select begun as record, 'too few values' as reason from line where kind = 0
        union all select begun || ',y,z', 'too many values' from line where kind = 2""",
    "null_tokens": """select o_orderkey,
        case when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then o_orderpriority end as a,
        case o_orderstatus when 'O' then 'nAn' when 'P' then 'n/a ' end as b from orders""",
    "explode_entries": f"""with {PAGES}
        select page_no, entry_pos, dc_identifier, prism_doi,
          case when event_type = 'view' then 'n/a' else cast(cited as varchar) end as citedby_count
        from entry""",
    "search_feed_records": f"""with {PAGES}
        select page_no, entry_pos, dc_identifier, prism_doi, cast(day as varchar) as prism_coverdate,
          cast(cited as double) as citedby_count, 'Feed ' || event_type as prism_publicationname,
          event_type as subtypedescription, prism_url, subtype, fa,
          cast(coalesce(year(day), 2100) as integer) as publication_year,
          cast(coalesce(month(day), 0) as integer) as publication_month from entry""",
    "next_link": f"""with {PAGES} select page_no, url,
        case when n = 25 then 'page/' || (page_no + 1) end as next_url from page""",
    "missing_pages": f"""with {PAGES} select 'page/' || (page_no + 1) as url from page
        where n = 25 and page_no + 1 not in (select page_no from page)""",
    "page_chain": f"""with {PAGES}, told as (
          select page_no, url, page_no = 0 or page_no = 8 or lag(n) over (order by page_no) < 25
            or lag(page_no) over (order by page_no) <> page_no - 1 as begins from page),
        begun as (select *, max(case when begins then page_no end) over (order by page_no) as origin from told)
        select url, 'page/' || origin as start, page_no - origin as position,
          case when page_no = origin then 'first' else 'linked' end as state from begun
        union all select 'ring/' || r_regionkey, null, null, 'loop' from region
        union all select 'alone', 'alone', 0, 'first'""",
    "backfill_month": f"""with {SEARCH} select ingest_seq,
        case when affiliation <> 'P' then cast(day as varchar) end as prism_coverdate,
        case when affiliation <> 'P' then publication_month else 0 end as publication_month from search""",
    "sink_append": f"with {SEARCH} select ingest_seq, doi, citedby_count from search",
    "sink_append_csv": f"""with {RESPONSES} select {ORDER}, doi,
        cast(case when l_returnflag <> 'R' then 200 when l_linenumber = 1 then 404
          when l_linenumber = 2 then 429 when l_linenumber = 3 then 503
          when l_linenumber >= 6 then 200 end as integer) as http_status from response""",
    "sink_overwrite_year": f"""with {SEARCH}
        select dc_identifier, ingest_seq, citedby_count, publication_year from search
        where publication_year <> 1997
        union all
        (select dc_identifier, ingest_seq, citedby_count, publication_year from search
         where publication_year = 1997
         qualify row_number() over (partition by dc_identifier order by ingest_seq desc) = 1)""",
    "split_part_ids": f"""select {ORDER},
        (row_number() over (order by {ORDER}) - 1) // 5000 + 1 as part_id from lineitem""",
    "sink_table_parts": f"""with {AUTHORSHIPS}
        select doi, oa_author_id, oa_author_position,
          (row_number() over (order by doi, oa_author_id, oa_author_position) - 1) // 5000 + 1 as part_id
        from publication_authorships_t""",
    "split_verify_counts": """select count(*) as n_source, count(*) as n_in_parts,
        (count(*) + 4999) // 5000 as n_parts, true as matches from lineitem""",
    "sink_fanout": f"""with {AUTHORSHIPS}, {GRANTS}, {COUNTS}, first_line as (
          select * from whole where doi is not null qualify row_number() over (partition by doi order by {ORDER}) = 1),
        publications_t as (select doi, 'Work ' || l_orderkey || '.' || l_linenumber as oa_title,
          cast(l_quantity as integer) as oa_cited_by_count, l_discount as oa_fwci, 'Success' as oa_status from first_line),
        raw_scopus_search_t as (select 'SID:' || l_orderkey || '.' || l_linenumber as dc_identifier,
          cast(cast(l_shipdate as date) as varchar) as prism_coverdate, cast(l_quantity as integer) as citedby_count,
          year(l_shipdate) as publication_year, month(l_shipdate) as publication_month, doi from first_line),
        rejects_t as (select doi, 'oa_authorships' as cell,
          case when l_discount = 0.1 then 'invalid json' else 'not a list' end as reject_reason,
          case when l_discount = 0.1 then 'not json' else '{{"author": {{"id": "X"}}}}' end as value
          from whole where doi is not null and l_discount in (0.09, 0.1))
        {" union all ".join(_digest(n) for n in DIGESTED)}""",
    "upsert_update": f"""with {SEARCH}, {UPSERT}
        select * from older where dc_identifier not in (select dc_identifier from newer)
        union all select * from newer""",
    "upsert_do_nothing": f"""with {SEARCH}, {UPSERT}
        select dc_identifier from older union select dc_identifier from newer""",
    "upsert_null_keys": f"""with {GRANTS}
        select doi, oa_funder_id, oa_award_id from publication_funding_t""",
    "load_tables": f"""with {SEARCH}
        select {RAW_SEARCH} from (
          select *, row_number() over (partition by dc_identifier
            order by affiliation = 'F' desc, ingest_seq desc) as r from search) where r = 1""",
    "load_counts": f"""with {SEARCH}, keyed as (
          select case when ingest_seq % 5 <> 0 then dc_identifier end as id from search)
        select count(*) as n_source, count(*) - count(id) as n_rejected, count(distinct id) as n_loaded,
          count(id) - count(distinct id) as n_replaced from keyed""",
    "load_unknown_year": f"""with {SEARCH} select dc_identifier,
          cast(case when affiliation = 'P' then 9999 else publication_year end as integer) as publication_year from search
        qualify row_number() over (partition by dc_identifier order by ingest_seq desc) = 1""",
    "parts_rewritten": """select c_custkey, c_mktsegment,
        (row_number() over (order by c_custkey) - 1) // 100 + 1 as part_id
        from customer where c_mktsegment = 'BUILDING'""",
    "load_null_keys": f"""with {SEARCH}, keyed as (
          select *, case when ingest_seq % 5 <> 0 then dc_identifier end as id from search)
        select 'rejected' as place, prism_url from keyed where id is null
        union all
        select 'loaded' as place, prism_url from keyed where id is not null
        qualify row_number() over (partition by id order by ingest_seq desc) = 1""",
    "flatten_struct": """select event_id, user_id as "rec:head.@id", event_type as "rec:head.dc:kind",
        value as "rec:head.geo.value-x", props as "rec:head.geo.props" from events""",
    "clean_columns": """select event_id, user_id as rec_head_id, event_type as rec_head_dc_kind,
        value as rec_head_geo_value_x, props as rec_head_geo_props from events""",
    "ensure_columns": """select o_orderkey, 'SID:' || o_custkey as dc_identifier,
        cast(null as varchar) as prism_doi, cast(null as varchar) as prism_coverdate,
        cast(null as varchar) as citedby_count, cast(null as varchar) as prism_publicationname,
        cast(null as varchar) as subtypedescription from orders""",
    "project_schema": f"with {SEARCH} select {RAW_SEARCH} from search",
    "flatten_work": f"with {WORKS} select *, l_linenumber as n_counted from work",
    "enriched_layout": f"""with {WORKS} select {ORDER}, doi as prism_doi, doi, 'Success' as oa_status,
        oa_id, oa_title from work""",
    "project_abstract": """select doc_id, 'DOC:' || doc_id as dc_identifier, text as dc_title,
        '10.3000/D.' || doc_id as prism_doi, cast(null as varchar) as prism_coverdate,
        cast(n_chars as varchar) as citedby_count, source as prism_publicationname,
        lang as subtypedescription, cast(null as varchar) as prism_volume,
        cast(null as varchar) as prism_issueidentifier, cast(null as varchar) as prism_pagerange,
        cast(n_chars % 2 as varchar) as openaccess, cast(null as varchar) as pubmed_id,
        case when lang = 'fr' then 0 else 1 end as n_affiliations,
        case when lang <> 'fr' then source end as first_affiliation,
        case when lang <> 'fr' then lang end as first_city, cast(null as varchar) as first_country,
        case when lang = 'de' then 0 else 2 end as n_authors,
        case when lang <> 'de' then source end as first_author,
        case when lang <> 'de' then 'A' || doc_id end as first_author_affiliation,
        cast(null as varchar) as second_author_affiliation from documents""",
    "abstract_refresh": """select 'DOC:' || doc_id as dc_identifier, text as dc_title,
        '10.3000/D.' || doc_id as prism_doi, cast(null as varchar) as prism_coverdate,
        cast(n_chars as varchar) as citedby_count, source as prism_publicationname,
        lang as subtypedescription, cast(null as varchar) as prism_volume,
        cast(null as varchar) as prism_issueidentifier, cast(null as varchar) as prism_pagerange,
        cast(n_chars % 2 as varchar) as openaccess, cast(null as varchar) as pubmed_id,
        case when lang = 'fr' then '[]' else
          '[{"name":"' || source || '","city":"' || lang || '","country":null}]' end as affiliations,
        case when lang = 'de' then '[]' else
          '[{"name":"' || source || '","affiliation":"A' || doc_id || '"},'
          || '{"name":"' || lang || '","affiliation":null}]' end as authors
        from documents where lang <> 'es'""",
    "filter_valid_keys": f"with {SEARCH} select ingest_seq, doi from search where doi is not null",
    "filter_element_ids": f"""with {AUTHORSHIPS}
        select {ORDER}, a_pos, oa_author_id as author_id from authorship""",
    "search_slice": f"""with {SEARCH}
        select ingest_seq, dc_identifier, affiliation, cast(day as varchar) as prism_coverdate,
          subtypedescription, publication_year, citedby_count from search
        where affiliation = 'F' and publication_year = 1997 and subtypedescription = '1-URGENT'""",
    "array_compact": """select o_orderkey,
        case when o_orderstatus = 'F' then 2 else 1 end as n_kept,
        case when o_orderstatus = 'F' then o_orderpriority || '|' || o_custkey
          else o_orderpriority end as kept_text from orders""",
    "resume_anti_join": f"""with {SEARCH} select ingest_seq, doi from search
        where doi is not null and doi not in (
          select doi from search where affiliation = 'F' and doi is not null)""",
    "enrich_left_join": f"""with {SEARCH}, {LATEST}
        select ingest_seq, s.doi, coalesce(r.oa_status, 'DOI Not Found (pyalex)') as oa_status,
          case when ok then 'W' || l_orderkey end as oa_id,
          case when ok then 'Work ' || l_partkey end as oa_title,
          case when ok then cast(l_quantity as integer) end as oa_cited_by_count,
          case when ok then l_discount end as oa_fwci,
          case when ok then strftime(l_shipdate, '%Y-%m-%d') end as oa_publication_date,
          case when ok then cast(l_linenumber as varchar) end as oa_biblio_volume,
          case when ok then 'S' || l_suppkey end as first_author_id
        from search s left join (select *, oa_status = 'Success' as ok from latest) r on r.doi = s.doi
        where s.doi is not null""",
    "enrich_status": f"with {RESPONSES} select {ORDER}, oa_status from response",
    "exclude_existing": f"""with {PAGES} select page_no, entry_pos, dc_identifier from entry
        where dc_identifier not in (
          select 'EID:' || user_id || '-' || event_type from events where value > 250)""",
    "star_join_read": f"""with {AUTHORSHIPS}
        select doi, oa_author_id, oa_author_name, oa_institution_id, oa_institution_name,
          oa_institution_country_code
        from authorship_institutions_t join authors_t using (oa_author_id)
        join institutions_t using (oa_institution_id)""",
    "parse_json_cell": f"""select {ORDER},
        case when l_discount in (0.08, 0.09, 0.1) then 0 when l_linestatus = 'F' then 5 else 4 end
          as n_elements,
        case when l_discount in (0.08, 0.09) or l_discount = 0.1 then null
          when l_linestatus = 'F' then '-|S' || l_suppkey || '|P' || l_partkey || '||-'
          else '-|S' || l_suppkey || '|P' || l_partkey || '|S' || l_suppkey end as author_ids
        from lineitem""",
    "parse_quoted_cell": f"""with {GRANTS} select {ORDER}, 3 as n_elements, oa_funder_id as funder,
        oa_award_id as award_id from gift""",
    "norm_authorships": f"with {AUTHORSHIPS} select * from publication_authorships_t",
    "norm_authors": f"with {AUTHORSHIPS} select * from authors_t",
    "norm_authorship_institutions": f"with {AUTHORSHIPS} select * from authorship_institutions_t",
    "norm_institutions": f"with {AUTHORSHIPS} select * from institutions_t",
    "norm_authorship_countries": f"with {AUTHORSHIPS} select * from authorship_countries_t",
    "norm_funding": f"with {GRANTS} select * from publication_funding_t",
    "norm_funders": f"with {GRANTS} select * from funders_t",
    "norm_citation_counts": f"with {COUNTS} select * from publication_citation_counts_t",
    "norm_publications": f"""with {WORKS}
        select * exclude ({ORDER}), 'Success' as oa_status from work where doi is not null
        qualify row_number() over (partition by doi order by {ORDER}) = 1""",
    "norm_raw_search": f"""with {SEARCH} select {RAW_SEARCH} from search where doi is not null
        qualify row_number() over (partition by doi order by ingest_seq) = 1""",
    "norm_raw_search_keyed": f"""with {SEARCH}, newest as (
          select * from search where doi is not null
          qualify row_number() over (partition by dc_identifier order by ingest_seq desc) = 1)
        select {RAW_SEARCH} from newest
        qualify row_number() over (partition by doi order by ingest_seq) = 1""",
    "join_affiliations": f"with {AUTHORSHIPS} select {ORDER}, a_pos, affiliations from authorship",
    "json_round_trip": f"""select {ORDER}, case when l_returnflag <> 'N' then l_partkey end as part,
        l_tax as tax, l_linestatus as state, l_returnflag = 'N' as has_null from lineitem""",
    "dedupe_keep_first": f"""with {KEYED} select * from keyed
        qualify row_number() over (partition by user_id, event_type order by event_id) = 1""",
    "dedupe_keep_last": f"""with {KEYED} select * from keyed
        qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1""",
    "distinct_keys": f"with {SEARCH} select distinct doi from search where doi is not null",
    "dedupe_report": f"""with {KEYED}, kept as (select count(*) as n from (
          select distinct user_id, event_type from keyed)), al as (select count(*) as n from keyed)
        select al.n as rows_before, kept.n as rows_after, al.n - kept.n as rows_dropped from al, kept""",
    "table_counts": _report(["orders", "lineitem", "events", "documents"], "{}"),
    "key_quality_counts": f"""with {SEARCH} select count(*) as n_rows, count(doi) as n_valid,
        count(*) - count(doi) as n_skipped from search""",
    "any_null_profile": f"with {SEARCH} {_profile(SEARCH_COLUMNS)}",
    "search_sorted": f"""with {SEARCH}
        select row_number() over (order by citedby_count desc, dc_identifier, ingest_seq) as place,
          dc_identifier, ingest_seq, citedby_count from search
        where affiliation = 'F' and publication_year = 1997 and subtypedescription = '1-URGENT'""",
    "page_slice": f"""with {SEARCH} select ingest_seq, dc_identifier, citedby_count from search
        where affiliation = 'O' and publication_year = 1998 and subtypedescription = '2-HIGH'
        order by citedby_count desc, dc_identifier, ingest_seq limit 25 offset 25""",
    "page_slice_deep": f"select {ORDER} from lineitem order by {ORDER} limit 25 offset 5500",
    "top_n_per_type": f"""with {SEARCH}
        select publication_year, subtypedescription, ingest_seq, citedby_count from search
        qualify row_number() over (partition by publication_year, subtypedescription
          order by citedby_count desc, dc_identifier, ingest_seq) <= 10""",
    "union_types": f"""with {SEARCH} select ingest_seq, dc_identifier, subtypedescription from search
        where subtypedescription in ('1-URGENT', '3-MEDIUM')""",
    "union_existing_new": f"""with {SEARCH} select ingest_seq, dc_identifier, citedby_count,
        publication_year, case when affiliation = 'F' then affiliation end as affiliation from search""",
    "format_doi": f"""with raw as (select o_orderkey as ingest_seq,
          regexp_replace(trim({RAW_DOI}), '^https?://doi.org/', '', 'i') as name from orders)
        select ingest_seq, case when starts_with(name, '10.') and contains(name, '/')
          then 'https://doi.org/' || lower(name) end as doi from raw""",
    "coerce_double": f"with {TEXTS} select o_orderkey, cast(num as double) as parsed from parsed",
    "coerce_int": f"with {TEXTS} select o_orderkey, cast(whole as integer) as parsed from parsed",
    "coerce_date": f"with {TEXTS} select o_orderkey, cast(d as varchar) as parsed from parsed",
    "coerce_timestamp": f"""with {TEXTS}
        select o_orderkey, strftime(t, '%Y-%m-%d %H:%M:%S') as parsed from parsed""",
    "coerce_boolean": f"with {TEXTS} select o_orderkey, flag as parsed from parsed",
    "pub_year": f"""with {TEXTS}
        select o_orderkey, cast(coalesce(year(d), 2100) as integer) as parsed from parsed""",
    "pub_month": f"""with {TEXTS}
        select o_orderkey, cast(coalesce(month(d), 0) as integer) as parsed from parsed""",
    "nan_to_null": f"select {ORDER}, nullif(l_tax, 0) as tax from lineitem",
    "coerce_table": f"""with {TEXTS}
        select o_orderkey, cast(whole as integer) as oa_cited_by_count, cast(num as double) as oa_fwci,
          flag as oa_is_retracted, cast(d as varchar) as oa_publication_date,
          strftime(t, '%Y-%m-%d %H:%M:%S') as oa_updated_date, raw as oa_title,
          cast(null as varchar) as oa_language from parsed""",
    "stream_incremental": f"""with {SEARCH}, {LATEST}, taken as (
          select ingest_seq, doi from search where affiliation <> 'F' and doi is not null
          union all
          select ingest_seq, doi from search where affiliation = 'F' and doi is not null
            and doi not in (select doi from search where affiliation <> 'F' and doi is not null))
        select ingest_seq, t.doi, coalesce(r.oa_status, 'DOI Not Found (pyalex)') as oa_status,
          case when r.oa_status = 'Success' then 'W' || l_orderkey end as oa_id,
          case when r.oa_status = 'Success' then cast(l_quantity as integer) end as oa_cited_by_count
        from taken t left join latest r on r.doi = t.doi""",
    "stream_two_sources": f"""with {SEARCH}, {LATEST}, taken as (
          select ingest_seq, doi from search where affiliation <> 'F' and doi is not null
          union all
          select ingest_seq, doi from search where affiliation = 'F' and doi is not null
            and doi not in (select doi from search where affiliation <> 'F' and doi is not null))
        select ingest_seq, t.doi, coalesce(r.oa_status, 'DOI Not Found (pyalex)') as oa_status
        from taken t left join latest r on r.doi = t.doi""",
    "incremental_refresh": f"""with {SEARCH}, rows as (
          select ingest_seq, dc_identifier, citedby_count, publication_year, affiliation = 'F' as fresh
          from search) select ingest_seq, dc_identifier, citedby_count,
          case when fresh then 'F' end as affiliation, publication_year from rows
        qualify row_number() over (partition by publication_year, dc_identifier
          order by fresh desc, ingest_seq desc) = 1""",
    "refresh_unknown_year": f"""with {SEARCH}, rows as (
          select ingest_seq, dc_identifier, citedby_count, affiliation <> 'O' as fresh,
            cast(case when affiliation = 'P' then 2100 else publication_year end as integer) as publication_year from search)
        select ingest_seq, dc_identifier, citedby_count, publication_year from rows
        qualify row_number() over (partition by publication_year, dc_identifier
          order by fresh desc, ingest_seq desc) = 1""",
    "quarantine_rejects": f"""select {ORDER},
        case when l_discount = 0.1 then 'invalid json' else 'not a list' end as reject_reason
        from lineitem where l_discount in (0.09, 0.1)""",
    "schema_diff": f"""with {SEARCH} {" union all ".join(
        f"select '{c}' as column_name, '{state}' as state, {n} as n_values from search"
        for c, state, n in [
            *[(c, 'missing' if c == 'subtype' else 'declared',
               'cast(0 as bigint)' if c == 'subtype' else f'count({e})')
              for c, e in SEARCH_COLUMNS.items() if c not in ('ingest_seq', 'affiliation')],
            ('ingest_seq', 'extra', 'count(ingest_seq)'), ('affiliation', 'extra', 'count(affiliation)'),
        ])}""".replace("cast(0 as bigint) as n_values from search", "cast(0 as bigint) as n_values"),
    "pk_violations": f"""with {SEARCH}, picked as (
          select * from search where doi is not null
          qualify row_number() over (partition by doi order by ingest_seq) = 1)
        select dc_identifier, count(*) as n_rows from picked group by dc_identifier having count(*) > 1""",
    "pk_nulls": f"with {GRANTS} select * from publication_funding_t where oa_award_id is null",
    "too_long_texts": """select o_orderkey as ingest_seq, o_orderpriority as oa_language from orders
        where length(o_orderpriority) > 10""",
}
