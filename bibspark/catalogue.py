"""Declared tables: columns, types, primary keys and de-duplication keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType, _parse_datatype_string


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...]
    dedupe_key: tuple[str, ...]
    nullable_key: tuple[str, ...] = ()  # parts of the key that may be NULL

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.ddl.split(",")]

    @property
    def types(self) -> dict[str, str]:
        return dict(part.split() for part in self.ddl.split(","))

    @property
    def schema(self) -> StructType:
        return _parse_datatype_string(self.ddl)


# ---------------------------------------------------------------------------
# Table names, column names, column order, types and keys of the
# relational model. Downstream queries depend on every one of them.
# ---------------------------------------------------------------------------
_TABLES = [
    Table(
        "raw_scopus_search",
        "prism_url string, dc_identifier string, prism_publicationname string,"
        "prism_coverdate date, prism_doi string, citedby_count int,"
        "subtype string, subtypedescription string,"
        "publication_year int, publication_month int, doi string",
        key=("dc_identifier",),
        dedupe_key=("doi",),
    ),
    Table(
        "publications",
        "doi string, oa_id string, oa_doi string, oa_title string,"
        "oa_display_name string, oa_publication_year int,"
        "oa_publication_date date, oa_language string, oa_type string,"
        "oa_cited_by_count int, oa_fwci double, oa_is_retracted boolean,"
        "oa_updated_date timestamp_ntz, oa_created_date date,"
        "oa_primary_location_is_oa boolean,"
        "oa_primary_location_landing_page_url string,"
        "oa_primary_location_source_id string,"
        "oa_primary_location_source_name string,"
        "oa_primary_location_source_issn_l string,"
        "oa_primary_location_source_is_oa boolean,"
        "oa_primary_location_source_is_indexed_in_scopus boolean,"
        "oa_primary_location_source_host_org_name string,"
        "oa_primary_location_source_host_org_lineage_names string,"
        "oa_primary_location_source_type string,"
        "oa_biblio_volume string, oa_biblio_issue string,"
        "oa_biblio_first_page string, oa_biblio_last_page string,"
        "oa_primary_topic_id string, oa_primary_topic_name string,"
        "oa_primary_topic_score double, oa_primary_topic_subfield_name string,"
        "oa_primary_topic_field_name string,"
        "oa_primary_topic_domain_name string,"
        "oa_cnp_value double, oa_cnp_is_top_1_percent boolean,"
        "oa_cnp_is_top_10_percent boolean, oa_cbpy_min int, oa_cbpy_max int,"
        "oa_status string",
        key=("doi",),
        dedupe_key=("doi",),
    ),
    Table(
        "authors",
        "oa_author_id string, oa_author_name string, oa_author_orcid string",
        key=("oa_author_id",),
        dedupe_key=("oa_author_id",),
    ),
    Table(
        "institutions",
        "oa_institution_id string, oa_institution_name string,"
        "oa_institution_ror string, oa_institution_country_code string,"
        "oa_institution_type string",
        key=("oa_institution_id",),
        dedupe_key=("oa_institution_id",),
    ),
    Table(
        "funders",
        "oa_funder_id string, oa_funder_name string",
        key=("oa_funder_id",),
        dedupe_key=("oa_funder_id",),
    ),
    Table(
        "publication_authorships",
        "doi string, oa_author_id string, oa_author_position string,"
        "oa_author_is_corresponding boolean, oa_author_raw_name string",
        key=("doi", "oa_author_id", "oa_author_position"),
        dedupe_key=("doi", "oa_author_id", "oa_author_position"),
    ),
    Table(
        "authorship_institutions",
        "doi string, oa_author_id string, oa_institution_id string,"
        "oa_raw_affiliation_string string",
        key=("doi", "oa_author_id", "oa_institution_id"),
        dedupe_key=("doi", "oa_author_id", "oa_institution_id"),
    ),
    Table(
        "authorship_countries",
        "doi string, oa_author_id string, oa_country_code string",
        key=("doi", "oa_author_id", "oa_country_code"),
        dedupe_key=("doi", "oa_author_id", "oa_country_code"),
    ),
    Table(
        "publication_funding",
        "doi string, oa_funder_id string, oa_award_id string",
        key=("doi", "oa_funder_id", "oa_award_id"),
        dedupe_key=("doi", "oa_funder_id", "oa_award_id"),
        nullable_key=("oa_award_id",),
    ),
    Table(
        "publication_citation_counts",
        "doi string, year int, cited_by_count int",
        key=("doi", "year"),
        dedupe_key=("doi", "year"),
    ),
]

# Length-limited text columns (language and country codes).
MAX_LENGTH = {"oa_language": 10, "oa_institution_country_code": 10, "oa_country_code": 10}

# Columns every cleaned search record carries.
SEARCH_FIELDS = (
    "dc_identifier string, prism_doi string, prism_coverdate string,"
    "citedby_count string, prism_publicationname string,"
    "subtypedescription string"
)

# Document types a search refresh covers.
DOCUMENT_TYPES = [
    "Article", "Book", "Book Chapter", "Conference Paper", "Data Paper",
    "Editorial", "Erratum", "Letter", "Note", "Retracted", "Review",
    "Short Survey",
]

# Texts read as NULL in delimited input.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Sizes.
ROWS_PER_PART = 5000
PAGE_SIZE = 25
MAX_RESULTS_PER_TYPE = 5000
NO_YEAR = 2100
NO_YEAR_AT_LOAD = 9999
NO_MONTH = 0

# Shape of the nested cells of a work record.
AUTHORSHIPS_TYPE = (
    "array<struct<"
    "author: struct<id: string, display_name: string, orcid: string>,"
    "author_position: string, is_corresponding: boolean,"
    "raw_author_name: string,"
    "institutions: array<struct<id: string, display_name: string,"
    " ror: string, country_code: string, type: string>>,"
    "raw_affiliation_strings: array<string>, countries: array<string>>>"
)
GRANTS_TYPE = (
    "array<struct<funder: string, funder_display_name: string,"
    " award_id: string>>"
)
COUNTS_TYPE = "array<struct<year: int, cited_by_count: int>>"
#: The fields of an authorship that publication_authorships takes.
AUTHORSHIP_LINKS_TYPE = (
    "array<struct<author: struct<id: string>, author_position: string,"
    " is_corresponding: boolean, raw_author_name: string>>"
)
LIST_CELLS = {
    "oa_authorships": AUTHORSHIPS_TYPE,
    "oa_grants": GRANTS_TYPE,
    "oa_counts_by_year": COUNTS_TYPE,
}

# Output column -> field of the work record.
WORK_FIELDS = {
    "oa_id": "id",
    "oa_doi": "doi",
    "oa_title": "title",
    "oa_display_name": "display_name",
    "oa_publication_year": "publication_year",
    "oa_publication_date": "publication_date",
    "oa_language": "language",
    "oa_type": "type",
    "oa_cited_by_count": "cited_by_count",
    "oa_fwci": "fwci",
    "oa_is_retracted": "is_retracted",
    "oa_updated_date": "updated_date",
    "oa_created_date": "created_date",
    "oa_primary_location_is_oa": "primary_location.is_oa",
    "oa_primary_location_landing_page_url": "primary_location.landing_page_url",
    "oa_primary_location_source_id": "primary_location.source.id",
    "oa_primary_location_source_name": "primary_location.source.display_name",
    "oa_primary_location_source_issn_l": "primary_location.source.issn_l",
    "oa_primary_location_source_is_oa": "primary_location.source.is_oa",
    "oa_primary_location_source_is_indexed_in_scopus":
        "primary_location.source.is_indexed_in_scopus",
    "oa_primary_location_source_host_org_name":
        "primary_location.source.host_organization_name",
    "oa_primary_location_source_host_org_lineage_names":
        "primary_location.source.host_organization_lineage_names",
    "oa_primary_location_source_type": "primary_location.source.type",
    "oa_biblio_volume": "biblio.volume",
    "oa_biblio_issue": "biblio.issue",
    "oa_biblio_first_page": "biblio.first_page",
    "oa_biblio_last_page": "biblio.last_page",
    "oa_primary_topic_id": "primary_topic.id",
    "oa_primary_topic_name": "primary_topic.display_name",
    "oa_primary_topic_score": "primary_topic.score",
    "oa_primary_topic_subfield_name": "primary_topic.subfield.display_name",
    "oa_primary_topic_field_name": "primary_topic.field.display_name",
    "oa_primary_topic_domain_name": "primary_topic.domain.display_name",
    "oa_cnp_value": "citation_normalized_percentile.value",
    "oa_cnp_is_top_1_percent":
        "citation_normalized_percentile.is_in_top_1_percent",
    "oa_cnp_is_top_10_percent":
        "citation_normalized_percentile.is_in_top_10_percent",
    "oa_cbpy_min": "cited_by_percentile_year.min",
    "oa_cbpy_max": "cited_by_percentile_year.max",
}
WORK_LISTS = {
    "oa_authorships": "authorships",
    "oa_grants": "grants",
    "oa_counts_by_year": "counts_by_year",
}

# The abstract record and its projection.
ABSTRACT_TYPE = (
    "struct<`abstracts-retrieval-response`: struct<"
    "coredata: struct<`dc:identifier`: string, `dc:title`: string,"
    " `prism:doi`: string, `prism:coverDate`: string,"
    " `citedby-count`: string, `prism:publicationName`: string,"
    " subtypeDescription: string, `prism:volume`: string,"
    " `prism:issueIdentifier`: string, `prism:pageRange`: string,"
    " openaccess: string, `pubmed-id`: string,"
    " `dc:creator`: struct<author: array<struct<`ce:indexed-name`: string,"
    "  affiliation: struct<`@id`: string>>>>>,"
    "affiliation: array<struct<affilname: string, `affiliation-city`: string,"
    " `affiliation-country`: string>>>>"
)
ABSTRACT_FIELDS = [
    "dc:identifier", "dc:title", "prism:doi", "prism:coverDate",
    "citedby-count", "prism:publicationName", "subtypeDescription",
    "prism:volume", "prism:issueIdentifier", "prism:pageRange", "openaccess",
    "pubmed-id",
]
ABSTRACT_TABLE = Table(
    "scopus_abstract_output",
    "dc_identifier string, dc_title string, prism_doi string,"
    "prism_coverdate string, citedby_count string,"
    "prism_publicationname string, subtypedescription string,"
    "prism_volume string, prism_issueidentifier string,"
    "prism_pagerange string, openaccess string, pubmed_id string,"
    "affiliations string, authors string",
    key=("dc_identifier",),
    dedupe_key=("dc_identifier",),
)

# A search response page.
SEARCH_ENTRY_TYPE = (
    "struct<`@_fa`: string, `prism:url`: string, subtype: string,"
    " `dc:identifier`: string, `prism:doi`: string,"
    " `prism:coverDate`: string, `citedby-count`: string,"
    " `prism:publicationName`: string, subtypeDescription: string>"
)
SEARCH_LINK_TYPE = "array<struct<`@ref`: string, `@href`: string>>"

TABLES: dict[str, Table] = {t.name: t for t in _TABLES}
