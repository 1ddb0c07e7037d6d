import json

import pytest
from pyspark.sql import functions as F

from bibspark.catalogue import TABLES
from bibspark.functions import cells, status
from bibspark.functions.identifiers import format_doi
from bibspark.operators import works
from bibspark.operators.quality import key_violations
from bibspark.plans import enrich, load, normalize, search
from bibspark.sinks import files as sink
from bibspark.sinks import tables as stored
from bibspark.sources import files as source
from bibspark.sources import lookup, search_pages
from bibspark.streaming import incremental


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- files -----------------------------------------------------------------


def test_csv_with_quotes_breaks_and_mark(spark, tmp_path):
    text = '﻿prism_doi,extra,n,note\n10.1/A,x,5.0,"say ""hi"",\nthere"\nNA,y,bad,plain\n'
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    frame = source.scan_search_csv(spark, str(tmp_path), "note string, n int, prism_doi string, absent date")
    assert frame.columns == ["note", "n", "prism_doi", "absent", "doi"]
    assert as_set(frame) == as_set(spark.createDataFrame(
        [('say "hi",\nthere', 5, "10.1/A", None, "https://doi.org/10.1/a"), ("plain", None, None, None, None)],
        "note string, n int, prism_doi string, absent date, doi string"))


def test_csv_without_required_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    with pytest.raises(source.MissingColumns, match="prism_doi"):
        source.scan_search_csv(spark, str(tmp_path), "a string, prism_doi string")


def test_csv_parts_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,c\n3,4\n")
    frame = source.scan_csv_parts(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "a int, b int, c int")
    assert as_set(frame) == as_set(spark.createDataFrame([(1, 2, None), (None, 3, 4)], "a int, b int, c int"))


def test_nothing_landed_yet(spark, tmp_path):
    assert source.load_search_results(spark, str(tmp_path / "none")).count() == 0
    assert source.processed_keys(spark, str(tmp_path / "none")).count() == 0


def test_parts_are_full_and_verified(spark, tmp_path):
    path = str(tmp_path / "parts")
    frame = spark.range(23)
    sink.write_parts(frame, path, ["id"], rows_per_part=5)
    assert as_set(sink.part_counts(spark, path)) == [(1, 5), (2, 5), (3, 5), (4, 5), (5, 3)]
    assert len(list((tmp_path / "parts").glob("part_id=*/*.parquet"))) == 5
    assert tuple(sink.verify_parts(frame, sink.part_counts(spark, path)).first()) == (23, 23, 5, True)


def test_second_write_replaces_the_first(spark, tmp_path):
    path = str(tmp_path / "parts")
    for rows in (23, 7, 0):
        assert sink.write_table_parts(spark.range(rows), path, ["id", "gone"], ["id"], rows_per_part=5) == ["gone"]
        counts = sink.part_counts(spark, path)
        assert sum(r["n_rows"] for r in counts.collect()) == rows
        assert tuple(sink.verify_parts(spark.range(rows), counts).select("n_source").first()) == (rows,)


def test_refresh_keeps_columns_and_years(spark, tmp_path):
    path = str(tmp_path / "years")
    old = "dc_identifier string, n int, extra string, prism_coverdate date, publication_year int"
    sink.overwrite_years(spark.createDataFrame([("a", 1, "x", None, 2020), ("b", 1, "y", None, 2021)], old).withColumn(
        "prism_coverdate", F.expr("date'2020-03-01'")), path)
    new = spark.createDataFrame([("b", 2, 7, 2021), ("e", 2, 8, 2022)],
                                "dc_identifier string, n int, more int, publication_year int")
    with pytest.raises(ValueError, match="2022"):
        search.refresh_years(spark, path, new, ["n"], years=[2021])
    for _ in range(2):  # a second run changes nothing
        search.refresh_years(spark, path, new, ["n"])
        got = source.read_stored(spark, path, old).selectExpr("dc_identifier", "n", "extra", "more", "publication_year")
        assert as_set(got) == [("a", 1, "x", None, 2020), ("b", 2, None, 7, 2021), ("e", 2, None, 8, 2022)]


def test_month_is_filled_on_load(spark, tmp_path):
    path = str(tmp_path / "earlier")
    spark.sql("select 's1' as dc_identifier, date'2020-03-01' as prism_coverdate").write.parquet(path)
    assert source.load_search_results(spark, path).first()["publication_month"] == 3


def test_rows_without_key_are_set_aside(spark, tmp_path):
    spec = TABLES["raw_scopus_search"]
    rows = spark.createDataFrame([(None, "a", 1), (None, "b", 2), ("k", "c", 3), ("k", "d", 4)],
                                 "dc_identifier string, prism_url string, seq int")
    stored.load_table(rows, str(tmp_path / "t"), spec, ["seq"], str(tmp_path / "rejects"))
    assert as_set(stored.read_current(spark, str(tmp_path / "t"), spec).select("prism_url")) == [("d",)]
    assert as_set(spark.read.parquet(str(tmp_path / "rejects")).select("prism_url")) == [("a",), ("b",)]
    with pytest.raises(ValueError, match="repeats keys"):
        load.load_all({spec.name: rows}, str(tmp_path / "u"))


def test_normalized_rows_load_with_the_newest_record(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "https://doi.org/10.1/a", "S1", 2020, 9), (2, "https://doi.org/10.1/b", "S1", 2021, 1)],
        "seq int, doi string, dc_identifier string, publication_year int, citedby_count int")
    for name in ("oa_authorships", "oa_grants", "oa_counts_by_year"):
        rows = rows.withColumn(name, F.lit("[]"))
    load.load_all(normalize.normalize(rows, ["seq"]), str(tmp_path))
    spec = TABLES["raw_scopus_search"]
    got = stored.read_current(spark, f"{tmp_path}/{spec.name}", spec)
    assert [r["publication_year"] for r in got.collect()] == [2021]


def test_broken_bodies_are_no_success(spark):
    bodies = {'{"id": "W1", "title": "x': "Processing", "[1]": "DOI Not", "{}": "DOI Not", "": "DOI Not", None: "DOI Not",
              '{"id": 1}': "Success", "oops": "Processing"}
    frame = spark.createDataFrame([(b,) for b in bodies], "body string")
    none = F.lit(None).cast("string")
    got = frame.select("body", status.lookup_status(F.lit(200), none, none, F.col("body")).alias("s")).collect()
    assert all(r["s"].startswith(bodies[r["body"]]) for r in got)


def test_compact_item_keeps_what_counts(spark):
    items = {'["a", null, "", 0, false, true, 2, [], {}]': ["a", "true", "2"], '{"x": 0, "y": "z"}': ["z"],
             "0": [], "false": [], "plain": ["plain"], None: [], "": []}
    frame = spark.createDataFrame([(i,) for i in items], "item string")
    got = frame.select("item", cells.compact_item(F.col("item")).alias("kept")).collect()
    assert {r["item"]: r["kept"] for r in got} == items


# --- search pages ----------------------------------------------------------


def page(entries=None, following=None):
    links = [{"@ref": "self", "@href": "x"}]
    if following:
        links.append({"@ref": "next", "@href": following})
    results = {"link": links}
    if entries is not None:
        results["entry"] = entries
    return json.dumps({"search-results": results})


def test_search_pages(spark):
    pages = spark.createDataFrame([
        ("p1", page([{"dc:identifier": "1", "prism:coverDate": "2021-05-01", "citedby-count": "7"},
                     {"dc:identifier": "2", "prism:coverDate": "soon"}], "p2")),
        ("p2", page(following="p3")), ("p4", "no json"), ("p5", page([])),
    ], "url string, body string")
    records = search_pages.search_records(pages)
    got = records.selectExpr("dc_identifier", "citedby_count", "publication_year", "publication_month")
    assert as_set(got) == [("1", 7.0, 2021, 5), ("2", None, 2100, 0)]
    links = search_pages.next_links(pages)
    assert as_set(links) == [("p1", "p2"), ("p2", "p3"), ("p4", None), ("p5", None)]
    assert as_set(search_pages.missing_pages(links)) == [("p3",)]


# --- works -----------------------------------------------------------------


def test_flatten_work_keeps_what_is_readable(spark):
    body = json.dumps({
        "id": "W1", "publication_year": "2020", "fwci": 1.5, "is_retracted": False, "cited_by_count": 3.0,
        "publication_date": "2020-01-02", "created_date": "2020", "updated_date": "2020-01-02T03:04:05.5",
        "primary_location": {"is_oa": True, "source": {"host_organization_lineage_names": ["a", None]}},
        "biblio": "odd", "primary_topic": {"id": "T", "subfield": None},
        "authorships": ["stray", {"author": {"id": "A"}}],
    })
    row = works.flatten_work(spark.createDataFrame([(1, body), (2, "no")], "k int, body string")).orderBy("k")
    first, second = row.collect()
    assert (first["oa_id"], first["oa_publication_year"], first["oa_cited_by_count"]) == ("W1", 2020, 3)
    assert str(first["oa_publication_date"]) == "2020-01-02" and first["oa_created_date"] is None
    assert first["oa_updated_date"].microsecond == 500000
    assert first["oa_primary_location_is_oa"] is True and first["oa_is_retracted"] is False
    lineage = first["oa_primary_location_source_host_org_lineage_names"]
    assert json.loads(lineage) == ["a", None]
    assert first["oa_biblio_volume"] is None and first["oa_primary_topic_id"] == "T"
    assert first["oa_authorships"][0] is None and first["oa_authorships"][1]["author"]["id"] == "A"
    assert set(second.asDict().values()) == {2, None}


def test_fetch_reaches_every_key_once(spark):
    def fetch(keys):
        for key in keys:
            yield {"doi": key, "http_status": 200, "body": key.upper()}

    rows = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "doi string")
    got = lookup.fetch_responses(rows, fetch, tasks=3).select("doi", "http_status", "error_kind", "body")
    assert as_set(got) == [("a", 200, None, "A"), ("b", 200, None, "B")]


SAMPLE = [(1, "10.1/A"), (2, "10.1/a"), (3, "10.2/B"), (4, None), (5, "invalid"), (6, "10.3/C")]
RESPONSES = [
    ("https://doi.org/10.1/a", 200, None, None, '{"id": "W1", "authorships": [{"author": {"id": "A1"}}]}'),
    ("https://doi.org/10.2/b", 404, None, None, None),
]
RESPONSE_DDL = "doi string, http_status int, error_kind string, error_message string, body string"


def prepared(spark, rows=SAMPLE):
    frame = spark.createDataFrame(rows, "seq int, prism_doi string")
    return frame.withColumn("doi", format_doi(F.col("prism_doi")))


def test_enrichment_keeps_misses_and_repeats(spark):
    responses = spark.createDataFrame(RESPONSES, RESPONSE_DDL)
    want = [(1, "Success", "W1"), (2, "Success", "W1"), (3, "DOI Not Found (API 404)", None),
            (6, "DOI Not Found (pyalex)", None)]
    full = enrich.enrich(prepared(spark), responses)
    assert full.columns[:5] == ["seq", "prism_doi", "doi", "oa_status", "oa_id"]
    assert as_set(full.select("seq", "oa_status", "oa_id")) == want


def test_failed_lookups_count_as_processed_unless_retried(spark):
    done = spark.createDataFrame(
        [("https://doi.org/10.1/a", "Success"), ("https://doi.org/10.2/b", "Network Error - Skipped: x")],
        "doi string, oa_status string")
    rows = prepared(spark)
    assert as_set(enrich.unprocessed(rows, done).select("seq")) == [(6,)]
    assert as_set(enrich.unprocessed(rows, done, ["Network Error"]).select("seq")) == [(3,), (6,)]


def test_stream_resumes_and_adds_nothing_twice(spark, tmp_path):
    landing, target, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    responses = spark.createDataFrame(RESPONSES, RESPONSE_DDL)

    def run(rows):
        rows.write.mode("append").parquet(landing)
        incremental.enrich_stream(spark, landing, rows.schema, responses, target, log).awaitTermination()
        return as_set(incremental.enriched_so_far(spark, target).select("seq", "oa_status"))

    first = run(prepared(spark, SAMPLE[:3]))
    assert [s for s, _ in first] == [1, 2, 3]
    again = run(prepared(spark, SAMPLE[:3]))
    assert again == first
    last = run(prepared(spark, SAMPLE))
    assert [s for s, _ in last] == [1, 2, 3, 6]


# --- normalize and load ----------------------------------------------------


def enriched(spark):
    cell = '[{"author":{"id":"A%d"},"author_position":"first","institutions":[{"id":"I1"},{"id":"I2"}],' \
           '"raw_affiliation_strings":["x","y"],"countries":["CN","CN"]}]'
    rows = [(i, f"https://doi.org/10.1/{i % 4}", f"S{i % 5}", "10.1/x", 2020, cell % (i % 3),
             '[{"funder":"F1","award_id":null},{"funder":"F1","award_id":null}]',
             '[{"year":2020,"cited_by_count":1},{"year":2021,"cited_by_count":null}]') for i in range(12)]
    return spark.createDataFrame(
        rows, "seq int, doi string, dc_identifier string, prism_doi string, publication_year int,"
              " oa_authorships string, oa_grants string, oa_counts_by_year string")


def test_ten_tables_are_keyed_and_linked(spark, tmp_path):
    paths = normalize.write_normalized(
        enriched(spark), ["seq"], str(tmp_path / "t"), staging=str(tmp_path / "s"))
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    assert set(tables) == set(TABLES)
    known = tables["publications"].select("doi")
    for name, df in tables.items():
        spec = TABLES[name]
        assert df.columns == spec.columns, name
        assert key_violations(df, spec.dedupe_key).count() == 0, name
        if "doi" in df.columns:
            assert df.join(known, "doi", "left_anti").count() == 0, name
    assert {n: df.count() for n, df in tables.items()} == {
        "raw_scopus_search": 4, "publications": 4, "authors": 3, "institutions": 2, "funders": 1,
        "publication_authorships": 12, "authorship_institutions": 24, "authorship_countries": 12,
        "publication_funding": 4, "publication_citation_counts": 4}


def test_ten_tables_in_delimited_parts(spark, tmp_path):
    paths = normalize.write_normalized(
        enriched(spark), ["seq"], str(tmp_path / "t"), rows_per_part=5, format="csv")
    spec = TABLES["publication_authorships"]
    back = source.scan_csv(spark, paths[spec.name], spec.ddl)
    assert back.count() == 12
    assert len(list((tmp_path / "t" / spec.name).glob("part_id=*/*.csv"))) == 3


def test_normalizing_does_not_depend_on_row_order(spark):
    rows = enriched(spark)
    plain = normalize.normalize(rows, ["seq"])
    mixed = normalize.normalize(rows.orderBy(F.hash("seq")).repartition(5), ["seq"])
    for name in ("raw_scopus_search", "authors", "authorship_institutions"):
        assert as_set(plain[name]) == as_set(mixed[name]), name


def test_load_twice_is_load_once(spark, tmp_path):
    spec = TABLES["raw_scopus_search"]
    tables = {spec.name: normalize.raw_search(normalize.typed_rows(enriched(spark)), ["seq"])}
    for _ in range(2):
        load.load_all(tables, str(tmp_path))
        current = stored.read_current(spark, f"{tmp_path}/{spec.name}", spec)
        assert current.count() == 4 and key_violations(current, spec.key).count() == 0
    newer = tables[spec.name].limit(1).withColumn("publication_year", F.lit(1999))
    load.load_all({spec.name: newer}, str(tmp_path))
    current = stored.read_current(spark, f"{tmp_path}/{spec.name}", spec)
    assert sorted(r[0] for r in current.select("publication_year").collect()) == [1999, 2020, 2020, 2020]


def test_entry_is_registered_whole():
    from __spark_entry__ import oracle_sql, queries
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_two_streams_share_a_target(spark, tmp_path):
    target = str(tmp_path / "out")
    responses = spark.createDataFrame(RESPONSES, RESPONSE_DDL)
    for name, rows in (("a", SAMPLE[:2]), ("b", SAMPLE[2:]), ("b", [])):
        frame = prepared(spark, rows or SAMPLE[:1])
        if rows:
            frame.write.parquet(str(tmp_path / name))
        incremental.enrich_stream(spark, str(tmp_path / name), frame.schema, responses, target,
                                  str(tmp_path / f"log-{name}")).awaitTermination()
    assert as_set(incremental.enriched_so_far(spark, target).select("seq")) == [(1,), (2,), (3,), (6,)]


def test_stored_rows_are_read_by_field(spark, tmp_path):
    rows = normalize.typed_rows(enriched(spark))
    rows.write.parquet(str(tmp_path / "typed"))
    stored_rows = spark.read.schema(rows.schema).parquet(str(tmp_path / "typed"))
    plan = normalize.authorship_countries(stored_rows, ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doi:string,oa_authorships:array<struct<author:struct<id:string>,countries" in plan
