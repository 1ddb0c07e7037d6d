"""Abstract refresh, whole search entries and rejected cells."""

import json

from pyspark.sql import functions as F

from bibspark.operators.quality import rejected_cells
from bibspark.plans.abstracts import read_abstracts, refresh_abstracts
from bibspark.plans.normalize import write_normalized
from bibspark.sources.files import scan_csv
from bibspark.sources.search_pages import entries, search_records


def _abstract(identifier, title):
    return json.dumps({"abstracts-retrieval-response": {
        "coredata": {"dc:identifier": identifier, "dc:title": title,
                     "dc:creator": {"author": [{"ce:indexed-name": "A", "affiliation": {"@id": "1"}}, {}]}},
        "affiliation": [{"affilname": "U", "affiliation-city": "C"}]}})


def test_abstract_refresh_sets_unreadable_aside_and_keeps_the_newest(spark, tmp_path):
    search = spark.createDataFrame([("d1",), ("d1",), ("d2",), (None,), ("d4",)], "prism_doi string")
    bodies = spark.createDataFrame([
        ("d1", _abstract("I1", "old"), 1), ("d1", _abstract("I1", "new"), 2),
        ("d2", "{broken", 1), ("d3", _abstract("I3", "not asked for"), 1),
    ], "prism_doi string, body string, fetched int")
    root, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    for _ in range(2):
        refresh_abstracts(search, bodies, ["fetched"], root, rejects)
    [row] = read_abstracts(spark, root).collect()
    assert (row.dc_identifier, row.dc_title) == ("I1", "new")
    assert json.loads(row.affiliations) == [{"name": "U", "city": "C", "country": None}]
    assert json.loads(row.authors) == [{"name": "A", "affiliation": "1"}, {"name": None, "affiliation": None}]
    assert [r.requested_doi for r in spark.read.parquet(rejects).collect()] == ["d2"]


def test_abstract_refresh_of_nothing_is_empty(spark, tmp_path):
    none = spark.createDataFrame([], "prism_doi string, body string, fetched int")
    refresh_abstracts(none, none, ["fetched"], str(tmp_path / "t"))
    assert read_abstracts(spark, str(tmp_path / "t")).count() == 0


def test_entries_keep_all_that_the_page_says(spark):
    page = {"search-results": {"entry": [
        {"@_fa": "true", "dc:identifier": "I1", "prism:url": "u", "subtype": "ar", "extra": {"deep": [1]}}, "stray"]}}
    pages = spark.createDataFrame([("p", json.dumps(page))], "url string, body string")
    [found] = entries(pages).collect()
    assert json.loads(found.entry_json) == page["search-results"]["entry"][0]
    [row] = search_records(pages).collect()
    assert (row.fa, row.prism_url, row.subtype, row.dc_identifier) == (True, "u", "ar", "I1")


def test_unusable_cells_are_written_with_their_reason(spark, tmp_path):
    rows = spark.createDataFrame([
        (1, "d1", "nope", "[]"), (2, "d2", '{"a": 1}', None), (3, "d3", None, "[null]"), (4, None, "nope", "nope"),
    ], "seq int, doi string, oa_authorships string, oa_grants string")
    found = rejected_cells(rows, ["oa_authorships", "oa_grants"], ["seq"])
    assert sorted((r.seq, r.cell, r.reject_reason) for r in found.collect()) == [
        (1, "oa_authorships", "invalid json"), (2, "oa_authorships", "not a list"),
        (4, "oa_authorships", "invalid json"), (4, "oa_grants", "invalid json")]
    path = str(tmp_path / "rejects")
    full = rows.selectExpr("*", "'[]' as oa_counts_by_year", "'I' || seq as dc_identifier")
    write_normalized(full, ["seq"], str(tmp_path / "tables"), rejects=path)
    assert sorted(r.seq for r in spark.read.parquet(path).collect()) == [1, 2]


def test_files_without_line_breaks_in_values_are_split(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("﻿seq,note\n" + "".join(f'{i},"a ""{i}"", b"\n' for i in range(20000)), encoding="utf-8")
    name, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(name, "65536")
    try:
        frame = scan_csv(spark, str(path), "seq int, note string", multi_line=False)
        assert frame.select(F.spark_partition_id()).distinct().count() > 1
        assert {(r.seq, r.note) for r in frame.collect()} == {(i, f'a "{i}", b') for i in range(20000)}
    finally:
        spark.conf.set(name, before)
