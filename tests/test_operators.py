import random

import pytest
from pyspark.sql import functions as F

from bibspark.catalogue import TABLES
from bibspark.operators import dedupe, frames, keyed, quality, ranking
from bibspark.plans import normalize


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_first_and_last_with_null_keys(spark):
    rows = [(None, 1), (None, 2), ("a", 3), ("a", 4)]
    frame = spark.createDataFrame(rows, "k string, v int")
    assert as_set(dedupe.keep_first(frame, ["k"], ["v"], carry_order=True)) == as_set(
        spark.createDataFrame([(None, 1), ("a", 3)], "k string, v int"))
    assert as_set(dedupe.keep_last(frame, ["k"], ["v"], carry_order=True)) == as_set(
        spark.createDataFrame([(None, 2), ("a", 4)], "k string, v int"))


def test_order_is_required(spark):
    with pytest.raises(ValueError):
        dedupe.keep_first(spark.range(3), ["id"], [])


def test_dedupe_does_not_depend_on_row_order(spark):
    rows = [(i % 7, i, f"v{i}") for i in range(500)]
    expect = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "k int, seq int, v string").repartition(seed + 2)
        got = as_set(dedupe.keep_first(frame, ["k"], ["seq"]))
        expect = expect or got
        assert got == expect


def test_hot_key_leaves_each_map_task_once(spark):
    """The rank filter runs before the shuffle, so a hot key is cut there."""
    frame = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as seq", "id as v")
    plan = dedupe.keep_first(frame, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_dedupe_counts(spark):
    frame = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert tuple(dedupe.dedupe_counts(frame, ["k"]).first()) == (3, 2, 1)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_a_hot_key_is_split_and_each_side_computed_once(spark, how):
    rows = spark.range(200_000).selectExpr("if(id % 3 = 0, 7, id % 50) as k", "id", "repeat(uuid(), 4) as pad")
    unique = spark.range(0, 40, 2).selectExpr("id as k", "'u' || id as name").union(
        spark.range(1, 40, 2).selectExpr("id as k", "'u' || id as name"))
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        joined = keyed.join_unique(rows, unique, ["k"], how)
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = plan[: plan.index("Initial Plan")]
    assert "skew=true" in final
    assert final.count("Range (0, 200000") == 1


def test_not_in_keeps_rows_without_key(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    done = spark.createDataFrame([("a",), ("a",), (None,)], "other string")
    assert as_set(keyed.not_in(rows, done, "k", "other")) == [("b", 2), (None, 3)]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = keyed.upsert(target, source, ["k"])
    assert as_set(once) == [(1, "a"), (2, "B"), (3, "c")]
    assert as_set(keyed.upsert(once, source, ["k"])) == as_set(once)
    keys = keyed.upsert(target.select("k"), source.select("k"), ["k"])
    assert as_set(keys) == [(1,), (2,), (3,)]


def test_upsert_matches_null_keys(spark):
    target = spark.createDataFrame([("d", None, 1)], "a string, b string, v int")
    source = spark.createDataFrame([("d", None, 2)], "a string, b string, v int")
    assert as_set(keyed.upsert(target, source, ["a", "b"])) == [("d", None, 2)]


def test_row_numbers_and_parts(spark):
    frame = spark.range(1003).selectExpr("(id * 7919) % 1003 as n").repartition(5)
    got = ranking.with_row_number(frame, ["n"]).collect()
    assert sorted(r["row_number"] for r in got) == list(range(1, 1004))
    assert all(r["row_number"] == r["n"] + 1 for r in got)
    parts = ranking.with_part_id(frame, ["n"], 100).groupBy("part_id").count().collect()
    assert sorted((r[0], r[1]) for r in parts) == [(i, 100) for i in range(1, 11)] + [(11, 3)]


def test_top_per_group_with_one_hot_group(spark):
    frame = spark.range(2000).selectExpr("if(id % 3 <> 0, 0, id % 10) as g", "(id * 31) % 2000 as v", "id")
    got = ranking.top_per_group(frame, ["g"], [F.desc("v")], ["id"], limit=4, salts=8).collect()
    want = {}
    for r in frame.collect():
        want.setdefault(r["g"], []).append(r["v"])
    assert {(r["g"], r["v"]) for r in got} == {
        (g, v) for g, vs in want.items() for v in sorted(vs, reverse=True)[:4]}


def test_page_slice_near_and_deep(spark):
    frame = spark.range(7000).repartition(4)
    for start in (50, 6000, 6999):
        got = [r[0] for r in ranking.page_slice(frame, [F.col("id")], start, 3).collect()]
        assert got == list(range(start, min(start + 3, 7000)))


def test_clashing_names_are_refused(spark):
    with pytest.raises(ValueError, match="clash"):
        frames.clean_columns(spark.createDataFrame([(1, 2)], "`a:b` int, `a-b` int"))


def test_conform(spark):
    frame = spark.createDataFrame([("5.7", "x", 1)], "year string, extra string, doi int")
    out = frames.conform(frame, TABLES["publication_citation_counts"].types)
    assert out.columns == ["doi", "year", "cited_by_count"]
    assert out.collect() == [("1", 5, None)]


def test_enriched_layout():
    assert frames.enriched_layout(["a", "prism_doi", "b"], ["oa_id", "b"]) == [
        "a", "prism_doi", "doi", "oa_status", "b", "oa_id"]
    assert frames.enriched_layout(["prism_doi", "doi"], ["oa_id"]) == [
        "prism_doi", "doi", "oa_status", "oa_id"]


def test_null_tokens(spark):
    frame = spark.createDataFrame([("NA",), ("",), ("nan",), ("China",), (None,)], "c string")
    assert [r[0] for r in frames.null_tokens(frame.coalesce(1)).collect()] == [None, None, None, "China", None]


CELLS = {
    '[{"author":{"id":"A1"},"countries":["CN","CN",""]}]': ["A1"],
    '["s",{"author":{"id":"A2"}}]': ["A2"],
    '[{"author":"oops"},{"author":{"id":"A3"}}]': ["A3"],
    '{"author":{"id":"A4"}}': [],
    '[null,{"author":{"id":"A8"}}]': ["A8"],
    '[{"author":{"id":"A6"},"countries":"CN"}]': ["A6"],
    "[]": [], "bad": [], None: [], "null": [],
    '"[{\\"author\\":{\\"id\\":\\"A5\\"}}]"': ["A5"],
    '[{"author":{"id":""}},{"author":{}},{}]': [],
}


def test_list_cells(spark):
    rows = [(f"d{i}", i, cell) for i, cell in enumerate(CELLS)]
    enriched = spark.createDataFrame(rows, "doi string, seq int, oa_authorships string")
    typed = normalize.typed_rows(enriched)
    links = normalize.publication_authorships(typed, ["seq"])
    got = {(r["doi"], r["oa_author_id"]) for r in links.collect()}
    assert got == {(f"d{i}", a) for i, ids in enumerate(CELLS.values()) for a in ids}
    countries = normalize.authorship_countries(typed, ["seq"])
    assert as_set(countries) == [("d0", "A1", "CN")]


def test_parsing_happens_once(spark):
    enriched = spark.createDataFrame([("d", 1, "[]")], "doi string, seq int, oa_authorships string")
    links = normalize.publication_authorships(normalize.typed_rows(enriched), ["seq"])
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_rejects(spark):
    frame = spark.createDataFrame([("[1]",), ("{}",), ("no",), ("null",), (None,)], "c string")
    good, bad = quality.split_rejects(frame, "c")
    assert as_set(good) == [("[1]",), (None,)]
    assert as_set(bad) == [("no", "invalid json"), ("null", "not a list"), ("{}", "not a list")]


def test_first_seen_attributes_are_not_merged(spark):
    cells = ['[{"author":{"id":"A","display_name":null}}]', '[{"author":{"id":"A","display_name":"Late"}}]']
    enriched = spark.createDataFrame(
        [(f"d{i}", i, c) for i, c in enumerate(cells)], "doi string, seq int, oa_authorships string")
    authors = normalize.authors(normalize.typed_rows(enriched), ["seq"])
    assert authors.collect() == [("A", None, None)]
