import pytest
from pyspark.sql import functions as F

from bibspark.catalogue import NO_YEAR, NO_YEAR_AT_LOAD, TABLES
from bibspark.plans import load, search
from bibspark.session import fresh_path
from bibspark.sinks import buckets, files, tables
from bibspark.sources import search_pages
from bibspark.streaming import incremental

DDL = "k string, v int"


def stored(spark, rows, tmp_path, name):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, DDL).write.parquet(path)
    return spark.read.parquet(path)


def rows_of(spark, root):
    found = buckets.read_buckets(spark, root, buckets.current(spark, root), DDL)
    return {r.k: r.v for r in found.collect()}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "t")
    first = {f"k{i}": i for i in range(200)}
    buckets.merge(stored(spark, list(first.items()), tmp_path, "a"), root, ["k"], DDL, buckets=16)
    before = buckets.current(spark, root)
    assert rows_of(spark, root) == first and len(before.folders) == 16
    buckets.merge(stored(spark, [("k3", -3), ("new", 7)], tmp_path, "b"), root, ["k"], DDL, buckets=99)
    after = buckets.current(spark, root)
    assert rows_of(spark, root) == {**first, "k3": -3, "new": 7} and after.buckets == 16
    assert 14 <= sum(before.folders[b] == after.folders[b] for b in range(16)) < 16
    # an earlier version stays readable
    assert {r.k: r.v for r in buckets.read_buckets(spark, root, before, DDL).collect()} == first
    empty = spark.createDataFrame([], DDL)
    assert buckets.merge(empty, root, ["k"], DDL).endswith("version=00000002")


def test_a_concurrent_load_fails_and_leaves_no_trace(spark, tmp_path):
    root = str(tmp_path / "t")
    one = stored(spark, [("a", 1)], tmp_path, "a")
    buckets.merge(one, root, ["k"], DDL)
    since = buckets.current(spark, root)
    buckets.merge(stored(spark, [("b", 2)], tmp_path, "b"), root, ["k"], DDL)
    with pytest.raises(buckets.ConcurrentLoad):
        buckets.merge(stored(spark, [("a", 9)], tmp_path, "c"), root, ["k"], DDL, since=since)
    assert rows_of(spark, root) == {"a": 1, "b": 2}


def test_two_writers_of_one_version(spark, tmp_path):
    root = str(tmp_path / "t")
    for writer, bucket in (("x", 1), ("a", 2)):  # as if both had found the place free
        spark.createDataFrame([(writer, 4, bucket, f"data/{writer}")], buckets._ENTRY).coalesce(1).write.mode("append").json(
            f"{root}/versions/version=00000001")
    assert buckets.current(spark, root) == buckets.Version(1, 4, {2: "data/a"})


def test_empty_first_load_and_null_keys(spark, tmp_path):
    root = str(tmp_path / "t")
    buckets.merge(spark.createDataFrame([], DDL), root, ["k"], DDL)
    assert rows_of(spark, root) == {}
    for v in (1, 2):
        buckets.merge(stored(spark, [(None, v)], tmp_path, f"n{v}"), root, ["k"], DDL)
    assert rows_of(spark, root) == {None: 2}


def test_a_load_keeps_count_of_what_it_sets_aside(spark, tmp_path):
    spec = TABLES["raw_scopus_search"]
    rows = spark.createDataFrame(
        [(None, "a", 1, 2020), ("k", "b", 2, None), ("k", "c", 3, None), ("l", "d", 4, 2021)],
        "dc_identifier string, prism_url string, seq int, publication_year int")
    load.load_all({spec.name: rows}, str(tmp_path), {spec.name: ["seq"]})
    root = f"{tmp_path}/{spec.name}"
    got = tables.read_current(spark, root, spec)
    assert {(r.dc_identifier, r.prism_url, r.publication_year) for r in got.collect()} == {
        ("k", "c", NO_YEAR_AT_LOAD), ("l", "d", 2021)}
    assert [r.prism_url for r in tables.read_rejects(spark, root).collect()] == ["a"]
    counts = load.load_counts(rows, root, spec).first()
    assert (counts.n_source, counts.n_rejected, counts.n_loaded, counts.n_replaced) == (4, 1, 2, 1)


def test_rows_without_a_year_are_refreshed(spark, tmp_path):
    path = str(tmp_path / "years")
    ddl = "dc_identifier string, n int, publication_year int"
    files.overwrite_years(spark.createDataFrame([("a", 1, 2020)], ddl), path)
    for n in (2, 3):
        search.refresh_years(spark, path, spark.createDataFrame([("b", n, None), ("a", n, 2020)], ddl), ["n"])
    got = spark.read.parquet(path).select("dc_identifier", "n", "publication_year").collect()
    assert sorted(map(tuple, got)) == [("a", 3, 2020), ("b", 3, NO_YEAR)]


def test_a_batch_reads_the_buckets_of_its_keys(spark, tmp_path):
    target = str(tmp_path / "out")
    rows = spark.range(400).selectExpr("'d' || id as doi", "'Success' as oa_status", "'q' as query", "1L as batch")
    rows.withColumn(incremental.BUCKET, buckets.bucket_of(["doi"], 16)).write.partitionBy(
        "query", "batch", incremental.BUCKET).parquet(target)
    asked = spark.createDataFrame([("d7",), ("d11",), (None,)], "doi string")
    done = incremental.processed_in(spark, target, asked, 16)
    # inputFiles names all files of a scan, so the pruning is read off the plan
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{incremental.BUCKET}" in plan.replace("isnotnull", "")
    assert done.select(incremental.BUCKET).distinct().count() <= 2 and done.count() < 80
    assert {"d7", "d11"} <= {r.doi for r in done.collect()}


def test_chains_of_pages(spark):
    links = [(f"p{i}", f"p{i + 1}" if i < 40 else None) for i in range(41)]
    links += [("x", "y"), ("y", "z"), ("z", "x"), ("tail", "z"), ("alone", None), ("gone", "never landed"), ("p0", "p1"), (None, "p7")]
    frame = spark.createDataFrame(links, "url string, next_url string")
    got = {r.url: (r.start, r.position, r.state) for r in search_pages.page_chains(frame).collect()}
    want = {f"p{i}": ("p0", i, "linked" if i else "first") for i in range(41)}
    want |= {"tail": ("tail", 0, "first"), "alone": ("alone", 0, "first"), "gone": ("gone", 0, "first")}
    # tail precedes z, so z and what follows it hang on tail
    want |= {"z": ("tail", 1, "linked"), "x": ("tail", 2, "linked"), "y": ("tail", 3, "linked")}
    assert got == want
    loop = spark.createDataFrame([("x", "y"), ("y", "z"), ("z", "x")], "url string, next_url string")
    assert {(r.start, r.position, r.state) for r in search_pages.page_chains(loop).collect()} == {(None, None, "loop")}
    assert search_pages.page_chains(loop.limit(0)).collect() == []
