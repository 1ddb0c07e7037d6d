"""Work that must not be done twice, and rows that must not be moved or kept at their full width."""

import datetime

import pytest
from pyspark.sql import functions as F

from bibspark import catalogue
from bibspark.functions.cells import parse_list
from bibspark.llm.rows import written
from bibspark.operators import quality, works
from bibspark.plans import normalize
from bibspark.session import fresh_path, shared_folder, shuffles_freed
from bibspark.sinks import tables
from bibspark.sinks.files import part_counts, write_parts
from checks import feed, queries


@pytest.fixture(scope="module")
def tables_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("given"))
    day = datetime.datetime(1996, 9, 13)
    lines = [(i // 3, i % 7, i % 4, i % 3 + 1, 5.0, 10.0 + i, (i % 11) / 100, 0.02, "NRA"[i % 3], "OF"[i % 2], day) for i in range(300)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                          " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                          " l_linestatus string, l_shipdate timestamp").write.parquet(f"{root}/lineitem.parquet")
    spark.range(4).selectExpr("id as s_suppkey", "'Supplier ' || id as s_name", "cast(id % 2 as int) as s_nationkey").write.parquet(f"{root}/supplier.parquet")
    spark.range(2).selectExpr("cast(id as int) as n_nationkey", "'Nation ' || id as n_name", "0 as n_regionkey").write.parquet(f"{root}/nation.parquet")
    spark.range(1).selectExpr("cast(id as int) as r_regionkey", "'Region' as r_name").write.parquet(f"{root}/region.parquet")
    spark.range(7).selectExpr("id as p_partkey", "'Brand' as p_brand", "'Type' as p_type").write.parquet(f"{root}/part.parquet")
    return root


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f and f.endswith(".data")}


@pytest.mark.parametrize("cells", [feed.works, feed.responses, feed.authorship_cells, feed.grant_cells, feed.count_cells, feed.enriched_rows])
def test_json_is_made_behind_the_shuffles(spark, tables_dir, cells):
    """Only narrow rows move; the input is neither shuffled nor stored with its JSON."""
    df = cells(spark, tables_dir)
    assert df.count() == 300
    assert not any(shared_folder(spark) in f for f in df.inputFiles())
    below = plan(df).split("RepartitionByExpression", 1)
    assert "StructsToJson" in below[0] and "StructsToJson" not in below[1]


def test_rejected_cells_are_not_judged_in_a_filter(spark, tables_dir):
    kept, rejected = quality.split_rejects(feed.authorship_cells(spark, tables_dir), "oa_authorships")
    for side in (kept, rejected):
        assert plan(side).count("parseJson(") == 1
        assert not any("parseJson(" in line for line in plan(side).splitlines() if "Filter" in line or "Join" in line)
    reasons = {r[0] for r in rejected.select("reject_reason").distinct().collect()}
    assert reasons == {"invalid json", "not a list"}
    assert kept.count() + rejected.count() == 300


def test_star_join_parses_each_cell_once(spark, tables_dir, monkeypatch):
    """The three tables come from stored authorships, not from three parses of the cells."""
    seen = []
    for name in ("authorship_institutions", "authors", "institutions"):
        build = normalize.BUILDERS[name]
        monkeypatch.setitem(normalize.BUILDERS, name, lambda rows, order, build=build: seen.append(plan(rows)) or build(rows, order))
    assert queries.star_join_read(spark, tables_dir).count() > 0
    assert len(seen) == 3 and not any("parseJson(" in p for p in seen)


def test_load_computes_its_source_once(spark):
    """Rows to keep and rows to set aside are both read from the stored source."""
    done = spark.sparkContext.accumulator(0)

    def counted(x):
        done.add(1)
        return x

    note = F.udf(counted, "string")
    spec = catalogue.TABLES["raw_scopus_search"]
    source = spark.range(100).selectExpr("if(id % 5 = 0, null, 'SID:' || id % 40) as dc_identifier", "id", "'u' || id as url")
    source = source.select("dc_identifier", "id", note("url").alias("prism_url"))
    root, rejects = fresh_path(spark, "loaded"), fresh_path(spark, "rejects")
    tables.load_table(source, root, spec, ["id"], rejects)
    assert done.value == 100
    assert spark.read.parquet(rejects).count() == 20
    assert tables.read_current(spark, root, spec).count() == 32


def test_shuffles_go_when_the_table_is_written(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(spark), spark.conf.get(key, None)
    with shuffles_freed(spark):
        spark.range(1000).repartition(3, "id").write.parquet(fresh_path(spark, "freed"))
    assert not shuffle_files(spark) - before
    assert spark.conf.get(key, None) == was


def test_a_written_stage_of_an_operator_leaves_no_shuffles(spark):
    before = shuffle_files(spark)
    stage = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "stage")
    assert not shuffle_files(spark) - before
    assert stage.count() == 7


def test_normalized_tables_leave_no_shuffles(spark, tables_dir):
    enriched = feed.enriched_rows(spark, tables_dir)
    before = shuffle_files(spark)
    paths = normalize.write_normalized(enriched, feed.LINE_ORDER, fresh_path(spark, "normalized"), staging=fresh_path(spark, "typed"))
    assert len(paths) == 10 and not shuffle_files(spark) - before


def test_exact_parts_leave_no_shuffles(spark, tmp_path):
    before = shuffle_files(spark)
    write_parts(spark.range(1000).repartition(3, "id"), str(tmp_path / "parts"), ["id"], 300)
    assert not shuffle_files(spark) - before
    assert sorted(r.n_rows for r in part_counts(spark, str(tmp_path / "parts")).collect()) == [100, 300, 300, 300]


@pytest.mark.parametrize("given", [None, "60000"])
def test_wide_projections_are_compiled_in_any_session(spark, given):
    limit = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(limit)
    try:
        spark.conf.unset(limit) if given is None else spark.conf.set(limit, given)
        bodies = spark.createDataFrame([('{"id": "W1", "fwci": 0.5}',)], "body string")
        row = works.flatten_work(bodies).first()
        assert (row.oa_id, row.oa_fwci) == ("W1", 0.5)
        assert spark.conf.get(limit) == (given or "8000")
    finally:
        spark.conf.set(limit, was)


def test_links_make_only_the_fields_they_take(spark, tables_dir, monkeypatch):
    whole = normalize.publication_authorships(normalize.typed_rows(feed.authorship_cells(spark, tables_dir)), feed.LINE_ORDER)
    made = []
    monkeypatch.setattr(normalize, "parse_list", lambda cell, kind: made.append(kind) or parse_list(cell, kind))
    links = queries._authorships(spark, tables_dir)
    assert len(made) == 1 and not any(name in made[0] for name in ("orcid", "institutions", "countries"))
    rows = sorted(map(str, links.collect()))
    assert rows and rows == sorted(map(str, whole.collect()))


def test_a_narrow_type_keeps_rows_with_bad_elements(spark):
    cells = ['[{"author": {"id": "A", "orcid": 3}, "author_position": "first", "is_corresponding": "x"}, "stray", null]',
             '[{"author": "oops", "raw_author_name": {"a": 1}}, {"author": {"id": "B"}, "institutions": "none"}]', "not json", '{"author": 1}', None, "[]"]
    rows = spark.createDataFrame([(i, f"d{i}", c) for i, c in enumerate(cells)], "seq int, doi string, oa_authorships string")
    taken = ["seq", "oa_authorships.author.id", "oa_authorships.author_position", "oa_authorships.is_corresponding", "oa_authorships.raw_author_name"]
    whole = normalize.typed_rows(rows).select(*taken).orderBy("seq").collect()
    assert normalize.typed_rows(rows, {"oa_authorships": catalogue.AUTHORSHIP_LINKS_TYPE}).select(*taken).orderBy("seq").collect() == whole
