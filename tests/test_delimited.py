import csv
import random

import pytest
from pyspark.sql import functions as F

from bibspark.sources import delimited
from bibspark.sources import files as source

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    names = {SPLIT: "2000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "64"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def texts(rng, n):
    pieces = ["plain", 'say "hi"', "two\nlines", "", "é, ö", '"', '""\n"', "a\r\nb", "x" * 40, "\n\n"]
    return [[str(i), *("".join(rng.choices(pieces, k=rng.randint(1, 4))) for _ in range(2))] for i in range(n)]


def write(path, header, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)


def values(frame, columns):
    return sorted(tuple(r) for r in frame.select(*[F.coalesce(F.col(c), F.lit("")) for c in columns]).collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_in_values_read_by_many_tasks(spark, tmp_path, small_splits, end):
    rows = texts(random.Random(5), 1500)
    rows[700][1] = "long\n" * 1500  # over several splits
    path = str(tmp_path / "a.csv")
    write(path, ["k", "a", "b"], rows, end)
    frame = source.scan_csv(spark, path, "k string, a string, b string")
    assert frame.rdd.getNumPartitions() > 8
    known = delimited.splits(delimited.lines(spark, path))
    assert known.count() > 20 and known.filter("inside").count() > 3
    assert values(frame, "kab") == sorted(map(tuple, rows))
    whole = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
    if end == "\n":  # the reader of whole files changes line breaks within values to those of the file's records
        assert values(whole, "kab") == values(frame, "kab")


def test_each_record_has_its_own_place(spark, tmp_path, small_splits):
    write(tmp_path / "a.csv", ["k", "a", "b"], texts(random.Random(6), 800))
    found = delimited.records(spark, str(tmp_path))
    assert found.count() == found.select("file", "start", "place").distinct().count() == 801


def test_open_value_at_the_end_of_a_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,a\n1,x\n2,"never\nclosed')
    assert values(source.scan_csv(spark, str(tmp_path), "k string, a string"), "ka") == [("1", "x"), ("2", "never\nclosed")]


def test_headers_are_one_scan_each(spark, tmp_path):
    headers = [["a", "b"], ["b", "c", "more"], ["c", "a"]]
    for i in range(100):
        header = headers[i % 3]
        write(tmp_path / f"part {i}.csv", header, [[f"{c}{i}" for c in header]])
    frame = source.scan_csv_parts(spark, [str(tmp_path / f"part {i}.csv") for i in range(100)], "a string, b string, c string", "rest")
    assert frame.columns == ["a", "b", "c", "rest"] and frame.count() == 100
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 3
    row = frame.filter("b = 'b4'").first()
    assert tuple(row) == (None, "b4", "c4", '{"more":"more4"}')
    with pytest.raises(source.MissingColumns):
        source.scan_csv(spark, str(tmp_path), "a string", required=["a"])


def test_malformed_records_are_reported_with_their_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,a,b\n1,x,y\n2,x\n3,"p\nq",y,z\n\n4,,\n')
    got = source.csv_rejects(spark, str(tmp_path)).orderBy("place").collect()
    assert [(r.place, r.record, r.reason) for r in got] == [(2, "2,x", "too few values"), (4, '3,"p\nq",y,z', "too many values")]
    assert all(r.file.endswith("a.csv") and r.start == 0 for r in got)
    assert source.scan_csv(spark, str(tmp_path), "k string").count() == 4


def test_empty_folder_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert source.scan_csv(spark, str(tmp_path), "k string, n int").collect() == []
    assert source.csv_rejects(spark, str(tmp_path)).collect() == []
    with pytest.raises(source.MissingColumns):
        source.scan_csv(spark, str(tmp_path), "k string", required=["k"])
