"""Reading delimited and Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from bibspark import catalogue
from bibspark.functions.dates import publication_month
from bibspark.functions.coerce import to_type
from bibspark.functions.identifiers import format_doi
from bibspark.operators.dedupe import distinct_values
from bibspark.operators.frames import conform, null_tokens, union_by_name
from bibspark.sources import delimited


class MissingColumns(ValueError):
    """An input lacks columns the caller requires."""


def _header_errors(groups: list[list[str]], required: Sequence[str]) -> None:
    missing = [c for c in required if not groups or any(c not in names for names in groups)]
    if missing:
        raise MissingColumns(f"input lacks columns {missing}")


def _declared(frame: DataFrame, header: Sequence[str], types: dict[str, str], rescued: str | None) -> DataFrame:
    """The declared columns of a header, typed; what no one declared as JSON text in ``rescued``."""
    named = [F.col(f"`{c}`") for c in types if c in header]
    if rescued is None:
        return conform(null_tokens(frame.select(*named)), types)
    others = [F.col(f"`{c}`") for c in header if c not in types]
    extra = F.to_json(F.struct(*others)) if others else F.lit("{}")
    kept = frame.select(*named, F.when(extra != "{}", extra).alias(rescued))
    return conform(null_tokens(kept), {**types, rescued: "string"})


def scan_csv(spark: SparkSession, path: str | list[str], ddl: str,
             required: Sequence[str] = (), multi_line: bool = True, rescued: str | None = None) -> DataFrame:
    """The columns declared in ``ddl`` from delimited files with a header.

    Columns are found by name, whatever else the files hold and in whatever
    order; a declared column the files lack is NULL, unless it is ``required``.
    Quoted line breaks, doubled quotes and a byte-order mark are understood, and large
    files are read by many tasks (``sources.delimited``). Missing-value texts become NULL,
    then every value is parsed to its declared type. Files may differ in their headers:
    those of one header are one scan. Values of other columns are kept as JSON text in the
    column ``rescued``, if named. Without ``multi_line`` no value may hold a line break,
    all files share one header, and the text is read once instead of twice.
    """
    types = {f.name: f.dataType.simpleString() for f in _parse_datatype_string(ddl).fields}
    if multi_line:
        groups = delimited.tables(spark, path)
    else:
        reader = spark.read.options(header=True, quote='"', escape='"', encoding="UTF-8")
        header = reader.csv(path).columns
        texts = StructType([StructField(name, StringType()) for name in header])
        groups = [(header, reader.schema(texts).csv(path, enforceSchema=False))]
    _header_errors([names for names, _ in groups], required)
    frames = [_declared(frame, names, types, rescued) for names, frame in groups]
    whole = {**types, rescued: "string"} if rescued else types
    return union_by_name(frames) if frames else conform(spark.createDataFrame([], "_none string"), whole)


def csv_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, place, record, reason): records with more or fewer values than their header.

    ``start`` is the first byte of the split that holds the record, ``place`` its line there.
    """
    frames = [
        frame.filter(F.col(delimited.BROKEN).isNotNull()).select(
            "file", "start", "place", F.col(delimited.BROKEN).alias("record"),
            F.when(F.col(f"`{names[-1]}`").isNull(), F.lit("too few values")).otherwise(F.lit("too many values")).alias("reason"))
        for names, frame in delimited.tables(spark, path)
    ]
    return union_by_name(frames) if frames else spark.createDataFrame(
        [], "file string, start bigint, place bigint, record string, reason string")


def scan_search_csv(spark: SparkSession, path: str | list[str], ddl: str,
                    raw_doi: str = "prism_doi", multi_line: bool = True) -> DataFrame:
    """Search rows from delimited files, with the canonical ``doi`` added."""
    frame = scan_csv(spark, path, ddl, required=[raw_doi], multi_line=multi_line)
    return frame.withColumn("doi", format_doi(F.col(raw_doi)))


def scan_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet parts whose columns may differ, united by column name in one scan."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def scan_csv_parts(spark: SparkSession, paths: Sequence[str], ddl: str, rescued: str | None = None) -> DataFrame:
    """Delimited parts whose headers may differ, as the declared columns; a scan for each header."""
    return scan_csv(spark, list(paths), ddl, rescued=rescued)


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet table at ``path``, or no rows where nothing is there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_stored(spark: SparkSession, path: str, otherwise: StructType | str) -> DataFrame:
    """The Parquet table at ``path`` with the columns its files really have."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], otherwise)


def processed_keys(spark: SparkSession, path: str, key: str = "doi") -> DataFrame:
    """Distinct keys of an earlier output; only that column is read."""
    return distinct_values(read_or_empty(spark, path, f"{key} string"), key)


def backfill_month(df: DataFrame) -> DataFrame:
    """Fill ``publication_month`` of earlier results from the cover date where it is missing."""
    if "prism_coverdate" not in df.columns:
        return df
    day = to_type(F.col("prism_coverdate"), df.schema["prism_coverdate"].dataType, "date")
    dated = df.withColumn("prism_coverdate", day)
    month = publication_month(F.col("prism_coverdate"))
    if "publication_month" in df.columns:
        month = F.coalesce(F.col("publication_month"), month)
    return dated.withColumn("publication_month", month)


def load_search_results(spark: SparkSession, path: str) -> DataFrame:
    """Earlier search results, or none, in the declared columns."""
    table = catalogue.TABLES["raw_scopus_search"]
    return backfill_month(read_or_empty(spark, path, table.schema))
