"""Keyed tables kept in buckets of their key and changed bucket by bucket.

A table is a folder of versions. A version is one small file that names, for every bucket
that has rows, the folder that holds them; the rows are plain Parquet below ``data``. A
load reads and rewrites only the buckets its keys fall into, and the next version takes
the folders of all others over. Readers use the newest version, so they see a load as a
whole or not at all, and folders are never changed once a version names them.

Two loads that begin from the same version cannot both become the next one: the later
one finds it there and fails, without a trace in the table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bibspark.operators.keyed import upsert
from bibspark.session import shuffles_freed

BUCKETS = 16  # for tables of some GB; name more for larger ones, so that a bucket stays small
_BUCKET = "_bucket"
_ENTRY = "writer string, buckets int, bucket int, folder string"


class ConcurrentLoad(RuntimeError):
    """Another load has changed the table since this one began."""


@dataclass(frozen=True)
class Version:
    """What one version of a table is made of."""

    number: int = 0
    buckets: int = 0
    folders: dict[int, str] = field(default_factory=dict)


def bucket_of(keys: Sequence[str], buckets: int):
    """The bucket of a row, the same in every load; a NULL in a key is a value like others."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _versions(spark: SparkSession, root: str) -> list[int]:
    try:
        files = spark.read.text(f"{root}/versions").inputFiles()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []
    return sorted({int(m.group(1)) for m in (re.search(r"/version=(\d+)/", f) for f in files) if m})


def _entries(spark: SparkSession, root: str, number: int) -> list:
    """What a version says. Where two loads wrote it at the same moment, the first by name counts."""
    rows = spark.read.schema(_ENTRY).json(f"{root}/versions/version={number:08d}").collect()
    writer = min(r.writer for r in rows)
    return [r for r in rows if r.writer == writer]


def current(spark: SparkSession, root: str) -> Version:
    """The newest version; number 0 before the first."""
    numbers = _versions(spark, root)
    if not numbers:
        return Version()
    rows = _entries(spark, root, numbers[-1])
    return Version(numbers[-1], rows[0].buckets, {r.bucket: r.folder for r in rows if r.bucket is not None})


def read_buckets(spark: SparkSession, root: str, version: Version, schema: StructType | str,
                 buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version, of the given buckets only."""
    folders = [f"{root}/{f}" for b, f in sorted(version.folders.items()) if buckets is None or b in buckets]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def _publish(spark: SparkSession, root: str, version: Version, writer: str) -> str:
    path = f"{root}/versions/version={version.number:08d}"
    rows = [(writer, version.buckets, b, f) for b, f in sorted(version.folders.items())] or [(writer, version.buckets, None, None)]
    late = f"version {version.number} of {root} was published by another load"
    try:
        spark.createDataFrame(rows, _ENTRY).coalesce(1).write.mode("errorifexists").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise ConcurrentLoad(late) from error
    if _entries(spark, root, version.number)[0].writer != writer:
        raise ConcurrentLoad(late)
    return path


def merge(source: DataFrame, root: str, keys: Sequence[str], schema: StructType | str,
          buckets: int = BUCKETS, since: Version | None = None) -> str:
    """Upsert ``source``, which has one row per key, and return the path of the new version.

    ``buckets`` counts for the first load of a table and stays as it is from then on. The
    load begins ``since`` a version, the newest by default. ``source`` is read twice, for
    its buckets, which takes its keys only, and for its rows: hand in one that rests on a stored table.
    """
    spark = source.sparkSession
    before = since or current(spark, root)
    buckets = before.buckets or buckets
    placed = source.withColumn(_BUCKET, bucket_of(keys, buckets))
    touched = [r[0] for r in placed.select(_BUCKET).distinct().collect()]  # no more than there are buckets
    if not touched and before.number:
        return f"{root}/versions/version={before.number:08d}"
    old = read_buckets(spark, root, before, schema, touched)
    writer = uuid.uuid4().hex
    merged = upsert(old, source.select(*old.columns), keys).withColumn(_BUCKET, bucket_of(keys, buckets))
    # a bucket is written by the tasks that hold its rows; a heavy one is split at run time
    with shuffles_freed(spark):
        merged.hint("rebalance", F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(f"{root}/data/{writer}")
    folders = {**before.folders, **{b: f"data/{writer}/{_BUCKET}={b}" for b in touched}}
    return _publish(spark, root, Version(before.number + 1, buckets, folders), writer)
