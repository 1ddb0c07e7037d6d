"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "bibspark", **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` adds to them."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # the JVM leaves methods above 8000 bytes uncompiled; wide projections
        # run faster without one fused method of that size
        .config(_METHOD_LIMIT, "8000")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A session on one machine may do without: a folder beside its warehouse serves.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-shared"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def methods_compiled(spark: SparkSession) -> None:
    """Let wide projections run in methods that the JVM compiles, as ``build_session`` does,
    also in a session built elsewhere; a limit that is set there stays."""
    if spark.conf.get(_METHOD_LIMIT, None) is None:
        spark.conf.set(_METHOD_LIMIT, "8000")


_FREE_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a job that writes a table go when the table is written.

    Otherwise they stay on the executors' disks until the driver collects its garbage.
    """
    before = spark.conf.get(_FREE_SHUFFLE, None)
    spark.conf.set(_FREE_SHUFFLE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLE)
        else:
            spark.conf.set(_FREE_SHUFFLE, before)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding a given folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
