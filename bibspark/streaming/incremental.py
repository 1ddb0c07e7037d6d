"""Incremental enrichment of landed search rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from bibspark.plans.enrich import enrich, unprocessed
from bibspark.sinks.buckets import BUCKETS, bucket_of
from bibspark.sources.files import read_or_empty


BUCKET = "key_bucket"


def processed_in(spark: SparkSession, target: str, rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """What is written under the buckets that the keys of ``rows`` fall into; other folders are not read."""
    keys = rows.filter(F.col("doi").isNotNull()).select(bucket_of(["doi"], buckets).alias(BUCKET)).distinct()
    touched = [r[0] for r in keys.collect()]  # no more than there are buckets
    done = read_or_empty(spark, target, f"doi string, oa_status string, query string, batch bigint, {BUCKET} int")
    return done.filter(F.col(BUCKET).isin(touched))


def enrich_stream(
    spark: SparkSession,
    landing: str,
    schema: StructType | str,
    responses: DataFrame,
    target: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    retry_statuses: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Enrich what has landed since the last run and stop.

    Each micro-batch leaves out the keys that other batches have written, joins
    the rest to ``responses`` and writes its own ``batch=`` folder below the
    ``query=`` folder of its checkpoint. What is written is laid out by a hash of the
    key in ``buckets`` folders, and a batch reads the keys of the buckets it has keys in,
    not those of all history. A batch that is run again after a failure
    overwrites that folder with the same rows; nothing else is rewritten, so several
    streams may share a target.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # the id that Spark keeps in the checkpoint, the same whenever it is resumed
        query = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        own = (F.col("query") == query) & (F.col("batch") == batch_id)
        done = processed_in(batch.sparkSession, target, batch, buckets).filter(~own)
        rest = unprocessed(batch, done, retry_statuses)
        full = enrich(rest, responses).withColumn(BUCKET, bucket_of(["doi"], buckets))
        (
            full.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy(BUCKET).parquet(f"{target}/query={query}/batch={batch_id}")
        )

    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        reader.load(landing).writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def enriched_so_far(spark: SparkSession, target: str) -> DataFrame:
    """All rows written by all batches."""
    return spark.read.parquet(target).drop("query", "batch", BUCKET)
