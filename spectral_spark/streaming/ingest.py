"""Nightly increments: what is new, upserts from a stream, stages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import small
from ..sources.catalog import upsert_keep_last

NATURAL_KEY = ("mjd", "hemi", "camera", "expnum")


def new_frames(found: DataFrame, store: DataFrame, keys: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """Frames that the store does not hold."""
    return found.join(store.select(*keys).distinct(), list(keys), "left_anti")


def update_stage(frames: DataFrame, updates: DataFrame, keys: Sequence[str] = ("camera", "expnum"), bits: str = "bits", stage: str = "stage") -> DataFrame:
    """Set stage bits; updates of one frame are or-ed."""
    u = updates.groupBy(*keys).agg(F.bit_or(bits).alias("__b"))
    return frames.join(u, list(keys), "left").withColumn(stage, F.col(stage).bitwiseOR(F.coalesce("__b", F.lit(0).cast("long")))).drop("__b")


def _there(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def merge_stream(source: DataFrame, sink: str, checkpoint: str, partition: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> StreamingQuery:
    """Merge a stream of rows into a Parquet store that is partitioned by a column, all that is there now, then stop.

    merge(base, batch) gives the new rows of the partitions that the batch touches; base is what the store holds of them, so
    state is kept in the store and bounded by those partitions. A batch is written to a staging folder named by its number
    first, and replaces its partitions from there: one that is run again after a failure gives the same store, if merging
    the same rows twice changes nothing.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        base = batch.limit(0)
        if _there(spark, sink):
            base = spark.read.schema(batch.schema).parquet(sink).join(small(batch.select(partition).distinct()), partition, "left_semi")
        staged = f"{sink}-staging/batch-{number}"
        merge(base, batch).select(*batch.columns).write.mode("overwrite").parquet(staged)
        done = spark.read.schema(batch.schema).parquet(staged)
        done.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(sink)

    return source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_stream(source: DataFrame, sink: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], partition: str) -> StreamingQuery:
    """Upsert a stream of rows into a store (see merge_stream): one row for each key, the last by order. The partition is one of the keys."""
    if partition not in keys:
        raise ValueError("the store must be partitioned by one of the keys")
    return merge_stream(source, sink, checkpoint, partition, lambda base, batch: upsert_keep_last(base, upsert_keep_last(batch, batch.limit(0), keys, order), keys, order))


def stream_new_frames(source: DataFrame, sink: str, checkpoint: str, keys: Sequence[str] = NATURAL_KEY, partition: str = "mjd", time: str | None = None, delay: str = "2 days") -> StreamingQuery:
    """Add a stream of found frames to a store; frames whose keys it holds, or that are found again, change nothing.

    With a column of event times, frames found again within the delay are dropped by the engine's own bounded state before
    they reach the store. Frames may come in any order and in any number of runs: of rows with one key the first seen stays,
    of those of one batch the least by all columns. The partition is one of the keys.
    """
    if partition not in keys:
        raise ValueError("the store must be partitioned by one of the keys")
    rows = source if time is None else source.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))

    def merge(base: DataFrame, batch: DataFrame) -> DataFrame:
        one = batch.groupBy(*keys).agg(F.min(F.struct(*batch.columns)).alias("__row")).select("__row.*")
        return base.unionByName(new_frames(one, base, keys))

    return merge_stream(rows, sink, checkpoint, partition, merge)


def stream_stages(source: DataFrame, sink: str, checkpoint: str, keys: Sequence[str] = ("camera", "expnum"), partition: str = "part", bits: str = "bits") -> StreamingQuery:
    """Keep the stage bits of frames (partition, keys, bits) in a store: updates of one frame are or-ed, in whatever order and however often they come."""

    def merge(base: DataFrame, batch: DataFrame) -> DataFrame:
        return base.unionByName(batch).groupBy(*dict.fromkeys([partition, *keys])).agg(F.bit_or(bits).alias(bits))

    return merge_stream(source, sink, checkpoint, partition, merge)
