"""The additive union as a stream: counts add up, so new pairs only touch their own keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.scratch import folder


def stream_of(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table as a stream, whether it is a folder of files or one file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", at.getName()).parquet(f"{at.getParent().toString()}/*{at.getName()}")


def additive_counts(stream: DataFrame, keys: list[str], high: Column, late: str | None = None, time: str = "ts") -> DataFrame:
    """count and high for each key, kept up to date; with `late` a watermark bounds the state by time."""
    rows = stream.withWatermark(time, late) if late else stream
    return rows.groupBy(*keys).agg(F.count("*").alias("count"), F.count_if(high).alias("high"))


def run_once(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Process what is there in micro-batches and return the last state of every key.

    Each batch writes the keys it changed, with its number, to the shared folder; a batch that is run again writes the
    same folder again, so the result holds each change once.
    """
    top = folder(spark, "stream")
    keys = [c for c in counts.columns if c not in ("count", "high")]

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{top}/out/n={number}")

    q = counts.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{top}/state").queryName(f"q{uuid.uuid4().hex}").foreachBatch(save).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()
    rows = spark.read.parquet(f"{top}/out")
    return rows.groupBy(*keys).agg(F.max(F.struct("batch", "count", "high")).alias("x")).select(*keys, "x.count", "x.high")
