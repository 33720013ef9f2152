"""The additive union as a stream gives the batch result."""

from pyspark.sql import functions as F

from bitextile.streaming.incremental import additive_counts, run_once, stream_of


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") % 7).alias("k"), (F.col("id") % 100).cast("double").alias("value"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    for n, part in enumerate(rows.randomSplit([1.0, 1.0, 1.0], 3)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    high = F.col("value") >= 50
    stream = stream_of(spark, str(tmp_path / "t.parquet"), rows.schema)
    out = {r["k"]: (r["count"], r["high"]) for r in run_once(spark, additive_counts(stream, ["k"], high)).collect()}
    want = {r["k"]: (r["count"], r["high"]) for r in additive_counts(rows, ["k"], high).collect()}
    assert out == want


def test_late_rows_are_bounded(spark, tmp_path):
    rows = spark.range(100).select(F.timestamp_seconds(F.col("id")).alias("ts"), F.lit(1.0).alias("value"))
    rows.coalesce(1).write.parquet(str(tmp_path / "t"))
    stream = stream_of(spark, str(tmp_path / "t"), rows.schema).withColumn("minute", F.date_trunc("minute", "ts"))
    out = run_once(spark, additive_counts(stream, ["minute"], F.col("value") > 0, late="1 minute"))
    assert out.agg(F.sum("count")).first()[0] == 100
