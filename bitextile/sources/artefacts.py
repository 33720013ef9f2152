"""Learned results kept under a digest of what they were learned from: computed where they are missing, read where they are not.

The digest covers the files that the inputs are read from (path, length, time of change), or their rows where they come from
no files, and the settings. A result is written under a name of its own and then given its place by one rename; of two
writers that make the same result the later one drops its own. On stores where a rename is no single step, give each run a
root of its own.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def files_digest(df: DataFrame) -> str | None:
    """The digest of the files that df reads, by their metadata alone; None where it reads none."""
    spark, facts = df.sparkSession, []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        facts.append((name, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(json.dumps(facts).encode()).hexdigest() if facts else None


def rows_digest(df: DataFrame) -> str:
    """A digest of the rows of df in any order: sums of two hashes of each, and their number."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    part = lambda at: F.sum(F.conv(F.substring(F.sha2(row, 256), at, 15), 16, 10).cast("decimal(38,0)"))
    r = df.agg(F.count(F.lit(1)).alias("n"), part(1).alias("a"), part(16).alias("b")).first()
    return hashlib.sha256(f"{r['n']}:{r['a']}:{r['b']}".encode()).hexdigest()


def digest_of(inputs: list[DataFrame], settings: dict) -> str:
    own = [files_digest(df) or rows_digest(df) for df in inputs]
    return hashlib.sha256(json.dumps([own, settings], sort_keys=True).encode()).hexdigest()


def kept(spark: SparkSession, root: str, name: str, inputs: list[DataFrame], settings: dict, build: Callable[[], DataFrame]) -> DataFrame:
    """build()'s result for these inputs and settings, from root/name/<digest> if it is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    top, digest = f"{root.rstrip('/')}/{name}", digest_of(inputs, settings)
    path = hadoop(f"{top}/{digest}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop(path, "_SUCCESS")):
        own = hadoop(f"{top}/.{digest}-{uuid.uuid4().hex}")
        try:
            build().write.option("compression", "zstd").parquet(own.toString())
            if not system.exists(path) and system.rename(own, path):
                own = hadoop(path, own.getName())  # where a folder of that name came in between, ours went into it
        finally:
            system.delete(own, True)
    return spark.read.parquet(path.toString())


def stopword_manifest(words: DataFrame, group: str) -> DataFrame:
    """group, n_words and the digest of its words, sorted and joined by newlines."""
    from ..operators.lexicon import canonical_hash

    return canonical_hash(words, group, [F.col("word")], ["word"]).withColumnsRenamed({"rows": "n_words", "sha256": "content_sha256"})


def affix_manifest(words: DataFrame, suffixes: DataFrame, prefixes: DataFrame, stems: DataFrame, group: str) -> DataFrame:
    """group, the numbers of its types, suffixes, prefixes and stems, and the digest of the affixes by rank, as JSON."""
    count = lambda df, n: df.groupBy(group).agg(F.count(F.lit(1)).alias(n))
    listed = lambda df, n: df.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "affix"))), lambda x: x["affix"]).alias(n))  # noqa: E731  as many as `top`
    out = count(words, "n_types").join(count(stems, "n_stems"), group, "left")
    for df, n in ((suffixes, "suffixes"), (prefixes, "prefixes")):
        out = out.join(listed(df, n), group, "left").withColumn(n, F.coalesce(n, F.array().cast("array<string>")))
    text = F.to_json(F.struct("prefixes", "suffixes"))
    return out.select(group, "n_types", F.size("suffixes").cast("long").alias("n_suffixes"), F.size("prefixes").cast("long").alias("n_prefixes"), F.coalesce("n_stems", F.lit(0)).alias("n_stems"), F.sha2(text.cast("binary"), 256).alias("content_sha256"))
