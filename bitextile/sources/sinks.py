"""Writers of datasets and their manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parquet(df: DataFrame, root: str, by: str = "iso", digits: dict[str, int] | None = None, tasks: int = 8, rows: int = 5_000_000) -> None:
    """A dataset partitioned by a column; only the partitions in df are replaced, so a job may be run again.

    A large partition is dealt to `tasks` tasks by a hash of its rows, and a file has at most `rows` rows.
    """
    for c, n in (digits or {}).items():
        df = df.withColumn(c, F.round(c, n).cast("float"))
    spread = F.pmod(F.xxhash64(*(c for c, kind in df.dtypes if not kind.startswith("map"))), F.lit(tasks))
    df.repartition(F.col(by), spread).write.option("maxRecordsPerFile", rows).partitionBy(by).mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(root)


def tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def pair_jsonl(pairs: DataFrame, root: str) -> None:
    """A line for each verse with its pairs in order, by method, tag and book, verses in order."""
    own = [c for c in pairs.columns if c not in ("ref", "book", "chapter", "verse", "method", "tag")]
    verses = pairs.groupBy("method", "tag", "book", "ref", "chapter", "verse").agg(F.array_sort(F.collect_list(F.struct(*own))).alias("pairs"))
    verses.repartition("method", "tag", "book").sortWithinPartitions("method", "tag", "book", "ref").write.partitionBy("method", "tag", "book").mode("overwrite").json(root)


def compact(verses: DataFrame, root: str) -> None:
    """verses: iso, edition, book, book_hash, ref, compact; a folder for each, named by the content hash."""
    verses.withColumn("file", F.concat_ws("-", "book", "book_hash")).repartition("iso", "edition", "file").sortWithinPartitions("iso", "edition", "file", "ref").select("iso", "edition", "file", "ref", "compact").write.partitionBy("iso", "edition", "file").mode("overwrite").json(root)


def priors_tsv(counts: DataFrame, path: str, top: int = 10, min_count: int = 2) -> None:
    tsv(priors_rows(counts, top, min_count), path)


def priors_rows(counts: DataFrame, top: int = 10, min_count: int = 2) -> DataFrame:
    """strong and its most frequent glosses joined by '; '. counts: strong, gloss, count."""
    from ..operators.lexicon import top_k

    best = top_k(counts.where(F.col("count") >= min_count), ["strong"], [F.desc("count"), F.asc("gloss")], top)
    return best.groupBy("strong").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "gloss"))), lambda x: x["gloss"]), "; ").alias("gloss"))


def report(df: DataFrame, rows: int = 10) -> str:
    """The first rows as a Markdown table."""
    head = df.columns
    lines = ["| " + " | ".join(head) + " |", "|" + "-|" * len(head)]
    return "\n".join(lines + ["| " + " | ".join(str(r[c]) for c in head) + " |" for r in df.limit(rows).collect()])
