"""Verse corpora: versification schemes, superscriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import leading_run


def scheme_shares(schemes: DataFrame, own: DataFrame, key: list[str]) -> DataFrame:
    """For each scheme the share of chapters whose last verse is that of the text; best first."""
    j = schemes.join(own.withColumnRenamed("last", "own_last"), key)
    out = j.groupBy("scheme").agg(F.round(F.avg((F.col("last") == F.col("own_last")).cast("double")), 6).alias("share"))
    return out.withColumn("place", F.row_number().over(Window.orderBy(F.desc("share"), F.asc("scheme"))))  # a row for each scheme


def superscriptions(tokens: DataFrame, is_title: Column) -> DataFrame:
    """Mark the content tokens from the start of verse 1 for as long as they are title words."""
    run = leading_run(tokens.where("content"), ["ref"], ["h_idx"], is_title, "is_superscription").where("is_superscription").select("ref", "h_idx", "is_superscription")
    return tokens.join(run, ["ref", "h_idx"], "left").withColumn("is_superscription", F.coalesce("is_superscription", F.lit(False)))
