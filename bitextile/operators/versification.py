"""Verse numbering schemes: maps between them, which one a text has, and which one its alignment bears out.

A map is a table of what it moves (ref, to); every other reference stays where it is. Maps may send several references to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def table_map(lines: DataFrame, ref: str, to: str, order: str = "line") -> DataFrame:
    """The map ref -> to of a table's lines; of lines with one ref the last counts. Incomplete lines are left out."""
    whole = lines.where(F.col(ref).isNotNull() & F.col(to).isNotNull())
    return whole.groupBy(F.col(ref).alias("ref")).agg(F.max_by(F.col(to), F.col(order)).alias("to"))


def conflicts(moved: DataFrame) -> DataFrame:
    """to, and the references that a map sends there where they are several; one that stays there is among them."""
    stays = moved.select(F.col("to").alias("ref")).distinct().join(moved.select("ref"), "ref", "left_anti").select("ref", F.col("ref").alias("to"))
    met = moved.select("ref", "to").union(stays).groupBy("to").agg(F.sort_array(F.collect_list("ref")).alias("refs"))  # as many as a map folds
    return met.where(F.size("refs") > 1)


def inverted(moved: DataFrame) -> DataFrame:
    """The map back: each target goes to the greatest reference that was moved there, and lies in conflict if others were
    too, or one that did not move. ref, to, conflict."""
    clash = conflicts(moved).select(F.col("to").alias("ref"), F.lit(True).alias("conflict"))
    back = moved.groupBy(F.col("to").alias("ref")).agg(F.max("ref").alias("to"))
    return back.join(clash, "ref", "left").select("ref", "to", F.coalesce("conflict", F.lit(False)).alias("conflict"))


def composed(first: DataFrame, second: DataFrame) -> DataFrame:
    """The map that goes by `first` and then by `second`. ref, to; what ends where it began is left out."""
    then = second.select(F.col("ref").alias("mid"), F.col("to").alias("end"))
    through = first.select("ref", F.col("to").alias("mid")).join(then, "mid", "left").select("ref", F.coalesce("end", "mid").alias("to"))
    alone = second.select("ref", "to").join(first.select("ref"), "ref", "left_anti")
    return through.union(alone).where("ref <> to")


def lost(moved: DataFrame) -> DataFrame:
    """References that a map and its inverse do not bring back: ref, to, back."""
    back = inverted(moved).select(F.col("ref").alias("to"), F.col("to").alias("back"))
    stays = moved.select(F.col("to").alias("ref")).distinct().join(moved.select("ref"), "ref", "left_anti").select("ref", F.col("ref").alias("to"))
    return moved.select("ref", "to").union(stays).join(back, "to").where("back <> ref").select("ref", "to", "back")


def remapped(rows: DataFrame, moved: DataFrame, ref: str = "ref") -> DataFrame:
    """rows with their references as the map has them."""
    t = moved.select(F.col("ref").alias(ref), F.col("to").alias("__to"))
    return rows.join(t, ref, "left").withColumn(ref, F.coalesce("__to", ref)).drop("__to")


def detected(schemes: DataFrame, own: DataFrame, tables: DataFrame, books: list | None = None) -> DataFrame:
    """For each text (iso) the scheme whose last verses its chapters share most: iso, scheme, label, share.

    schemes: scheme, book, chapter, last; own: iso, book, chapter, last; tables: scheme, label, nth (the order in which
    equals win); only chapters that both have count, of the given books.
    """
    a = own if books is None else own.where(F.col("book").isin(*books))
    j = schemes.join(a.withColumnRenamed("last", "own_last"), ["book", "chapter"])
    shares = j.groupBy("iso", "scheme").agg(F.round(F.avg((F.col("last") == F.col("own_last")).cast("double")), 6).alias("share")).join(tables, "scheme")
    best = Window.partitionBy("iso").orderBy(F.desc("share"), "nth")
    return shares.withColumn("r", F.row_number().over(best)).where("r = 1").select("iso", "scheme", "label", "share")


def judged(pairs: DataFrame, tables: DataFrame, found: DataFrame, book) -> DataFrame:
    """The candidate under which the sensitive book has most certain pairs, and whether that is what was detected.

    pairs: iso, label, book, content, covered, high of each source token aligned under each candidate; tables: label, nth.
    """
    tally = pairs.where((F.col("book") == book) & F.col("content")).groupBy("iso", "label").agg(F.count(F.lit(1)).alias("content"), F.count_if("covered").alias("covered"), F.count_if("high").alias("high"))
    nth = tables.groupBy("label").agg(F.min("nth").alias("nth"))
    best = Window.partitionBy("iso").orderBy(F.desc("high"), "nth")
    top = tally.join(nth, "label").withColumn("r", F.row_number().over(best)).where("r = 1").drop("r", "nth")
    return top.join(found.select("iso", F.col("label").alias("detected")), "iso", "left").withColumn("agrees", F.coalesce(F.col("label") == F.col("detected"), F.lit(False)))
