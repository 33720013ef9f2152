"""Order within verses: islands, leading runs, neighbours, interpolation, coherence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(rows: DataFrame, group: list[str], order: list, value: str) -> DataFrame:
    """Consecutive rows of equal value as one: first and last place and their number."""
    w = Window.partitionBy(*group).orderBy(*order)
    change = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    marked = rows.withColumn("__c", change).withColumn("island", F.sum("__c").over(w)).withColumn("__p", F.row_number().over(w) - 1)
    return marked.groupBy(*group, "island").agg(F.first(value).alias(value), F.min("__p").alias("first"), F.max("__p").alias("last"), F.count("*").alias("n"))


def leading_run(rows: DataFrame, group: list[str], order: list, holds: Column, name: str = "leading") -> DataFrame:
    """Mark the rows from the start of a group for as long as the condition holds."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.max(F.when(holds, 0).otherwise(1)).over(w) == 0)


def renumber(rows: DataFrame, group: list[str], order: list, name: str = "idx") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)


def content_ordinal(rows: DataFrame, group: list[str], order: list, content: str = "content") -> DataFrame:
    """The place among content rows alone."""
    return renumber(rows.where(F.col(content)), group, order, "src_ord")


def covered_phrases(pairs: DataFrame) -> DataFrame:
    """For each phrase of a verse with aligned content: its function, first source place and mean target place."""
    rows = pairs.where(F.col("content") & F.col("phrase_id").isNotNull() & F.col("function").isNotNull())
    first = F.min(F.struct("h_idx", "function"))
    return rows.groupBy("ref", "phrase_id").agg(first["function"].alias("function"), F.min("h_idx").alias("src"), F.avg(F.element_at("t_idx", 1)).alias("tgt"), F.max("n_src").alias("n_src"), F.max("n_trg").alias("n_trg"))


def pair_order(phrases: DataFrame, least: int = 30) -> DataFrame:
    """How often neighbouring phrases keep their order in the target, by pair of functions."""
    w = Window.partitionBy("ref").orderBy("src", "phrase_id")
    nxt = phrases.withColumn("fb", F.lead("function").over(w)).withColumn("tb", F.lead("tgt").over(w)).where(F.col("fb").isNotNull())
    out = nxt.groupBy(F.col("function").alias("fa"), "fb").agg(F.count_if(F.col("tgt") < F.col("tb")).alias("kept"), F.count("*").alias("total"))
    return out.where(F.col("total") >= least).withColumn("rate", F.round(F.col("kept") / F.col("total"), 6))


def drift(phrases: DataFrame, least: int = 30) -> DataFrame:
    """Mean shift of a function's relative place from source to target, over verses with two phrases or more."""
    many = phrases.withColumn("k", F.count("*").over(Window.partitionBy("ref"))).where("k >= 2")
    shift = F.col("tgt") / F.col("n_trg") - F.col("src") / F.col("n_src")
    return many.groupBy("function").agg(F.count("*").alias("n"), F.round(F.avg(shift), 6).alias("mean_drift")).where(F.col("n") >= least)


def between(p: Column, b: Column, a: Column, n_src: Column, n_trg: Column) -> Column:
    """The expected target place of p from the anchors (p, t) below and above, null where there is none."""
    line = b["t"] + (p - b["p"]) / (a["p"] - b["p"]) * (a["t"] - b["t"])
    both = b.isNotNull() & a.isNotNull() & (b["p"] != a["p"])
    return F.when(both, line).when(b.isNotNull(), b["t"].cast("double")).when(a.isNotNull(), a["t"].cast("double")).otherwise(p / n_src * n_trg)


def interpolate(rows: DataFrame, group: list[str], place: str, anchor: str, n_src: str, n_trg: str) -> DataFrame:
    """The expected target place: between the nearest anchors below and above, else that of the one there is, else on
    the diagonal. `anchor` is null for rows without one."""
    w = Window.partitionBy(*group).orderBy(place)
    below, above = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    point = F.when(F.col(anchor).isNotNull(), F.struct(F.col(place).alias("p"), F.col(anchor).alias("t")))
    out = rows.withColumn("__b", F.last(point, ignorenulls=True).over(below)).withColumn("__a", F.first(point, ignorenulls=True).over(above))
    return out.withColumn("expected", between(F.col(place), F.col("__b"), F.col("__a"), F.col(n_src), F.col(n_trg))).drop("__b", "__a")


def coherence(pairs: DataFrame, near: int = 3) -> DataFrame:
    """coherent: the nearest target place of an aligned phrase-mate is within `near`; null without a mate."""
    own = pairs.withColumn("pos", F.element_at("t_idx", 1))
    mate = own.select("ref", "phrase_id", F.col("h_idx").alias("m_idx"), F.col("pos").alias("m_pos"))
    met = own.join(mate, ["ref", "phrase_id"]).where("h_idx <> m_idx").groupBy("ref", "h_idx").agg(F.min(F.abs(F.col("pos") - F.col("m_pos"))).alias("gap"))
    return own.join(met, ["ref", "h_idx"], "left").withColumn("coherent", F.col("gap") <= near)


def merged_ranges(ranges: DataFrame, group: list[str], start: str = "verse_start", end: str = "verse_end") -> DataFrame:
    """Overlapping ranges of a group as one: a range opens where it begins beyond the greatest end before it."""
    w = Window.partitionBy(*group).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col(start) <= reach, 0).otherwise(1)
    marked = ranges.where(F.col(start) <= F.col(end)).withColumn("__o", opens).withColumn("__r", F.sum("__o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*group, "__r").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__r")


def verse_groups(ranges: DataFrame, verses: DataFrame, tokens: DataFrame, moved: DataFrame | None = None) -> DataFrame:
    """Pool source tokens by target range: tokens of all verses that fall in a range, numbered anew under its anchor.

    ranges: book, chapter, verse_start, verse_end in target coordinates, overlapping ones counting as one; verses and tokens:
    book, chapter, verse (and idx) of the source. moved: book, chapter, verse, to_chapter, to_verse of the verses that the target
    numbers otherwise; all others keep their place. Groups never cross source chapters, so a chapter that is split gives groups
    in each part, and two that are folded give groups of their own. The anchor is the first source verse that falls on the
    start of the range; without one the range has no group. A verse in no range stands for itself, with any that fall on it.
    """
    key = ["book", "chapter", "verse"]
    to = ["to_chapter", "to_verse"]
    at = verses.select(*key).distinct()
    at = at.join(moved.select(*key, *to), key, "left") if moved is not None else at.select("*", F.lit(None).cast("long").alias(to[0]), F.lit(None).cast("long").alias(to[1]))
    at = at.select(*key, F.coalesce(to[0], "chapter").alias(to[0]), F.coalesce(to[1], "verse").alias(to[1]))
    member = merged_ranges(ranges, ["book", "chapter"]).select("book", F.col("chapter").alias(to[0]), "verse_start", "verse_end", F.explode(F.sequence("verse_start", "verse_end")).alias(to[1]))
    at = at.join(member, ["book", *to], "left").withColumns({c: F.coalesce(c, to[1]) for c in ("verse_start", "verse_end")})
    group = ["book", "chapter", to[0], "verse_start"]
    anchors = at.where(F.col(to[1]) == F.col("verse_start")).groupBy(*group).agg(F.min("verse").alias("anchor"))
    return renumber(tokens.join(at.join(anchors, group).drop(to[1]), key), group, ["verse", "idx"], "pooled_idx")
