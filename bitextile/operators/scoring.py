"""Scoring against gold: tiers, trust, contests, agreement, merging of methods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import wilson


def tier_precision(judged: DataFrame) -> DataFrame:
    """Judged pairs and hits by tier, by part of speech, by both and in all, in one pass."""
    both = judged.cube("tier", "pos").agg(F.count("*").alias("n"), F.count_if("hit").alias("correct"), F.grouping_id().alias("level"))
    return both.withColumn("precision", F.round(F.col("correct") / F.col("n"), 6))


def trust(judged: DataFrame, keys: list[str], least: int = 25) -> DataFrame:
    """For each key: pooled precision, spread of languages with `least` rows, and the weight: Wilson bound less half
    the spread, 0 at least."""
    by = judged.groupBy(*keys, "iso").agg(F.count("*").alias("n"), F.count_if("hit").alias("c"))
    p = F.when(F.col("n") >= least, F.col("c") / F.col("n"))
    out = by.withColumn("p", p).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("c").alias("c"), F.count("p").alias("langs"), (F.max("p") - F.min("p")).alias("spread"))
    spread = F.coalesce("spread", F.lit(0.0))
    return out.select(*keys, "n", "langs", F.round(F.col("c") / F.col("n"), 6).alias("pooled"), F.round(spread, 6).alias("spread"), F.round(F.greatest(F.lit(0.0), wilson(F.col("c"), F.col("n")) - spread / 2), 6).alias("weight"))


def contested(a: DataFrame, b: DataFrame) -> DataFrame:
    """Source tokens that both methods have with other targets. Columns of a: ref, h_idx, target, hit; b the same and tier."""
    y = b.select("ref", "h_idx", F.col("target").alias("gl_target"), F.col("hit").alias("gl_hit"), "gl_tier")
    x = a.select("ref", "h_idx", F.col("target").alias("ef_target"), F.col("hit").alias("ef_hit"), "ef_tier", "iso")
    return x.join(y, ["ref", "h_idx"]).where("ef_target <> gl_target")


def contest_rule(pairs: DataFrame, least: int = 15) -> DataFrame:
    """For each pair of tiers the method that wins alone more often; gloss only with `least` decided cases."""
    out = pairs.groupBy("ef_tier", "gl_tier").agg(F.count_if(F.col("ef_hit") & ~F.col("gl_hit")).alias("ew"), F.count_if(F.col("gl_hit") & ~F.col("ef_hit")).alias("gw"))
    return out.withColumn("rule", F.when((F.col("gw") > F.col("ew")) & (F.col("ew") + F.col("gw") >= least), "gl").otherwise("ef"))


def contest_leave_one_out(pairs: DataFrame, least: int = 15) -> DataFrame:
    """Accuracy for each language of the rule fitted on the others: totals less its own counts."""
    by = pairs.groupBy("ef_tier", "gl_tier", "iso").agg(
        F.count_if(F.col("ef_hit") & ~F.col("gl_hit")).alias("ew"), F.count_if(F.col("gl_hit") & ~F.col("ef_hit")).alias("gw"),
        F.count_if("ef_hit").alias("ef"), F.count_if("gl_hit").alias("gl"), F.count("*").alias("n"), F.count_if(F.col("ef_hit") | F.col("gl_hit")).alias("best"),
    )
    w = Window.partitionBy("ef_tier", "gl_tier")
    e, g = F.sum("ew").over(w) - F.col("ew"), F.sum("gw").over(w) - F.col("gw")
    ruled = by.withColumn("rule", F.when((g > e) & (e + g >= least), "gl").otherwise("ef"))
    ok = F.when(F.col("rule") == "gl", F.col("gl")).otherwise(F.col("ef"))
    return ruled.groupBy("iso").agg(F.sum("n").alias("n"), F.sum(ok).alias("correct"), F.sum("best").alias("oracle"), F.round(F.sum(ok) / F.sum("n"), 6).alias("accuracy"))


def gold_free(ef: DataFrame, gl: DataFrame, judged: DataFrame) -> DataFrame:
    """By language, of the source tokens that both methods have: how many agree, are links of both directions, and are
    contested where the gold could judge.

    ef: iso, ref, h_idx, target, score, strong; gl: ref, h_idx, target; judged: the ref and strong that the gold has.
    """
    both = ef.select("iso", "ref", "h_idx", "strong", "score", F.col("target").alias("e")).join(gl.select("ref", "h_idx", F.col("target").alias("g")), ["ref", "h_idx"])
    both = both.join(judged.select("ref", "strong").distinct().withColumn("seen", F.lit(True)), ["ref", "strong"], "left")
    same = F.col("e") == F.col("g")
    share = lambda c, n: F.round(F.count_if(c) / F.count("*"), 6).alias(n)
    return both.groupBy("iso").agg(F.count("*").alias("both"), share(same, "agree_rate"), share(F.col("score") == 0.9, "ef09_share"), share(~same & F.coalesce("seen", F.lit(False)), "contested_share"))


def tilt(contests: DataFrame, least: int = 15) -> DataFrame:
    """By language: the share of contests that a rule fitted on that language alone gives to the glosses, and its accuracy
    beside that of the rule of all languages, of links alone, and of the better one of each contest. contests as of contested()."""
    by = contests.groupBy("iso", "ef_tier", "gl_tier").agg(
        F.count_if(F.col("ef_hit") & ~F.col("gl_hit")).alias("ew"), F.count_if(F.col("gl_hit") & ~F.col("ef_hit")).alias("gw"), F.count("*").alias("n"),
        F.count_if("ef_hit").alias("ef"), F.count_if("gl_hit").alias("gl"), F.count_if(F.col("ef_hit") | F.col("gl_hit")).alias("best"),
    )
    w = Window.partitionBy("ef_tier", "gl_tier")
    every = F.when((F.sum("gw").over(w) > F.sum("ew").over(w)) & (F.sum("ew").over(w) + F.sum("gw").over(w) >= least), "gl").otherwise("ef")
    ruled = by.withColumn("own", F.when((F.col("gw") > F.col("ew")) & (F.col("ew") + F.col("gw") >= least), "gl").otherwise("ef")).withColumn("all", every)
    right = lambda rule: F.sum(F.when(F.col(rule) == "gl", F.col("gl")).otherwise(F.col("ef")))
    share = lambda c, n: F.round(c / F.sum("n"), 6).alias(n)
    return ruled.groupBy("iso").agg(
        F.sum("n").alias("contested"), share(F.sum(F.when(F.col("own") == "gl", F.col("n")).otherwise(0)), "gl_share"), share(right("own"), "tailored"), share(right("all"), "universal"),
        share(F.sum("ef"), "always_ef"), share(F.sum("best"), "oracle"),
    )


def gold_health(pairs: DataFrame, gold: DataFrame) -> DataFrame:
    """For each language: hits at the same verse and hits anywhere in the gold lexicon; a wide gap marks shifted gold."""
    here = gold.select("ref", "strong", "word1").distinct().withColumn("here", F.lit(True))
    any_ = gold.select("strong", "word1").distinct().withColumn("any", F.lit(True))
    j = pairs.join(here, ["ref", "strong", "word1"], "left").join(any_, ["strong", "word1"], "left")
    out = j.groupBy("iso").agg(F.count("*").alias("n"), F.count("here").alias("positional"), F.count("any").alias("lexical"))
    return out.withColumn("gap", F.round((F.col("lexical") - F.col("positional")) / F.col("n"), 6))


def usable(health: DataFrame, least: int = 1000, rate: float = 0.05) -> DataFrame:
    """Languages with enough judged pairs of which enough are hits: iso, n, rate. health: iso, n, positional."""
    share = F.col("positional") / F.col("n")
    return health.where((F.col("n") >= least) & (share >= rate)).select("iso", "n", F.round(share, 6).alias("rate"))


def status_rollup(rows: DataFrame) -> DataFrame:
    """Tokens by status, over all and over content tokens."""
    return rows.groupBy("status").agg(F.count("*").alias("all_tokens"), F.count_if("content").alias("content_tokens"))


def reverse_check(spine: DataFrame, pairs: DataFrame, target_count: str = "n_trg") -> DataFrame:
    """Every source token with what became of it: aligned, pooled_non_anchor, truly_skipped (no target there) or
    unaligned."""
    own = pairs.select("ref", "h_idx", F.col("target").alias("target")).dropDuplicates(["ref", "h_idx"])
    j = spine.join(own, ["ref", "h_idx"], "left")
    status = F.when(F.col("target").isNotNull(), "aligned").when(~F.col("is_anchor"), "pooled_non_anchor").when(F.col(target_count) == 0, "truly_skipped").otherwise("unaligned")
    return j.withColumn("status", status)


def stopword_check(words: DataFrame, truth: DataFrame, partners: int, freq: int) -> DataFrame:
    """Candidates against words that have many partners at a frequency: true and false positives, misses, precision, recall
    and F1; shares of nothing are null."""
    gold = truth.where((F.col("partners") >= partners) & (F.col("freq") >= freq)).select("word", F.lit(True).alias("g"))
    j = words.select("word", F.lit(True).alias("w")).join(gold, "word", "full_outer")
    out = j.agg(F.count_if(F.col("w") & F.col("g")).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("w").isNull()).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    share = lambda a, b, n: F.round(F.try_divide(a, b), 6).alias(n)
    return out.select("*", share(tp, tp + fp, "precision"), share(tp, tp + fn, "recall"), share(2 * tp, 2 * tp + fp + fn, "f1"))


METHOD_RANK = {"eflomal": 3, "gloss": 2, "gapfill": 1}


def rank_of(method: Column) -> Column:
    return F.coalesce(*(F.when(method == m, r) for m, r in METHOD_RANK.items()), F.lit(0))


def merge_vote(votes: DataFrame) -> DataFrame:
    """For each source token the target with most methods, then the best score, then the first method; two votes or
    more score .97."""
    by = votes.groupBy("ref", "h_idx", "target").agg(F.countDistinct("method").alias("agree"), F.max("score").alias("best"), F.max(rank_of(F.col("method"))).alias("first"), F.array_sort(F.collect_set("method")).alias("voters"))
    order = Window.partitionBy("ref", "h_idx").orderBy(F.desc("agree"), F.desc("best"), F.desc("first"), F.asc("target"))
    won = by.withColumn("r", F.row_number().over(order)).where("r = 1")
    return won.select("ref", "h_idx", "target", "agree", F.when(F.col("agree") >= 2, 0.97).otherwise(F.col("best")).alias("score"), F.array_join("voters", "+").alias("voters"))


def merge_trust(votes: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """For each source token the target with the greatest sum of weights; unknown keys weigh the upper median of their
    method."""
    order = Window.partitionBy("method").orderBy("weight", *[k for k in keys if k != "method"])
    ranked = weights.withColumn("r", F.row_number().over(order)).withColumn("k", F.count("*").over(Window.partitionBy("method")))
    default = ranked.where(F.col("r") == F.floor(F.col("k") / 2) + 1).select("method", F.col("weight").alias("usual"))
    j = votes.join(weights.select(*keys, "weight"), keys, "left").join(default, "method", "left")
    each = j.groupBy("ref", "h_idx", "target").agg(F.round(F.sum(F.coalesce("weight", "usual", F.lit(0.0))), 6).alias("sum"), F.count("*").alias("agree"))
    won = each.withColumn("r", F.row_number().over(Window.partitionBy("ref", "h_idx").orderBy(F.desc("sum"), F.asc("target")))).where("r = 1")
    return won.select("ref", "h_idx", "target", "agree", F.least(F.lit(0.99), F.col("sum")).alias("score"))


def merge_contest(ef: DataFrame, gl: DataFrame, gap: DataFrame, rule: DataFrame) -> DataFrame:
    """Agreement scores .97; a contest goes by the rule of its tiers (default eflomal); light glosses are ignored; a
    method alone keeps its score; fills come last."""
    a = ef.select("ref", "h_idx", F.col("target").alias("e"), F.col("score").alias("es"), F.col("tier").alias("ef_tier"))
    b = gl.where(~F.coalesce(F.col("light"), F.lit(False))).select("ref", "h_idx", F.col("target").alias("g"), F.col("score").alias("gs"), F.col("tier").alias("gl_tier"))
    c = gap.select("ref", "h_idx", F.col("target").alias("f"), F.col("score").alias("fs"))
    return decide(a.join(b, ["ref", "h_idx"], "full_outer").join(c, ["ref", "h_idx"], "full_outer"), rule)


def decide(met: DataFrame, rule: DataFrame) -> DataFrame:
    """merge_contest of rows in which the methods have met: ref, h_idx; e, es, ef_tier; g, gs, gl_tier; f, fs."""
    j = met.join(rule.select("ef_tier", "gl_tier", "rule"), ["ef_tier", "gl_tier"], "left")
    both = F.col("e").isNotNull() & F.col("g").isNotNull()
    source = F.when(both & (F.col("e") == F.col("g")), "both").when(both, F.when(F.col("rule") == "gl", "gl").otherwise("ef")).when(F.col("e").isNotNull(), "ef").when(F.col("g").isNotNull(), "gl").otherwise("gap")
    pick = lambda e, g, f: F.when(F.col("source") == "gap", F.col(f)).when(F.col("source") == "gl", F.col(g)).otherwise(F.col(e))
    out = j.withColumn("source", source)
    return out.select("ref", "h_idx", pick("e", "g", "f").alias("target"), F.when(F.col("source") == "both", 0.97).otherwise(pick("es", "gs", "fs")).alias("score"), "source")


def first_method(rows: DataFrame) -> DataFrame:
    """One row for each source token, of the method with the highest rank."""
    order = Window.partitionBy("ref", "h_idx").orderBy(F.desc(rank_of(F.col("method"))), F.desc("score"), F.asc("target"))
    return rows.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


def precision_by(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Judged rows, hits and precision of each key."""
    out = judged.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if("hit").alias("correct"))
    return out.withColumn("precision", F.round(F.col("correct") / F.col("n"), 6))
