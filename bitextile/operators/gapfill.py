"""Filling of gaps: source content words without a target, from what other verses, editions and phrases say."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import name_score
from .kernels import by_group, in_verse
from .sequence import between


@dataclass(frozen=True)
class Weights:
    """Fixed values of the scoring."""

    strong: float = 0.6
    name: float = 0.6
    cross: float = 0.5
    phrase: float = 0.4
    pos: float = 0.15
    morph: float = 0.1
    place: float = 0.2
    phrase_place: float = 0.6
    fill: float = 0.9
    phrase_fill: float = 0.75
    wide: float = 0.6


def gaps(source: DataFrame, covered: DataFrame) -> DataFrame:
    """Content tokens that no pair covers."""
    return source.where("content").join(in_verse(covered.select("ref", "h_idx").distinct()), ["ref", "h_idx"], "left_anti")


def phrase_expected(source: DataFrame, anchors: DataFrame, dependent_after: bool = True) -> DataFrame:
    """For tokens with an aligned phrase-mate: the target place next to it.

    The mate of a dependent ('rec') is its head ('NA') and the other way round where there is one, else the nearest. A
    dependent stands after its head, or before it where the language says so; other mates keep the source order.
    """
    tokens = source.where("phrase_id IS NOT NULL").groupBy("ref").agg(F.collect_list(F.struct("h_idx", "phrase_id", "rela")).alias("s"))
    own = anchors.groupBy("ref").agg(F.collect_list(F.struct("h_idx", "anchor")).alias("a"))
    mate = lambda t: F.transform(F.filter("a", lambda x: x["h_idx"] == t["h_idx"]), lambda x: F.struct(t["h_idx"].alias("m"), t["phrase_id"].alias("phrase_id"), t["rela"].alias("rela"), x["anchor"].alias("anchor")))
    v = tokens.join(in_verse(own), "ref").select("ref", "s", F.flatten(F.transform("s", mate)).alias("mates")).select("ref", F.explode_outer("s").alias("t"), "mates")
    h, after = F.col("t")["h_idx"], 1 if dependent_after else -1

    def met(m: Column) -> Column:
        dep, head = ((F.col("t")["rela"] == a) & (m["rela"] == b) for a, b in (("rec", "NA"), ("NA", "rec")))
        side = F.when(F.coalesce(dep, F.lit(False)), after).when(F.coalesce(head, F.lit(False)), -after).otherwise(F.when(h > m["m"], 1).otherwise(-1))
        return F.struct((~F.coalesce(dep | head, F.lit(False))).alias("other"), F.abs(m["m"] - h).alias("far"), m["m"].alias("m"), (m["anchor"] + side).cast("double").alias("p_exp"))

    near = F.array_min(F.transform(F.filter("mates", lambda m: (m["phrase_id"] == F.col("t")["phrase_id"]) & (m["m"] != h)), met))
    return v.select("ref", h.alias("h_idx"), near.alias("near")).where("near IS NOT NULL").select("ref", "h_idx", F.col("near")["p_exp"].alias("p_exp"), F.lit("phrase").alias("p_prior"))


def cross_phrase_expected(source: DataFrame, phrases: DataFrame, order: DataFrame) -> DataFrame:
    """For tokens whose own phrase has no aligned member: a place beside the nearest covered phrase, on the side that
    the order rate of the two functions says. phrases: ref, src, function, tgt; order: fa, fb, rate."""
    near = Window.partitionBy("ref", "h_idx").orderBy(F.abs(F.col("src") - F.col("h_idx")), "src")
    met = source.where("function is not null").join(phrases.select("ref", "src", F.col("function").alias("other"), "tgt"), "ref").withColumn("r", F.row_number().over(near)).where("r = 1 AND src <> h_idx")
    first = F.col("h_idx") < F.col("src")
    named = met.withColumn("fa", F.when(first, F.col("function")).otherwise(F.col("other"))).withColumn("fb", F.when(first, F.col("other")).otherwise(F.col("function")))
    kept = F.col("rate") >= 0.5
    side = F.when(first == kept, F.lit(-1)).otherwise(1)
    return named.join(order.select("fa", "fb", "rate"), ["fa", "fb"]).select("ref", "h_idx", (F.col("tgt") + side).alias("p_exp"), F.lit("phrase_xorder").alias("p_prior"))


def sure_order(order: DataFrame, least: int = 100, margin: float = 0.2) -> DataFrame:
    """Pairs of functions seen often enough, on one side often enough, to tell a place."""
    return order.where((F.col("total") >= least) & (F.abs(F.col("rate") - 0.5) >= margin))


def construct_rate(source: DataFrame, anchors: DataFrame, least: int = 50, margin: float = 0.2) -> DataFrame:
    """How often a dependent stands after its head in the target, and whether that is sure enough to use."""
    own = source.join(anchors, ["ref", "h_idx"])
    d = own.where("rela = 'rec'").select("ref", "phrase_id", F.col("anchor").alias("d"))
    h = own.where("rela = 'NA'").select("ref", "phrase_id", F.col("anchor").alias("h"))
    out = d.join(h, ["ref", "phrase_id"]).agg(F.count("*").alias("n"), F.count_if(F.col("d") > F.col("h")).alias("after"))
    rate = F.try_divide(F.col("after"), F.col("n"))
    return out.select("n", "after", F.round(rate, 6).alias("rate"), F.coalesce((F.col("n") >= least) & (F.abs(rate - 0.5) >= margin), F.lit(False)).alias("use"))


def morph_surfaces(pairs: DataFrame, features: list[str], k: int = 3, least: int = 3) -> DataFrame:
    """The top words of each number key, feature and value."""
    rows = pairs.select("strong", "word1", *features).unpivot(["strong", "word1"], features, "feature", "value").where("value is not null")
    counts = rows.groupBy("strong", "feature", "value", F.col("word1").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    w = Window.partitionBy("strong", "feature", "value").orderBy(F.desc("n"), F.asc("word"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def scored(source: DataFrame, target: DataFrame, covered: DataFrame, known: DataFrame, vocab: DataFrame, priors: DataFrame, target_pos: DataFrame, weights: Weights = Weights(), expected: DataFrame | None = None, morph: DataFrame | None = None, wide: DataFrame | None = None) -> DataFrame:
    """Scored fills of a verse: a gap and a free place that a prior speaks for.

    covered: ref, h_idx, anchor (its first target place) and places (array, all of them; without it the anchor alone);
    known: strong, word; vocab: lexeme, word; priors: lexeme, pos, translit; target_pos: word, pos; expected: ref, h_idx,
    p_exp, p_prior where phrases tell a place; morph: strong, feature, value, word, for features that are columns of source;
    wide: lexeme, multiword_rate over languages. Places that are taken or blocked (function words) are not filled; all
    tokens of both sides count for the order. `grows`: a fill may take the next place too, as its lexeme is often wide.
    """
    features = [r["feature"] for r in morph.select("feature").distinct().collect()] if morph is not None else []  # a row for each feature
    # a verse is one row until its gaps are told, so each table is dealt out by verse once
    blocked = F.coalesce("blocked", F.lit(False)) if "blocked" in target.columns else F.lit(False)
    verse = source.groupBy("ref").agg(F.array_sort(F.collect_list(F.struct("h_idx", "content", "strong", "lexeme", *features))).alias("s"))
    words = target.groupBy("ref").agg(F.collect_list(F.struct("place", F.lower("token").alias("word"), blocked.alias("blocked"))).alias("t"))
    places = F.flatten(F.collect_list("places")) if "places" in covered.columns else F.collect_list("anchor")
    own = covered.groupBy("ref").agg(F.collect_list(F.struct("h_idx", "anchor")).alias("c"), places.alias("taken"))
    v = verse.join(in_verse(words), "ref").join(in_verse(own), "ref", "left")
    v = v.join(in_verse(expected.groupBy("ref").agg(F.collect_list(F.struct("h_idx", "p_exp", "p_prior")).alias("e"))), "ref", "left") if expected is not None else v.withColumn("e", F.array().cast("array<struct<h_idx:bigint,p_exp:double,p_prior:string>>"))
    here = lambda rows, h: F.coalesce(F.filter(rows, lambda x: x["h_idx"] == h), F.slice(rows, 1, 0))
    free = F.filter("t", lambda x: ~x["blocked"] & ~F.coalesce(F.exists("taken", lambda y: y == x["place"]), F.lit(False)))
    v = v.select("ref", "e", F.size("s").alias("n_s"), F.size("t").alias("n_t"), free.alias("free"), F.transform("s", lambda x, i: F.struct(x.alias("x"), i.alias("p"), F.get(here("c", x["h_idx"]), F.lit(0))["anchor"].alias("t"))).alias("s"))
    gaps = F.filter("s", lambda x: x["t"].isNull() & x["x"]["content"])
    v = v.select("ref", "e", "n_s", "n_t", F.transform("free", lambda x: F.struct(x["place"], x["word"], F.exists("free", lambda y: y["place"] == x["place"] + 1).alias("next_free"))).alias("free"), F.filter("s", lambda x: x["t"].isNotNull()).alias("at"), gaps.alias("gaps"))
    below = lambda g: F.filter("at", lambda x: x["p"] <= g["p"])
    near = lambda g: F.struct(g["x"].alias("x"), g["p"].alias("p"), F.get(F.reverse(below(g)), F.lit(0)).alias("b"), F.get(F.filter("at", lambda x: x["p"] >= g["p"]), F.lit(0)).alias("a"), here("e", g["x"]["h_idx"]).alias("e"))
    tell = lambda g: F.struct(g["x"].alias("x"), between(g["p"], g["b"], g["a"], F.col("n_s"), F.col("n_t")).alias("expected"), F.when(F.size(g["e"]) > 0, g["e"]).otherwise(F.array(F.lit(None).cast(v.schema["e"].dataType.elementType))).alias("e"))
    v = v.select("ref", "n_t", "free", F.transform(F.transform("gaps", near), tell).alias("gaps"))
    # one array of all that a verse's gaps meet: what is computed beside an array would be computed again for each of its rows
    meet = lambda g: F.flatten(F.transform(g["e"], lambda e: F.transform("free", lambda x: F.struct(*(g["x"][c].alias(c) for c in ("h_idx", "strong", "lexeme", *features)), F.col("n_t").alias("n_t"), g["expected"].alias("expected"), e["p_exp"].alias("p_exp"), e["p_prior"].alias("p_prior"), x["place"].alias("place"), x["word"].alias("word"), x["next_free"].alias("next_free")))))
    j = v.select("ref", F.explode_outer(F.flatten(F.transform("gaps", meet))).alias("x")).select("ref", "x.*").join(priors.select("lexeme", "pos", "translit"), "lexeme", "left")
    j = j.join(wide.select("lexeme", "multiword_rate"), "lexeme", "left") if wide is not None else j.withColumn("multiword_rate", F.lit(None).cast("double"))
    j = j.join(known.select("strong", "word", F.lit(True).alias("is_known")).distinct(), ["strong", "word"], "left").join(vocab.select("lexeme", "word", F.lit(True).alias("is_vocab")).distinct(), ["lexeme", "word"], "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    strong = yes(F.col("is_known"))
    name = yes((F.col("pos") == "name") & (name_score(F.regexp_replace("translit", "[.·]", ""), F.col("word")) >= 0.8))
    cross = yes(F.col("is_vocab")) & ~strong
    phrase = yes(F.abs(F.col("place") - F.col("p_exp")) <= 1)
    # pairs that no prior speaks for go before the rest
    j = j.where(strong | name | cross | phrase).join(target_pos.select("word", F.col("pos").alias("t_pos")), "word", "left").withColumn("agrees", F.lit(False))
    for i, feature in enumerate(features):
        own = morph.where(F.col("feature") == feature).select("strong", F.col("value").alias(feature), "word", F.lit(True).alias(f"morph{i}"))
        j = j.join(own, ["strong", feature, "word"], "left").withColumn("agrees", F.col("agrees") | F.coalesce(f"morph{i}", F.lit(False))).drop(f"morph{i}")
    away = F.when(F.col("p_exp").isNotNull(), weights.phrase_place * F.abs(F.col("place") - F.col("p_exp"))).otherwise(weights.place * F.abs(F.col("place") - F.col("expected"))) / F.col("n_t")
    gain = lambda c, w: F.when(c, w).otherwise(0.0)
    score = gain(strong, weights.strong) + gain(name, weights.name) + gain(cross, weights.cross) + gain(phrase, weights.phrase) + gain(yes(F.col("pos") == F.col("t_pos")), weights.pos) + gain(strong & F.col("agrees"), weights.morph) - away
    prior = F.when(strong, "strong").when(name, "name").when(cross, "cross_edition").otherwise(F.col("p_prior"))
    return j.select("ref", "h_idx", F.col("place").cast("long").alias("place"), F.round(score, 9).alias("score"), prior.alias("prior"), (strong | name | cross).alias("vocab"), (yes(F.col("next_free")) & yes(F.col("multiword_rate") >= weights.wide)).alias("grows"))


def fill(candidates: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """Two greedy passes for each verse: fills that a vocabulary speaks for, then those by phrase alone in what is left.
    Then fills that grow take the place behind theirs, in the same order, while no other has it. `places` has them all."""

    def one(rows: list[tuple]) -> Iterator[tuple]:
        sources, places, out = set(), set(), []
        for vocab in (True, False):
            for ref, h, t, score, prior, grows in sorted(((r[0], r[1], r[2], r[3], r[4], r[6]) for r in rows if r[5] == vocab), key=lambda r: (-r[3], r[1], r[2])):
                if h not in sources and t not in places:
                    sources.add(h)
                    places.add(t)
                    out.append((ref, h, t, weights.fill if vocab else weights.phrase_fill, prior, grows))
        for ref, h, t, score, prior, grows in out:
            more = [t + 1] if grows and t + 1 not in places else []
            places.update(more)
            yield ref, h, t, score, prior, [t, *more]

    own = candidates.select("ref", "h_idx", "place", "score", "prior", "vocab", F.col("grows") if "grows" in candidates.columns else F.lit(False).alias("grows"))
    return by_group(own, "ref", one, "ref long, h_idx long, place long, score double, prior string, places array<long>")


def self_trained(earlier: DataFrame, fills: DataFrame) -> DataFrame:
    """The fills of an earlier pass and those of this one for tokens that it left open; ref, h_idx and what both have."""
    return earlier.unionByName(fills.join(earlier.select("ref", "h_idx"), ["ref", "h_idx"], "left_anti"))
