"""Alignment by dictionary glosses: candidates from joins and array functions, then one greedy pass for each verse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import strong_of
from ..functions.similarity import form_score, name_form, word_score
from ..functions.text import title_words
from .kernels import greedy, in_verse


def lower_forms(word: Column) -> Column:
    """The default normal forms: the word in lower case alone."""
    return F.array(F.lower(word))


Forms = Callable[[Column], Column] | DataFrame


def language(forms: Forms) -> list[str]:
    """The column of the language, where forms are told by it."""
    return ["iso"] if isinstance(forms, DataFrame) and "iso" in forms.columns else []


def with_forms(rows: DataFrame, word: str, forms: Forms) -> DataFrame:
    """rows with `forms` of a word: by a function of the column, or by a table (word in lower case, forms, and iso where
    languages have their own), where words that it lacks have themselves alone."""
    if not isinstance(forms, DataFrame):
        return rows.withColumn("forms", forms(F.col(word)))
    own = language(forms)
    known = forms.select(*own, F.col("word").alias("__w"), F.col("forms").alias("__f"))
    low = F.lower(word)
    return rows.withColumn("__w", low).join(known, [*own, "__w"], "left").withColumn("forms", F.coalesce("__f", F.array("__w"))).drop("__w", "__f")


def variant_forms(priors: DataFrame, forms: Forms) -> DataFrame:
    """strong (and iso), v: the forms of each word of each variant, looked up once for each entry and not for each token."""
    if not isinstance(forms, DataFrame):
        return priors.select("strong", F.explode("variants").alias("v")).select("strong", F.transform("v", forms).alias("v"))
    keys = ["strong", *language(forms)]
    words = priors.select(*keys, F.posexplode("variants").alias("i", "v")).select(*keys, "i", F.posexplode("v").alias("j", "w"))
    rows = with_forms(words, "w", forms).groupBy(*keys, "i").agg(F.sort_array(F.collect_list(F.struct("j", "forms"))).alias("v"))  # the words of one variant
    return rows.select(*keys, F.transform("v", lambda x: x["forms"]).alias("v"))


def candidates(source: DataFrame, target: DataFrame, priors: DataFrame, forms: Forms = lower_forms) -> DataFrame:
    """All scored pairs of a verse.

    source: ref, h_idx, strong, gloss_en, is_name; target: ref, place, token, blocked; priors: strong, variants (arrays of
    words). Kinds: name; exact, stem, prefix and fuzzy for single words; multi for runs of words that all reach .7; head
    for the first word of such a variant alone. Blocked places take part in runs only. With forms by language, source, target
    and priors have iso.
    """
    t = with_forms(target.select("ref", "place", "token", "blocked", *language(forms)), "token", forms)
    free = t.where(~F.col("blocked"))
    glosses = source.where("is_name AND gloss_en IS NOT NULL").select("ref", "h_idx", name_form(F.col("gloss_en")).alias("g"))
    names = glosses.join(in_verse(free.select("ref", "place", F.lower("token").alias("low"))), "ref").select("ref", "h_idx", F.array("place").alias("t_idx"), form_score(F.col("g"), F.col("low")).alias("score"), F.lit("name").alias("method"))
    looked = source.join(variant_forms(priors, forms), ["strong", *language(forms)]).select("ref", "h_idx", "v")
    single = looked.where(F.size("v") == 1).join(in_verse(free), "ref").select("ref", "h_idx", F.array("place").alias("t_idx"), word_score(F.col("v")[0], F.col("forms")).alias("score"))
    s = F.col("score")
    single = single.withColumn("method", F.when(s == 1.0, "exact").when(s == 0.9, "stem").when(s == 0.7, "prefix").otherwise("fuzzy"))
    many = looked.where(F.size("v") > 1)
    heads = many.select("ref", "h_idx", F.array(F.col("v")[0]).alias("v")).join(in_verse(free), "ref").where(F.arrays_overlap(F.col("v")[0], F.col("forms"))).select("ref", "h_idx", F.array("place").alias("t_idx"), F.lit(0.65).alias("score"), F.lit("head").alias("method"))
    verse = t.groupBy("ref").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "forms"))), lambda x: x["forms"]).alias("words"))
    runs = many.join(in_verse(verse), "ref").where(F.size("words") >= F.size("v")).select("ref", "h_idx", "v", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.size("v"))).alias("j"))
    # the first word is looked at alone, as few places pass it and the rest of a run is looked at by array functions
    runs = runs.where(word_score(F.col("v")[0], F.get("words", F.col("j"))) >= 0.7)
    least = F.array_min(F.transform("v", lambda w, k: word_score(w, F.get(F.col("words"), F.col("j") + k))))
    runs = runs.withColumn("least", least).where("least >= 0.7").select(
        "ref", "h_idx", F.transform(F.sequence(F.col("j"), F.col("j") + F.size("v") - 1), lambda x: x.cast("long")).alias("t_idx"),
        F.when(F.col("least") < 1, 0.95 * F.col("least") / 0.7).otherwise(0.95).alias("score"), F.lit("multi").alias("method"),
    )
    long = lambda d: d.select("ref", "h_idx", F.col("t_idx").cast("array<bigint>").alias("t_idx"), "score", "method")
    return long(names).union(long(single)).union(long(heads)).union(long(runs)).where("score > 0")


def align(source: DataFrame, target: DataFrame, priors: DataFrame, forms: Forms = lower_forms, multiword: DataFrame | None = None, floor: float = 0.6, light: DataFrame | None = None) -> DataFrame:
    """One-to-one gloss matches: ref, h_idx, t_idx, score, method, light.

    multiword: lexeme, multiword_rate; a single match of a lexeme at the floor takes the place to its right too, if that
    is free. light: lexeme; its matches are marked.
    """
    sizes = source.groupBy("ref").agg((F.max("h_idx") + 1).alias("n_h")).join(in_verse(target.groupBy("ref").agg(F.count("*").alias("n_t"))), "ref")
    c = candidates(source, target, priors, forms).join(in_verse(sizes), "ref")
    near = F.round(F.abs(F.col("h_idx") / F.col("n_h") - F.col("t_idx")[0] / F.col("n_t")), 9)
    out = greedy(c.select("ref", "h_idx", "t_idx", F.round("score", 9).alias("score"), near.alias("near"), "method")).drop("near")
    lexeme = source.select("ref", "h_idx", "lexeme")
    if multiword is not None:
        used = out.select("ref", F.explode("t_idx").alias("next")).withColumn("used", F.lit(True))
        open_ = target.where(~F.col("blocked")).select("ref", F.col("place").cast("long").alias("next"), F.lit(True).alias("open"))
        wide = lexeme.join(multiword.where(F.col("multiword_rate") >= floor).select("lexeme"), "lexeme", "left_semi").select("ref", "h_idx", F.lit(True).alias("wide"))
        out = out.withColumn("next", F.element_at("t_idx", -1) + 1).join(in_verse(wide), ["ref", "h_idx"], "left").join(in_verse(used), ["ref", "next"], "left").join(in_verse(open_), ["ref", "next"], "left")
        grows = (F.size("t_idx") == 1) & F.coalesce("wide", F.lit(False)) & F.col("used").isNull() & F.coalesce("open", F.lit(False))
        out = out.select("ref", "h_idx", F.when(grows, F.concat("t_idx", F.array("next"))).otherwise(F.col("t_idx")).alias("t_idx"), "score", F.when(grows, "multi").otherwise(F.col("method")).alias("method"))
    if light is None:
        return out.withColumn("light", F.lit(False))
    marked = lexeme.join(light.select("lexeme"), "lexeme", "left_semi").select("ref", "h_idx", F.lit(True).alias("light"))
    return out.join(in_verse(marked), ["ref", "h_idx"], "left").withColumn("light", F.coalesce("light", F.lit(False)))


def lookup(tokens: DataFrame, by_stem: DataFrame, by_default: DataFrame, by_strong: DataFrame, by_title: DataFrame) -> DataFrame:
    """tokens with `variants`: those of the lexeme and stem, of the lexeme, of the number key and of its titles, in this
    order, without repeats. The tables have their keys and `variants`."""
    out = tokens
    for k, (t, keys) in enumerate(((by_stem, ["lexeme", "stem"]), (by_default, ["lexeme"]), (by_strong, ["strong"]), (by_title, ["strong"]))):
        out = out.join(t.withColumnRenamed("variants", f"__v{k}"), keys, "left")
    none = F.array().cast("array<array<string>>")
    return out.withColumn("variants", F.array_distinct(F.concat(*(F.coalesce(f"__v{k}", none) for k in range(4))))).drop(*(f"__v{k}" for k in range(4)))


def lexical_priors(matches: DataFrame) -> DataFrame:
    """How often a number key meets the first word of its certain gloss matches."""
    return matches.where(F.col("method").isin("exact", "stem", "name", "multi")).groupBy("strong", F.lower("word1").alias("word")).agg(F.count("*").alias("n"))


def bootstrap_priors(lexicon: DataFrame, k: int = 5, share: float = 0.04) -> DataFrame:
    """Variants by number key from an earlier lexicon: its top surfaces as word lists."""
    sums = lexicon.groupBy("strong", "surface").agg(F.sum("count").alias("count"))
    part = sums.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy("strong")))
    top = part.where(F.col("share") >= share).withColumn("r", F.row_number().over(Window.partitionBy("strong").orderBy(F.desc("count"), F.asc("surface")))).where(F.col("r") <= k)
    return top.groupBy("strong").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "surface"))), lambda x: F.split(x["surface"], " ")).alias("variants"))


def _tops(counts: DataFrame, key: str, k: int, share: float) -> DataFrame:
    """key and variants: the words of its k most frequent surfaces that have the share, without repeats."""
    order = Window.partitionBy(key).orderBy(F.desc("count"), F.asc("surface"))
    part = counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy(key))).withColumn("r", F.row_number().over(order))
    top = part.where((F.col("r") <= k) & (F.col("share") >= share)).withColumn("v", title_words(F.col("surface"))).where(F.size("v") > 0)
    return top.groupBy(key).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("r", "v"))), lambda x: x["v"])).alias("variants"))


def bootstrap(lexicon: DataFrame, pack: DataFrame, k: int = 5, share: float = 0.04, bridged: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Variants by lexeme, by number key, and by Greek lexeme over the old translation, from the links of an earlier lexicon.

    lexicon: lexeme, strong, surface, method, count; of it only eflomal rows count. pack: lexeme, strong, testament, keyness,
    lxx_greek. A lexeme that the pack knows as a function word (no keyness) gets no variants by lexeme. The top surfaces of a
    Hebrew lexeme go to the content lexemes of the new part whose number key the pack links it with.
    """
    rows = lexicon.where(F.coalesce("method", F.lit("eflomal")) == "eflomal")
    sums = rows.groupBy("lexeme", "surface").agg(F.sum("count").alias("count"))
    function = pack.where("keyness IS NULL").select("lexeme")
    by_lexeme = _tops(sums.join(function, "lexeme", "left_anti"), "lexeme", k, share)
    keyed = rows.withColumn("strong", F.coalesce("strong", strong_of(F.col("lexeme")))).where("strong IS NOT NULL")
    by_strong = _tops(keyed.groupBy("strong", "surface").agg(F.sum("count").alias("count")), "strong", k, share)
    linked = pack.select(F.col("lexeme").alias("via"), F.explode("lxx_greek").alias("strong")).where(F.col("via").startswith("hbo")).distinct()
    greek = pack.where("testament = 'NT' AND keyness IS NOT NULL AND strong IS NOT NULL").select("lexeme", "strong")
    tops = _tops(sums.where(F.col("lexeme").startswith("hbo")), "lexeme", bridged, share).select(F.col("lexeme").alias("via"), "variants")
    bridge = linked.join(greek, "strong").join(tops, "via").select("lexeme", "via", "variants").distinct()
    over = bridge.groupBy("lexeme").agg(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("via", "variants"))), lambda x: x["variants"]))).alias("variants"))  # as many as the pack links
    return by_lexeme, by_strong, over


def bootstrapped(tokens: DataFrame, by_lexeme: DataFrame, by_strong: DataFrame, bridged: DataFrame) -> DataFrame:
    """tokens with `variants`: those of the lexeme, of the number key, and of the bridge, in this order, without repeats."""
    out = tokens
    for n, (t, key) in enumerate(((by_lexeme, "lexeme"), (by_strong, "strong"), (bridged, "lexeme"))):
        out = out.join(t.withColumnRenamed("variants", f"__v{n}"), key, "left")
    none = F.array().cast("array<array<string>>")
    return out.withColumn("variants", F.array_distinct(F.concat(*(F.coalesce(f"__v{n}", none) for n in range(3))))).drop("__v0", "__v1", "__v2")
