"""Joins of sources, priors, gold and datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nth_occurrence(left: DataFrame, right: DataFrame, key: list[str], left_order: list, right_order: list, how: str = "left") -> DataFrame:
    """The n-th row of a key on the left meets the n-th on the right; as a queue from which each row takes the next."""
    number = lambda order: F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return left.withColumn("n", number(left_order)).join(right.withColumn("n", number(right_order)), [*key, "n"], how)


def gold_join(pairs: DataFrame, gold: DataFrame, words: Column) -> DataFrame:
    """Pairs that gold judges (same ref and key), with `hit`: any of the words is in the gold set."""
    sets = gold.groupBy("ref", "strong").agg(F.collect_set("surface").alias("gold"))
    return pairs.join(sets, ["ref", "strong"]).withColumn("hit", F.arrays_overlap(words, F.col("gold")))


def head_to_head(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("ef", "gl"), target: str = "target") -> DataFrame:
    """Full outer join of two methods on the source token, classed as agree, disagree, or only one of them."""
    x, y = (f.select("ref", "h_idx", F.col(target).alias(n)) for f, n in zip((a, b), names, strict=True))
    both = x.join(y, ["ref", "h_idx"], "full_outer")
    l, r = names
    kind = F.when(F.col(l).isNull(), f"{r}_only").when(F.col(r).isNull(), f"{l}_only").when(F.col(l) == F.col(r), "agree").otherwise("disagree")
    return both.withColumn("kind", kind)


def keyness_filter(rows: DataFrame, priors: DataFrame, floor: float) -> DataFrame:
    """Rows whose lexeme has a keyness of `floor` or more (null marks function words)."""
    return rows.join(priors.where(F.col("keyness") >= floor).select("lexeme", "keyness"), "lexeme")


def sense_inventory(prior: DataFrame, attested: DataFrame) -> DataFrame:
    """Senses of the inventory confirmed or missing, and attested ones that are extra; with the top surface."""
    inventory = prior.select("lexeme", F.explode("senses").alias("s")).select("lexeme", F.col("s.stem").alias("stem"), F.col("s.sense").alias("sense"), F.col("s.share").alias("prior_share"))
    best = F.max(F.struct("count", "surface"))
    counts = attested.groupBy("lexeme", "stem", "sense", "surface").agg(F.sum("count").alias("count"))
    seen = counts.groupBy("lexeme", "stem", "sense").agg(F.sum("count").alias("attested_count"), best["surface"].alias("top_surface"))
    out = inventory.join(seen, ["lexeme", "stem", "sense"], "full_outer")
    status = F.when(F.col("prior_share").isNull(), "extra").when(F.col("attested_count").isNull(), "missing").otherwise("confirmed")
    return out.withColumn("status", status).withColumn("attested_count", F.coalesce("attested_count", F.lit(0)))


def gap_map(spine: DataFrame, attested: DataFrame, priors: DataFrame) -> DataFrame:
    """Content lexemes of the source that have no attestation, by confidence (null as 99) and frequency."""
    freq = spine.where("content").groupBy("lexeme").agg(F.max("strong").alias("strong"), F.count("*").alias("spine_freq"))
    gaps = freq.join(attested.select("lexeme").distinct(), "lexeme", "left_anti").join(priors.select("lexeme", "xling_confidence"), "lexeme", "left")
    return gaps.withColumn("rank_confidence", F.coalesce("xling_confidence", F.lit(99)))


def bridge(priors: DataFrame, lex: DataFrame, k: int = 3) -> DataFrame:
    """From a lexeme of the first part over its linked numbers to lexemes of the second part, with the first's top
    surfaces as candidates, and whether and how often the second part confirms them."""
    sums = lex.groupBy("lexeme", "surface").agg(F.sum("count").alias("count"))
    order = Window.partitionBy("lexeme").orderBy(F.desc("count"), F.asc("surface"))
    total = Window.partitionBy("lexeme")
    top = sums.withColumn("share", F.round(F.col("count") / F.sum("count").over(total), 6)).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    links = priors.where("lexeme LIKE 'hbo:%'").select(F.col("lexeme").alias("via_hebrew"), F.explode("lxx_greek").alias("grc_strong")).distinct()
    greek = priors.where("lexeme LIKE 'grc:%' AND keyness IS NOT NULL").select(F.col("lexeme").alias("grc_lexeme"), F.col("strong").alias("grc_strong"))
    cand = links.join(greek, "grc_strong").join(top.select(F.col("lexeme").alias("via_hebrew"), F.col("surface").alias("candidate_surface"), F.col("count").alias("ot_count"), "share"), "via_hebrew")
    confirmed = sums.select(F.col("lexeme").alias("grc_lexeme"), F.col("surface").alias("candidate_surface"), F.col("count").alias("nt_total"))
    out = cand.join(confirmed, ["grc_lexeme", "candidate_surface"], "left")
    return out.select("grc_lexeme", "grc_strong", "candidate_surface", "via_hebrew", "ot_count", "share", F.col("nt_total").isNotNull().alias("nt_confirmed"), F.coalesce("nt_total", F.lit(0)).alias("nt_total"))


def interval_expand(ranges: DataFrame, start: str, end: str, name: str = "verse") -> DataFrame:
    """A row for each member of a range, so that membership is an equi-join."""
    return ranges.withColumn(name, F.explode(F.sequence(start, end)))


def occurrence_union(frames: dict[str, DataFrame], order: str = "verse_ref") -> DataFrame:
    """The occurrence rows of all sources, with their source, columns that one lacks null, in order of verses."""
    out = None
    for source, df in frames.items():
        own = df.withColumn("source", F.lit(source))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out.orderBy(order, "source", *(c for c in out.columns if c not in (order, "source")))


def recipe_order(rows: DataFrame, recipe: str) -> DataFrame:
    """The rows of a recipe as they are published: keyness by lexeme, certainty and count; gap by confidence and frequency;
    sense by status and share; bridge by what is confirmed least and frequent most."""
    status = F.array_position(F.array(*map(F.lit, ("confirmed", "missing", "extra"))), F.col("status"))
    keys = {
        "keyness": lambda: [F.asc("lexeme"), F.desc("hi_conf"), F.desc("count")],
        "gap": lambda: [F.asc("rank_confidence"), F.desc("spine_freq"), F.asc("lexeme")],
        "sense": lambda: [status.asc(), F.coalesce("prior_share", F.lit(0.0)).desc(), F.asc("lexeme")],
        "bridge": lambda: [F.asc("nt_total"), F.desc("ot_count")],
    }[recipe]()
    return rows.orderBy(*keys)


def remap(rows: DataFrame, table: DataFrame, key: list[str], to: list[str]) -> DataFrame:
    """Left join on the key with the row's own key where the table has none."""
    t = table.select(*(F.col(k) for k in key), *(F.col(c).alias(f"__{c}") for c in to))
    return rows.join(t, key, "left").select("*", *(F.coalesce(f"__{c}", k).alias(f"std_{k}") for c, k in zip(to, key, strict=True))).drop(*(f"__{c}" for c in to))


def top1_accuracy(lex: DataFrame, gold: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Types and tokens whose top lexeme is in the gold for that surface; a fallback gold is asked on misses."""
    sums = lex.groupBy("surface", "lexeme").agg(F.sum("count").alias("count"))
    order = Window.partitionBy("surface").orderBy(F.desc("count"), F.asc("lexeme"))
    top = sums.withColumn("r", F.row_number().over(order)).where("r = 1").select("surface", "lexeme")
    weights = gold.groupBy("surface").agg(F.count("*").alias("tokens"), F.collect_set("lexeme").alias("keys"))
    own = weights.join(top, "surface", "left")
    if fallback is not None:
        own = own.join(fallback.groupBy("surface").agg(F.collect_set("lexeme").alias("more")), "surface", "left")
    else:
        own = own.withColumn("more", F.lit(None).cast("array<string>"))
    ok = F.coalesce(F.array_contains("keys", F.col("lexeme")), F.lit(False)) | F.coalesce(F.array_contains("more", F.col("lexeme")), F.lit(False))
    has = F.col("lexeme").isNotNull()
    return own.withColumn("ok", ok).agg(
        F.count("*").alias("gold_types"), F.count_if(has).alias("shared_types"), F.count_if("ok").alias("correct_types"),
        F.sum("tokens").alias("gold_tokens"), F.sum(F.when(has, F.col("tokens")).otherwise(0)).alias("shared_tokens"), F.sum(F.when(F.col("ok"), F.col("tokens")).otherwise(0)).alias("correct_tokens"),
    )


def lexicon_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on both sides and on one only; precision is the share of a's keys that b has, recall that of b's that a has."""
    x, y = a.select(key).distinct().withColumn("l", F.lit(True)), b.select(key).distinct().withColumn("r", F.lit(True))
    j = x.join(y, key, "full_outer")
    out = j.agg(F.count_if(F.col("l") & F.col("r")).alias("both"), F.count_if(F.col("r").isNull()).alias("left_only"), F.count_if(F.col("l").isNull()).alias("right_only"))
    share = lambda rest: F.round(F.coalesce(F.try_divide("both", F.col("both") + F.col(rest)), F.lit(0.0)), 6)
    return out.withColumn("precision", share("left_only")).withColumn("recall", share("right_only"))


def ids_in_ranges(rows: DataFrame, ranges: DataFrame, unit: str = "ref", width: int = 1000) -> DataFrame:
    """Rows whose number lies in a range (range_id, first, last), once for each such range.

    Both sides are dealt by cells of `width` numbers, so that the range condition is tested within an equi-join.
    """
    cells = ranges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("first") / width), F.floor(F.col("last") / width))))
    own = rows.withColumn("cell", F.floor(F.col(unit) / width))
    return own.join(cells, (own["cell"] == cells["cell"]) & F.col(unit).between(F.col("first"), F.col("last"))).drop("cell")


def vocabulary_hits(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """rows with `tokens` and lexeme; `hits`: its tokens that are known surfaces of the lexeme, repeats kept."""
    keyed = rows.withColumn("__id", F.struct(*(c for c in rows.columns)))
    each = keyed.select("__id", "lexeme", F.posexplode("tokens").alias("__n", "__t")).join(vocab.select("lexeme", F.col("surface").alias("__t")).distinct(), ["lexeme", "__t"])
    hits = each.groupBy("__id").agg(F.array_sort(F.collect_set(F.struct("__n", "__t"))).alias("__h"))
    none = F.array().cast("array<string>")
    return keyed.join(hits, "__id", "left").select(*rows.columns, F.coalesce(F.transform("__h", lambda x: x["__t"]), none).alias("hits"))


def state_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """add, update, delete or unchanged for each key of two states."""
    j = old.select(key, F.col(value).alias("o")).join(new.select(key, F.col(value).alias("n")), key, "full_outer")
    return j.select(key, F.when(F.col("o").isNull(), "add").when(F.col("n").isNull(), "delete").when(F.col("o") == F.col("n"), "unchanged").otherwise("update").alias("change"))


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old without the keys of new, and new."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def id_join(ids: DataFrame, words: DataFrame) -> DataFrame:
    """Rows whose source_id is 'n' and eleven digits meet word_id by number; other ids are left out."""
    number = F.when(F.col("source_id").rlike("^n[0-9]{11}$"), F.substring("source_id", 2, 11).cast("long"))
    return ids.withColumn("word_id", number).join(words, "word_id").drop("word_id")


def first_match(rows: DataFrame, table: DataFrame, key: list[str], rank: str) -> DataFrame:
    """rows joined with the row of least rank for their key."""
    first = table.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(rank))).where("__r = 1").drop("__r", rank)
    return rows.join(first, key)
