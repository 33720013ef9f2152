"""Aggregates that make lexicon datasets from alignment pairs.

All are grouped sums: counts are combined before the shuffle and add up over editions and methods.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import contiguous
from ..sources.scratch import written

LEX_KEYS = ["surface", "lexeme", "method", "base_text"]


def usable(pairs: DataFrame) -> DataFrame:
    """Content pairs with a number key and a target; surfaces trimmed in lower case; lexeme falls back to the key."""
    ok = F.col("content") & F.col("strong").isNotNull() & (F.col("strong") != "") & F.col("surface").isNotNull() & (F.col("surface") != "")
    return pairs.where(ok).withColumn("surface", F.lower(F.trim("surface"))).withColumn("lexeme", F.coalesce(F.nullif(F.col("lexeme"), F.lit("")), F.col("strong")))


def is_high(score: Column, coherent: Column, floor: float = 0.9) -> Column:
    """Score at the floor and not known to be incoherent."""
    return (score >= floor) & F.coalesce(coherent, F.lit(True))


def method_high(method: Column, score: Column) -> Column:
    """High confidence by method: dictionary tiers always, statistics from .3, links and fills from .9."""
    return method.isin("exact", "stem", "name", "multi") | ((method == "stat") & (score >= 0.3)) | (method.isin("eflomal", "gapfill") & (score >= 0.9))


def tier(method: Column, score: Column, match: Column, prior: Column, unknown: str = "?") -> Column:
    """The tier of a pair: a link's score, a gloss's kind of match, a fill's prior, else 'all'. A fill without a prior is
    `unknown`: '?' where methods are merged, 'embedding' where they are scored."""
    return F.when(method == "eflomal", F.concat(F.lit("score "), score.cast("string"))).when(method == "gloss", match).when(method == "gapfill", F.coalesce(prior, F.lit(unknown))).otherwise(F.lit("all"))


def operating_point(lexicon: DataFrame, name: str) -> DataFrame:
    """Presets: 'recall' all rows; 'model_free' without fills; 'precise' count 2 and hi_conf .5 at least."""
    if name == "precise":
        return lexicon.where("count >= 2 AND hi_conf >= 0.5")
    return lexicon.where("method <> 'gapfill'") if name == "model_free" else lexicon


def additive_union(pairs: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """count and hi_conf for each surface, lexeme, method and base text (and extra keys)."""
    keys = [*extra, *LEX_KEYS]
    high = F.count_if(is_high(F.col("score"), F.col("coherent")))
    return usable(pairs).groupBy(*keys).agg(F.max("strong").alias("strong"), F.count("*").alias("count"), F.round(high / F.count("*"), 4).alias("hi_conf"))


def with_share(counts: DataFrame, group: list[str], count: str = "count", name: str = "share", digits: int = 4) -> DataFrame:
    """The share of a row in the sum of its group."""
    return counts.withColumn(name, F.round(F.col(count) / F.sum(count).over(Window.partitionBy(*group)), digits))


def lexicon(pairs: DataFrame, min_count: int = 1) -> DataFrame:
    """The additive union with shares of the surface; shares are taken before rare rows go."""
    return with_share(additive_union(pairs), ["surface", "method", "base_text"]).where(F.col("count") >= min_count)


def multiword(pairs: DataFrame) -> DataFrame:
    """Contiguous targets of two or more words, with their share among the lexeme's."""
    rows = usable(pairs).where(contiguous(F.col("t_idx")))
    counts = rows.groupBy("lexeme", "strong", F.col("surface").alias("phrase"), F.size(F.split("surface", " ")).alias("n_words")).agg(F.count("*").alias("count"))
    return with_share(counts, ["lexeme"]).withColumn("contig", F.lit(True))


def scattered(pairs: DataFrame) -> DataFrame:
    """For each lexeme: targets of two or more places, contiguous and not."""
    many = usable(pairs).where(F.size("t_idx") >= 2)
    return many.groupBy("lexeme").agg(F.count_if(contiguous(F.col("t_idx"))).alias("contiguous"), F.count_if(~contiguous(F.col("t_idx"))).alias("scattered"))


SENSE_KEYS = ["lexeme", "stem", "sense", "surface", "base_text", "method"]


def senses(pairs: DataFrame) -> DataFrame:
    rows = usable(pairs).where(F.col("sense").isNotNull()).withColumn("stem", F.coalesce("stem", F.lit("")))
    return rows.groupBy(*SENSE_KEYS).agg(F.count("*").alias("count"))


def exclude(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Drop rows that meet any rule; a rule holds where each of its non-null fields is equal (surfaces in lower case).

    Rules with the same fields set are one equi-join, so there are as many joins as such sets, at most 2 ** fields.
    """
    fields = rules.columns
    named = rules.select(*((F.lower(f) if f == "surface" else F.col(f)).alias(f) for f in fields))
    for mask in sorted(named.select(*(F.col(f).isNotNull().alias(f) for f in fields)).distinct().collect()):
        held = [f for f, used in zip(fields, mask, strict=True) if used]
        own = named.where(" AND ".join(f"`{f}` IS {'NOT ' if f in held else ''}NULL" for f in fields))
        rows = rows.join(own.select(*held).distinct(), held, "left_anti") if held else rows.join(own.limit(1), F.lit(True), "left_anti")
    return rows


def attested_senses(pairs: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Sense counts with shares taken after exclusions."""
    rows = senses(pairs)
    rows = rows if rules is None else exclude(rows, rules)
    return with_share(rows, ["lexeme", "stem", "sense", "base_text", "method"])


def rollup_view(lex: DataFrame, method: str, base_text: str, min_count: int = 1, min_hi: float = 0.0, min_share: float = 0.0) -> DataFrame:
    """One method and base text by number key and surface: counts, shares and the count-weighted hi_conf."""
    rows = lex.where((F.col("method") == method) & (F.col("base_text") == base_text) & (F.col("count") >= min_count) & (F.col("hi_conf") >= min_hi))
    sums = rows.groupBy("strong", "surface").agg(F.sum("count").alias("count"), F.round(F.sum(F.col("hi_conf") * F.col("count")) / F.sum("count"), 9).alias("hi_conf"))
    return with_share(sums, ["strong"], digits=6).where(F.col("share") >= min_share)


def coverage(pairs: DataFrame, book: str, targets: DataFrame | None = None) -> DataFrame:
    """For each book: verses, content tokens, and how many are aligned and highly so. With targets (book, ref, n_tokens):
    also target tokens, how many of them pairs cover, and the share."""
    high = F.col("content") & is_high(F.col("score"), F.col("coherent"))
    own = [F.countDistinct("ref").alias("verses"), F.count_if("content").alias("content"), F.count_if(high).alias("high"), F.round(F.count_if(high) / F.count_if("content"), 6).alias("high_rate")]
    if targets is None:
        return pairs.groupBy(book).agg(*own)
    out = pairs.groupBy(book).agg(*own, F.sum(F.size("t_idx")).alias("target_covered"))
    out = out.join(targets.groupBy(book).agg(F.sum("n_tokens").alias("target_tokens")), book)
    return out.withColumn("target_rate", F.round(F.col("target_covered") / F.col("target_tokens"), 6))


def language_stats(pairs: DataFrame) -> DataFrame:
    """For each language and lexeme: total, mean words, share of multiword targets, share of the top surface."""
    rows = usable(pairs)
    by = rows.groupBy("iso", "lexeme", "surface").agg(F.count("*").alias("c"), F.count_if(contiguous(F.col("t_idx"))).alias("m"))
    words = F.size(F.split("surface", " "))
    out = by.groupBy("iso", "lexeme").agg(F.sum("c").alias("total"), F.sum(F.col("m") * words).alias("mwe_words"), F.sum("m").alias("mwe"), F.max("c").alias("top"))
    return out.select(
        "iso", "lexeme", "total", "mwe", ((F.col("mwe_words") + F.col("total") - F.col("mwe")) / F.col("total")).alias("span_mean"),
        (F.least("mwe", "total") / F.col("total")).alias("multiword_rate"), (F.col("top") / F.col("total")).alias("dominance"),
    )


def span_profile(stats: DataFrame, least: int = 2) -> DataFrame:
    """Means over languages that have multiword data at all, for lexemes of `least` languages."""
    known = stats.groupBy("iso").agg(F.sum("mwe").alias("k")).where("k > 0").select("iso")
    rows = stats.join(known, "iso", "left_semi").groupBy("lexeme")
    return rows.agg(F.countDistinct("iso").alias("n_langs"), F.round(F.avg("span_mean"), 3).alias("span_mean"), F.round(F.avg("multiword_rate"), 3).alias("multiword_rate")).where(F.col("n_langs") >= least)


def light_lexemes(stats: DataFrame, below: float = 0.30, total: int = 5, least: int = 2) -> DataFrame:
    """Lexemes whose top surface holds a small share in the mean over languages."""
    rows = stats.where(F.col("total") >= total).groupBy("lexeme").agg(F.countDistinct("iso").alias("n_langs"), F.avg("dominance").alias("dominance"))
    return rows.where((F.col("n_langs") >= least) & (F.col("dominance") < below)).withColumn("dominance", F.round("dominance", 6))


def agreement(lex: DataFrame, by: str, keys: list[str], least: int = 2) -> DataFrame:
    """Keys that `least` values of `by` share."""
    return lex.groupBy(*keys).agg(F.countDistinct(by).alias("n"), F.sum("count").alias("count")).where(F.col("n") >= least)


def top_k(counts: DataFrame, group: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each group in the given order."""
    return counts.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= k)


def seed_dictionary(lex: DataFrame, key: str = "lexeme", k: int = 5, share: float = 0.04) -> DataFrame:
    """The top surfaces of each key by count, with their share in the key's total."""
    sums = with_share(lex.groupBy(key, "surface").agg(F.sum("count").alias("count")), [key], digits=6)
    return top_k(sums.where(F.col("share") >= share), [key], [F.desc("count"), F.asc("surface")], k)


def dominant_lexeme(lex: DataFrame, share: float = 0.4) -> DataFrame:
    """For each surface the lexeme it stands for most, if that has the share."""
    sums = with_share(lex.groupBy("surface", "lexeme").agg(F.sum("count").alias("count")), ["surface"], digits=6)
    return top_k(sums, ["surface"], [F.desc("count"), F.asc("lexeme")], 1).where(F.col("share") >= share).drop("rank")


def known_surfaces(pairs: DataFrame, k: int = 5, share: float = 0.1) -> DataFrame:
    """The top words of each number key, with their share in its words."""
    words = usable(pairs).select("strong", F.explode(F.split("surface", " ")).alias("word")).groupBy("strong", "word").agg(F.count("*").alias("count"))
    return top_k(with_share(words, ["strong"], digits=6).where(F.col("share") >= share), ["strong"], [F.desc("count"), F.asc("word")], k)


def anomaly_scope(rows: DataFrame, key: str, lexeme: str = "lexeme") -> DataFrame:
    """Keys whose Hebrew lexemes have more than one base number, with these lexemes: variants of one number are none."""
    own = rows.select(key, lexeme, F.regexp_extract(lexeme, "^hbo:([0-9]+)", 1).alias("base")).where("base <> ''").distinct()
    odd = own.groupBy(key).agg(F.countDistinct("base").alias("bases")).where("bases > 1")
    return own.join(odd, key).select(key, lexeme, "bases")


def majority(rows: DataFrame, key: list[str], value: str, least: int = 10, purity: float = 0.9, other_than: str | None = None, like: str | None = None) -> DataFrame:
    """The most frequent value of each key where the key is frequent and the value holds most of it; with `other_than`
    only values that differ from that part of the key, with `like` only values of that pattern."""
    counts = rows.groupBy(*key, value).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*key))
    counts = counts.withColumn("total", total).where((F.col("total") >= least) & (F.col("n") / F.col("total") >= purity))
    best = top_k(counts, key, [F.desc("n"), F.asc(value)], 1).drop("rank")
    best = best if other_than is None else best.where(F.col(value) != F.col(other_than))
    return best if like is None else best.where(F.col(value).rlike(like))


def remap_table(pairs: DataFrame, gold: DataFrame, candidates: DataFrame, least: int = 10, purity: float = 0.9, guard: str = "^H") -> DataFrame:
    """lexeme and to_key: the number key that a lexeme's surfaces mostly stand for in the gold, where it is another than its own.

    pairs: lexeme, strong, surface, content; gold: surface, strong; candidates: lexeme. A surface votes for its dominant key
    in the gold alone, once for each time we gave it to the lexeme, so a word that is frequent in the gold has no more say.
    Targets of several words do not vote; keys that `guard` does not match are no target.
    """
    top = top_k(gold.where("surface <> ''").groupBy("surface", "strong").agg(F.count("*").alias("n")), ["surface"], [F.desc("n"), F.asc("strong")], 1).select("surface", F.col("strong").alias("key"))
    own = pairs.where(F.col("content") & single_token(F.col("surface"))).join(candidates.select("lexeme").distinct(), "lexeme", "left_semi")
    votes = own.join(top, "surface").groupBy("lexeme", "key").agg(F.count("*").alias("n"), F.max("strong").alias("own"))
    w = Window.partitionBy("lexeme")
    first = F.row_number().over(w.orderBy(F.desc("n"), F.asc("key")))
    best = votes.withColumns({"total": F.sum("n").over(w), "own": F.max("own").over(w), "r": first}).where("r = 1")
    sure = (F.col("total") >= least) & (F.col("n") / F.col("total") >= purity)
    return best.where(sure & (F.col("key") != F.col("own")) & F.col("key").rlike(guard)).select("lexeme", F.col("key").alias("to_key"), "n", "total")


def vocabulary(lexicon: DataFrame, sure: bool = False) -> DataFrame:
    """lexeme and surface: the words of its surfaces, each word of a multiword one by itself; `sure` takes rows alone of
    which some are of high confidence."""
    from ..functions.text import tokens

    rows = lexicon.where("hi_conf > 0") if sure else lexicon
    return rows.select("lexeme", F.explode(tokens(F.col("surface"))).alias("surface")).distinct()


def entropy(counts: DataFrame, key: list[str], n: str = "n") -> DataFrame:
    """Shannon entropy in bits of each key's counts; 0 for a single observation."""
    p = F.col(n) / F.sum(n).over(Window.partitionBy(*key))
    out = counts.withColumn("__p", p).groupBy(*key).agg(F.sum(n).alias("total"), F.countDistinct(F.struct(*[c for c in counts.columns if c not in (*key, n)])).alias("partners"), (-F.sum(F.col("__p") * F.log2("__p"))).alias("h"))
    return out.select(*key, "total", "partners", F.round(F.when(F.col("total") <= 1, 0.0).otherwise(F.abs("h")), 6).alias("entropy"))


def base_text_counts(lex: DataFrame, key: str = "iso") -> DataFrame:
    """Rows, and the sum of counts, of each language and base text, for the manifest."""
    return lex.groupBy(key, "base_text").agg(F.count("*").alias("rows"), F.sum("count").alias("count"))


def manifest(lex: DataFrame, key: str = "iso", methods: Sequence[str] = ("eflomal", "gloss", "gapfill")) -> DataFrame:
    """For each language: rows, distinct surfaces, lexemes and keys, rows of high confidence, rows by method, testament."""
    by_method = [F.count_if(F.col("method") == m).alias(f"rows_{m}") for m in methods]
    parts = F.array_join(F.array_sort(F.collect_set(F.when(F.col("strong").startswith("G"), "NT").otherwise("OT"))), "+")
    return lex.groupBy(key).agg(F.count("*").alias("rows"), *(F.countDistinct(c).alias(f"n_{c}") for c in ("surface", "lexeme", "strong")), F.count_if(F.col("hi_conf") >= 0.9).alias("hi_rows"), *by_method, parts.alias("testament"))


def _chunks(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Sorted rows (group, line) as runs of lines of one group of about `size` characters, numbered within the partition."""
    part, n, now, held, length = TaskContext.get().partitionId(), 0, None, [], 0

    def run(schema: pa.Schema) -> pa.RecordBatch:
        nonlocal n, length
        out = pa.RecordBatch.from_arrays([pa.array([now], schema.field(0).type), pa.array([part], pa.int32()), pa.array([n]), pa.array([len(held)]), pa.array(["\n".join(held)])], ["group", "part", "n", "rows", "lines"])
        n, length = n + 1, 0
        held.clear()
        return out

    for batch in batches:
        for group, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (group != now or length >= size):
                yield run(batch.schema)
            now = group
            held.append(line)
            length += len(line) + 1
    if held:
        yield run(batch.schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of rows and the digest of each group, whose runs arrive in order."""
    now, rows, digest, first = None, 0, None, True
    for batch in batches:
        for group, more, lines in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if digest is None or group != now:
                if digest is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([rows]), pa.array([digest.hexdigest()])], ["group", "rows", "sha256"])
                now, rows, digest, first = group, 0, hashlib.sha256(), True
            digest.update(b"" if first else b"\n")
            digest.update(lines.encode())
            rows, first = rows + more, False
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([rows]), pa.array([digest.hexdigest()])], ["group", "rows", "sha256"])


def canonical_hash(rows: DataFrame, group: str, columns: list[Column], order: list[str]) -> DataFrame:
    """SHA-256 of each group's rows, tab-joined, in order, joined by newlines: the digest of a published file.

    `order` are names, with - in front for descending numbers. Rows are sorted in ranges that cut groups where they must, and
    each task makes runs of lines of about a megabyte; the runs of a group then stream in order through one digest, so a
    group of any size takes the memory of a run, and one task reads but its runs.
    """
    keys = [(-F.col(o[1:]) if o.startswith("-") else F.col(o)).alias(f"k{i}") for i, o in enumerate(order)]
    names = [f"k{i}" for i in range(len(order))]
    lines = rows.select(F.col(group).alias("group"), *keys, F.concat_ws("\t", *columns).alias("line"))
    kind = lines.schema["group"].dataType.simpleString()
    ranged = lines.repartitionByRange("group", *names, "line").sortWithinPartitions("group", *names, "line").select("group", "line")
    runs = ranged.mapInArrow(_chunks, f"group {kind}, part int, n long, rows long, lines string")
    dealt = runs.repartition("group").sortWithinPartitions("group", "part", "n").select("group", "rows", "lines")
    return dealt.mapInArrow(_digests, f"group {kind}, rows long, sha256 string").withColumnRenamed("group", group)


def content_hash(rows: DataFrame, group: str, columns: list[Column], digits: int | None = None, block: int = 100_000) -> DataFrame:
    """A digest of each group's rows that does not depend on their order, for groups of any size.

    Rows, tab-joined, are dealt into 16 ** digits blocks by their own MD5; each block's sorted lines have a SHA-256, and
    the group's is that of the blocks' digests in order. No group is sorted or held as a whole. Without `digits`, there are
    as many as keep a block of the largest group at about `block` rows, two at least; the rows are written once for that.
    """
    if digits is None:
        rows = written(rows, "hashed")
        most = rows.groupBy(group).count().agg(F.max("count")).first()[0] or 1
        digits = max(2, math.ceil(math.log(max(most / block, 1), 16)))
    lines = rows.select(group, F.concat_ws("\t", *columns).alias("line")).withColumn("b", F.left(F.md5(F.col("line").cast("binary")), F.lit(digits)))
    blocks = lines.groupBy(group, "b").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("line")), "\n").cast("binary"), 256).alias("d"))
    return blocks.groupBy(group).agg(F.sum("n").alias("rows"), F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", "d"))), lambda s: s["d"]), "\n").cast("binary"), 256).alias("sha256"))


def single_token(surface: Column) -> Column:
    """Whether a target is one word."""
    return ~F.trim(surface).contains(" ")


def not_excluded(part: Column, excluded: str) -> Column:
    """All parts but the excluded one; 'all' excludes none."""
    return F.lit(True) if excluded == "all" else part != excluded


def remapped(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows with `key`: the table's key of their lexeme, else their number key. table: lexeme, to_key."""
    return rows.join(table, "lexeme", "left").withColumn("key", F.coalesce("to_key", "strong")).drop("to_key")
