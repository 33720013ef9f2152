"""Queries over the statistical aligner, versification, learned word forms and editions of like texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import editions as E
from ..operators import hmm, induction, kernels
from ..operators import sequence as Q
from ..operators import versification as V
from ..sources.scratch import written
from .corpus_queries import parallel, vocabulary
from .proxy import IPAIRS, PAIRS, pairs, table, with_iso
from .registry import query


@query()
def hmm_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Links of both directions of the jump model with fertilities, symmetrized."""
    v, pairs, model = hmm.train(*parallel(spark, d))
    return kernels.symmetrize(*hmm.links(v, pairs, model))


# -- verses that move

MOVED = """v AS (SELECT conv_id AS chapter, turn AS verse FROM conversations), m AS (SELECT *, CASE WHEN chapter % 4 = 0 AND verse >= 4 THEN chapter + 100000 WHEN chapter % 8 IN (1, 5) THEN chapter - chapter % 8 + 300000 ELSE chapter END AS to_chapter,
CASE WHEN chapter % 4 = 0 AND verse >= 4 THEN verse - 4 WHEN chapter % 8 = 5 THEN verse + 4 WHEN (chapter + verse) % 3 = 0 AND verse % 2 = 0 THEN verse + 1 ELSE verse END AS to_verse FROM v),
raw AS (SELECT DISTINCT to_chapter, to_verse AS a, to_verse + 1 AS b FROM m WHERE to_verse % 3 = 0 UNION SELECT DISTINCT to_chapter, to_verse, to_verse + 2 FROM m WHERE to_verse % 5 = 1)"""


@query(f"""WITH {MOVED}, o AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY to_chapter ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS o FROM raw),
i AS (SELECT *, sum(o) OVER (PARTITION BY to_chapter ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS i FROM o), r AS (SELECT to_chapter, min(a) AS a, max(b) AS b FROM i GROUP BY to_chapter, i),
x AS (SELECT m.*, coalesce(a, to_verse) AS vs, coalesce(b, to_verse) AS ve FROM m LEFT JOIN r ON r.to_chapter = m.to_chapter AND m.to_verse BETWEEN a AND b),
an AS (SELECT chapter, to_chapter, vs, min(verse) AS anchor FROM x WHERE to_verse = vs GROUP BY ALL)
SELECT x.chapter, x.to_chapter, x.vs AS verse_start, x.ve AS verse_end, anchor, verse, row_number() OVER (PARTITION BY x.chapter, x.to_chapter, x.vs ORDER BY verse)::INT - 1 AS pooled_idx FROM x JOIN an ON an.chapter = x.chapter AND an.to_chapter = x.to_chapter AND an.vs = x.vs""")
def verse_pooling_remapped(spark: SparkSession, d: str) -> DataFrame:
    """Pooling where a third of the verses move, chapters split and fold, and ranges overlap."""
    c, t = F.col("chapter"), F.col("verse")
    v = table(spark, d, "conversations").select(F.lit("GEN").alias("book"), F.col("conv_id").alias("chapter"), F.col("turn").alias("verse"))
    split, fold = (c % 4 == 0) & (t >= 4), (c % 8).isin(1, 5)
    m = v.withColumn("to_chapter", F.when(split, c + 100_000).when(fold, c - c % 8 + 300_000).otherwise(c))
    m = m.withColumn("to_verse", F.when(split, t - 4).when(c % 8 == 5, t + 4).when(((c + t) % 3 == 0) & (t % 2 == 0), t + 1).otherwise(t))
    two = [m.where(k).select("book", F.col("to_chapter").alias("chapter"), F.col("to_verse").alias("verse_start"), (F.col("to_verse") + n).alias("verse_end")).distinct() for k, n in (("to_verse % 3 = 0", 1), ("to_verse % 5 = 1", 2))]
    out = Q.verse_groups(two[0].union(two[1]), v, v.withColumn("idx", F.lit(0)), m.where("to_chapter <> chapter OR to_verse <> verse"))
    return out.select("chapter", "to_chapter", "verse_start", "verse_end", "anchor", "verse", "pooled_idx")


# -- versification schemes

LINES = "lines AS (SELECT (l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line, l_partkey AS source, CASE WHEN l_linenumber % 3 <> 0 THEN l_suppkey END AS standard FROM lineitem)"
STEPS = """f AS (SELECT source AS ref, arg_max(standard, line) AS "to" FROM lines WHERE standard IS NOT NULL GROUP BY 1), s AS (SELECT standard AS ref, arg_max(source, line) AS "to" FROM lines WHERE standard IS NOT NULL GROUP BY 1)"""


def two_maps(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, d, "lineitem").select(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line"), F.col("l_partkey").alias("source"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_suppkey")).alias("standard"))
    return V.table_map(lines, "source", "standard"), V.table_map(lines, "standard", "source")


@query(f"""WITH {LINES}, {STEPS} SELECT f.ref, coalesce(s."to", f."to") AS "to" FROM f LEFT JOIN s ON s.ref = f."to" WHERE f.ref <> coalesce(s."to", f."to") UNION ALL SELECT ref, "to" FROM s WHERE ref <> "to" AND ref NOT IN (SELECT ref FROM f)""")
def scheme_composed(spark: SparkSession, d: str) -> DataFrame:
    """From one scheme to the standard and on to another, both read off tables with the last line counting."""
    return V.composed(*two_maps(spark, d))


@query(f"""WITH {LINES}, {STEPS}, a AS (SELECT ref, "to" FROM f UNION SELECT "to", "to" FROM f WHERE "to" NOT IN (SELECT ref FROM f)), k AS (SELECT "to", list(ref ORDER BY ref) AS refs FROM a GROUP BY 1), b AS (SELECT "to" AS ref, max(ref) AS back FROM f GROUP BY 1)
SELECT b.ref, b.back AS "to", len(refs) > 1 AS conflict, (SELECT count(*) FROM a WHERE a."to" = b.ref AND a.ref <> b.back) AS n_lost FROM b JOIN k ON k."to" = b.ref""")
def scheme_inverted(spark: SparkSession, d: str) -> DataFrame:
    """A many-to-one map inverted, its conflicts, and how many references do not come back."""
    f = two_maps(spark, d)[0]
    gone = V.lost(f).groupBy(F.col("to").alias("ref")).agg(F.count(F.lit(1)).alias("n_lost"))
    return V.inverted(f).join(gone, "ref", "left").withColumn("n_lost", F.coalesce("n_lost", F.lit(0).cast("long")))


SCHEMES = """own AS (SELECT iso, ref % 10 AS book, ref % 100 AS chapter, max(h_idx) AS last FROM ipairs WHERE l_suppkey % 2 = 0 GROUP BY ALL), schemes AS (SELECT l_suppkey % 7 AS scheme, ref % 10 AS book, ref % 100 AS chapter, max(h_idx) AS last FROM pairs GROUP BY ALL),
shares AS (SELECT iso, scheme, round(avg(CASE WHEN s.last = o.last THEN 1.0 ELSE 0.0 END), 6) AS share FROM schemes s JOIN own o USING (book, chapter) WHERE book < 8 GROUP BY ALL),
det AS (SELECT iso, scheme, 'L' || scheme % 3 AS label, share FROM (SELECT *, row_number() OVER (PARTITION BY iso ORDER BY share DESC, scheme) AS r FROM shares) WHERE r = 1)"""


def schemes_of(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = pairs(spark, d)
    rows = with_iso(spark, d, p)
    book, chapter = (F.col("ref") % 10).alias("book"), (F.col("ref") % 100).alias("chapter")
    schemes = p.groupBy((F.col("l_suppkey") % 7).alias("scheme"), book, chapter).agg(F.max("h_idx").alias("last"))
    own = rows.where("l_suppkey % 2 = 0").groupBy("iso", book, chapter).agg(F.max("h_idx").alias("last"))
    tables = schemes.select("scheme").distinct().select("scheme", F.concat(F.lit("L"), (F.col("scheme") % 3).cast("string")).alias("label"), F.col("scheme").alias("nth"))
    return rows, tables, V.detected(schemes, own, tables, list(range(8)))


@query(f"""WITH {IPAIRS}, {SCHEMES}, t AS (SELECT iso, 'L' || l_partkey % 3 AS label, count(*) AS content, count(*) FILTER (l_tax >= 0.02) AS covered, count(*) FILTER (score >= 0.9 AND coalesce(coherent, true)) AS high FROM ipairs WHERE content AND ref % 10 = 9 GROUP BY ALL),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY iso ORDER BY high DESC, label) AS r FROM t) WHERE r = 1)
SELECT w.iso, w.label, content, covered, high, det.label AS detected, coalesce(w.label = det.label, false) AS agrees FROM w LEFT JOIN det USING (iso)""")
def scheme_judged(spark: SparkSession, d: str) -> DataFrame:
    """The scheme that most chapters point to, and the one that the sensitive book bears out."""
    from ..operators import lexicon as L

    rows, tables, found = schemes_of(spark, d)
    aligned = rows.select("iso", F.concat(F.lit("L"), (F.col("l_partkey") % 3).cast("string")).alias("label"), (F.col("ref") % 10).alias("book"), "content", (F.col("l_tax") >= 0.02).alias("covered"), L.is_high(F.col("score"), F.col("coherent")).alias("high"))
    return V.judged(aligned, tables, found, 9)


# -- editions

ORDER = ["BUILDING", "AUTOMOBILE", "MACHINERY"]
NEXT = "nb AS (SELECT c_nationkey AS g, c_custkey AS key, c_acctbal, lead(c_custkey) OVER w AS nxt, lag(c_custkey) OVER w AS prv, lead(c_acctbal) OVER w AS nb, lag(c_acctbal) OVER w AS pb FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey))"


@query(f"""WITH RECURSIVE rk AS (SELECT c_nationkey AS g, c_custkey AS key, CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'AUTOMOBILE' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 3 END AS r FROM customer), {NEXT},
said AS (SELECT g, key, 0 AS nth, nxt AS c FROM nb WHERE abs(nb - c_acctbal) < 250 UNION ALL SELECT g, key, 1, prv FROM nb WHERE abs(pb - c_acctbal) < 250),
e AS (SELECT said.g, said.key, list({{'c': said.c, 'strong': a.r < b.r}} ORDER BY nth) AS e FROM said JOIN rk a ON a.g = said.g AND a.key = said.key JOIN rk b ON b.g = said.g AND b.key = said.c GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY key) AS i FROM e),
run AS (SELECT g, 0::BIGINT AS i, []::BIGINT[] AS gone FROM (SELECT DISTINCT g FROM rk) UNION ALL
SELECT g, i, CASE WHEN list_contains(gone, key) OR v IS NULL THEN gone WHEN v.strong THEN list_append(gone, v.c) ELSE list_append(gone, key) END FROM (SELECT k.g, k.i, k.key, run.gone, list_filter(k.e, lambda x: NOT list_contains(run.gone, x.c))[1] AS v FROM run JOIN k ON k.g = run.g AND k.i = run.i + 1)),
fin AS (SELECT g, arg_max(gone, i) AS gone FROM run GROUP BY 1)
SELECT rk.g AS iso, rk.key FROM rk JOIN fin ON fin.g = rk.g WHERE NOT list_contains(gone, rk.key)""")
def editions_unlike(spark: SparkSession, d: str) -> DataFrame:
    """Editions without near copies: each is near the next and the one before by balance, so chains and mutual pairs abound."""
    c = table(spark, d, "customer")
    w = Window.partitionBy("c_nationkey").orderBy("c_acctbal", "c_custkey")
    own = c.select(F.col("c_nationkey").alias("iso"), F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("source"))
    near = lambda f, n: c.select(F.col("c_nationkey").alias("iso"), F.col("c_custkey").alias("key"), F.lit(n).alias("nth"), F.when(F.abs(f("c_acctbal").over(w) - F.col("c_acctbal")) < 250, "near_identical").otherwise("distinct").alias("likely"), f("c_custkey").over(w).alias("closest"))
    return E.drop_like(own, near(F.lead, 0).union(near(F.lag, 1)), ORDER).select("iso", "key")


CATALOG = """cl AS (SELECT 'i' || c_nationkey AS iso, CASE WHEN c_custkey % 3 = 0 THEN 'nt' WHEN c_custkey % 3 = 1 THEN 'ot' ELSE 'ntp' END AS canon, c_custkey % 40 AS cluster, c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'pkf' WHEN 'AUTOMOBILE' THEN 'helloao' ELSE 'dbt' END || ':' || (c_custkey % 97) AS key, c_acctbal FROM customer WHERE c_nationkey < 15),
g AS (SELECT iso, canon, cluster, min(key) AS first, min(c_acctbal) >= -900 AS fetchable, CASE WHEN cluster % 5 = 0 THEN 'near_identical' END AS likely, CASE WHEN cluster % 5 = 0 THEN 'dbt:' || (cluster + 1) END AS closest FROM cl GROUP BY ALL),
rows AS (SELECT DISTINCT iso, left(canon, 2) AS testament, canon, cluster, key, CASE WHEN key <> first THEN first END AS anchor, fetchable, likely, closest FROM cl JOIN g USING (iso, canon, cluster)),
ix AS (SELECT DISTINCT 'i' || s_nationkey AS iso, CASE WHEN s_suppkey % 2 = 0 THEN 'nt' ELSE 'ot' END AS testament, CASE s_suppkey % 3 WHEN 0 THEN 'pkf' WHEN 1 THEN 'helloao' ELSE 'dbt' END AS source FROM supplier),
miss AS (SELECT * FROM ix ANTI JOIN rows USING (iso, testament)),
li AS (SELECT DISTINCT 'i' || s_nationkey AS iso, CASE WHEN s_suppkey % 3 = 1 THEN 'helloao' ELSE 'dbt' END AS source, 's' || s_suppkey AS edition, CASE WHEN s_suppkey % 3 = 1 THEN NULL WHEN s_suppkey % 2 = 0 THEN 'nt' ELSE 'ot' END AS of FROM supplier WHERE s_suppkey % 3 <> 0),
made AS (SELECT iso, testament, 'pkf:' || upper(iso) || 'PKF' AS key FROM miss WHERE source = 'pkf' UNION ALL SELECT DISTINCT iso, testament, source || ':' || edition FROM miss JOIN li USING (iso, source) WHERE coalesce(of = testament, true)),
ver AS (SELECT iso, testament, key, anchor, fetchable, likely, closest FROM rows UNION ALL SELECT iso, testament, key, NULL, true, NULL, NULL FROM made)"""


def catalog_of(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").where("c_nationkey < 15")
    k = F.col("c_custkey")
    name = F.when(F.col("c_mktsegment") == "BUILDING", "pkf").when(F.col("c_mktsegment") == "AUTOMOBILE", "helloao").otherwise("dbt")
    rows = c.select(F.concat(F.lit("i"), F.col("c_nationkey").cast("string")).alias("iso"), F.when(k % 3 == 0, "nt").when(k % 3 == 1, "ot").otherwise("ntp").alias("canon"), (k % 40).alias("cluster"), F.concat_ws(":", name, (k % 97).cast("string")).alias("key"), "c_acctbal")
    flagged = F.col("cluster") % 5 == 0
    clusters = rows.groupBy("iso", "canon", "cluster").agg(F.array_sort(F.collect_set("key")).alias("ids"), (F.min("c_acctbal") >= -900).alias("reachable"))
    clusters = clusters.withColumn("likely", F.when(flagged, "near_identical")).withColumn("closest", F.when(flagged, F.concat(F.lit("dbt:"), (F.col("cluster") + 1).cast("string"))))
    s, n = table(spark, d, "supplier"), F.col("s_suppkey")
    iso, canon = F.concat(F.lit("i"), F.col("s_nationkey").cast("string")).alias("iso"), F.when(n % 2 == 0, "nt").otherwise("ot")
    source = F.when(n % 3 == 0, "pkf").when(n % 3 == 1, "helloao").otherwise("dbt").alias("source")
    index = s.select(iso, canon.alias("canon"), source)
    listed = s.select(iso, source, F.concat(F.lit("s"), n.cast("string")).alias("edition"), F.when(n % 3 != 1, canon).alias("canon"))
    return E.catalog_versions(clusters, index, listed)


@query(f"WITH {CATALOG} SELECT iso, testament, key, split_part(key, ':', 1) AS source, split_part(key, ':', 2) AS edition, anchor, fetchable, likely, closest FROM ver")
def catalog_versions(spark: SparkSession, d: str) -> DataFrame:
    """All known editions from clusters and, where a language has none, from the index."""
    return catalog_of(spark, d)


@query(f"""WITH RECURSIVE {CATALOG}, f AS (SELECT iso, key, arg_min(anchor, testament || anchor) AS parent FROM ver WHERE fetchable GROUP BY 1, 2), p AS (SELECT iso, key, parent FROM f WHERE parent IS NOT NULL),
up AS (SELECT iso, key, key AS cur FROM f UNION ALL SELECT up.iso, up.key, p.parent FROM up JOIN p ON p.iso = up.iso AND p.key = up.cur), root AS (SELECT iso, key, cur AS root FROM up ANTI JOIN p ON p.iso = up.iso AND p.key = up.cur)
SELECT iso, root, count(*) AS members, arg_min(key, (CASE split_part(key, ':', 1) WHEN 'pkf' THEN 0 WHEN 'helloao' THEN 1 ELSE 2 END, key)) AS picked FROM root GROUP BY 1, 2""")
def catalog_families(spark: SparkSession, d: str) -> DataFrame:
    """Families of equal texts by the links of both testaments, and the edition that stands for each."""
    found = E.families(catalog_of(spark, d))
    picked = E.preferred(found, ["iso", "root"], "source", ["pkf", "helloao", "dbt"], "key").select("iso", "root", F.col("key").alias("picked"))
    return found.groupBy("iso", "root").agg(F.count(F.lit(1)).alias("members")).join(picked, ["iso", "root"])


# -- learned word forms


def _learned(side: str) -> str:
    stem, affix, least = ("word[1:len(word) - k]", "word[len(word) - k + 1:]", 1) if side == "suf" else ("word[k + 1:]", "word[1:k]", 2)
    return f"""{side}_s AS (SELECT lang, {stem} AS stem, CASE WHEN k = 0 THEN '' ELSE {affix} END AS affix FROM (SELECT lang, word, unnest(range(0, least(5, len(word) - 3) + 1)) AS k FROM v WHERE len(word) >= 3) WHERE k = 0 OR k >= {least}),
{side}_r AS (SELECT lang, stem FROM {side}_s GROUP BY 1, 2 HAVING count(DISTINCT affix) >= 2), {side}_f AS (SELECT lang, affix, count(DISTINCT stem) AS stems FROM {side}_s JOIN {side}_r USING (lang, stem) WHERE affix <> '' GROUP BY 1, 2 HAVING count(DISTINCT stem) >= 12),
{side} AS (SELECT lang, affix FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY stems DESC, affix) AS r FROM {side}_f) WHERE r <= 40)"""


def _cut(side: str, name: str, bases: str) -> str:
    stem, affix = ("base[1:len(base) - k]", "base[len(base) - k + 1:]") if side == "suf" else ("base[k + 1:]", "base[1:k]")
    return f"""{name}_k AS (SELECT lang, base, {stem} AS rest, {affix} AS affix, k FROM (SELECT lang, base, unnest(range(1, least(5, len(base) - 3) + 1)) AS k FROM (SELECT DISTINCT lang, base FROM {bases}) WHERE len(base) >= 4)),
{name}_b AS (SELECT c.lang, c.base, arg_max(rest, k) AS rest FROM {name}_k c SEMI JOIN {side} a ON a.lang = c.lang AND a.affix = c.affix SEMI JOIN stems s ON s.lang = c.lang AND s.stem = c.rest GROUP BY 1, 2),
{name} AS (SELECT * FROM {bases} UNION ALL SELECT x.lang, x.word, b.rest FROM {bases} x JOIN {name}_b b ON b.lang = x.lang AND b.base = x.base)"""


def word_forms(spark: SparkSession, d: str) -> DataFrame:
    v = written(vocabulary(spark, d), "vocabulary")
    suffixes, prefixes = induction.affixes(v, "lang", "suffix", once=True), induction.affixes(v, "lang", "prefix", shortest=2, once=True)
    suffixes, prefixes = written(suffixes, "suffixes"), written(prefixes, "prefixes")
    return induction.learned_forms(v, "lang", suffixes, prefixes, written(induction.stem_lexicon(v, "lang", once=True), "stems"))


@query(f"""WITH v AS (SELECT DISTINCT lang, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]+')) AS word FROM documents), {_learned("suf")}, {_learned("pre")}, stems AS (SELECT lang, stem FROM suf_r UNION SELECT lang, word FROM v),
b0 AS (SELECT lang, word, word AS base FROM v), {_cut("suf", "b1", "b0")}, {_cut("pre", "b2", "b1")}, o AS (SELECT DISTINCT lang, word, base FROM b2 WHERE base <> word)
SELECT v.lang, v.word, concat_ws(',', v.word, string_agg(base, ',' ORDER BY len(base) DESC, base)) AS forms FROM v LEFT JOIN o USING (lang, word) GROUP BY 1, 2""")
def learned_word_forms(spark: SparkSession, d: str) -> DataFrame:
    """Each word with what is left of it without its longest productive affixes."""
    return word_forms(spark, d).withColumn("forms", F.array_join("forms", ","))


@query(f"""WITH v AS (SELECT DISTINCT lang, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]+')) AS word FROM documents), {_learned("suf")}, stems AS (SELECT lang, stem FROM suf_r UNION SELECT lang, word FROM v)
SELECT lang, count(*) AS n_stems, count(*) FILTER (stem IN (SELECT word FROM v x WHERE x.lang = stems.lang)) AS n_words, sha256(string_agg(stem, chr(10) ORDER BY stem)) AS sha256 FROM stems GROUP BY 1""")
def stem_lexicons(spark: SparkSession, d: str) -> DataFrame:
    """The stem lexicon of each language: its size, the words in it, and the digest of its published form."""
    from ..operators import lexicon as L

    v = written(vocabulary(spark, d), "vocabulary")
    stems = induction.stem_lexicon(v, "lang", once=True)
    words = stems.join(v.withColumnRenamed("word", "stem"), ["lang", "stem"], "left_semi").groupBy("lang").agg(F.count(F.lit(1)).alias("n_words"))
    return L.canonical_hash(stems, "lang", [F.col("stem")], ["stem"]).withColumnRenamed("rows", "n_stems").join(words, "lang")


@query(r"""WITH v AS (SELECT DISTINCT lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]+')) AS word FROM documents),
s AS (SELECT lang, word, word AS base FROM v UNION ALL SELECT lang, word, word[1 : len(word) - len(s)] FROM v, (SELECT unnest(CASE WHEN 1 = 1 THEN ['ed', 'er', 'es', 'en', 'ing', 's'] END) AS s) a WHERE ends_with(word, s) AND len(word) - len(s) >= 3 AND (lang = 'en' AND s IN ('ed', 'ing', 's') OR lang = 'de' AND s IN ('en', 'er', 'es'))),
p AS (SELECT * FROM s UNION ALL SELECT lang, word, base[len(p) + 1 :] FROM s, (SELECT unnest(['be', 'ge', 'ver']) AS p) WHERE lang = 'de' AND starts_with(base, p) AND len(base) - len(p) >= 3),
o AS (SELECT DISTINCT lang, word, base FROM p WHERE base <> word)
SELECT v.lang AS iso, v.word, concat_ws(',', v.word, string_agg(base, ',' ORDER BY len(base) DESC, base)) AS forms FROM v LEFT JOIN o USING (lang, word) GROUP BY 1, 2""")
def normalizer_forms(spark: SparkSession, d: str) -> DataFrame:
    """The words of all languages by one table function: two languages have rules of their own, the others none."""
    from ..functions.normalizers import Affixes, forms_table

    rules = {"en": Affixes(("ed", "ing", "s")), "de": Affixes(("en", "er", "es"), ("be", "ge", "ver"))}
    return forms_table(vocabulary(spark, d), rules, "lang").withColumn("forms", F.array_join("forms", ","))


NEW = "l_suppkey % 5 <> 3 AND (l_suppkey % 5 <> 2 OR l_tax >= 0.03)"


@query(f"""WITH {PAIRS}, c AS (SELECT surface, method, base_text, lexeme, count(*) AS count, count(*) FILTER (score >= 0.9 AND coalesce(coherent, true)) AS high FROM pairs WHERE content AND {NEW} GROUP BY ALL)
SELECT *, round(count / sum(count) OVER (PARTITION BY surface, method, base_text), 6) AS share, round(high / count, 6) AS hi_conf FROM c""")
def stream_retractions(spark: SparkSession, d: str) -> DataFrame:
    """The lexicon kept by a stream from one state of the editions to the next, in which one came, one went and one changed."""
    from ..operators import lexicon as L
    from ..sources.scratch import folder
    from ..streaming import retractions as R

    p = L.usable(pairs(spark, d)).withColumn("edition", F.col("l_suppkey") % 5).withColumn("sure", L.is_high(F.col("score"), F.col("coherent")))
    own = lambda keep: p.where(keep).groupBy("edition", *R.GROUP, "lexeme").agg(F.count(F.lit(1)).alias("count"), F.count_if("sure").alias("high"))
    sha = lambda keep, s: own(keep).withColumn("sha", F.when(F.col("edition") == 2, s).otherwise("same"))
    none, old, new = sha("false", "a"), sha("edition <> 4", "a"), sha(NEW, "b")
    top = folder(spark, "retractions")
    for before, after in ((none, old), (old, new)):
        R.signed_counts(before, after).write.mode("append").parquet(f"{top}/signed")
        R.advance(spark, f"{top}/signed", top)
    return R.lexicon(spark, top).withColumns({c: F.round(c, 6) for c in ("share", "hi_conf")})


# -- published files and kept results


@query(f"""WITH {IPAIRS}, r AS (SELECT DISTINCT 'B' || ref % 20 AS book, ref FROM pairs), e AS (SELECT DISTINCT iso, base_text AS edition, 'B' || ref % 20 AS book FROM ipairs), c AS (SELECT iso, base_text AS edition, ref, string_agg(h_idx || ':' || t_idx[1], ' ' ORDER BY h_idx) AS compact FROM ipairs WHERE content GROUP BY 1, 2, 3),
f AS (SELECT e.iso, e.edition, e.book, '[' || string_agg('"' || coalesce(compact, '') || '"', ', ' ORDER BY r.ref) || ']' || chr(10) AS body, count(*) AS rows FROM e JOIN r USING (book) LEFT JOIN c ON c.iso = e.iso AND c.edition = e.edition AND c.ref = r.ref GROUP BY 1, 2, 3)
SELECT iso[1] || '/' || iso || '/' || edition || '/' || book || '_' || left(md5(iso || book), 5) || '.json' AS file, rows, strlen(body) AS bytes, sha256(body) AS sha256 FROM f""")
def compact_files(spark: SparkSession, d: str) -> DataFrame:
    """The index of compact files, one a language, edition and book, that a data source writes under names of their own."""
    from ..sources import named
    from ..sources.scratch import folder

    x = F.when(F.col("content"), F.concat_ws(":", F.col("h_idx").cast("string"), F.col("t_idx")[0].cast("string")))
    tokens = F.array_sort(F.collect_list(F.struct("h_idx", "iso", F.col("base_text").alias("edition"), x.alias("x"))))
    verses = with_iso(spark, d, pairs(spark, d)).groupBy("ref").agg(tokens.alias("s"), F.array_sort(F.collect_set("lexeme")).alias("lexemes"))
    own = lambda e: F.transform(F.filter("s", lambda t: (t["iso"] == e["iso"]) & (t["edition"] == e["edition"])), lambda t: t["x"])
    editions = F.transform(F.array_distinct(F.transform("s", lambda t: F.struct(t["iso"], t["edition"]))), lambda e: F.struct(e["iso"], e["edition"], F.array_join(own(e), " ").alias("compact")))
    verses = written(verses.select(F.concat(F.lit("B"), (F.col("ref") % 20).cast("string")).alias("book"), "ref", "lexemes", editions.alias("editions")), "verses")
    books = verses.select("book", F.explode("editions").alias("e")).select("e.iso", "e.edition", "book").distinct()
    books = books.withColumn("book_hash", F.left(F.md5(F.concat("iso", "book").cast("binary")), F.lit(5)))
    root = folder(spark, "compact")
    named.publish_verses(verses, books, f"{root}/files", f"{root}/books")
    return named.index_of(spark, f"{root}/files")


@query(f"""WITH v AS (SELECT DISTINCT lang, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]+')) AS word FROM documents), {_learned("suf")}, {_learned("pre")}, stems AS (SELECT lang, stem FROM suf_r UNION SELECT lang, word FROM v),
a AS (SELECT lang, list(affix ORDER BY stems DESC, affix)[1:40] AS x, 's' AS side FROM suf_f GROUP BY 1 UNION ALL SELECT lang, list(affix ORDER BY stems DESC, affix)[1:40], 'p' FROM pre_f GROUP BY 1),
l AS (SELECT DISTINCT lang FROM v), m AS (SELECT l.lang, coalesce(p.x, []) AS prefixes, coalesce(s.x, []) AS suffixes FROM l LEFT JOIN a s ON s.lang = l.lang AND s.side = 's' LEFT JOIN a p ON p.lang = l.lang AND p.side = 'p')
SELECT lang, (SELECT count(*) FROM v WHERE v.lang = m.lang) AS n_types, len(suffixes) AS n_suffixes, len(prefixes) AS n_prefixes, (SELECT count(*) FROM stems s WHERE s.lang = m.lang) AS n_stems,
sha256('{{"prefixes":' || to_json(prefixes) || ',"suffixes":' || to_json(suffixes) || '}}') AS content_sha256 FROM m""")
def affix_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of learned affixes; what was learned is kept by the digest of its input and settings."""
    from ..sources import artefacts as A
    from ..sources.scratch import folder

    docs, root, rule = table(spark, d, "documents"), folder(spark, "artefacts"), {"stem": 3, "longest": 5, "productive": 12, "top": 40}
    v = A.kept(spark, root, "words", [docs], {"by": "lang"}, lambda: vocabulary(spark, d))
    side = lambda name, least: A.kept(spark, root, name, [docs], rule | {"side": name, "shortest": least}, lambda: induction.affixes(v, "lang", name, shortest=least, once=True, **rule))
    stems = A.kept(spark, root, "stems", [docs], {"real": 2}, lambda: induction.stem_lexicon(v, "lang", once=True))
    return A.affix_manifest(v, side("suffix", 1), side("prefix", 2), stems, "lang")


@query("""WITH w AS (SELECT lang, source, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}]+')) AS word FROM documents), tot AS (SELECT lang, word, count(*) AS freq, count(DISTINCT source) AS in_books FROM w GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY freq DESC, word) AS rank FROM tot), bk AS (SELECT lang, count(DISTINCT source) AS n_books FROM w GROUP BY 1)
SELECT lang, count(*) AS n_words, sha256(string_agg(word, chr(10) ORDER BY word)) AS content_sha256 FROM rk JOIN bk USING (lang) WHERE rank <= 150 AND in_books / n_books >= 0.85 GROUP BY 1""")
def stopword_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of learned stopwords."""
    from ..sources import artefacts as A
    from .corpus_queries import stopwords

    return A.stopword_manifest(stopwords(spark, d), "lang")
