"""Queries over priors from an earlier lexicon, keys of a grain, features without gold, and what clients read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import editions as E
from ..operators import gloss
from ..operators import joins as J
from ..operators import lexicon as L
from ..operators import scoring as S
from .join_queries import IEF, IGOLD, PRIORS, gold, methods, priors
from .proxy import IPAIRS, PAIRS, pairs, table, with_iso
from .registry import query

def _tops(key: str, rows: str, k: int) -> str:
    words = "regexp_extract_all(lower(surface), '\\p{L}+')"
    ranked = f"SELECT {key}, {words} AS v, count / sum(count) OVER (PARTITION BY {key}) AS share, row_number() OVER (PARTITION BY {key} ORDER BY count DESC, surface) AS r FROM {rows}"
    return f"SELECT {key}, list(DISTINCT v) AS vs FROM ({ranked}) WHERE r <= {k} AND share >= 0.04 GROUP BY 1"


def first_words(variants) -> F.Column:
    """Variants as one text, sorted, for comparison."""
    return F.array_join(F.array_sort(F.transform(variants, lambda v: F.array_join(v, " "))), "; ")


def pack_of(spark: SparkSession, d: str) -> DataFrame:
    return priors(spark, d).withColumn("testament", F.when(F.col("lexeme").startswith("grc"), "NT").otherwise("OT"))


@query(f"""WITH {PAIRS}, {PRIORS}, c AS (SELECT lexeme, strong, surface, count(*) AS count FROM pairs WHERE content AND method = 'eflomal' GROUP BY ALL), cl AS (SELECT lexeme, surface, sum(count) AS count FROM c GROUP BY 1, 2), cs AS (SELECT strong, surface, sum(count) AS count FROM c GROUP BY 1, 2),
fl AS (SELECT cl.* FROM cl WHERE lexeme NOT IN (SELECT lexeme FROM priors WHERE keyness IS NULL)), bl AS ({_tops("lexeme", "fl", 5)}), bs AS ({_tops("strong", "cs", 5)}), bh AS ({_tops("lexeme", "cl", 3)}),
ln AS (SELECT DISTINCT lexeme AS via, unnest(lxx_greek) AS strong FROM priors WHERE lexeme LIKE 'hbo%'), gk AS (SELECT lexeme, strong FROM priors WHERE lexeme LIKE 'grc%' AND keyness IS NOT NULL), br AS (SELECT gk.lexeme, list_distinct(flatten(list(bh.vs))) AS vs FROM ln JOIN gk USING (strong) JOIN bh ON bh.lexeme = via GROUP BY 1),
t AS (SELECT lexeme, strong FROM pairs GROUP BY 1, 2),
x AS (SELECT t.lexeme, t.strong, bl.vs AS a, bs.vs AS b, br.vs AS c, list_distinct(list_concat(list_concat(coalesce(bl.vs, []), coalesce(bs.vs, [])), coalesce(br.vs, []))) AS vs FROM t LEFT JOIN bl ON bl.lexeme = t.lexeme LEFT JOIN bs ON bs.strong = t.strong LEFT JOIN br ON br.lexeme = t.lexeme)
SELECT lexeme, strong, coalesce(len(a), 0)::INT AS by_lexeme, coalesce(len(b), 0)::INT AS by_strong, coalesce(len(c), 0)::INT AS bridged, array_to_string(list_sort(list_transform(vs, lambda v: array_to_string(v, ' '))), '; ') AS variants FROM x""")
def bootstrap_lookup(spark: SparkSession, d: str) -> DataFrame:
    """What an earlier lexicon's links, its number keys and the old translation offer for each lexeme."""
    p = pairs(spark, d)
    lex = L.usable(p).groupBy("lexeme", "strong", "surface", "method").agg(F.count("*").alias("count"))
    three = gloss.bootstrap(lex, pack_of(spark, d))
    out = gloss.bootstrapped(p.select("lexeme", "strong").distinct(), *three)
    for t, key, name in zip(three, ("lexeme", "strong", "lexeme"), ("by_lexeme", "by_strong", "bridged"), strict=True):
        out = out.join(t.select(key, F.size("variants").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out.select("lexeme", "strong", "by_lexeme", "by_strong", "bridged", first_words(F.col("variants")).alias("variants"))


@query(f"""WITH {PAIRS}, k AS (SELECT surface, strong || '|' || lower(trim(nfc_normalize(strip_accents(word2)))) AS key FROM pairs WHERE content) SELECT surface, key, count(*) AS n FROM k GROUP BY 1, 2""")
def lexeme_grain(spark: SparkSession, d: str) -> DataFrame:
    """The produced lexicon at the grain of number key and lemma."""
    p = pairs(spark, d).where("content")
    lemma = F.concat(F.lit(" "), F.initcap("word2"))
    return p.select("surface", K.strong_key(F.lower("strong"), lemma, "lexeme").alias("key")).groupBy("surface", "key").agg(F.count("*").alias("n"))


@query(f"""WITH {IPAIRS}, {IEF}, g AS (SELECT DISTINCT ref, strong FROM ipairs WHERE l_extendedprice > 30000), b AS (SELECT ef.iso, ef.ref, ef.strong, ef.score, ef.target AS e, gl.target AS g FROM ef JOIN gl ON gl.ref = ef.ref AND gl.h_idx = ef.h_idx)
SELECT iso, count(*) AS "both", round(count(*) FILTER (e = b.g) / count(*), 6) AS agree_rate, round(count(*) FILTER (score = 0.9) / count(*), 6) AS ef09_share, round(count(*) FILTER (e <> b.g AND g.ref IS NOT NULL) / count(*), 6) AS contested_share FROM b LEFT JOIN g ON g.ref = b.ref AND g.strong = b.strong GROUP BY 1""")
def agreement_features(spark: SparkSession, d: str) -> DataFrame:
    """What can be told of a language without its gold: agreement, links of both directions, contests."""
    p = with_iso(spark, d, pairs(spark, d))
    ef, gl, _ = methods(p)
    return S.gold_free(ef, gl, gold(p))


@query(f"""WITH {IPAIRS}, {IEF}, {IGOLD}, gw AS (SELECT DISTINCT ref, strong, word1 FROM gold), gk AS (SELECT DISTINCT ref, strong FROM gold), b AS (SELECT ef.iso, 'score ' || ef.score AS et, gl.stem AS gt, a.ref IS NOT NULL AS eh, c.ref IS NOT NULL AS gh FROM ef JOIN gl ON gl.ref = ef.ref AND gl.h_idx = ef.h_idx AND gl.target <> ef.target JOIN gk ON gk.ref = ef.ref AND gk.strong = ef.strong
LEFT JOIN gw a ON a.ref = ef.ref AND a.strong = ef.strong AND a.word1 = ef.target LEFT JOIN gw c ON c.ref = ef.ref AND c.strong = ef.strong AND c.word1 = gl.target),
k AS (SELECT iso, et, gt, count(*) AS n, count(*) FILTER (eh AND NOT gh) AS ew, count(*) FILTER (gh AND NOT eh) AS gw, count(*) FILTER (eh) AS e, count(*) FILTER (gh) AS g, count(*) FILTER (eh OR gh) AS o FROM b GROUP BY ALL),
r AS (SELECT *, gw > ew AND ew + gw >= 3 AS own, sum(gw) OVER w > sum(ew) OVER w AND sum(ew) OVER w + sum(gw) OVER w >= 3 AS every FROM k WINDOW w AS (PARTITION BY et, gt))
SELECT iso, sum(n)::BIGINT AS contested, round(sum(CASE WHEN own THEN n ELSE 0 END) / sum(n), 6) AS gl_share, round(sum(CASE WHEN own THEN g ELSE e END) / sum(n), 6) AS tailored, round(sum(CASE WHEN every THEN g ELSE e END) / sum(n), 6) AS universal, round(sum(e) / sum(n), 6) AS always_ef, round(sum(o) / sum(n), 6) AS oracle FROM r GROUP BY 1""")
def contest_tilt(spark: SparkSession, d: str) -> DataFrame:
    """How far a language's own rule leans to the glosses, and what it gains over the rule of all."""
    p = with_iso(spark, d, pairs(spark, d))
    ef, gl, _ = methods(p)
    at = gold(p).select("ref", "strong", F.col("word1").alias("target")).distinct().withColumn("h", F.lit(True))
    hit = lambda df: df.join(at, ["ref", "strong", "target"], "left").withColumn("hit", F.coalesce("h", F.lit(False))).drop("h")
    stem = p.select("ref", "h_idx", "stem")
    judged = hit(ef).join(gold(p).select("ref", "strong").distinct(), ["ref", "strong"], "left_semi").withColumnRenamed("tier", "ef_tier")
    return S.tilt(S.contested(judged, hit(gl).join(stem, ["ref", "h_idx"]).withColumn("gl_tier", F.col("stem"))), 3)


@query(f"""WITH {PAIRS}, r AS (SELECT CASE l_suppkey % 8 WHEN 0 THEN 'exact' WHEN 1 THEN 'stem' WHEN 2 THEN 'name' WHEN 3 THEN 'multi' WHEN 4 THEN 'stat' WHEN 5 THEN 'eflomal' WHEN 6 THEN 'gapfill' ELSE 'gloss' END AS method, l_discount * 10 AS s, CASE WHEN l_tax >= 0.03 THEN 'phrase' END AS prior, CASE l_partkey % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'stem' WHEN 2 THEN 'prefix' ELSE 'fuzzy' END AS match FROM pairs)
SELECT CASE method WHEN 'eflomal' THEN 'score ' || round(s, 1)::DECIMAL(4, 1) WHEN 'gloss' THEN match WHEN 'gapfill' THEN coalesce(prior, 'embedding') ELSE 'all' END AS tier, method IN ('exact', 'stem', 'name', 'multi') OR (method = 'stat' AND s >= 0.3) OR (method IN ('eflomal', 'gapfill') AND s >= 0.9) AS high, count(*) AS n FROM r GROUP BY 1, 2""")
def method_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Tiers and high confidence of all methods, fills without a prior as the scorers name them."""
    k = F.col("l_suppkey") % 8
    method = F.element_at(F.array(*map(F.lit, ("exact", "stem", "name", "multi", "stat", "eflomal", "gapfill", "gloss"))), (k + 1).cast("int"))
    score = F.col("l_discount") * 10
    match = F.element_at(F.array(*map(F.lit, ("exact", "stem", "prefix", "fuzzy"))), (F.col("l_partkey") % 4 + 1).cast("int"))
    tier = L.tier(method, F.round(score, 1).cast("decimal(4,1)"), match, F.when(F.col("l_tax") >= 0.03, "phrase"), "embedding")
    return pairs(spark, d).groupBy(tier.alias("tier"), L.method_high(method, score).alias("high")).agg(F.count("*").alias("n"))


@query(f"""WITH {PAIRS}, c AS (SELECT word1 AS surface, lexeme, count(*) AS count FROM pairs WHERE l_discount >= 0.02 GROUP BY 1, 2), t AS (SELECT surface, lexeme, row_number() OVER (PARTITION BY surface ORDER BY count DESC, lexeme) AS r FROM c),
g AS (SELECT word1 AS surface, count(*) AS tokens, list(DISTINCT lexeme) AS keys FROM pairs WHERE l_extendedprice > 75000 GROUP BY 1), f AS (SELECT word1 AS surface, list(DISTINCT lexeme) AS more FROM pairs WHERE l_quantity > 40 GROUP BY 1),
j AS (SELECT g.*, t.lexeme, coalesce(list_contains(keys, t.lexeme), false) OR coalesce(list_contains(more, t.lexeme), false) AS ok FROM g LEFT JOIN t ON g.surface = t.surface AND r = 1 LEFT JOIN f ON f.surface = g.surface)
SELECT count(*) AS gold_types, count(lexeme) AS shared_types, count(*) FILTER (ok) AS correct_types, sum(tokens)::BIGINT AS gold_tokens, sum(CASE WHEN lexeme IS NOT NULL THEN tokens ELSE 0 END)::BIGINT AS shared_tokens, sum(CASE WHEN ok THEN tokens ELSE 0 END)::BIGINT AS correct_tokens FROM j""")
def top1_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Top-1 accuracy where a second gold is asked on misses."""
    p = pairs(spark, d)
    lex = p.where("l_discount >= 0.02").groupBy(F.col("word1").alias("surface"), "lexeme").agg(F.count("*").alias("count"))
    rows = lambda keep: p.where(keep).select(F.col("word1").alias("surface"), "lexeme")
    return J.top1_accuracy(lex, rows("l_extendedprice > 75000"), rows("l_quantity > 40"))


@query(f"""WITH {PAIRS}, v AS (SELECT DISTINCT lexeme, unnest(regexp_extract_all(surface, '[\\p{{L}}\\p{{M}}]+')) AS w FROM (SELECT lexeme, surface, count(*) FILTER (score >= 0.9 AND coalesce(coherent, true)) AS h FROM pairs WHERE content GROUP BY 1, 2) WHERE h > 0)
SELECT p.ref, p.h_idx, (CASE WHEN a.w IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN b.w IS NOT NULL THEN 1 ELSE 0 END)::INT AS n_hits FROM pairs p LEFT JOIN v a ON a.lexeme = p.lexeme AND a.w = p.word1 LEFT JOIN v b ON b.lexeme = p.lexeme AND b.w = p.word2 WHERE NOT content""")
def vocabulary_multiword(spark: SparkSession, d: str) -> DataFrame:
    """Words of a verse that a lexeme is known by elsewhere, multiword surfaces taken word by word."""
    p = pairs(spark, d)
    vocab = L.vocabulary(L.additive_union(p), sure=True)
    rows = p.where("NOT content").select("ref", "h_idx", "lexeme", F.array("word1", "word2").alias("tokens"))
    return J.vocabulary_hits(rows, vocab).select("ref", "h_idx", F.size("hits").alias("n_hits"))


SOURCES = "o AS (SELECT ref AS verse_ref, strong, word1 AS text, NULL AS gloss, 'left' AS source FROM pairs WHERE l_suppkey % 2 = 0 UNION ALL SELECT ref, strong, NULL, word2, 'right' FROM pairs WHERE l_suppkey % 3 = 0)"


@query(f"WITH {PAIRS}, {SOURCES} SELECT verse_ref, source, strong, text, gloss, count(*) AS n FROM o GROUP BY ALL")
def occurrence_rows(spark: SparkSession, d: str) -> DataFrame:
    """The occurrence rows of two sources, of which each lacks a column."""
    p = pairs(spark, d)
    two = {"left": p.where("l_suppkey % 2 = 0").select(F.col("ref").alias("verse_ref"), "strong", F.col("word1").alias("text")), "right": p.where("l_suppkey % 3 = 0").select(F.col("ref").alias("verse_ref"), "strong", F.col("word2").alias("gloss"))}
    return J.occurrence_union(two).groupBy("verse_ref", "source", "strong", "text", "gloss").agg(F.count("*").alias("n"))


@query(f"""WITH {PAIRS}, {PRIORS}, f AS (SELECT lexeme, max(strong) AS strong, count(*) AS spine_freq FROM pairs WHERE content GROUP BY 1), g AS (SELECT f.* FROM f WHERE lexeme NOT IN (SELECT lexeme FROM pairs WHERE content AND l_quantity > 49.5 AND l_discount > 0.04))
SELECT lexeme, g.strong, spine_freq, coalesce(xling_confidence, 99) AS rank_confidence FROM g LEFT JOIN priors USING (lexeme) ORDER BY rank_confidence, spine_freq DESC, lexeme LIMIT 40""")
def recipe_gap_first(spark: SparkSession, d: str) -> DataFrame:
    """The first gaps in the order of the published recipe."""
    p = pairs(spark, d)
    gaps = J.gap_map(p, p.where("content AND l_quantity > 49.5 AND l_discount > 0.04"), priors(spark, d)).drop("xling_confidence")
    return J.recipe_order(gaps, "gap").limit(40)


CODES = """c AS (SELECT l_orderkey AS ref, max(CASE WHEN l_returnflag = 'A' OR l_suppkey % 4 = 0 THEN 1 ELSE 0 END) AS a, max(CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END) AS v, max(CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END) AS t, max(CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE 0 END) AS s,
max(CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END) AS o, max(CASE WHEN l_linenumber = 4 THEN 1 ELSE 0 END) AS n, max(CASE WHEN l_linenumber = 6 THEN 1 ELSE 0 END) AS d FROM lineitem GROUP BY 1),
k AS (SELECT ref, CASE WHEN a = 1 THEN 'a' ELSE '' END || CASE WHEN v = 1 THEN 'v' ELSE '' END || CASE WHEN t = 1 THEN 't' ELSE '' END || CASE WHEN s = 1 THEN 's' ELSE '' END AS media, CASE WHEN o = 1 THEN 'o' ELSE '' END || CASE WHEN n = 1 THEN 'n' ELSE '' END || CASE WHEN d = 1 THEN 'd' ELSE '' END AS codex FROM c)"""


@query(f"""WITH {CODES} SELECT media, codex, concat_ws(',', CASE WHEN contains(media, 'a') THEN 'audio' END, CASE WHEN contains(media, 'v') THEN 'video' END, CASE WHEN contains(media, 't') THEN 'audio_timed' END, CASE WHEN contains(media, 's') THEN 'video_timed' END) AS has_media,
concat_ws(',', CASE WHEN contains(codex, 'o') THEN 'old' END, CASE WHEN contains(codex, 'n') THEN 'new' END, CASE WHEN contains(codex, 'd') THEN 'deuterocanon' END) AS has_text, (NOT contains(media, 't') OR contains(media, 'a')) AND (NOT contains(media, 's') OR contains(media, 'v')) AS sound, count(*) AS n FROM k GROUP BY ALL""")
def presence_badges(spark: SparkSession, d: str) -> DataFrame:
    """Presence codes made of what is there, and what a client reads off them letter by letter."""
    li = table(spark, d, "lineitem")
    any_ = lambda holds: F.max(holds)
    c = li.groupBy("l_orderkey").agg(
        any_((F.col("l_returnflag") == "A") | (F.col("l_suppkey") % 4 == 0)).alias("a"), any_(F.col("l_suppkey") % 5 == 0).alias("v"), any_(F.col("l_partkey") % 3 == 0).alias("t"), any_(F.col("l_partkey") % 7 == 0).alias("s"),
        any_(F.col("l_linenumber") == 2).alias("o"), any_(F.col("l_linenumber") == 4).alias("n"), any_(F.col("l_linenumber") == 6).alias("d"),
    )
    k = c.select(K.presence_code({x: F.col(x) for x in "avts"}).alias("media"), K.presence_code({x: F.col(x) for x in "ond"}).alias("codex"))
    names = lambda col, letters: F.array_join(K.presence(F.col(col), letters), ",")
    out = k.select("*", names("media", K.MEDIA).alias("has_media"), names("codex", K.CODEX).alias("has_text"), K.sound_media(F.col("media")).alias("sound"))
    return out.groupBy("media", "codex", "has_media", "has_text", "sound").agg(F.count("*").alias("n"))


@query(f"""WITH {PAIRS}, mf AS (SELECT p_partkey, 'm' || left(regexp_replace(p_brand, '[^0-9]', '', 'g'), 1) || CASE WHEN p_brand NOT SIMILAR TO '.*#[12].*' THEN '' WHEN p_size >= 25 THEN 'g' ELSE 'h' END AS m FROM part), q AS (SELECT pairs.*, m FROM pairs JOIN mf ON l_partkey = p_partkey),
g AS (SELECT m, strong FROM (SELECT m, strong, row_number() OVER (PARTITION BY m ORDER BY count(*) DESC, strong) AS r FROM q WHERE l_extendedprice > 30000 GROUP BY 1, 2) WHERE r = 1),
v AS (SELECT q.lexeme, g.strong AS key, count(*) AS n, max(q.strong) AS own FROM q JOIN g USING (m) WHERE content AND NOT contains(trim(m), ' ') AND q.lexeme LIKE 'hbo:%' GROUP BY 1, 2),
b AS (SELECT *, sum(n) OVER w AS total, max(own) OVER w AS mine, row_number() OVER (PARTITION BY lexeme ORDER BY n DESC, key) AS r FROM v WINDOW w AS (PARTITION BY lexeme))
SELECT lexeme, key AS to_key, n, total::BIGINT AS total FROM b WHERE r = 1 AND total >= 10 AND n / total >= 0.9 AND key <> mine AND regexp_matches(key, '^H')""")
def remap_guarded(spark: SparkSession, d: str) -> DataFrame:
    """Hebrew lexemes whose surfaces the gold knows under another Hebrew key; Greek keys are never taken."""
    maker = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat(F.lit("m"), F.left(F.regexp_replace("p_brand", "[^0-9]", ""), F.lit(1)), F.when(~F.col("p_brand").rlike("#[12]"), "").when(F.col("p_size") >= 25, "g").otherwise("h")).alias("m"))
    p = pairs(spark, d).join(maker, "l_partkey").drop("surface").withColumnRenamed("m", "surface")
    hebrew = p.where("lexeme LIKE 'hbo:%'").select("lexeme")
    return L.remap_table(p, p.where("l_extendedprice > 30000").select("surface", "strong"), hebrew)


@query("""WITH a AS (SELECT n_nationkey AS iso FROM nation), e AS (SELECT c_nationkey AS iso, CASE c_mktsegment WHEN 'BUILDING' THEN 'dbt' ELSE 'pkf' END AS source FROM customer WHERE c_acctbal > 9900)
SELECT iso FROM a WHERE iso NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000) AND iso NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -990) AND iso IN (SELECT iso FROM e) AND iso NOT IN (SELECT iso FROM e WHERE source = 'dbt')""")
def catalog_plan_without(spark: SparkSession, d: str) -> DataFrame:
    """Languages to do that have an edition, and none of the source that is left out."""
    c = table(spark, d, "customer")
    editions = c.where("c_acctbal > 9900").select(F.col("c_nationkey").alias("iso"), F.when(F.col("c_mktsegment") == "BUILDING", "dbt").otherwise("pkf").alias("source"))
    done = table(spark, d, "supplier").where("s_acctbal > 8000").select(F.col("s_nationkey").alias("iso"))
    return E.plan(table(spark, d, "nation").select(F.col("n_nationkey").alias("iso")), done, c.where("c_acctbal < -990").select(F.col("c_nationkey").alias("iso")), editions=editions, without="dbt")


# -- tags, stale outputs, titles, references

TAGS = "t AS (SELECT CASE WHEN c_custkey % 4 = 3 THEN upper(left(c_mktsegment, 3)) ELSE lower(left(c_mktsegment, 3)) END || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '_' || c_custkey END || CASE WHEN c_custkey % 10 = 4 THEN 'x' ELSE '' END AS tag, c_custkey FROM customer), m AS (SELECT tag, min('m' || c_custkey % 9) AS iso FROM t WHERE c_custkey % 5 = 0 GROUP BY 1), l AS (SELECT tag, min('l' || c_custkey % 7) AS iso FROM t WHERE c_custkey % 2 = 0 GROUP BY 1)"
RESOLVED = TAGS + ", r AS (SELECT d.tag, coalesce(m.iso, l.iso, nullif(regexp_extract(d.tag, '^([a-z]{3})(?:_|$)', 1), '')) AS iso FROM (SELECT DISTINCT tag FROM t) d LEFT JOIN m ON m.tag = d.tag LEFT JOIN l ON l.tag = d.tag)"


def resolved(spark: SparkSession, d: str) -> DataFrame:
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    first = F.left("c_mktsegment", F.lit(3))
    tag = F.concat(F.when(k % 4 == 3, F.upper(first)).otherwise(F.lower(first)), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("_"), k.cast("string"))), F.when(k % 10 == 4, "x").otherwise(""))
    t = c.select(tag.alias("tag"), k.alias("k"))
    named = lambda keep, letter, m: t.where(keep).groupBy("tag").agg(F.min(F.concat(F.lit(letter), (F.col("k") % m).cast("string"))).alias("iso"))
    return E.resolve_iso(t.select("tag").distinct(), named("k % 5 = 0", "m", 9), named("k % 2 = 0", "l", 7))


@query(f"WITH {RESOLVED} SELECT * FROM r")
def resolved_tags(spark: SparkSession, d: str) -> DataFrame:
    """The language of a tag: by the manifest, an older map, or how it begins."""
    return resolved(spark, d)


@query(f"WITH {RESOLVED}, p AS (SELECT DISTINCT 'm' || s_nationkey % 9 AS iso FROM supplier WHERE s_acctbal > 3000 UNION SELECT DISTINCT 'l' || s_nationkey % 7 FROM supplier WHERE s_acctbal > 5000), q AS (SELECT DISTINCT CASE WHEN n_nationkey % 2 = 0 THEN 'm' ELSE 'l' END || n_regionkey AS iso FROM nation) SELECT tag, r.iso FROM r WHERE iso IN (SELECT iso FROM p) AND iso IN (SELECT iso FROM q)")
def cleanable_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags whose language is in every published dataset."""
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    code = lambda letter, number: F.concat(F.lit(letter), number.cast("string")).alias("iso")
    one = s.where("s_acctbal > 3000").select(code("m", F.col("s_nationkey") % 9)).union(s.where("s_acctbal > 5000").select(code("l", F.col("s_nationkey") % 7)))
    two = n.select(F.concat(F.when(F.col("n_nationkey") % 2 == 0, "m").otherwise("l"), F.col("n_regionkey").cast("string")).alias("iso"))
    return E.safe_to_clean(resolved(spark, d), one, two)


@query("SELECT o_orderkey, out IS NULL OR out < o_orderdate OR out < o_orderdate + INTERVAL 30 DAY AS stale FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS out FROM lineitem WHERE l_quantity > 20 GROUP BY 1) ON l_orderkey = o_orderkey")
def stale_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Outputs that are missing or older than what they were made from."""
    made = table(spark, d, "lineitem").where("l_quantity > 20").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("out"))
    both = table(spark, d, "orders").join(made, "o_orderkey", "left")
    return both.select("o_orderkey", E.is_stale(F.col("o_orderdate"), F.col("out"), F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("stale"))


@query(f"WITH {PAIRS}, c AS (SELECT ref, h_idx, max(CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY ref ORDER BY h_idx ROWS UNBOUNDED PRECEDING) = 0 AS lead FROM pairs WHERE content) SELECT p.ref, p.h_idx, coalesce(lead, false) AS is_superscription FROM pairs p LEFT JOIN c ON c.ref = p.ref AND c.h_idx = p.h_idx")
def superscriptions(spark: SparkSession, d: str) -> DataFrame:
    """The content tokens from the start of a verse for as long as they are words of a title."""
    from ..operators.corpus import superscriptions as mark

    return mark(pairs(spark, d), F.col("l_partkey") % 3 != 0).select("ref", "h_idx", "is_superscription")


REF = "CASE l_linenumber % 4 WHEN 0 THEN 'GEN ' || l_partkey || ':' || l_suppkey WHEN 1 THEN '  1SA  ' || l_suppkey || ':' || l_linenumber || ' ' WHEN 2 THEN 'MAT ' || l_partkey ELSE 'no ref' END"


@query(f"WITH r AS (SELECT l_orderkey, l_linenumber, {REF} AS t FROM lineitem), p AS (SELECT *, regexp_extract(t, '^\\s*(\\w+)\\s+(\\d+):(\\d+)\\s*$', ['b', 'c', 'v']) AS x FROM r) SELECT nullif(x.b, '') AS book, nullif(x.c, '')::INT AS chapter, nullif(x.v, '')::INT AS verse, count(*) AS n FROM p GROUP BY ALL")
def parsed_references(spark: SparkSession, d: str) -> DataFrame:
    """References written as text, read into book, chapter and verse; others are null."""
    n, part, supp = F.col("l_linenumber") % 4, F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    text = F.when(n == 0, F.concat(F.lit("GEN "), part, F.lit(":"), supp)).when(n == 1, F.concat(F.lit("  1SA  "), supp, F.lit(":"), F.col("l_linenumber").cast("string"), F.lit(" "))).when(n == 2, F.concat(F.lit("MAT "), part)).otherwise("no ref")
    return table(spark, d, "lineitem").select(K.parse_ref(text).alias("x")).groupBy("x.book", "x.chapter", "x.verse").agg(F.count("*").alias("n"))


CELL = "p_name || CASE p_size % 5 WHEN 0 THEN '; ' WHEN 1 THEN ' atau ' WHEN 2 THEN '/' WHEN 3 THEN ',,' ELSE ' ' END || p_type || CASE WHEN p_size % 3 = 0 THEN ' (' || p_brand || ')' ELSE ';12' END"


@query(f"""WITH c AS (SELECT p_partkey, list_filter(list_transform(string_split_regex(lower({CELL}), '[;,/]| atau '), lambda p: regexp_extract_all(p, '\\p{{L}}+')), lambda w: len(w) > 0) AS v, regexp_replace('q' || p_size, '[0-9]+$', '') || regexp_replace('pi' || p_brand, '[0-9]+$', '') AS markers, regexp_extract_all(lower(p_brand || ' ' || p_type), '\\p{{L}}+') AS t FROM part)
SELECT p_partkey, array_to_string(list_transform(v, lambda w: array_to_string(w, ' ')), '; ') AS variants, len(v)::INT AS n, markers, array_to_string(t, ' ') AS title FROM c""")
def gloss_cells(spark: SparkSession, d: str) -> DataFrame:
    """Gloss cells as word lists, titles as words, markers without their numbers."""
    from ..functions import text as T

    k = F.col("p_size")
    sep = F.element_at(F.array(*map(F.lit, ("; ", " atau ", "/", ",,", " "))), (k % 5 + 1).cast("int"))
    cell = F.concat("p_name", sep, "p_type", F.when(k % 3 == 0, F.concat(F.lit(" ("), "p_brand", F.lit(")"))).otherwise(";12"))
    v = table(spark, d, "part").select("*", T.variants(cell).alias("v"))
    markers = F.concat(T.base_marker(F.concat(F.lit("q"), k.cast("string"))), T.base_marker(F.concat(F.lit("pi"), "p_brand")))
    lists = F.array_join(F.transform("v", lambda w: F.array_join(w, " ")), "; ")
    return v.select("p_partkey", lists.alias("variants"), F.size("v").alias("n"), markers.alias("markers"), F.array_join(T.title_words(F.concat_ws(" ", "p_brand", "p_type")), " ").alias("title"))


@query("""WITH w AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) || CASE p_size % 3 WHEN 0 THEN 'nya' WHEN 1 THEN 'an' ELSE '' END AS word FROM part UNION SELECT DISTINCT CASE p_size % 2 WHEN 0 THEN 'me' ELSE 'di' END || lower(split_part(p_name, ' ', 2)) || CASE p_size % 3 WHEN 0 THEN 'kan' ELSE 'i' END FROM part),
s AS (SELECT word, word AS base FROM w UNION SELECT word, word[1 : len(word) - len(a)] FROM w, (SELECT unnest(CASE WHEN 1 = 1 THEN ['an', 'i', 'kah', 'ku', 'lah', 'mu', 'nya', 'pun'] END) AS a) x WHERE ends_with(word, a) AND len(word) - len(a) >= 3),
p AS (SELECT * FROM s UNION SELECT word, base[len(b) + 1 :] FROM s, (SELECT unnest(CASE WHEN 1 = 1 THEN ['ber', 'di', 'ke', 'me', 'mem', 'men', 'meng', 'meny', 'pe', 'per', 'se', 'ter'] END) AS b) y WHERE starts_with(base, b) AND len(base) - len(b) >= 3)
SELECT w.word, concat_ws(',', w.word, string_agg(base, ',' ORDER BY len(base) DESC, base) FILTER (base <> w.word)) AS forms FROM w JOIN p ON p.word = w.word GROUP BY 1""")
def indonesian_forms(spark: SparkSession, d: str) -> DataFrame:
    """Words by the registered rule of one language."""
    from ..functions.normalizers import forms_table

    p = table(spark, d, "part")
    part = lambda k: F.split(F.lower("p_name"), " ")[k]
    k = F.col("p_size")
    one = p.select(F.concat(part(0), F.when(k % 3 == 0, "nya").when(k % 3 == 1, "an").otherwise("")).alias("word"))
    two = p.select(F.concat(F.when(k % 2 == 0, "me").otherwise("di"), part(1), F.when(k % 3 == 0, "kan").otherwise("i")).alias("word"))
    return forms_table(one.union(two).withColumn("iso", F.lit("ind"))).select("word", F.array_join("forms", ",").alias("forms"))
