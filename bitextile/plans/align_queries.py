"""Queries over gloss alignment, gap filling, editions and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import editions as E
from ..operators import gapfill as G
from ..operators import gloss
from ..operators import lexicon as L
from ..sources.scratch import written
from .proxy import PAIRS, pairs, table
from .registry import query


def verses(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (written once, as each part of a plan would make them anew), source tokens and target tokens: every line gives two
    target words."""
    p = written(pairs(spark, d).drop("t_idx", "l_extendedprice", "l_quantity"), "pairs")
    source = p.select("ref", "h_idx", "strong", "lexeme", "content", "phrase_id", "function", F.when(F.col("l_partkey") % 2 == 0, "NA").otherwise("rec").alias("rela"), F.col("sense").alias("number"), F.col("word2").alias("gloss_en"), (F.col("l_suppkey") % 9 == 0).alias("is_name"))
    two = F.array(*(F.struct((2 * F.col("h_idx") + k).cast("long").alias("place"), F.col(f"word{k + 1}").alias("token")) for k in (0, 1)))
    target = p.select("ref", F.explode(two).alias("x")).select("ref", "x.place", "x.token", (F.col("x.token") == "large").alias("blocked"))
    return p, source, target


@query()
def gloss_align(spark: SparkSession, d: str) -> DataFrame:
    p, source, target = verses(spark, d)
    priors = gloss.bootstrap_priors(L.additive_union(p.where("l_discount >= 0.08")), k=2)
    wide = p.groupBy("lexeme").agg(F.avg((F.col("l_tax") < 0.04).cast("double")).alias("multiword_rate"))
    light = p.where("light").select("lexeme").distinct()
    return gloss.align(source, target, priors, multiword=wide, light=light)


def covered(p: DataFrame) -> DataFrame:
    return p.where("content AND l_discount >= 0.03").select("ref", "h_idx", (2 * F.col("h_idx")).cast("long").alias("anchor"))


def scored(spark: SparkSession, d: str) -> DataFrame:
    """The scored fills of all gaps, with every prior. Priors are written, so that Spark knows how small they are before it deals
    out what is joined to them."""
    p, source, target = verses(spark, d)
    own = covered(p).withColumn("places", F.array("anchor", F.col("anchor") + 1))
    known = written(L.known_surfaces(p.where("l_discount >= 0.03"), share=0.05).select("strong", "word"), "known")
    vocab = written(p.where("content AND score >= 0.9").select("lexeme", F.col("word1").alias("word")).distinct(), "vocab")
    by_lexeme = written(p.groupBy("lexeme").agg(F.max("stem").alias("pos"), F.max("word2").alias("translit"), F.avg((F.col("l_tax") < 0.05).cast("double")).alias("multiword_rate")), "lexemes")
    priors, wide = by_lexeme.drop("multiword_rate"), by_lexeme.select("lexeme", "multiword_rate")
    target_pos = L.majority(p.select("word1", "stem"), ["word1"], "stem", 1, 0.0).select(F.col("word1").alias("word"), F.col("stem").alias("pos"))
    target_pos = written(target_pos, "target_pos")
    morph = written(G.morph_surfaces(p.withColumnRenamed("sense", "number"), ["number"]), "morph")
    return G.scored(source, target, own, known, vocab, priors, target_pos, expected=G.phrase_expected(source, own.drop("places")), morph=morph, wide=wide)


@query(f"""WITH {PAIRS}, c AS (SELECT ref, h_idx, 2 * h_idx AS anchor FROM pairs WHERE content AND l_discount >= 0.03), tg AS (SELECT ref, 2 * h_idx AS place, word1 AS word FROM pairs UNION ALL SELECT ref, 2 * h_idx + 1, word2 FROM pairs),
taken AS (SELECT ref, anchor AS place FROM c UNION SELECT ref, anchor + 1 FROM c), free AS (SELECT * FROM tg ANTI JOIN taken USING (ref, place) WHERE word <> 'large'),
s AS (SELECT ref, h_idx, h_idx AS p, count(*) OVER (PARTITION BY ref) AS n_s, strong, lexeme, content, phrase_id, l_partkey % 2 = 0 AS na, sense AS number FROM pairs),
a AS (SELECT s.*, anchor, max(CASE WHEN anchor IS NOT NULL THEN p END) OVER (PARTITION BY ref ORDER BY p) AS bp, min(CASE WHEN anchor IS NOT NULL THEN p END) OVER (PARTITION BY ref ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ap FROM s LEFT JOIN c USING (ref, h_idx)),
g AS (SELECT *, CASE WHEN bp IS NOT NULL AND ap IS NOT NULL THEN 2 * bp + (p - bp) / (ap - bp) * (2 * ap - 2 * bp) WHEN bp IS NOT NULL THEN 2 * bp WHEN ap IS NOT NULL THEN 2 * ap ELSE p / n_s * (2 * n_s) END AS expected FROM a WHERE anchor IS NULL AND content),
m AS (SELECT s.ref, s.phrase_id, s.h_idx AS m, s.na AS m_na, c.anchor FROM s JOIN c USING (ref, h_idx)), mj AS (SELECT s.ref, s.h_idx, m, anchor, NOT s.na AND m_na AS dep, s.na AND NOT m_na AS head FROM s JOIN m USING (ref, phrase_id) WHERE s.h_idx <> m),
ph AS (SELECT ref, h_idx, anchor + CASE WHEN dep THEN 1 WHEN head THEN -1 WHEN h_idx > m THEN 1 ELSE -1 END AS p_exp FROM (SELECT *, row_number() OVER (PARTITION BY ref, h_idx ORDER BY dep OR head DESC, abs(m - h_idx), m) AS r FROM mj) WHERE r = 1),
kw AS (SELECT strong, w AS word, count(*) AS n FROM (SELECT strong, unnest(string_split(surface, ' ')) AS w FROM pairs WHERE content AND l_discount >= 0.03) GROUP BY 1, 2),
known AS (SELECT strong, word FROM (SELECT *, row_number() OVER (PARTITION BY strong ORDER BY n DESC, word) AS r FROM (SELECT *, n / sum(n) OVER (PARTITION BY strong) AS share FROM kw) WHERE round(share, 6) >= 0.05) WHERE r <= 5),
vocab AS (SELECT DISTINCT lexeme, word1 AS word FROM pairs WHERE content AND score >= 0.9), pr AS (SELECT lexeme, max(stem) AS pos, max(word2) AS translit FROM pairs GROUP BY 1),
tp AS (SELECT word, arg_min(pos, r) AS t_pos FROM (SELECT word1 AS word, stem AS pos, row_number() OVER (PARTITION BY word1 ORDER BY count(*) DESC, stem) AS r FROM pairs GROUP BY word1, stem) WHERE r = 1 GROUP BY 1),
mo AS (SELECT strong, number, word FROM (SELECT strong, sense AS number, word1 AS word, row_number() OVER (PARTITION BY strong, sense ORDER BY count(*) DESC, word1) AS r FROM pairs GROUP BY 1, 2, 3 HAVING count(*) >= 3) WHERE r <= 3),
wide AS (SELECT lexeme, avg(CASE WHEN l_tax < 0.05 THEN 1.0 ELSE 0.0 END) AS rate FROM pairs GROUP BY 1),
j AS (SELECT g.ref, g.h_idx, f.place, k.word IS NOT NULL AS strong, k.word IS NULL AND v.word IS NOT NULL AS crossed, coalesce(abs(f.place - p_exp) <= 1, false) AS phrase, coalesce(pos = t_pos, false) AS pos_ok, mo.word IS NOT NULL AND k.word IS NOT NULL AS morph_ok,
CASE WHEN p_exp IS NOT NULL THEN 0.6 * abs(f.place - p_exp) ELSE 0.2 * abs(f.place - expected) END / (2 * n_s) AS away, p_exp, coalesce(rate >= 0.6, false) AND nx.place IS NOT NULL AS grows
FROM g JOIN free f USING (ref) LEFT JOIN known k ON k.strong = g.strong AND k.word = f.word LEFT JOIN vocab v ON v.lexeme = g.lexeme AND v.word = f.word LEFT JOIN pr ON pr.lexeme = g.lexeme LEFT JOIN tp ON tp.word = f.word LEFT JOIN ph ON ph.ref = g.ref AND ph.h_idx = g.h_idx
LEFT JOIN mo ON mo.strong = g.strong AND mo.number = g.number AND mo.word = f.word LEFT JOIN wide ON wide.lexeme = g.lexeme LEFT JOIN free nx ON nx.ref = f.ref AND nx.place = f.place + 1)
SELECT ref, h_idx, place::BIGINT AS place, round(CASE WHEN strong THEN 0.6 ELSE 0 END + CASE WHEN crossed THEN 0.5 ELSE 0 END + CASE WHEN phrase THEN 0.4 ELSE 0 END + CASE WHEN pos_ok THEN 0.15 ELSE 0 END + CASE WHEN morph_ok THEN 0.1 ELSE 0 END - away, 6)::DOUBLE + 0.0 AS score,
CASE WHEN strong THEN 'strong' WHEN crossed THEN 'cross_edition' ELSE 'phrase' END AS prior, strong OR crossed AS vocab, grows FROM j WHERE strong OR crossed OR phrase""")
def gapfill_scored(spark: SparkSession, d: str) -> DataFrame:
    """Candidates before the greedy passes."""
    return scored(spark, d).withColumn("score", F.round("score", 6) + 0.0)  # no negative zero


@query()
def gapfill_fill(spark: SparkSession, d: str) -> DataFrame:
    return G.fill(scored(spark, d)).withColumn("places", F.array_join("places", ","))


@query(f"""WITH {PAIRS}, s AS (SELECT *, CASE WHEN l_partkey % 2 = 0 THEN 'NA' ELSE 'rec' END AS rela FROM pairs), c AS (SELECT ref, h_idx, 2 * h_idx AS anchor FROM pairs WHERE content AND l_discount >= 0.03),
m AS (SELECT s.ref, s.phrase_id, s.h_idx AS m, s.rela AS m_rela, c.anchor FROM s JOIN c USING (ref, h_idx)), j AS (SELECT s.ref, s.h_idx, m, anchor, rela = 'rec' AND m_rela = 'NA' AS dep, rela = 'NA' AND m_rela = 'rec' AS head FROM s JOIN m USING (ref, phrase_id) WHERE s.h_idx <> m),
r AS (SELECT *, row_number() OVER (PARTITION BY ref, h_idx ORDER BY dep OR head DESC, abs(m - h_idx), m) AS r FROM j) SELECT ref, h_idx, (anchor + CASE WHEN dep THEN 1 WHEN head THEN -1 WHEN h_idx > m THEN 1 ELSE -1 END)::DOUBLE AS p_exp FROM r WHERE r = 1""")
def phrase_expected(spark: SparkSession, d: str) -> DataFrame:
    p, source, _ = verses(spark, d)
    return G.phrase_expected(source, covered(p)).select("ref", "h_idx", "p_exp")


@query(f"""WITH {PAIRS}, o AS (SELECT ref, phrase_id, 2 * h_idx AS anchor, l_partkey % 2 = 0 AS na FROM pairs WHERE content AND l_discount >= 0.03), j AS (SELECT d.anchor AS d, h.anchor AS h FROM o d JOIN o h ON d.ref = h.ref AND d.phrase_id = h.phrase_id WHERE NOT d.na AND h.na)
SELECT count(*) AS n, count(*) FILTER (d > h) AS after, round(count(*) FILTER (d > h) / count(*), 6) AS rate, coalesce(count(*) >= 50 AND abs(count(*) FILTER (d > h) / count(*) - 0.5) >= 0.2, false) AS use FROM j""")
def construct_order(spark: SparkSession, d: str) -> DataFrame:
    p, source, _ = verses(spark, d)
    return G.construct_rate(source, covered(p))


@query(f"""WITH {PAIRS}, u AS (SELECT strong, word1, 'sense' AS feature, sense AS value FROM pairs UNION ALL SELECT strong, word1, 'stem', stem FROM pairs), c AS (SELECT strong, feature, value, word1 AS word, count(*) AS n FROM u GROUP BY ALL HAVING count(*) >= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY strong, feature, value ORDER BY n DESC, word)::INT AS rank FROM c) SELECT * FROM r WHERE rank <= 3""")
def morph_agreement(spark: SparkSession, d: str) -> DataFrame:
    return G.morph_surfaces(pairs(spark, d), ["sense", "stem"])


@query(f"WITH {PAIRS} SELECT ref, h_idx FROM pairs WHERE content AND NOT (l_discount >= 0.03)")
def gap_tokens(spark: SparkSession, d: str) -> DataFrame:
    p, source, _ = verses(spark, d)
    return G.gaps(source, covered(p)).select("ref", "h_idx")


RANKS = "CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 2 WHEN 'MACHINERY' THEN 3 ELSE 4 END"


@query(f"SELECT c_nationkey AS iso, arg_min(c_custkey, ({RANKS}, c_custkey)) AS edition, arg_min(c_mktsegment, ({RANKS}, c_custkey)) AS source FROM customer GROUP BY 1")
def edition_priority(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("iso"), F.col("c_custkey").alias("edition"), F.col("c_mktsegment").alias("source"))
    return E.preferred(c, ["iso"], "source", ["BUILDING", "AUTOMOBILE", "MACHINERY"], "edition")


@query("""SELECT n_nationkey AS iso FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000) AND n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -900)""")
def catalog_plan(spark: SparkSession, d: str) -> DataFrame:
    all_ = table(spark, d, "nation").select(F.col("n_nationkey").alias("iso"))
    done = table(spark, d, "supplier").where("s_acctbal > 8000").select(F.col("s_nationkey").alias("iso"))
    out = table(spark, d, "customer").where("c_acctbal < -900").select(F.col("c_nationkey").alias("iso"))
    return E.plan(all_, done, out)


@query("SELECT c_custkey, CASE WHEN starts_with(lower(c_name), lower(left(c_mktsegment, 3))) THEN c_name ELSE lower(left(c_mktsegment, 3)) || '_' || c_name END AS edition_id, regexp_replace(lower(c_name), '[^a-z0-9]', '_', 'g') AS tag FROM customer")
def edition_names(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.keys import edition_id, edition_tag

    iso = F.lower(F.left("c_mktsegment", F.lit(3)))
    return table(spark, d, "customer").select("c_custkey", edition_id(iso, F.col("c_name")).alias("edition_id"), edition_tag(iso, F.col("c_name")).alias("tag"))


@query("SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS count, count(*) FILTER (value >= 50) AS high FROM events GROUP BY 1, 2")
def stream_additive_union(spark: SparkSession, d: str) -> DataFrame:
    """The additive union kept by a stream over the events."""
    from ..streaming.incremental import additive_counts, run_once, stream_of

    events = table(spark, d, "events")
    stream = stream_of(spark, f"{d}/events.parquet", events.schema)
    counts = additive_counts(stream.withColumn("hour", F.date_trunc("hour", "ts")), ["event_type", "hour"], F.col("value") >= 50)
    return run_once(spark, counts)
