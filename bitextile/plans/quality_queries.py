"""Queries over quality measures, lookups and small predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import joins as J
from ..operators import lexicon as L
from ..operators import scoring as S
from .join_queries import EF, GOLD, IEF, VOTES, gold, methods, votes
from .proxy import IPAIRS, PAIRS, pairs, table, with_iso
from .registry import query


@query(f"""WITH {PAIRS}, {EF}, {VOTES}, b AS (SELECT ref, h_idx, target, count(DISTINCT method) AS agree, max(score) AS best, max(r) AS first FROM votes GROUP BY 1, 2, 3),
w AS (SELECT *, row_number() OVER (PARTITION BY ref, h_idx ORDER BY agree DESC, best DESC, first DESC, target) AS k FROM b) SELECT agree, count(*) AS n FROM w WHERE k = 1 GROUP BY 1""")
def vote_histogram(spark: SparkSession, d: str) -> DataFrame:
    return S.merge_vote(votes(pairs(spark, d))).groupBy("agree").agg(F.count("*").alias("n"))


@query(f"""WITH {PAIRS}, {EF}, {GOLD}, g AS (SELECT DISTINCT ref, strong, word1 FROM gold), j AS (SELECT f.ref, f.h_idx, f.stem AS prior, bool_or(g.word1 = f.target) AS hit FROM gap f JOIN g USING (ref, strong) GROUP BY 1, 2, 3)
SELECT prior, count(*) AS n, count(*) FILTER (hit) AS correct, round(count(*) FILTER (hit) / count(*), 6) AS precision FROM j GROUP BY 1""")
def gapfill_precision(spark: SparkSession, d: str) -> DataFrame:
    p = pairs(spark, d)
    gap = methods(p)[2].join(p.select("ref", "h_idx", F.col("stem").alias("prior")), ["ref", "h_idx"])
    return S.precision_by(J.gold_join(gap, gold(p), F.array("target")), ["prior"])


@query(f"""WITH {IPAIRS}, t AS (SELECT iso, l_suppkey % 4 AS scheme, count(*) FILTER (score >= 0.9 AND coalesce(coherent, true)) AS high, count(*) AS n FROM ipairs WHERE content AND ref % 10 = 9 GROUP BY 1, 2)
SELECT iso, arg_max(scheme, (high, -scheme)) AS scheme, max(high) AS high FROM t GROUP BY 1""")
def scheme_winner(spark: SparkSession, d: str) -> DataFrame:
    """The scheme with most high pairs in the books that tell schemes apart."""
    rows = with_iso(spark, d, pairs(spark, d)).where("content AND ref % 10 = 9").withColumn("scheme", F.col("l_suppkey") % 4)
    tallies = rows.groupBy("iso", "scheme").agg(F.count_if(L.is_high(F.col("score"), F.col("coherent"))).alias("high"))
    return L.top_k(tallies, ["iso"], [F.desc("high"), F.asc("scheme")], 1).drop("rank")


@query(f"""WITH {PAIRS}, c AS (SELECT word1 AS word, count(*) AS freq, count(DISTINCT lexeme) AS partners FROM pairs WHERE content GROUP BY 1), w AS (SELECT word1 AS word FROM pairs GROUP BY 1 HAVING count(*) >= 3500), g AS (SELECT word FROM c WHERE partners >= 10 AND freq >= 2800)
SELECT count(*) FILTER (w.word IS NOT NULL AND g.word IS NOT NULL) AS tp, count(*) FILTER (g.word IS NULL) AS fp, count(*) FILTER (w.word IS NULL) AS fn,
round(count(*) FILTER (w.word IS NOT NULL AND g.word IS NOT NULL) / nullif(count(w.word), 0), 6) AS precision, round(count(*) FILTER (w.word IS NOT NULL AND g.word IS NOT NULL) / nullif(count(g.word), 0), 6) AS recall,
round(2 * count(*) FILTER (w.word IS NOT NULL AND g.word IS NOT NULL) / nullif(2 * count(*) FILTER (w.word IS NOT NULL AND g.word IS NOT NULL) + count(*) FILTER (g.word IS NULL) + count(*) FILTER (w.word IS NULL), 0), 6) AS f1 FROM w FULL JOIN g ON w.word = g.word""")
def stopword_verification(spark: SparkSession, d: str) -> DataFrame:
    p = pairs(spark, d)
    truth = p.where("content").groupBy(F.col("word1").alias("word")).agg(F.count("*").alias("freq"), F.countDistinct("lexeme").alias("partners"))
    found = p.groupBy(F.col("word1").alias("word")).agg(F.count("*").alias("n")).where("n >= 3500").select("word")
    return S.stopword_check(found, truth, 10, 2800)


@query("""WITH m AS (SELECT c_custkey AS id, 'n' || lpad(c_custkey::VARCHAR, 9, '0') || '01' AS source_id, c_mktsegment AS v FROM customer), g AS (SELECT c_custkey * 100 + 1 AS word_id, c_nationkey AS morph FROM customer WHERE c_acctbal > 0)
SELECT source_id, v, morph FROM m JOIN g ON substr(source_id, 2)::BIGINT = word_id WHERE len(source_id) = 12 AND left(source_id, 1) = 'n'""")
def morphology_key_join(spark: SparkSession, d: str) -> DataFrame:
    """Gold ids of twelve characters 'n' and digits meet word numbers of verse * 100 + place."""
    c = table(spark, d, "customer")
    ids = c.select(F.concat(F.lit("n"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lit("01")).alias("source_id"), F.col("c_mktsegment").alias("v"))
    words = c.where("c_acctbal > 0").select((F.col("c_custkey") * 100 + 1).alias("word_id"), F.col("c_nationkey").alias("morph"))
    return J.id_join(ids, words)


@query("""WITH m AS (SELECT left(n_name, 2) AS code, n_name AS long, n_nationkey AS rank FROM nation), f AS (SELECT code, arg_min(long, rank) AS long FROM m GROUP BY 1) SELECT c_custkey, code, long FROM (SELECT c_custkey, left(n_name, 2) AS code FROM customer JOIN nation ON c_nationkey = n_nationkey) JOIN f USING (code)""")
def ranked_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Short codes meet the first long code that begins so."""
    n = table(spark, d, "nation")
    codes = n.select(F.left("n_name", F.lit(2)).alias("code"), F.col("n_name").alias("long"), F.col("n_nationkey").alias("rank"))
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.left("n_name", F.lit(2)).alias("code"))
    return J.first_match(c, codes, ["code"], "rank")


@query(f"WITH {PAIRS} SELECT part, count(*) AS n FROM (SELECT CASE WHEN left(strong, 1) = 'G' THEN 'NT' ELSE 'OT' END AS part FROM pairs WHERE content AND NOT contains(trim(word1), ' ')) WHERE part <> 'NT' GROUP BY 1")
def testament_excluded(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.keys import testament

    rows = L.usable(pairs(spark, d).withColumn("surface", F.col("word1"))).where(L.single_token(F.col("surface")))
    return rows.withColumn("part", testament(F.col("strong"))).where(L.not_excluded(F.col("part"), "NT")).groupBy("part").agg(F.count("*").alias("n"))


@query("SELECT doc_id, contains(source, '1') AS audio, len(string_split_regex(trim(text), '\\s+'))::INT AS n_words FROM documents")
def presence_codes(spark: SparkSession, d: str) -> DataFrame:
    """Presence letters tested by containment, and words by white space."""
    return table(spark, d, "documents").select("doc_id", F.col("source").contains("1").alias("audio"), T.word_count(F.col("text")).alias("n_words"))


@query(f"""WITH {IPAIRS}, {IEF}, hits AS (SELECT DISTINCT ref, strong, word1 FROM ipairs WHERE l_extendedprice > 30000), j AS (SELECT e.iso, count(*) AS n, count(h.word1) AS hit FROM ef e LEFT JOIN hits h ON e.ref = h.ref AND e.strong = h.strong AND e.target = h.word1 GROUP BY 1)
SELECT iso, n, round(hit / n, 6) AS rate FROM j WHERE n >= 1000 AND hit / n >= 0.05""")
def usable_languages(spark: SparkSession, d: str) -> DataFrame:
    p = with_iso(spark, d, pairs(spark, d))
    ok = gold(p).select("ref", "strong", F.col("word1").alias("target")).distinct().withColumn("h", F.lit(True))
    rows = methods(p)[0].join(ok, ["ref", "strong", "target"], "left").groupBy("iso").agg(F.count("*").alias("n"), F.count("h").alias("positional"))
    return S.usable(rows, 1000, 0.05)


@query(f"""WITH {PAIRS}, r AS (SELECT lexeme, arg_max(stem, (n, stem)) AS to_key FROM (SELECT lexeme, stem, count(*) AS n FROM pairs GROUP BY 1, 2) GROUP BY 1), k AS (SELECT word1 AS surface, CASE WHEN p.lexeme LIKE 'hbo:%' THEN to_key ELSE strong END AS key FROM pairs p JOIN r USING (lexeme) WHERE content) SELECT surface, key, count(*) AS n FROM k GROUP BY 1, 2""")
def produced_lexicon_remapped(spark: SparkSession, d: str) -> DataFrame:
    p = pairs(spark, d)
    counts = p.groupBy("lexeme", "stem").agg(F.count("*").alias("n"))
    to = L.top_k(counts, ["lexeme"], [F.desc("n"), F.desc("stem")], 1).where("lexeme LIKE 'hbo:%'").select("lexeme", F.col("stem").alias("to_key"))
    return L.remapped(p.where("content").select("lexeme", "strong", F.col("word1").alias("surface")), to).groupBy("surface", "key").agg(F.count("*").alias("n"))


@query(f"""WITH {PAIRS}, c AS (SELECT strong, surface AS gloss, count(*) AS count FROM pairs WHERE content GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY strong ORDER BY count DESC, gloss) AS rank FROM c WHERE count >= 2)
SELECT strong, string_agg(gloss, '; ' ORDER BY rank) AS gloss FROM r WHERE rank <= 10 GROUP BY 1""")
def priors_rows(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.sinks import priors_rows as rows

    return rows(L.usable(pairs(spark, d)).groupBy("strong", F.col("surface").alias("gloss")).agg(F.count("*").alias("count")))


@query(f"""WITH {PAIRS}, c AS (SELECT surface, strong, count(*) AS count FROM pairs WHERE content GROUP BY 1, 2) SELECT surface, strong, count FROM c ORDER BY count DESC, surface, strong LIMIT 10""")
def report_preview(spark: SparkSession, d: str) -> DataFrame:
    """The ten most frequent pairs, for a report."""
    return L.usable(pairs(spark, d)).groupBy("surface", "strong").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "surface", "strong").limit(10)
