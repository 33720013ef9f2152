"""Queries over verses, sequences, texts and alignment models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.similarity import encode_span
from ..functions.text import tokens
from ..operators import em, induction, kernels
from ..operators import lexicon as L
from ..operators import sequence as Q
from ..sources.scratch import written
from .proxy import PAIRS, pairs, table
from .registry import query


@query("""WITH r AS (SELECT conv_id, min(turn) AS a, max(turn) AS b FROM conversations GROUP BY conv_id, turn // 2), m AS (SELECT c.conv_id, c.turn, c.text, r.a FROM conversations c JOIN r ON c.conv_id = r.conv_id AND c.turn BETWEEN r.a AND r.b)
SELECT conv_id, a AS anchor, count(*) AS members, string_agg(text, ' ' ORDER BY turn) AS text FROM m GROUP BY 1, 2""")
def interval_pool(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.joins import interval_expand

    c = table(spark, d, "conversations")
    ranges = c.groupBy("conv_id", F.floor(F.col("turn") / 2).alias("g")).agg(F.min("turn").alias("a"), F.max("turn").alias("b"))
    m = c.join(interval_expand(ranges, "a", "b", "turn"), ["conv_id", "turn"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ")
    return m.groupBy("conv_id", F.col("a").alias("anchor")).agg(F.count("*").alias("members"), text.alias("text"))


@query("""WITH w AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn) - 1 AS i FROM conversations) SELECT conv_id, (turn // 2) * 2 AS anchor, turn, i AS pooled_idx FROM w""")
def verse_pooling(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select(F.lit("GEN").alias("book"), F.col("conv_id").alias("chapter"), F.col("turn").alias("verse"))
    ranges = c.groupBy("book", "chapter", F.floor(F.col("verse") / 2).alias("g")).agg(F.min("verse").alias("verse_start"), F.max("verse").alias("verse_end"))
    out = Q.verse_groups(ranges, c, c.withColumn("idx", F.lit(0)))
    return out.select(F.col("chapter").alias("conv_id"), "anchor", F.col("verse").alias("turn"), "pooled_idx")


@query(f"""WITH {PAIRS}, c AS (SELECT *, CASE WHEN h_idx > 0 AND strong[1:1] = lag(strong[1:1]) OVER (PARTITION BY ref ORDER BY h_idx) THEN 0 ELSE 1 END AS ch FROM pairs), i AS (SELECT ref, h_idx, strong[1:1] AS part, sum(ch) OVER (PARTITION BY ref ORDER BY h_idx)::BIGINT AS island FROM c)
SELECT ref, island, first(part) AS part, min(h_idx) AS "first", max(h_idx) AS "last", count(*) AS n FROM i GROUP BY 1, 2""")
def islands_merge(spark: SparkSession, d: str) -> DataFrame:
    return Q.islands(pairs(spark, d).withColumn("part", F.left("strong", F.lit(1))), ["ref"], ["h_idx"], "part")


@query(f"WITH {PAIRS} SELECT ref, h_idx, coalesce(max(CASE WHEN content THEN 0 ELSE 1 END) OVER (PARTITION BY ref ORDER BY h_idx ROWS UNBOUNDED PRECEDING), 0) = 0 AS leading FROM pairs")
def leading_run(spark: SparkSession, d: str) -> DataFrame:
    return Q.leading_run(pairs(spark, d), ["ref"], ["h_idx"], F.col("content")).select("ref", "h_idx", "leading")


@query(f"WITH {PAIRS} SELECT ref, h_idx, row_number() OVER (PARTITION BY ref ORDER BY h_idx) - 1 AS src_ord FROM pairs WHERE content")
def content_ordinal(spark: SparkSession, d: str) -> DataFrame:
    return Q.content_ordinal(pairs(spark, d), ["ref"], ["h_idx"]).select("ref", "h_idx", "src_ord")


PHRASES = """ph AS (SELECT ref, phrase_id, arg_min(function, (h_idx, function)) AS function, min(h_idx) AS src, avg(t_idx[1]) AS tgt FROM pairs WHERE content GROUP BY 1, 2)"""


def phrases(spark: SparkSession, d: str) -> DataFrame:
    return Q.covered_phrases(pairs(spark, d).withColumn("n_src", F.lit(10)).withColumn("n_trg", F.lit(10)))


@query(f"""WITH {PAIRS}, {PHRASES}, n AS (SELECT function AS fa, tgt, lead(function) OVER w AS fb, lead(tgt) OVER w AS tb FROM ph WINDOW w AS (PARTITION BY ref ORDER BY src, phrase_id))
SELECT fa, fb, count(*) FILTER (tgt < tb) AS kept, count(*) AS total, round(count(*) FILTER (tgt < tb) / count(*), 6) AS rate FROM n WHERE fb IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 30""")
def adjacent_order(spark: SparkSession, d: str) -> DataFrame:
    return Q.pair_order(phrases(spark, d))


@query(f"""WITH {PAIRS}, ph AS (SELECT ref, phrase_id, arg_min(sense, (h_idx, sense)) AS function, min(h_idx) AS src, avg(t_idx[1]) AS tgt FROM pairs WHERE content GROUP BY 1, 2),
n AS (SELECT function AS fa, tgt, lead(function) OVER w AS fb, lead(tgt) OVER w AS tb FROM ph WINDOW w AS (PARTITION BY ref ORDER BY src, phrase_id)), ord AS (SELECT fa, fb, round(count(*) FILTER (tgt < tb) / count(*), 6) AS rate FROM n WHERE fb IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 100),
s AS (SELECT ref, h_idx, sense AS function FROM pairs ANTI JOIN ph USING (ref, phrase_id) WHERE NOT content), m AS (SELECT s.*, ph.function AS other, src, tgt, row_number() OVER (PARTITION BY ref, h_idx ORDER BY abs(src - h_idx), src) AS r FROM s JOIN ph USING (ref)),
j AS (SELECT *, h_idx < src AS ahead FROM m WHERE r = 1 AND src <> h_idx)
SELECT ref, h_idx, round(tgt + CASE WHEN ahead = (rate >= 0.5) THEN -1 ELSE 1 END, 6)::DOUBLE AS p_exp FROM j JOIN ord ON ord.fa = CASE WHEN ahead THEN function ELSE other END AND ord.fb = CASE WHEN ahead THEN other ELSE function END""")
def cross_phrase_place(spark: SparkSession, d: str) -> DataFrame:
    """Places of tokens whose phrase is not aligned, by the order of functions (here senses)."""
    from ..operators import gapfill as G

    p = pairs(spark, d).withColumn("function", F.col("sense"))
    own = Q.covered_phrases(p.withColumn("n_src", F.lit(10)).withColumn("n_trg", F.lit(10)))
    source = p.where("NOT content").join(own.select("ref", "phrase_id"), ["ref", "phrase_id"], "left_anti").select("ref", "h_idx", "function")
    return G.cross_phrase_expected(source, own, G.sure_order(Q.pair_order(own), margin=0.0)).select("ref", "h_idx", F.round("p_exp", 6).alias("p_exp"))


@query(f"WITH {PAIRS}, {PHRASES}, k AS (SELECT *, count(*) OVER (PARTITION BY ref) AS k FROM ph) SELECT function, count(*) AS n, round(avg(tgt / 10 - src / 10), 6) AS mean_drift FROM k WHERE k >= 2 GROUP BY 1 HAVING count(*) >= 30")
def function_drift(spark: SparkSession, d: str) -> DataFrame:
    return Q.drift(phrases(spark, d))


@query(f"""WITH {PAIRS}, a AS (SELECT ref, h_idx, CASE WHEN l_discount >= 0.06 THEN t_idx[1] END AS t, count(*) OVER (PARTITION BY ref) AS n FROM pairs),
b AS (SELECT *, max(CASE WHEN t IS NOT NULL THEN h_idx END) OVER (PARTITION BY ref ORDER BY h_idx) AS bp, min(CASE WHEN t IS NOT NULL THEN h_idx END) OVER (PARTITION BY ref ORDER BY h_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ap FROM a),
j AS (SELECT b.ref, b.h_idx, b.n, b.bp, b.ap, x.t AS bt, y.t AS atop FROM b LEFT JOIN a x ON x.ref = b.ref AND x.h_idx = b.bp LEFT JOIN a y ON y.ref = b.ref AND y.h_idx = b.ap)
SELECT ref, h_idx, round(CASE WHEN bp <> ap THEN bt + (h_idx - bp) / (ap - bp) * (atop - bt) WHEN bp IS NOT NULL THEN bt WHEN ap IS NOT NULL THEN atop ELSE h_idx / n * 9 END, 6) AS expected FROM j""")
def interpolate_position(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    rows = pairs(spark, d).select("ref", "h_idx", F.when(F.col("l_discount") >= 0.06, F.element_at("t_idx", 1)).alias("t"), F.count("*").over(Window.partitionBy("ref")).alias("n")).withColumn("m", F.lit(9))
    return Q.interpolate(rows, ["ref"], "h_idx", "t", "n", "m").select("ref", "h_idx", F.round("expected", 6).alias("expected"))


@query(f"""WITH {PAIRS}, g AS (SELECT a.ref, a.h_idx, min(abs(a.t_idx[1] - b.t_idx[1])) AS gap FROM pairs a JOIN pairs b ON a.ref = b.ref AND a.phrase_id = b.phrase_id AND a.h_idx <> b.h_idx GROUP BY 1, 2)
SELECT score, CASE WHEN gap IS NULL THEN 'no mate' WHEN gap <= 3 THEN 'coherent' ELSE 'scattered' END AS bucket, count(*) AS n FROM pairs LEFT JOIN g USING (ref, h_idx) GROUP BY 1, 2""")
def coherence(spark: SparkSession, d: str) -> DataFrame:
    bucket = F.when(F.col("coherent").isNull(), "no mate").when(F.col("coherent"), "coherent").otherwise("scattered")
    return Q.coherence(pairs(spark, d)).groupBy("score", bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query(f"""WITH {PAIRS}, o AS (SELECT ref, row_number() OVER (PARTITION BY ref ORDER BY h_idx) - 1 AS o, t_idx FROM pairs WHERE content), s AS (SELECT ref, o, o || ':' || CASE WHEN t_idx[2] - t_idx[1] = 1 THEN t_idx[1] || '-' || t_idx[2] ELSE t_idx[1] || ',' || t_idx[2] END AS x FROM o)
SELECT ref, string_agg(x, ' ' ORDER BY o) AS compact FROM s GROUP BY 1""")
def compact_encode(spark: SparkSession, d: str) -> DataFrame:
    rows = Q.content_ordinal(pairs(spark, d), ["ref"], ["h_idx"])
    cell = F.struct("src_ord", F.concat_ws(":", F.col("src_ord").cast("string"), encode_span(F.col("t_idx"))).alias("x"))
    return rows.groupBy("ref").agg(F.array_join(F.transform(F.array_sort(F.collect_list(cell)), lambda c: c["x"]), " ").alias("compact"))


@query("""WITH l AS (SELECT conv_id, turn, conv_id || ':' || turn || ':' || text AS line FROM conversations) SELECT conv_id, right(sha256(string_agg(line, chr(10) ORDER BY turn)), 5) AS book_hash FROM l GROUP BY 1""")
def book_content_hash(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    line = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "text")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]), "\n")
    return c.groupBy("conv_id").agg(F.right(F.sha2(text.cast("binary"), 256), F.lit(5)).alias("book_hash"))


@query(r"""SELECT doc_id, len(regexp_extract_all(nfc_normalize(text), '[\p{L}\p{M}]+'))::INT AS n_tokens, len(list_distinct(regexp_extract_all(lower(nfc_normalize(text)), '[\p{L}\p{M}]+')))::INT AS n_types FROM documents""")
def tokenize_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", tokens(F.col("text")).alias("w"))
    return docs.select("doc_id", F.size("w").alias("n_tokens"), F.size(F.array_distinct(F.transform("w", lambda x: F.lower(x)))).alias("n_types"))


WORDS = r"words AS (SELECT lang, source, word, count(*) AS n FROM (SELECT lang, source, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]+')) AS word FROM documents) GROUP BY 1, 2, 3)"
STOPS = """tot AS (SELECT lang, word, sum(n)::BIGINT AS freq, count(DISTINCT source) AS in_books FROM words GROUP BY 1, 2), rk AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY freq DESC, word)::INT AS rank FROM tot),
bk AS (SELECT lang, count(DISTINCT source) AS n_books FROM words GROUP BY 1), stops AS (SELECT lang, word, freq, in_books, n_books, rank FROM rk JOIN bk USING (lang) WHERE rank <= 150 AND in_books / n_books >= 0.85)"""


@query(f"WITH {WORDS}, {STOPS} SELECT * FROM stops")
def stopwords(spark: SparkSession, d: str) -> DataFrame:
    return induction.stopword_candidates(written(induction.word_counts(table(spark, d, "documents"), ["lang", "source"]), "words"))


@query(f"""WITH {WORDS}, {STOPS}, b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]+')) AS word FROM benchmark), s AS (SELECT word, sum(freq)::BIGINT AS freq FROM stops GROUP BY 1)
SELECT count(*) FILTER (s.word IS NOT NULL AND b.word IS NOT NULL) AS shared, count(*) FILTER (b.word IS NULL) AS left_only, count(*) FILTER (s.word IS NULL) AS right_only,
coalesce(round(count(*) FILTER (s.word IS NOT NULL AND b.word IS NOT NULL) / count(s.word), 6), 0)::DOUBLE AS precision, coalesce(round(count(*) FILTER (s.word IS NOT NULL AND b.word IS NOT NULL) / count(b.word), 6), 0)::DOUBLE AS recall FROM s FULL JOIN b ON s.word = b.word""")
def stopword_overlap(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.joins import lexicon_overlap

    own = stopwords(spark, d).select("word")
    other = table(spark, d, "benchmark").select(F.explode(F.transform(tokens(F.col("text")), lambda w: F.lower(w))).alias("word"))
    return lexicon_overlap(own, other, "word").withColumnRenamed("both", "shared")


@query(f"""WITH {WORDS}, {STOPS}, c AS (SELECT word, lang AS lexeme, sum(n) AS n FROM words GROUP BY 1, 2), sh AS (SELECT *, n / sum(n) OVER (PARTITION BY word) AS share, row_number() OVER (PARTITION BY word ORDER BY n DESC, lexeme) AS r FROM c),
content AS (SELECT lang AS lexeme FROM documents GROUP BY 1 HAVING avg(n_chars) > (SELECT avg(n_chars) FROM documents)), held AS (SELECT word FROM sh SEMI JOIN content USING (lexeme) WHERE r = 1 AND round(share, 6) >= 0.4)
SELECT lang, word, rank FROM stops ANTI JOIN held USING (word)""")
def stopword_rescue(spark: SparkSession, d: str) -> DataFrame:
    """Stopwords but those whose dominant class (here a language, for a lexeme) is one of content (of long texts)."""
    docs = table(spark, d, "documents")
    counts = written(induction.word_counts(docs, ["lang", "source"]), "words")
    lex = counts.groupBy(F.col("word").alias("surface"), F.col("lang").alias("lexeme")).agg(F.sum("n").alias("count"))
    mean = docs.agg(F.avg("n_chars").alias("mean"))
    content = docs.groupBy(F.col("lang").alias("lexeme")).agg(F.avg("n_chars").alias("own")).join(mean, F.col("own") > F.col("mean"))
    return induction.rescue(induction.stopword_candidates(counts), L.dominant_lexeme(lex), content).select("lang", "word", "rank")


def _affix_sql(side: str) -> str:
    stem, affix = ("word[1:len(word) - k]", "word[len(word) - k + 1:]") if side == "suffix" else ("word[k + 1:]", "word[1:k]")
    least = 1 if side == "suffix" else 2
    return f"""WITH v AS (SELECT DISTINCT lang, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]+')) AS word FROM documents), k AS (SELECT lang, word, unnest(range(0, least(5, len(word) - 3) + 1)) AS k FROM v WHERE len(word) >= 3),
s AS (SELECT lang, {stem} AS stem, CASE WHEN k = 0 THEN '' ELSE {affix} END AS affix FROM k WHERE k = 0 OR k >= {least}), r AS (SELECT lang, stem FROM s GROUP BY 1, 2 HAVING count(DISTINCT affix) >= 2),
f AS (SELECT lang, affix, count(DISTINCT stem) AS stems FROM s JOIN r USING (lang, stem) WHERE affix <> '' GROUP BY 1, 2 HAVING count(DISTINCT stem) >= 12), o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY stems DESC, affix)::INT AS rank FROM f) SELECT * FROM o WHERE rank <= 40"""


def vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return induction.word_counts(table(spark, d, "documents"), ["lang"]).select("lang", "word")


@query(_affix_sql("suffix"))
def affix_suffixes(spark: SparkSession, d: str) -> DataFrame:
    return induction.affixes(written(vocabulary(spark, d), "vocabulary"), "lang", "suffix", once=True)


@query(_affix_sql("prefix"))
def affix_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return induction.affixes(written(vocabulary(spark, d), "vocabulary"), "lang", "prefix", shortest=2, once=True)


# -- alignment models


def parallel(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Source tokens by number key and target words by place; the pairs that they come from are written once."""
    p = written(pairs(spark, d).select("ref", "h_idx", "strong", "word1", "word2"), "words")
    source = p.select("ref", "h_idx", F.col("strong").alias("s"))
    target = p.select("ref", F.explode(F.array(F.struct((2 * F.col("h_idx")).alias("place"), F.col("word1").alias("w")), F.struct((2 * F.col("h_idx") + 1).alias("place"), F.col("word2").alias("w")))).alias("x")).select("ref", "x.place", "x.w")
    return source, target


CELLS = """tw AS (SELECT ref, 2 * h_idx AS place, word1 AS w FROM pairs UNION ALL SELECT ref, 2 * h_idx + 1, word2 FROM pairs), sc AS (SELECT ref, strong AS s, count(*) AS k FROM pairs GROUP BY 1, 2 UNION ALL SELECT DISTINCT ref, '<null>', 1 FROM pairs),
cells AS (SELECT tw.ref, place, w, s, k FROM tw JOIN sc USING (ref)), t0 AS (SELECT s, w, 1 / count(*) OVER (PARTITION BY s) AS t FROM (SELECT DISTINCT s, w FROM cells))"""


def _round_sql(i: int) -> str:
    return f"""p{i} AS (SELECT ref, place, s, w, k * t AS p FROM cells JOIN t{i} USING (s, w)), q{i} AS (SELECT s, w, sum(c) AS c FROM (SELECT s, w, p / sum(p) OVER (PARTITION BY ref, place) AS c FROM p{i}) GROUP BY 1, 2), t{i + 1} AS (SELECT s, w, c / sum(c) OVER (PARTITION BY s) AS t FROM q{i})"""


@query(f"WITH {PAIRS}, {CELLS}, {_round_sql(0)}, {_round_sql(1)}, {_round_sql(2)} SELECT s, w, round(t, 6) AS t FROM t3")
def ibm1_em_3(spark: SparkSession, d: str) -> DataFrame:
    return em.train(*parallel(spark, d), rounds=3).select("s", "w", F.round("t", 6).alias("t"))


@query(f"WITH {PAIRS}, {CELLS}, {_round_sql(0)}, {_round_sql(1)}, {_round_sql(2)} SELECT p.ref, p.h_idx, tw.place, round(t, 6) AS score FROM pairs p JOIN tw ON tw.ref = p.ref JOIN t3 ON t3.s = p.strong AND t3.w = tw.w WHERE t >= 0.03")
def ibm1_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of a verse that model 1 holds for likely, before the greedy pass."""
    return em.Trained.of(*parallel(spark, d), 3, (0,)).candidates(0.03).withColumn("score", F.round("score", 6))


@query(f"""WITH {PAIRS}, {CELLS}, {_round_sql(0)}, {_round_sql(1)}, {_round_sql(2)}, x AS (SELECT tw.ref, tw.place, p.h_idx, round(t, 9) AS t, round(n.t0, 9) AS t0, row_number() OVER (PARTITION BY tw.ref, tw.place ORDER BY round(t, 9) DESC, p.h_idx) AS r FROM tw JOIN pairs p ON p.ref = tw.ref JOIN t3 ON t3.s = p.strong AND t3.w = tw.w LEFT JOIN (SELECT w, t AS t0 FROM t3 WHERE s = '<null>') n ON n.w = tw.w)
SELECT ref, h_idx, place FROM x WHERE r = 1 AND t > coalesce(t0, 0)""")
def ibm1_links(spark: SparkSession, d: str) -> DataFrame:
    """For each target word its likeliest source word by model 1, where the null word is not as likely."""
    return em.Trained.of(*parallel(spark, d), 3, (0,)).links()[0]


@query()
def ibm1_decode(spark: SparkSession, d: str) -> DataFrame:
    return em.Trained.of(*parallel(spark, d), 3, (0,)).one_to_one(0.03, lambda h, place: np.abs(h - place / 2))


@query()
def symmetrized_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Links of both directions by model 1, symmetrized: the statistical directional aligner."""
    forward, reverse = em.Trained.of(*parallel(spark, d), 3).links()
    return kernels.symmetrize(forward, reverse)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey AS ref, l_partkey AS s, l_suppkey AS t FROM lineitem), n AS (SELECT DISTINCT a.ref, a.s, b.s AS m FROM e a JOIN e b ON a.ref = b.ref AND a.t = b.t),
r AS (SELECT ref, s, m FROM n UNION SELECT r.ref, r.s, n.m FROM r JOIN n ON r.ref = n.ref AND r.m = n.s), c AS (SELECT ref, s, min(m) AS c FROM r GROUP BY 1, 2),
g AS (SELECT ref, c, count(DISTINCT s) AS ns, count(DISTINCT t) AS nt FROM e JOIN c USING (ref, s) GROUP BY 1, 2)
SELECT (CASE WHEN ns = 1 THEN '1' ELSE 'many' END) || ':' || (CASE WHEN nt = 1 THEN '1' ELSE 'many' END) AS kind, count(*) AS n, sum(ns)::BIGINT AS sources, sum(nt)::BIGINT AS targets FROM g GROUP BY 1""")
def link_components(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ref"), F.col("l_partkey").alias("s"), F.col("l_suppkey").alias("t"))
    return kernels.link_components(edges).groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.size("source_ids")).alias("sources"), F.sum(F.size("target_ids")).alias("targets"))


@query(f"""WITH {PAIRS}, p AS (SELECT ref, h_idx, l_suppkey % 3 AS strong, l_partkey, l_tax FROM pairs), s AS (SELECT ref, h_idx, strong, row_number() OVER (PARTITION BY ref, strong ORDER BY h_idx) AS n FROM p),
t AS (SELECT ref, h_idx AS t_idx, l_partkey % 3 AS strong, 'w' || l_partkey AS text, l_tax < 0.01 AS elided, row_number() OVER (PARTITION BY ref, l_partkey % 3 ORDER BY h_idx) AS n FROM p)
SELECT count(*) AS taken, count(*) FILTER (elided) AS elided FROM s JOIN t USING (ref, strong, n)""")
def fifo_queue_join(spark: SparkSession, d: str) -> DataFrame:
    return _fifo(spark, d).where("target_id is not null").agg(F.count("*").alias("taken"), F.count_if(F.col("kind") == "elided").alias("elided"))


@query(f"""WITH {PAIRS}, p AS (SELECT ref, h_idx, l_suppkey % 3 AS ss, l_partkey % 3 AS ts, 'w' || l_partkey AS text, l_tax < 0.01 AS elided FROM pairs), s AS (SELECT ref, h_idx, ss AS strong, row_number() OVER (PARTITION BY ref, ss ORDER BY h_idx) AS n FROM p),
t AS (SELECT ref, h_idx AS t_idx, ts AS strong, text, elided, row_number() OVER (PARTITION BY ref, ts ORDER BY h_idx) AS n FROM p), j AS (SELECT s.ref, s.h_idx, s.strong, t.t_idx, t.text, t.elided FROM s LEFT JOIN t USING (ref, strong, n)),
k AS (SELECT *, max(CASE WHEN t_idx IS NOT NULL THEN h_idx END) OVER (PARTITION BY ref ORDER BY h_idx) AS head FROM j), b AS (SELECT k.*, k.t_idx IS NULL AND NOT coalesce(h.strong = k.strong AND NOT h.elided AND h.text <> '', false) AS breaks FROM k LEFT JOIN j h ON h.ref = k.ref AND h.h_idx = k.head),
c AS (SELECT *, max(CASE WHEN breaks OR t_idx IS NOT NULL THEN h_idx END) OVER (PARTITION BY ref ORDER BY h_idx) AS cut FROM b), g AS (SELECT *, CASE WHEN t_idx IS NULL AND NOT breaks AND cut = head THEN head ELSE h_idx END AS grp FROM c)
SELECT ref, string_agg(h_idx, ',' ORDER BY h_idx) AS source_ids, max(t_idx) AS target_id, max(text) AS gloss, CASE WHEN max(t_idx) IS NULL THEN 'dropped' WHEN bool_or(coalesce(elided, false)) THEN 'elided' WHEN count(*) > 1 THEN 'many:1' ELSE '1:1' END AS kind FROM g GROUP BY ref, grp""")
def fifo_groups(spark: SparkSession, d: str) -> DataFrame:
    """Occurrence groups by number key with absorption."""
    return _fifo(spark, d).withColumn("source_ids", F.array_join("source_ids", ","))


def _fifo(spark: SparkSession, d: str) -> DataFrame:
    p = pairs(spark, d)
    source = p.select("ref", "h_idx", (F.col("l_suppkey") % 3).alias("strong"))
    target = p.select("ref", F.col("h_idx").alias("t_idx"), (F.col("l_partkey") % 3).alias("strong"), F.concat(F.lit("w"), F.col("l_partkey").cast("string")).alias("text"), (F.col("l_tax") < 0.01).alias("elided"))
    return kernels.queue_groups(source, target)


@query(f"""WITH {PAIRS}, p AS (SELECT ref, h_idx + 1 AS id, word1 AS text, strong FROM pairs), tg AS (SELECT ref, h_idx AS seq, h_idx + 1 AS anchor, CASE WHEN l_suppkey % 5 = 0 THEN h_idx + 1 + l_suppkey % 3 END AS real, CASE WHEN l_tax > 0.01 THEN word2 END AS gloss FROM pairs WHERE l_partkey % 4 <> 0),
plain AS (SELECT ref, anchor AS id, gloss, false AS folded FROM tg WHERE real IS NULL), late AS (SELECT * FROM tg WHERE real IS NOT NULL),
st AS (SELECT l.ref, l.real AS id, l.gloss, true AS folded, row_number() OVER (PARTITION BY l.ref, l.real ORDER BY l.seq) AS r FROM late l JOIN p ON p.ref = l.ref AND p.id = l.real LEFT JOIN plain q ON q.ref = l.ref AND q.id = l.real WHERE q.id IS NULL),
own AS (SELECT * FROM plain UNION ALL SELECT ref, id, gloss, folded FROM st WHERE r = 1), ext AS (SELECT l.ref, l.anchor AS id, l.seq, l.real, l.gloss FROM late l LEFT JOIN p ON p.ref = l.ref AND p.id = l.real WHERE p.id IS NULL),
tt AS (SELECT ref, id, -1 AS seq, id AS real, gloss FROM own UNION ALL SELECT ref, id, seq, real, gloss FROM ext SEMI JOIN own USING (ref, id)),
ta AS (SELECT ref, id, count(*) AS nt, list(gloss ORDER BY seq)[-1] AS last, list(gloss ORDER BY seq)[1] AS first_gloss, string_agg(real, ',' ORDER BY seq) AS ids, string_agg(coalesce(gloss, '-'), ',' ORDER BY seq) AS glosses FROM tt GROUP BY 1, 2),
x AS (SELECT p.*, own.folded, own.id IS NOT NULL AS hit, max(own.id) OVER (PARTITION BY p.ref ORDER BY p.id) AS head FROM p LEFT JOIN own USING (ref, id)),
z AS (SELECT x.*, hit OR coalesce(min(CASE WHEN NOT hit THEN x.id END) OVER (PARTITION BY x.ref, head) = head + 1 AND ta.last IS NOT NULL, false) AS joins FROM x LEFT JOIN ta ON ta.ref = x.ref AND ta.id = x.head),
g AS (SELECT ref, head, joins, count(*) AS ns, string_agg(id, ',' ORDER BY id) AS source_ids, string_agg(text, ',' ORDER BY id) AS source_text, string_agg(strong, ',' ORDER BY id) AS source_strong, bool_or(folded) AS folded FROM z GROUP BY 1, 2, 3)
SELECT g.ref, source_ids, source_text, source_strong, coalesce(ids, '') AS target_ids, coalesce(glosses, '') AS target_gloss,
CASE WHEN ids IS NULL THEN 'dropped' WHEN ns = 1 AND nt = 1 AND first_gloss IS NULL THEN CASE WHEN folded THEN 'suffix_pending' ELSE 'unglossed' END ELSE CASE WHEN ns = 1 THEN '1:' ELSE 'many:' END || CASE WHEN nt = 1 THEN '1' ELSE 'many' END END AS kind
FROM g LEFT JOIN ta ON ta.ref = g.ref AND ta.id = g.head AND g.joins""")
def suffix_groups(spark: SparkSession, d: str) -> DataFrame:
    """Occurrence groups by ids with suffixes."""
    p = pairs(spark, d)
    i, k = F.col("h_idx") + 1, (F.col("l_suppkey") % 3).cast("string")
    name = F.when(F.col("l_suppkey") % 5 == 0, F.concat_ws("-", i.cast("string"), k)).otherwise(i.cast("string"))
    word = F.struct(i.alias("id"), F.col("word1").alias("text"), F.col("strong").alias("lemma"))
    target = F.struct(F.col("h_idx").alias("seq"), name.alias("id"), F.when(F.col("l_tax") > 0.01, F.col("word2")).alias("gloss"))
    out = kernels.suffix_groups_of(p.select("ref", word.alias("word"), F.when(F.col("l_partkey") % 4 != 0, target).alias("target")))
    return out.select("ref", *(F.array_join(c, ",", "-").alias(c) for c in out.columns if c not in ("ref", "kind")), "kind")


@query(f"""WITH {PAIRS}, s AS (SELECT l_suppkey % 7 AS scheme, ref % 100 AS chapter, max(h_idx) AS last FROM pairs GROUP BY 1, 2), o AS (SELECT ref % 100 AS chapter, max(h_idx) AS last FROM pairs WHERE l_suppkey % 2 = 0 GROUP BY 1)
SELECT scheme, round(avg(CASE WHEN s.last = o.last THEN 1.0 ELSE 0 END), 6) AS share, row_number() OVER (ORDER BY round(avg(CASE WHEN s.last = o.last THEN 1.0 ELSE 0 END), 6) DESC, scheme)::INT AS place FROM s JOIN o USING (chapter) GROUP BY 1""")
def versification_detect(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.corpus import scheme_shares

    p = pairs(spark, d)
    schemes = p.groupBy((F.col("l_suppkey") % 7).alias("scheme"), (F.col("ref") % 100).alias("chapter")).agg(F.max("h_idx").alias("last"))
    own = p.where("l_suppkey % 2 = 0").groupBy((F.col("ref") % 100).alias("chapter")).agg(F.max("h_idx").alias("last"))
    return scheme_shares(schemes, own, ["chapter"])


@query(f"""WITH {PAIRS} SELECT word1, word2, CASE WHEN levenshtein(word1, word2) > 3 THEN 4 ELSE levenshtein(word1, word2) END::INT AS distance, CASE WHEN word1 = word2 THEN 1.0 WHEN least(len(word1), len(word2)) >= 4 AND (starts_with(word1, word2) OR starts_with(word2, word1) OR (word1[1:4] = word2[1:4] AND abs(len(word1) - len(word2)) <= 3)) THEN 0.7
WHEN least(len(word1), len(word2)) >= 5 AND levenshtein(word1, word2) <= 1 THEN 0.6 ELSE 0.0 END::DOUBLE AS word_score FROM (SELECT DISTINCT a.word1, b.word1 AS word2 FROM pairs a JOIN pairs b ON a.ref = b.ref)""")
def word_scores(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.similarity import edit_distance, word_score

    p = pairs(spark, d).select("ref", "word1").distinct()
    both = p.join(p.select("ref", F.col("word1").alias("word2")), "ref").select("word1", "word2").distinct()
    return both.select("word1", "word2", edit_distance(F.col("word1"), F.col("word2")).alias("distance"), word_score(F.array("word1"), F.array("word2")).alias("word_score"))


@query(f"WITH {PAIRS} SELECT method, round(score, 2) AS score, content, count(*) AS n FROM pairs WHERE (method = 'eflomal' AND score >= 0.9) OR (method = 'gapfill' AND score >= 0.9) GROUP BY ALL")
def method_high_rows(spark: SparkSession, d: str) -> DataFrame:
    return pairs(spark, d).where(L.method_high(F.col("method"), F.col("score"))).groupBy("method", "score", "content").agg(F.count("*").alias("n"))
