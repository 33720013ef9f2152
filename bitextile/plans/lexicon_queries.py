"""Queries over the lexicon aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lexicon as L
from .proxy import IPAIRS, PAIRS, pairs, with_iso
from .registry import query

HI = "count(*) FILTER (score >= 0.9 AND coalesce(coherent, true))"
LEX = f"lex AS (SELECT surface, lexeme, method, base_text, max(strong) AS strong, count(*) AS count, round({HI} / count(*), 4) AS hi_conf FROM pairs WHERE content GROUP BY 1, 2, 3, 4)"


@query(f"WITH {PAIRS}, {LEX} SELECT *, round(count / sum(count) OVER (PARTITION BY surface, method, base_text), 4) AS share FROM lex")
def lexicon_additive_union(spark: SparkSession, d: str) -> DataFrame:
    return L.lexicon(pairs(spark, d))


@query(f"WITH {PAIRS}, {LEX}, s AS (SELECT *, round(count / sum(count) OVER (PARTITION BY surface, method, base_text), 4) AS share FROM lex) SELECT * FROM s WHERE count >= 3")
def lexicon_min_count_share(spark: SparkSession, d: str) -> DataFrame:
    return L.lexicon(pairs(spark, d), min_count=3)


@query(f"""WITH {PAIRS}, c AS (SELECT lexeme, strong, surface AS phrase, len(string_split(surface, ' '))::INT AS n_words, count(*) AS count FROM pairs WHERE content AND t_idx[2] - t_idx[1] = 1 GROUP BY ALL)
SELECT *, round(count / sum(count) OVER (PARTITION BY lexeme), 4) AS share, true AS contig FROM c""")
def mwe_contiguous(spark: SparkSession, d: str) -> DataFrame:
    return L.multiword(pairs(spark, d))


@query(f"WITH {PAIRS} SELECT lexeme, count(*) FILTER (t_idx[2] - t_idx[1] = 1) AS contiguous, count(*) FILTER (t_idx[2] - t_idx[1] > 1) AS scattered FROM pairs WHERE content GROUP BY 1")
def mwe_scattered_count(spark: SparkSession, d: str) -> DataFrame:
    return L.scattered(pairs(spark, d))


SENSES = "senses AS (SELECT lexeme, stem, sense, surface, base_text, method, count(*) AS count FROM pairs WHERE content GROUP BY ALL)"


@query(f"WITH {PAIRS}, {SENSES} SELECT *, round(count / sum(count) OVER (PARTITION BY lexeme, stem, sense, base_text, method), 4) AS share FROM senses")
def senses_attested(spark: SparkSession, d: str) -> DataFrame:
    return L.attested_senses(pairs(spark, d))


@query(f"""WITH {PAIRS}, {SENSES}, kept AS (SELECT * FROM senses WHERE NOT (sense = '1' AND base_text = 'O') AND NOT (surface = lower('Almond Azure')))
SELECT *, round(count / sum(count) OVER (PARTITION BY lexeme, stem, sense, base_text, method), 4) AS share FROM kept""")
def senses_excluded(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame([(None, None, "1", None, "O"), (None, None, None, "Almond Azure", None)], "lexeme string, stem string, sense string, surface string, base_text string")
    return L.attested_senses(pairs(spark, d), rules)


@query(f"""WITH {PAIRS}, {LEX}, s AS (SELECT strong, surface, sum(count)::BIGINT AS count, round(sum(hi_conf * count) / sum(count), 9) AS hi_conf FROM lex WHERE method = 'eflomal' AND base_text = 'F' AND count >= 2 AND hi_conf >= 0.25 GROUP BY 1, 2),
t AS (SELECT *, round(count / sum(count) OVER (PARTITION BY strong), 6) AS share FROM s) SELECT * FROM t WHERE share >= 0.02""")
def rollup_view(spark: SparkSession, d: str) -> DataFrame:
    return L.rollup_view(L.additive_union(pairs(spark, d)), "eflomal", "F", 2, 0.25, 0.02)


@query(f"WITH {PAIRS}, {LEX} SELECT surface, lexeme, count(DISTINCT method) AS n, sum(count)::BIGINT AS count FROM lex GROUP BY 1, 2 HAVING count(DISTINCT method) >= 2")
def agreement_methods(spark: SparkSession, d: str) -> DataFrame:
    return L.agreement(L.additive_union(pairs(spark, d)), "method", ["surface", "lexeme"])


@query(f"WITH {PAIRS}, {LEX} SELECT surface, lexeme, count(DISTINCT base_text) AS n, sum(count)::BIGINT AS count FROM lex WHERE method <> 'gapfill' GROUP BY 1, 2 HAVING count(DISTINCT base_text) >= 2")
def agreement_editions(spark: SparkSession, d: str) -> DataFrame:
    return L.agreement(L.operating_point(L.additive_union(pairs(spark, d)), "model_free"), "base_text", ["surface", "lexeme"])


@query(f"WITH {PAIRS}, {LEX} SELECT surface, lexeme, method, base_text, strong, count, hi_conf FROM lex WHERE count >= 2 AND hi_conf >= 0.5")
def preset_precise(spark: SparkSession, d: str) -> DataFrame:
    return L.operating_point(L.additive_union(pairs(spark, d)), "precise")


@query(f"""WITH {PAIRS}, c AS (SELECT surface, lexeme, count(*) AS count FROM pairs WHERE content GROUP BY 1, 2), s AS (SELECT *, round(count / sum(count) OVER (PARTITION BY surface), 6) AS share, row_number() OVER (PARTITION BY surface ORDER BY count DESC, lexeme) AS r FROM c)
SELECT surface, lexeme, count, share FROM s WHERE r = 1 AND share >= 0.01""")
def argmax_dominant(spark: SparkSession, d: str) -> DataFrame:
    return L.dominant_lexeme(L.additive_union(pairs(spark, d)), 0.01)


@query(f"""WITH {PAIRS}, c AS (SELECT lexeme, surface, count(*) AS count FROM pairs WHERE content GROUP BY 1, 2), s AS (SELECT *, round(count / sum(count) OVER (PARTITION BY lexeme), 6) AS share FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY lexeme ORDER BY count DESC, surface)::INT AS rank FROM s WHERE share >= 0.02) SELECT * FROM r WHERE rank <= 5""")
def topk_seed_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return L.seed_dictionary(L.additive_union(pairs(spark, d)), share=0.02)


@query(f"""WITH {PAIRS}, c AS (SELECT strong, word, count(*) AS count FROM (SELECT strong, unnest([word1, word2]) AS word FROM pairs WHERE content) GROUP BY 1, 2), s AS (SELECT *, round(count / sum(count) OVER (PARTITION BY strong), 6) AS share FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY strong ORDER BY count DESC, word)::INT AS rank FROM s WHERE share >= 0.05) SELECT * FROM r WHERE rank <= 5""")
def known_surfaces(spark: SparkSession, d: str) -> DataFrame:
    return L.known_surfaces(pairs(spark, d), share=0.05)


@query(f"""WITH {PAIRS}, n AS (SELECT lexeme, stem, count(*) AS n FROM pairs GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY lexeme)::BIGINT AS total FROM n), r AS (SELECT *, row_number() OVER (PARTITION BY lexeme ORDER BY n DESC, stem) AS r FROM t WHERE total >= 10 AND n / total >= 0.5)
SELECT lexeme, stem, n, total FROM r WHERE r = 1""")
def majority_table(spark: SparkSession, d: str) -> DataFrame:
    return L.majority(pairs(spark, d), ["lexeme"], "stem", 10, 0.5)


ILEX = LEX.replace("SELECT surface", "SELECT iso, surface").replace("FROM pairs", "FROM ipairs").replace("GROUP BY 1, 2, 3, 4", "GROUP BY 1, 2, 3, 4, 5")


@query(f"""WITH {IPAIRS}, {ILEX} SELECT iso, count(*) AS rows, count(DISTINCT surface) AS n_surface, count(DISTINCT lexeme) AS n_lexeme, count(DISTINCT strong) AS n_strong, count(*) FILTER (hi_conf >= 0.9) AS hi_rows,
count(*) FILTER (method = 'eflomal') AS rows_eflomal, count(*) FILTER (method = 'gloss') AS rows_gloss, count(*) FILTER (method = 'gapfill') AS rows_gapfill,
array_to_string(list_sort(list(DISTINCT CASE WHEN left(strong, 1) = 'G' THEN 'NT' ELSE 'OT' END)), '+') AS testament FROM lex GROUP BY 1""")
def manifest_stats(spark: SparkSession, d: str) -> DataFrame:
    return L.manifest(L.additive_union(with_iso(spark, d, pairs(spark, d)), ["iso"]))


LINE = "concat_ws(chr(9), surface, lexeme, method, base_text, count, format('{:.4f}', hi_conf))"


def line_columns() -> list:
    return [*map(F.col, L.LEX_KEYS), F.col("count").cast("string"), F.format_string("%.4f", "hi_conf")]


@query(f"WITH {IPAIRS}, {ILEX} SELECT iso, count(*) AS rows, sha256(string_agg({LINE}, chr(10) ORDER BY surface, count DESC, lexeme, method, base_text)) AS sha256 FROM lex GROUP BY 1")
def canonical_hash(spark: SparkSession, d: str) -> DataFrame:
    lex = L.additive_union(with_iso(spark, d, pairs(spark, d)), ["iso"])
    return L.canonical_hash(lex, "iso", line_columns(), ["surface", "-count", "lexeme", "method", "base_text"])


@query(f"""WITH {IPAIRS}, {ILEX}, l AS (SELECT iso, {LINE} AS line FROM lex), b AS (SELECT iso, left(md5(line), 2) AS b, count(*) AS n, sha256(string_agg(line, chr(10) ORDER BY line)) AS d FROM l GROUP BY 1, 2)
SELECT iso, sum(n)::BIGINT AS rows, sha256(string_agg(d, chr(10) ORDER BY b)) AS sha256 FROM b GROUP BY 1""")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return L.content_hash(L.additive_union(with_iso(spark, d, pairs(spark, d)), ["iso"]), "iso", line_columns())


STATS = """by_ AS (SELECT iso, lexeme, surface, count(*) AS c, count(*) FILTER (t_idx[2] - t_idx[1] = 1) AS m FROM ipairs WHERE content GROUP BY 1, 2, 3),
stats AS (SELECT iso, lexeme, sum(c)::BIGINT AS total, sum(m)::BIGINT AS mwe, (sum(m * 2) + sum(c) - sum(m)) / sum(c) AS span_mean, least(sum(m), sum(c)) / sum(c) AS multiword_rate, max(c) / sum(c) AS dominance FROM by_ GROUP BY 1, 2)"""


@query(f"WITH {IPAIRS}, {STATS} SELECT iso, lexeme, total, mwe, round(span_mean, 6) AS span_mean, round(multiword_rate, 6) AS multiword_rate, round(dominance, 6) AS dominance FROM stats")
def language_stats(spark: SparkSession, d: str) -> DataFrame:
    s = L.language_stats(with_iso(spark, d, pairs(spark, d)))
    return s.select("iso", "lexeme", "total", "mwe", *(F.round(c, 6).alias(c) for c in ("span_mean", "multiword_rate", "dominance")))


@query(f"WITH {IPAIRS}, {STATS} SELECT lexeme, count(DISTINCT iso) AS n_langs, round(avg(span_mean), 3) AS span_mean, round(avg(multiword_rate), 3) AS multiword_rate FROM stats GROUP BY 1 HAVING count(DISTINCT iso) >= 2")
def span_profile(spark: SparkSession, d: str) -> DataFrame:
    return L.span_profile(L.language_stats(with_iso(spark, d, pairs(spark, d))))


@query(f"WITH {IPAIRS}, {STATS} SELECT lexeme, count(DISTINCT iso) AS n_langs, round(avg(dominance), 6) AS dominance FROM stats WHERE total >= 5 GROUP BY 1 HAVING count(DISTINCT iso) >= 2 AND avg(dominance) < 0.12")
def light_lexemes(spark: SparkSession, d: str) -> DataFrame:
    return L.light_lexemes(L.language_stats(with_iso(spark, d, pairs(spark, d))), 0.12)


@query(f"""WITH {IPAIRS} SELECT iso, count(DISTINCT ref) AS verses, count(*) FILTER (content) AS content, count(*) FILTER (content AND score >= 0.9 AND coalesce(coherent, true)) AS high,
round(count(*) FILTER (content AND score >= 0.9 AND coalesce(coherent, true)) / count(*) FILTER (content), 6) AS high_rate, sum(len(t_idx))::BIGINT AS target_covered, any_value(target_tokens)::BIGINT AS target_tokens, round(sum(len(t_idx)) / any_value(target_tokens), 6) AS target_rate
FROM ipairs JOIN (SELECT iso, sum(l_quantity::INT % 5 + 2) AS target_tokens FROM ipairs GROUP BY 1) USING (iso) GROUP BY 1""")
def coverage_stats(spark: SparkSession, d: str) -> DataFrame:
    p = with_iso(spark, d, pairs(spark, d))
    tokens = p.groupBy("iso", "ref").agg(F.sum(F.col("l_quantity").cast("int") % 5 + 2).alias("n_tokens"))
    return L.coverage(p, "iso", tokens)


@query(f"""WITH {IPAIRS} SELECT iso, base_text, count(*) AS rows, sum(n)::BIGINT AS count FROM (SELECT iso, base_text, surface, lexeme, strong, method, count(*) AS n FROM ipairs WHERE content GROUP BY ALL) GROUP BY 1, 2""")
def manifest_base_texts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the lexicon by language and base text."""
    return L.base_text_counts(L.additive_union(with_iso(spark, d, pairs(spark, d)), ["iso"]))


@query(f"""WITH {PAIRS}, c AS (SELECT base_text, sense, strong, count(*) AS n FROM pairs GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY base_text, sense) AS total, row_number() OVER (PARTITION BY base_text, sense ORDER BY n DESC, strong) AS r FROM c)
SELECT base_text, sense, strong, n, total::BIGINT AS total FROM t WHERE r = 1 AND total >= 10 AND n / total >= 0.01 AND strong <> base_text AND regexp_matches(strong, '^H')""")
def guarded_majority(spark: SparkSession, d: str) -> DataFrame:
    """The Hebrew key that most rows of a cell have, where it is another than the cell's own."""
    return L.majority(pairs(spark, d), ["base_text", "sense"], "strong", 10, 0.01, other_than="base_text", like="^H")


@query(f"""WITH {PAIRS}, n AS (SELECT surface, lexeme, count(*) AS n FROM pairs WHERE content GROUP BY 1, 2), p AS (SELECT *, n / sum(n) OVER (PARTITION BY surface) AS p FROM n)
SELECT surface, sum(n)::BIGINT AS total, count(*) AS partners, round(CASE WHEN sum(n) <= 1 THEN 0 ELSE -sum(p * log2(p)) END, 6) AS entropy FROM p GROUP BY 1""")
def entropy(spark: SparkSession, d: str) -> DataFrame:
    return L.entropy(L.usable(pairs(spark, d)).groupBy("surface", "lexeme").agg(F.count("*").alias("n")), ["surface"])
