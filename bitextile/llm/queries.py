"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from secrets import token_hex

from pyspark.sql import DataFrame, SparkSession

from ..session import ship
from . import chat, decontam, fill_middle, ngram_join, packing, pattern_packing, pii, prefix_trie, quality, secrets, suffix_dedup, syncmers, token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = shipped
    return f


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pseudonym_key(spark: SparkSession) -> str:
    """The setting spark.bitextile.pseudonym.key; where it is missing, a random one for this session."""
    name = "spark.bitextile.pseudonym.key"
    if not spark.conf.get(name, None):
        spark.conf.set(name, token_hex(32))
    return spark.conf.get(name)


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_pairs(table(spark, sf_dir, "documents"))


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated(table(spark, sf_dir, "documents"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query
def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preference(chat.contrasted(table(spark, sf_dir, "conversations")))


@query
def op7_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"), pseudonym_key(spark))


@query
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, table(spark, sf_dir, "labels")))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.report(table(spark, sf_dir, "documents"))


@query
def op12_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


ORACLES["op10_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) FROM m) GROUP BY 1),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)
"""

ORACLES["op6_preference_format"] = r"""
WITH own AS (SELECT * FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
said AS (SELECT conv_id, turn AS last, text AS answer FROM own WHERE role = 'assistant' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) = 1),
last AS (SELECT conv_id, last, coalesce(lead(answer) OVER (ORDER BY conv_id), first_value(answer) OVER (ORDER BY conv_id)) AS other, count(*) OVER () AS n FROM said),
t AS (SELECT o.conv_id AS pair_id, o.turn, o.role, o.text, CASE WHEN o.turn = l.last AND o.role = 'assistant' THEN l.other ELSE o.text END AS other
      FROM own o JOIN last l ON o.conv_id = l.conv_id WHERE o.turn <= l.last AND l.n > 1),
m AS (SELECT *, bool_and(text = other) OVER (PARTITION BY pair_id ORDER BY turn) AS shared FROM t),
r AS (SELECT pair_id, turn, role, shared, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS c, '<|im_start|>' || role || chr(10) || other || '<|im_end|>' || chr(10) AS j FROM m),
s AS (SELECT *, sum(CASE WHEN shared THEN 0 ELSE length(c) END) OVER (PARTITION BY pair_id ORDER BY turn) - length(c) AS cs, sum(CASE WHEN shared THEN 0 ELSE length(j) END) OVER (PARTITION BY pair_id ORDER BY turn) - length(j) AS js FROM r)
SELECT pair_id, count(*) FILTER (shared)::BIGINT AS prompt_turns, coalesce(string_agg(c, '' ORDER BY turn) FILTER (shared), '') AS prompt,
  coalesce(string_agg(c, '' ORDER BY turn) FILTER (NOT shared), '') AS chosen, coalesce(string_agg(j, '' ORDER BY turn) FILTER (NOT shared), '') AS rejected,
  coalesce(string_agg((cs + 13 + length(role))::BIGINT || '-' || (cs + length(c) - 1)::BIGINT, ',' ORDER BY turn) FILTER (NOT shared AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((js + 13 + length(role))::BIGINT || '-' || (js + length(j) - 1)::BIGINT, ',' ORDER BY turn) FILTER (NOT shared AND role = 'assistant'), '') AS rejected_mask
FROM s GROUP BY 1
"""

ORACLES["op8_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
two AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT x, y FROM two UNION SELECT r.x, two.y FROM r JOIN two ON r.y = two.x),
c AS (SELECT x, min(y) AS y FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.x = d.doc_id
"""

ORACLES["op11_fill_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]', 0, 's')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
             WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]', 0, 's') AS w, least(a, b) AS lo, greatest(a, b) AS hi FROM k),
s AS (SELECT *, coalesce(array_to_string(w[1 : lo], ''), '') AS p, coalesce(array_to_string(w[lo + 1 : hi], ''), '') AS m, coalesce(array_to_string(w[hi + 1 : n], ''), '') AS x FROM u)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM s
"""

ORACLES["op13_prefix_trie"] = r"""
WITH o AS (SELECT conv_id, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS k FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list_reduce(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT),
        lambda a, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(a, b)), 4294967295::BIGINT) AS crc FROM (SELECT DISTINCT conv_id FROM o)),
h AS (SELECT conv_id, xor(crc, 4294967295::BIGINT) % 6 AS h FROM c),
r AS (SELECT h.conv_id, 0 AS own, o.k, o.t, o.chars FROM h JOIN o ON o.conv_id = h.conv_id - h.conv_id % 100 AND o.k <= h.h UNION ALL SELECT h.conv_id, 1, o.k, o.t, o.chars FROM h JOIN o ON o.conv_id = h.conv_id AND o.k > h.h),
q AS (SELECT h.conv_id, coalesce(list(r.t ORDER BY own, k) FILTER (r.t IS NOT NULL), []) AS ts, coalesce(list(r.chars ORDER BY own, k) FILTER (r.t IS NOT NULL), []) AS cs FROM h LEFT JOIN r ON r.conv_id = h.conv_id GROUP BY 1),
x AS (SELECT conv_id, d, len(ts) AS n, md5(array_to_string(ts[1 : d], '')) AS node, CASE WHEN d > 0 THEN md5(array_to_string(ts[1 : d - 1], '')) END AS up, CASE WHEN d > 0 THEN cs[d] ELSE 0 END AS chars FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM q)),
nodes AS (SELECT node, d, any_value(up) AS up, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends FROM x GROUP BY 1, 2),
kids AS (SELECT up AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
leaf AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.node = n.node AND k.d = n.d),
own AS (SELECT a.node AS top, a.d AS top_d, l.* FROM x a JOIN x b ON b.conv_id = a.conv_id AND b.d >= a.d JOIN leaf l ON l.node = b.node AND l.d = b.d AND l.conv_id = b.conv_id),
sums AS (SELECT top, top_d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved FROM own GROUP BY 1, 2)
SELECT l.conv_id, l.d::BIGINT AS depth, p.conv_id AS parent_conv_id, l.n_convs, l.n_children::BIGINT AS n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, l.ends AS ends_sha256
FROM leaf l JOIN sums s ON s.top = l.node AND s.top_d = l.d LEFT JOIN leaf p ON p.node = l.up AND p.d = l.d - 1
"""
