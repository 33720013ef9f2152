"""The engine's logical tables made from the star-schema test tables, in Spark and as SQL.

An order is a verse, its lines are source tokens, parts are lexemes and surfaces, return flags are methods, line states are
base texts, and the region of the supplier is the language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

METHODS = {"A": "eflomal", "N": "gloss", "R": "gapfill"}
#: Up to so many parts are sent to all executors. The size of a file tells little: names repeat, so 1,200,000 parts are 5 MB of
#: Parquet, and 340 MB in the driver for each set of columns that a plan asks for.
SENT = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexeme_columns(df: DataFrame) -> DataFrame:
    digits = F.lpad(F.regexp_replace("p_brand", "[^0-9]", ""), 4, "0")
    greek = F.col("p_size") >= 25
    return df.select(
        "*",
        F.concat(F.when(greek, "grc:").otherwise("hbo:"), digits, F.lower(F.left("p_type", F.lit(1)))).alias("lexeme"),
        F.concat(F.when(greek, "G").otherwise("H"), digits).alias("strong"),
        F.lower("p_name").alias("surface"), F.split(F.lower("p_name"), " ")[0].alias("word1"), F.split(F.lower("p_name"), " ")[1].alias("word2"),
        (F.col("p_size") % 5).cast("string").alias("sense"), F.lower("p_type").alias("stem"),
        (F.col("p_size") % 4 != 0).alias("content"), (F.col("p_size") % 10 == 0).alias("light"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each source token with its target."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    part = lexeme_columns(part).hint("broadcast" if part.count() <= SENT else "merge")
    place = Window.partitionBy("ref").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    q = F.col("l_quantity").cast("int")
    start, step = (q % 7).alias("s"), F.when(F.col("l_tax") < 0.04, 1).otherwise(2)
    # named before the window, so that the plan knows its rows as dealt by ref
    joined = li.join(part, li["l_partkey"] == part["p_partkey"]).withColumnRenamed("l_orderkey", "ref")
    return joined.select(
        "ref", (F.row_number().over(place) - 1).alias("h_idx"), "lexeme", "strong", "surface", "word1", "word2",
        F.when(F.col("l_returnflag") == "A", "eflomal").when(F.col("l_returnflag") == "N", "gloss").otherwise("gapfill").alias("method"),
        F.col("l_linestatus").alias("base_text"), F.when(F.col("l_discount") >= 0.05, 0.9).otherwise(0.6).alias("score"), "content", "light",
        F.when(F.col("l_suppkey") % 3 != 0, F.col("l_quantity") < 40).alias("coherent"), F.array(start, start + step).alias("t_idx"), "sense", "stem",
        (F.col("l_suppkey") % 4).alias("phrase_id"), F.col("p_type").alias("function"), "l_suppkey", "l_partkey", "l_discount", "l_tax", "l_extendedprice", "l_quantity",
    )


def with_iso(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """df with iso, the region of its supplier; the lookup has one row for each supplier, and Spark picks the join."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    iso = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).select("s_suppkey", F.lower("r_name").alias("iso"))
    return df.join(iso, df["l_suppkey"] == iso["s_suppkey"]).drop("s_suppkey")


LEXEME = """CASE WHEN p_size >= 25 THEN 'grc:' ELSE 'hbo:' END || lpad(regexp_replace(p_brand, '[^0-9]', '', 'g'), 4, '0') || lower(left(p_type, 1))"""
STRONG = """CASE WHEN p_size >= 25 THEN 'G' ELSE 'H' END || lpad(regexp_replace(p_brand, '[^0-9]', '', 'g'), 4, '0')"""
#: Common table expressions: `pairs`, and with iso `ipairs`.
PAIRS = f"""parts AS (SELECT *, {LEXEME} AS lexeme, {STRONG} AS strong, lower(p_name) AS surface, split_part(lower(p_name), ' ', 1) AS word1, split_part(lower(p_name), ' ', 2) AS word2,
  (p_size % 5)::VARCHAR AS sense, lower(p_type) AS stem, p_size % 4 <> 0 AS content, p_size % 10 = 0 AS light FROM part),
pairs AS (SELECT l_orderkey AS ref, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS h_idx, lexeme, strong, surface, word1, word2,
  CASE l_returnflag WHEN 'A' THEN 'eflomal' WHEN 'N' THEN 'gloss' ELSE 'gapfill' END AS method, l_linestatus AS base_text, CASE WHEN l_discount >= 0.05 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS score,
  content, light, CASE WHEN l_suppkey % 3 <> 0 THEN l_quantity < 40 END AS coherent,
  [trunc(l_quantity)::INT % 7, trunc(l_quantity)::INT % 7 + CASE WHEN l_tax < 0.04 THEN 1 ELSE 2 END] AS t_idx, sense, stem, l_suppkey % 4 AS phrase_id, p_type AS function,
  l_suppkey, l_partkey, l_discount, l_tax, l_extendedprice, l_quantity FROM lineitem JOIN parts ON l_partkey = p_partkey)"""
IPAIRS = PAIRS + """, ipairs AS (SELECT pairs.*, lower(r_name) AS iso FROM pairs JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
