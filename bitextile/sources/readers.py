"""Readers of source texts, pairs, gold, priors and occurrence files.

Readers take a path that Spark reads (a folder or a pattern), so files spread over tasks. Files of nested trees with no
fixed schema are read whole, one file a row, and walked in Arrow batches; each is a book or a chapter.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import BOOKS, padded_strong, try_verse_ref
from ..functions.text import norm_surface, variants

#: Paragraph and character markers whose text is no verse text (numbers behind them do not count).
SKIP_PARAGRAPHS = frozenset("b ca cl cp d h ib ide ie ili im imi imt io iot ip ipi iq is lit mr ms mt periph r rem restore s sd sp sr toc".split())
SKIP_CHARACTERS = frozenset("ca cp fm fv va vp".split())
CONTAINERS = frozenset({"para", "char", "book", "table", "table:row", "table:cell", "USJ", "chapter", "verse", "ms"})

PAIR = "struct<h_idx:int,lexeme:string,strong:string,lemma:string,stem:string,surface:string,gloss_en:string,sense:string,target:string,t_idx:array<int>,score:double,method:string,content:boolean,light:boolean,prior:string,coherent:boolean,agree:int,voters:array<string>>"
PAIRS = f"ref int, book string, chapter int, verse int, pairs array<{PAIR}>"


def spine(rows: DataFrame) -> DataFrame:
    """Source tokens from spine_words: number keys padded, lexemes filled in, optional columns null where missing."""
    optional = {"gloss": "string", "stem": "string", "sense": "string", "sense_conf": "double", "is_superscription": "int", "phrase_id": "string", "function": "string", "rela": "string", "number": "string", "gender": "string", "lexeme": "string"}
    for name, kind in optional.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    n = F.array_position(F.array(*map(F.lit, BOOKS)), F.col("book"))
    strong = padded_strong(n, F.col("strong"))
    fallback = F.when(strong.isNotNull() & F.col("lemma").isNotNull(), F.concat_ws("|", strong, "lemma")).otherwise(F.coalesce(strong, "lemma"))
    out = rows.where("verse >= 1").withColumn("ref", try_verse_ref(F.col("book"), F.col("chapter"), F.col("verse"))).withColumn("lexeme", F.coalesce(F.nullif("lexeme", F.lit("")), fallback))
    return out.withColumn("strong", strong).withColumn("is_content", F.col("is_content").cast("boolean")).withColumn("is_superscription", F.coalesce(F.col("is_superscription").cast("boolean"), F.lit(False)))


def chapters(rows: DataFrame) -> DataFrame:
    return rows.where("verse >= 1").select("book", "chapter", "verse").distinct()


def walk_usj(tree: dict) -> Iterator[tuple[int, int, int, str]]:
    """(chapter, first verse, last verse, text) of each text piece in document order."""
    state = [0, 0, 0]

    def walk(node) -> Iterator[tuple[int, int, int, str]]:
        if isinstance(node, str):
            if state[1] and node.strip():
                yield state[0], state[1], state[2], node.strip()
            return
        kind, marker = node.get("type"), (node.get("marker") or "").rstrip("0123456789")
        if kind == "chapter":
            state[:] = [int(node["number"]), 0, 0]
            return
        if kind == "verse":
            a, _, b = str(node["number"]).partition("-")
            first = int("".join(c for c in a if c.isdigit()) or 0)
            state[1:] = [first, max(first, int("".join(c for c in b if c.isdigit()) or 0))]
            return
        if kind == "note" or (kind == "para" and marker in SKIP_PARAGRAPHS) or (kind == "char" and marker in SKIP_CHARACTERS):
            return
        for child in node.get("content") or ():
            yield from walk(child)

    yield from walk(tree)


def usj_pieces(spark: SparkSession, path: str) -> DataFrame:
    """path, piece, chapter, verse_start, verse_end, text from USJ books, one JSON file each."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")

    def run(batches):
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = list(walk_usj(json.loads(text)))
                if rows:
                    c, a, b, t = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(range(len(rows)), pa.int32()), pa.array(c, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(t)], ["file", "piece", "chapter", "verse_start", "verse_end", "text"])

    return files.mapInArrow(run, "file string, piece int, chapter int, verse_start int, verse_end int, text string")


def usj_book(file: Column) -> Column:
    """The book code in a file name like 01-GEN.json."""
    return F.regexp_extract(file, r"([1-3A-Z][A-Z0-9]{2})\.json$", 1)


def verse_ranges(pieces: DataFrame) -> DataFrame:
    """book, chapter, verse_start, verse_end and the pieces' text joined by spaces."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda x: x["text"]), " ")
    return pieces.groupBy(usj_book(F.col("file")).alias("book"), "chapter", "verse_start").agg(F.max("verse_end").alias("verse_end"), text.alias("text"))


def chapter_ends(pieces: DataFrame) -> DataFrame:
    """The last verse of each chapter."""
    return pieces.groupBy(usj_book(F.col("file")).alias("book"), "chapter").agg(F.max("verse_end").alias("last"))


def pair_files(spark: SparkSession, folder: str, method: str | None = None, tag: str | None = None) -> DataFrame:
    """Pairs from align_<method>_<tag>_<BOOK>.jsonl, one row each, with method, tag and book of the file.

    What follows the tag must be a book code, so one tag never takes the files of a longer one.
    """
    rows = spark.read.schema(PAIRS).json(f"{folder}/align_*.jsonl").withColumn("__f", F.col("_metadata.file_name"))
    p = rf"^align_([a-z0-9]+)_(.+)_({'|'.join(BOOKS)})\.jsonl$"
    rows = rows.select("*", *(F.regexp_extract("__f", p, k).alias(n) for k, n in ((1, "file_method"), (2, "tag"), (3, "file_book")))).where("file_book <> ''")
    rows = rows if method is None else rows.where(F.col("file_method") == method)
    rows = rows if tag is None else rows.where(F.col("tag") == tag)
    one = rows.select("ref", "book", "chapter", "verse", "file_method", "tag", F.explode("pairs").alias("p"))
    return one.select("ref", "book", "chapter", "verse", "file_method", "tag", "p.*")


def published(spark: SparkSession, root: str, *columns: str, iso: str | None = None) -> DataFrame:
    """A dataset partitioned by iso, with the columns asked for."""
    df = spark.read.parquet(root)
    df = df if iso is None else df.where(F.col("iso") == iso)
    return df.select(*columns) if columns else df


def gold_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, comment="#")


def gold_sets(gold: DataFrame, key: str, base_text: str | None = None) -> DataFrame:
    """For each normal surface its keys and its number of attestations."""
    rows = gold if base_text is None or "base_text" not in gold.columns else gold.where(F.col("base_text") == base_text)
    return rows.groupBy(norm_surface(F.col("surface")).alias("surface")).agg(F.sort_array(F.collect_set(key)).alias("keys"), F.count("*").alias("n"))


def gold_positions(gold: DataFrame) -> DataFrame:
    """For each verse (the first eight digits of the reference) and number key its normal surfaces."""
    return gold.groupBy(F.left("ref", F.lit(8)).alias("ref"), "strong").agg(F.sort_array(F.collect_set(norm_surface(F.col("surface")))).alias("surfaces"))


def lexicon_html(pages: DataFrame, pattern: str) -> DataFrame:
    """strong and gloss from pages (page, html) by a pattern with both as groups; the first entry holds."""
    found = pages.select("page", F.regexp_extract_all("html", F.lit(pattern), F.lit(1)).alias("s"), F.regexp_extract_all("html", F.lit(pattern), F.lit(2)).alias("g"))
    rows = found.select("page", F.posexplode(F.arrays_zip("s", "g"))).select("page", "pos", F.col("col.s").alias("strong"), F.trim(F.regexp_replace("col.g", "<[^>]*>", "")).alias("gloss"))
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("strong").orderBy("page", "pos"))).where("r = 1").select("strong", "gloss")


def gloss_csv(spark: SparkSession, path: str, key: str = "lex") -> DataFrame:
    """Glosses with a column for each stem as rows: key, stem, variants."""
    wide = spark.read.csv(path, header=True)
    wide = wide.withColumnsRenamed({c: c.replace("﻿", "") for c in wide.columns})
    long = wide.unpivot([key], [c for c in wide.columns if c != key], "stem", "cell").where("cell is not null")
    return long.select(F.col(key).alias("lexeme"), "stem", variants(F.col("cell")).alias("variants"))


def gloss_tsv(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, sep="\t", schema="strong string, lemma_ref string, en_ref string, gloss string")
    return rows.where("gloss is not null").groupBy("strong").agg(F.array_distinct(F.flatten(F.collect_list(variants(F.col("gloss"))))).alias("variants"))


def words_json(spark: SparkSession, path: str) -> DataFrame:
    """Words of books written as chapters, verses and words: ref, seq and the word's fields."""
    word = "struct<id:string,text:string,lemma:string,grammar:string,gloss:string>"
    books = spark.read.schema(f"chapters array<struct<verses:array<struct<id:string,words:array<{word}>>>>>").json(path, multiLine=True)
    verses = books.select(F.explode("chapters").alias("c")).select(F.explode("c.verses").alias("v"))
    return verses.select(F.col("v.id").cast("long").alias("ref"), F.posexplode("v.words").alias("seq", "w")).select("ref", "seq", "w.*")


def spans_json(rows: DataFrame, side: str) -> DataFrame:
    """Tagged spans from JSON text with a map of verse to arrays [text, strong, flags]: verse, idx, text, strong, elided."""
    verses = rows.select(F.explode(F.from_json(F.get_json_object("value", f"$.{side}"), "map<string,array<array<string>>>")).alias("verse", "spans"))
    return verses.select("verse", F.posexplode("spans").alias("idx", "s")).select("verse", "idx", F.col("s")[0].alias("text"), F.get("s", F.lit(1)).alias("strong"), F.coalesce(F.get("s", F.lit(2)).contains('"elided":true'), F.lit(False)).alias("elided"))


def vrs(spark: SparkSession, path: str) -> DataFrame:
    """book, chapter and last verse from lines 'BOOK c:v c:v ...'; other lines are left out."""
    lines = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("w")).where(F.col("w")[0].isin(*BOOKS))
    cells = lines.select(F.col("w")[0].alias("book"), F.explode(F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0)))).alias("x")).where(F.col("x").rlike(r"^\d+:\d+$"))
    return cells.select("book", F.split("x", ":")[0].cast("int").alias("chapter"), F.split("x", ":")[1].cast("int").alias("last"))


def pos_and_translit(priors: DataFrame) -> DataFrame:
    """lexeme with pos and translit, null where the pack has no such column."""
    have = lambda c: F.col(c) if c in priors.columns else F.lit(None).cast("string")
    return priors.select("lexeme", F.coalesce(have("pos").cast("string"), F.lit("?")).alias("pos"), F.regexp_replace(have("translit").cast("string"), "[.·]", "").alias("translit"))


def rules_json(spark: SparkSession, path: str) -> DataFrame:
    """Contest rules {'ef | gl': winner} as rows."""
    one = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "rule"))
    return one.select(F.trim(F.split("k", r"\|")[0]).alias("ef_tier"), F.trim(F.split("k", r"\|")[1]).alias("gl_tier"), "rule")


def titles_of(spark: SparkSession, articles: str) -> DataFrame:
    """article and title from a JSON object {article: {title: ...}}."""
    one = spark.read.text(articles, wholetext=True).select(F.explode(F.from_json("value", "map<string,struct<title:string>>")).alias("article", "a"))
    return one.select("article", F.col("a.title").alias("title")).where("title <> ''")


def title_variants(spark: SparkSession, links: str, articles: str) -> DataFrame:
    """strong and variants: the titles of the articles that a table (strong, article) links it with, in its order."""
    rows = spark.read.csv(links, sep="\t", schema="strong string, article string").where("strong <> 'strong' AND article IS NOT NULL")
    placed = rows.select(F.monotonically_increasing_id().alias("n"), "strong", "article")
    joined = placed.join(titles_of(spark, articles), "article").select("strong", F.struct("n", variants(F.col("title")).alias("v")).alias("x")).where(F.size("x.v") > 0)
    return joined.groupBy("strong").agg(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["v"]))).alias("variants"))


def table_json(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A table written as one JSON object, as rows."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias(key, value))


#: The fields that an exclusion rule may state.
EXCLUSION = ("lexeme", "stem", "sense", "surface", "base_text")


def exclusions_json(spark: SparkSession, path: str) -> DataFrame:
    """Exclusion rules, a row each: the fields that a rule states, others null; surfaces trimmed in lower case; rules that
    state none are left out. The file is an object with `exclude`, or the list itself."""
    fields = ", ".join(f"{c}:string" for c in EXCLUSION)
    text = spark.read.text(path, wholetext=True)
    rules = F.coalesce(F.from_json("value", f"struct<exclude:array<struct<{fields}>>>")["exclude"], F.from_json("value", f"array<struct<{fields}>>"))
    rows = text.select(F.explode(rules).alias("r")).select("r.*").withColumn("surface", F.lower(F.trim("surface")))
    return rows.where(F.coalesce(*EXCLUSION).isNotNull())
