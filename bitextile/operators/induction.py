"""What a corpus of texts teaches about its language: stopwords, affixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def word_counts(texts: DataFrame, group: list[str], normalize: bool = True) -> DataFrame:
    """Counts of lower-case words by group."""
    from ..functions.text import tokens

    words = texts.select(*group, F.explode(tokens(F.col("text"), normalize)).alias("word"))
    return words.groupBy(*group, F.lower("word").alias("word")).agg(F.count("*").alias("n"))


def stopword_candidates(counts: DataFrame, lang: str = "lang", book: str = "source", top: int = 150, dispersion: float = 0.85) -> DataFrame:
    """Of the most frequent words of a language those that are in most of its books."""
    books = counts.groupBy(lang).agg(F.countDistinct(book).alias("n_books"))
    words = counts.groupBy(lang, "word").agg(F.sum("n").alias("freq"), F.countDistinct(book).alias("in_books"))
    ranked = words.withColumn("rank", F.row_number().over(Window.partitionBy(lang).orderBy(F.desc("freq"), F.asc("word")))).where(F.col("rank") <= top)
    return ranked.join(books, lang).where(F.col("in_books") / F.col("n_books") >= dispersion).select(lang, "word", "freq", "in_books", "n_books", "rank")


def rescue(candidates: DataFrame, dominant: DataFrame, content: DataFrame) -> DataFrame:
    """Candidates without those whose dominant lexeme is a content lexeme."""
    held = dominant.join(content.select("lexeme"), "lexeme", "left_semi").select(F.col("surface").alias("word"))
    return candidates.join(held, "word", "left_anti")


def splits(words: DataFrame, group: str, side: str, stem: int = 3, longest: int = 5, shortest: int = 1, also: Sequence[str] = ()) -> DataFrame:
    """group, word, columns that go along, k, stem and affix: every split of a word of `stem` letters or more, the empty affix (k = 0) included."""
    n = F.length("word")
    cut = F.explode(F.sequence(F.lit(0), F.least(F.lit(longest), n - stem))).alias("k")
    parts = words.where(n >= stem).select(group, "word", *also, cut).where((F.col("k") == 0) | (F.col("k") >= shortest))
    k = F.col("k")
    if side == "suffix":
        return parts.select(group, "word", *also, "k", F.substring("word", F.lit(1), n - k).alias("stem"), F.substring("word", n - k + 1, k).alias("affix"))
    return parts.select(group, "word", *also, "k", F.substring("word", k + 1, n - k).alias("stem"), F.substring("word", F.lit(1), k).alias("affix"))


def single(words: DataFrame, group: str, once: bool) -> DataFrame:
    """The words of each group, each once; `once`: they are so already."""
    words = words.select(group, "word")
    return words if once else words.distinct()


def affixes(words: DataFrame, group: str, side: str, stem: int = 3, longest: int = 5, shortest: int = 1, real: int = 2, productive: int = 12, top: int = 40, once: bool = False) -> DataFrame:
    """Productive suffixes or prefixes of the distinct words of each group; `once`: no word comes twice.

    Every split with a stem of `stem` letters and an affix up to `longest` is taken; a stem is real if it has `real`
    different affixes, the empty one included; an affix is productive on `productive` real stems. A stem and an affix are
    one word, so splits of words that come once are counted without being told apart.
    """
    words = single(words, group, once).where(F.col(group).isNotNull())
    parts = splits(words, group, side, stem, longest, shortest).select("stem", group, "affix")
    parts = parts.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("stem", group)))  # stem first, as the sort goes by its first letters
    found = parts.where((F.col("n") >= real) & (F.col("affix") != "")).groupBy(group, "affix").agg(F.count(F.lit(1)).alias("stems")).where(F.col("stems") >= productive)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("stems"), F.asc("affix"))))
    return ranked.where(F.col("rank") <= top)


def stem_lexicon(words: DataFrame, group: str, once: bool = False, real: int = 2) -> DataFrame:
    """group and stem: the real stems of the suffix side, and all words; the prefix side is too noisy to vouch for a rest."""
    words, cut = single(words, group, once), F.length("word") >= 3
    stems = splits(words, group, "suffix", 3).groupBy("stem", group).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k"))
    short = words.where(~F.coalesce(cut, F.lit(False))).select(group, F.col("word").alias("stem"))
    return stems.where((F.col("n") >= real) | (F.col("k") == 0)).select(group, "stem").union(short)


def _stripped(bases: DataFrame, group: str, side: str, known: DataFrame, stems: DataFrame, longest: int) -> DataFrame:
    """group, word, base and what is left of base without its longest affix of `known` whose rest is a stem."""
    own = bases.select(group, F.col("word").alias("of"), F.col("base").alias("word"))
    cut = splits(own, group, side, longest=longest, also=["of"]).where("k > 0")
    fits = cut.join(F.broadcast(known.select(group, "affix")), [group, "affix"], "left_semi").join(stems, ["stem", group], "left_semi")
    return fits.groupBy(group, "of", "word").agg(F.max_by("stem", "k").alias("rest")).select(group, F.col("of").alias("word"), F.col("rest").alias("base"))


def learned_forms(words: DataFrame, group: str, suffixes: DataFrame, prefixes: DataFrame, stems: DataFrame, longest: int = 5) -> DataFrame:
    """group, word and forms: the word, and what is left of it without one productive suffix, then of each of these without
    one productive prefix, longest first and equals in order.

    The longest affix goes whose rest is a stem. suffixes and prefixes: group, affix, few for each group, as they are sent to
    all; stems: group, stem. A word is looked up by its few splits, so the stems stay a table that is joined and no list on every row.
    """
    own = words.select(group, F.lower("word").alias("word")).distinct().withColumn("base", F.col("word"))
    base = own.unionByName(_stripped(own, group, "suffix", suffixes, stems, longest))
    base = base.unionByName(_stripped(base, group, "prefix", prefixes, stems, longest))
    other = F.when(F.col("base") != F.col("word"), F.struct((-F.length("base")).alias("n"), "base"))
    rest = base.groupBy(group, "word").agg(F.sort_array(F.collect_set(other)).alias("r"))  # three at most
    return rest.select(group, "word", F.concat(F.array("word"), F.col("r.base")).alias("forms"))
