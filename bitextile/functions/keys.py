"""Key algebra: verse references, number keys, editions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 66 book codes in order; a book's number is its place from 1, and from 40 on it is of the second part.
BOOKS = (
    "GEN EXO LEV NUM DEU JOS JDG RUT 1SA 2SA 1KI 2KI 1CH 2CH EZR NEH EST JOB PSA PRO ECC SNG ISA JER LAM EZK DAN HOS JOL AMO OBA JON MIC NAM HAB ZEP HAG ZEC MAL "
    "MAT MRK LUK JHN ACT ROM 1CO 2CO GAL EPH PHP COL 1TH 2TH 1TI 2TI TIT PHM HEB JAS 1PE 2PE 1JN 2JN 3JN JUD REV"
).split()
SECOND_PART = 40


def book_number(book: Column) -> Column:
    """1 to 66; null for another code."""
    at = F.array_position(F.array(*map(F.lit, BOOKS)), F.upper(F.trim(book)))
    return F.when(at > 0, at.cast("int"))


def verse_ref(book: Column, chapter: Column, verse: Column) -> Column:
    """BBCCCVVV as a number. An unknown book, or a chapter or verse outside 1 to 999, is an error."""
    n = book_number(book)
    ok = n.isNotNull() & chapter.between(1, 999) & verse.between(1, 999)
    ref = n * 1_000_000 + chapter * 1_000 + verse
    return F.when(ok, ref).otherwise(F.raise_error(F.concat(F.lit("no verse: "), F.concat_ws(" ", book, chapter.cast("string"), verse.cast("string")))).cast("int"))


def try_verse_ref(book: Column, chapter: Column, verse: Column) -> Column:
    """verse_ref, but null for what is no verse."""
    n = book_number(book)
    return F.when(n.isNotNull() & chapter.between(1, 999) & verse.between(1, 999), n * 1_000_000 + chapter * 1_000 + verse)


def parse_ref(text: Column) -> Column:
    """'BOOK c:v' as a struct of book, chapter and verse; null fields where it is not of that form."""
    p = r"^\s*(\w+)\s+(\d+):(\d+)\s*$"
    part = lambda k: F.nullif(F.regexp_extract(text, p, k), F.lit(""))
    return F.struct(part(1).alias("book"), part(2).cast("int").alias("chapter"), part(3).cast("int").alias("verse"))


def padded_strong(book_no: Column, number: Column) -> Column:
    """H or G by part and four digits at least; null for no number or 0."""
    letter = F.when(book_no >= SECOND_PART, F.lit("G")).otherwise(F.lit("H"))
    return F.when(number.isNotNull() & (number != 0), F.concat(letter, F.format_string("%04d", number.cast("int"))))


def fallback_lexeme(strong: Column, lemma: Column) -> Column:
    """strong|lemma, or the one that is there."""
    s, m = F.nullif(strong, F.lit("")), F.nullif(lemma, F.lit(""))
    return F.when(s.isNotNull() & m.isNotNull(), F.concat_ws("|", s, m)).otherwise(F.coalesce(s, m))


def norm_strong(raw: Column, default: str = "H") -> Column:
    """First letter upper-cased (default H) and first run of digits in four places; null without digits."""
    digits = F.nullif(F.regexp_extract(raw, r"(\d+)", 1), F.lit(""))
    letter = F.coalesce(F.nullif(F.upper(F.regexp_extract(raw, r"(\p{L})", 1)), F.lit("")), F.lit(default))
    return F.when(digits.isNotNull(), F.concat(letter, F.format_string("%04d", digits.cast("int"))))


def lemma_skeleton(lemma: Column) -> Column:
    """A lemma in folded case without marks that stay by themselves in NFC, as vowel points do: what two vocalizations share.
    Null is empty."""
    from .text import folded

    return F.trim(folded(F.coalesce(lemma, F.lit(""))))


def strong_key(strong: Column, lemma: Column, grain: str = "strong") -> Column:
    """The key to compare at: the number key, or with 'lexeme' the number key and the lemma's skeleton; null without a number."""
    own = norm_strong(strong)
    if grain == "strong":
        return own
    if grain != "lexeme":
        raise ValueError(f"no grain: {grain}")
    return F.when(own.isNotNull(), F.concat(own, F.lit("|"), lemma_skeleton(lemma)))


#: The letters of the presence codes of media and of texts, and the badges they stand for.
MEDIA = {"a": "audio", "v": "video", "t": "audio_timed", "s": "video_timed"}
CODEX = {"o": "old", "n": "new", "d": "deuterocanon"}


def presence(code: Column, letters: dict[str, str]) -> Column:
    """The names of the letters that a code has, in their order; letters it does not know are passed over."""
    return F.filter(F.array(*(F.when(F.coalesce(code, F.lit("")).contains(k), F.lit(n)) for k, n in letters.items())), lambda x: x.isNotNull())


def presence_code(parts: dict[str, Column]) -> Column:
    """A code of the letters whose condition holds, in the order given."""
    return F.concat(*(F.when(holds, F.lit(k)).otherwise(F.lit("")) for k, holds in parts.items()))


def sound_media(code: Column) -> Column:
    """Whether a media code's timings have what they time: t needs a, s needs v."""
    return (~code.contains("t") | code.contains("a")) & (~code.contains("s") | code.contains("v"))


def strong_of(lexeme: Column) -> Column:
    """The number key of a lexeme 'lang:digits...': H for hbo, else G, and four digits at least."""
    digits = F.nullif(F.regexp_replace(F.substring_index(lexeme, ":", -1), r"\D", ""), F.lit(""))
    return F.when(digits.isNotNull(), F.concat(F.when(lexeme.startswith("hbo"), F.lit("H")).otherwise(F.lit("G")), F.format_string("%04d", digits.cast("int"))))


def testament(strong: Column) -> Column:
    return F.when(strong.startswith("G"), F.lit("NT")).otherwise(F.lit("OT"))


def edition_id(iso: Column, edition: Column) -> Column:
    """The edition with iso_ in front, unless it begins with iso already."""
    return F.when(F.lower(edition).startswith(F.lower(iso)), edition).otherwise(F.concat_ws("_", iso, edition))


def edition_tag(iso: Column, edition: Column) -> Column:
    """Lower case, other characters than letters and digits as _; with _2 if that is the iso itself."""
    slug = F.regexp_replace(F.lower(edition), "[^a-z0-9]", "_")
    return F.when(slug == iso, F.concat(slug, F.lit("_2"))).otherwise(slug)
