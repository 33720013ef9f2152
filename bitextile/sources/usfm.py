"""Verse texts from USFM, and USFM from verses.

A book is a stream of markers and text. A stack holds the open paragraph, notes and character markers: a paragraph marker
closes all that is open, a character marker closes its like, +markers nest, and an end marker closes up to its own. Text
counts where no open marker leaves it out, so unclosed notes end with their paragraph and no later verse is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import SKIP_CHARACTERS, SKIP_PARAGRAPHS

TOKEN = re.compile(r"\\(\+?)([a-z]+)([0-9]*)(?:-[se])?(\*?)|\\\*|~|//")
CODE, NUMBER = re.compile(r"\s*([^\s\\]+)[ ]?"), re.compile(r"\s*([0-9]+[a-z]?(?:[-,][0-9]+[a-z]?)*)[ ]?")
#: Markers of notes, of characters, and of milestones, which have no text of their own.
NOTES = frozenset("f fe ef x ex".split())
CHARACTERS = frozenset(
    "add bd bdit bk ca cat cp dc em fdc fig fk fl fm fp fq fqa fr ft fv fw it iqt ior jmp k lik litl liv nd ndx no ord pn png pro qac qs qt rb rq rt sc sig sls sup tl va vp w wa wg wh wj xdc xk xnt xo xop xot xq xt xta".split()
)
MILESTONES = frozenset("qt ts zaln".split())
HEADERS = frozenset("id usfm ide h toc toca rem sts mt mte imt".split())


def pieces(text: str) -> Iterator[tuple[str, int, int, int, str]]:
    """(book, chapter, first verse, last verse, text) of each piece of verse text in document order."""
    book, chapter, first, last = "", 0, 0, 0
    stack: list[tuple[str, bool]] = []  # markers that are open, and whether they leave text out
    at = 0

    def hidden() -> bool:
        return any(out for _, out in stack)

    def read(end: int) -> Iterator[tuple[str, int, int, int, str]]:
        own = text[at:end]
        if stack and stack[-1][0] in ("w", "rb", "jmp", "fig") and "|" in own:
            own = own.split("|", 1)[0]
        if first and not hidden() and own.strip():
            yield book, chapter, first, last, own.strip()

    for m in TOKEN.finditer(text):
        if m.start() < at:
            continue
        yield from read(m.start())
        at = m.end()
        plus, name, _, star = m.groups()
        if name is None:
            continue
        if m.group(0).endswith(("-s", "-e")) and name in MILESTONES:
            close = text.find("\\*", at)
            at = close + 2 if close >= 0 else at
        elif star:
            ends = [i for i, (n, _) in enumerate(stack) if n == name]
            if ends:
                del stack[ends[-1] :]
        elif name in ("c", "v", "id"):
            if name != "v":
                stack.clear()
            word = (CODE if name == "id" else NUMBER).match(text, at)
            value = word.group(1) if word else ""
            at = word.end() if word else at
            if name == "id":
                book, chapter, first, last = value.upper()[:3], 0, 0, 0
                line = text.find("\n", at)
                at = line if line >= 0 else len(text)
            elif name == "c":
                chapter, first, last = int(re.match(r"[0-9]*", value).group(0) or 0), 0, 0
            else:
                while stack and (stack[-1][0] in NOTES or stack[-1][0] in CHARACTERS):
                    stack.pop()  # a verse ends what its paragraph left open
                if hidden():
                    continue  # a verse within a heading is part of it
                a, _, b = value.partition("-")
                number = lambda x: int("".join(c for c in x if c.isdigit()) or 0)
                first = number(a)
                last = max(first, number(b))
        elif name in NOTES:
            stack.append((name, True))
        elif name in CHARACTERS:
            inside = stack[-1][0] if stack else ""
            if not plus and inside in CHARACTERS:
                stack.pop()
            stack.append((name, name in SKIP_CHARACTERS or name == "fig"))
        else:
            stack.clear()
            stack.append((name, name in SKIP_PARAGRAPHS or name in HEADERS))
    yield from read(len(text))


def usfm_pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, piece, book, chapter, verse_start, verse_end, text from USFM books, one file each."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return parsed(files)


def parsed(books: DataFrame) -> DataFrame:
    """The pieces of books given as file and value."""
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
    names = ["file", "piece", "book", "chapter", "verse_start", "verse_end", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = [(name, i, *p) for i, p in enumerate(pieces(text or ""))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return books.select("file", "value").mapInArrow(run, "file string, piece int, book string, chapter int, verse_start int, verse_end int, text string")


def verses(parts: DataFrame) -> DataFrame:
    """book, chapter, verse_start, verse_end and the text of the verse's pieces, joined by spaces."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file", "piece", "text"))), lambda x: x["text"]), " ")
    return parts.groupBy("book", "chapter", "verse_start").agg(F.max("verse_end").alias("verse_end"), text.alias("text"))


def rendered(rows: DataFrame) -> DataFrame:
    """book and its USFM from verses (book, chapter, verse, text): verses stand in one paragraph a chapter, empty ones are
    left out. A book is one row, as a file is."""
    kept = rows.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    lines = kept.groupBy("book", "chapter").agg(F.array_sort(F.collect_list(F.struct("verse", F.trim("text").alias("text")))).alias("v"))
    chapter = F.concat(F.lit("\\c "), F.col("chapter").cast("string"), F.lit("\n\\p\n"), F.array_join(F.transform("v", lambda x: F.concat(F.lit("\\v "), x["verse"].cast("string"), F.lit(" "), x["text"])), "\n"))
    whole = lines.groupBy("book").agg(F.array_sort(F.collect_list(F.struct("chapter", chapter.alias("c")))).alias("cs"))
    return whole.select("book", F.concat(F.lit("\\id "), F.col("book"), F.lit("\n"), F.array_join(F.transform("cs", lambda x: x["c"]), "\n"), F.lit("\n")).alias("usfm"))
