"""Text: tokens, normal forms, variants."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WORD = r"[\p{L}\p{M}]+"
BRACKETS = re.compile(r"[\[\]]")


#: Characters below U+0300 neither combine nor change in NFC, so texts of these alone need no Python.
STABLE = r"[^\x00-\u02FF]"


def _nfc(x: str) -> str:
    return x if x.isascii() else "".join(c for c in unicodedata.normalize("NFC", x) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def _composed(s: pd.Series) -> pd.Series:
    return s.map(_nfc, na_action="ignore")


@F.pandas_udf(StringType())
def folded(s: pd.Series) -> pd.Series:
    """composed() in folded case."""
    return s.map(lambda x: _nfc(x).casefold(), na_action="ignore")


def composed(text: Column) -> Column:
    """NFC without combining marks that stay by themselves. Spark has no built-in normal form, so the texts that can
    change go through Python, the others as nulls."""
    return F.coalesce(_composed(F.when(text.rlike(STABLE), text)), text)


def tokens(text: Column, normalize: bool = True) -> Column:
    """Runs of letters and marks, case kept; digits, marks of punctuation and spaces give nothing."""
    return F.regexp_extract_all(composed(text) if normalize else text, F.lit(f"({WORD})"), F.lit(1))


def _without_notes(x: str) -> str:
    open_, spans = [], []  # places of brackets that wait, and of the outermost pairs so far
    for m in BRACKETS.finditer(x):
        i = m.start()
        if x[i] == "[":
            open_.append(i)
        elif open_:
            first = open_.pop()
            while spans and spans[-1][0] > first:
                spans.pop()
            spans.append((first, i + 1))
    out, at = [], 0
    for first, end in spans:
        out += (x[at:first], " ")
        at = end
    return "".join([*out, x[at:]])


@F.pandas_udf(StringType())
def _noteless(s: pd.Series) -> pd.Series:
    return s.map(_without_notes, na_action="ignore")


def strip_notes(text: Column) -> Column:
    """Bracketed notes of any depth replaced by a space each; unbalanced brackets stay. One pass over the text with a stack,
    which Spark has no expression for, so texts that have both brackets go through Python, the others as nulls."""
    return F.coalesce(_noteless(F.when(text.contains("[") & text.contains("]"), text)), text)


def base_marker(marker: Column) -> Column:
    return F.regexp_replace(marker, "[0-9]+$", "")


def norm_surface(surface: Column) -> Column:
    """Folded case without marks, and without what is no word character at the ends."""
    return F.regexp_replace(folded(surface), r"(?U)^\W+|\W+$", "")


def variants(cell: Column) -> Column:
    """The word lists of a gloss cell: split at ; , / and ' atau ', lower-cased runs of letters, no empty ones."""
    parts = F.split(F.lower(cell), r"[;,/]| atau ")
    return F.filter(F.transform(parts, lambda p: F.regexp_extract_all(p, F.lit(r"(\p{L}+)"), F.lit(1))), lambda w: F.size(w) > 0)


def title_words(title: Column) -> Column:
    return F.regexp_extract_all(F.lower(title), F.lit(r"(\p{L}+)"), F.lit(1))


def word_count(surface: Column) -> Column:
    return F.size(F.split(F.trim(surface), r"\s+"))


def bare_lexeme(lexeme: Column) -> Column:
    """Without the 'lang:' in front."""
    return F.regexp_replace(lexeme, "^[^:]*:", "")


def affix_forms(word: Column, suffixes: list[str], prefixes: list[str], least: int = 3) -> Column:
    """The word in lower case and its forms without one suffix, then one prefix, that keep `least` letters; the
    others by length, longest first."""
    low = F.lower(word)
    cut_end = [F.when(low.endswith(s) & (F.length(low) - len(s) >= least), F.substring(low, F.lit(1), F.length(low) - len(s))) for s in suffixes]
    stems = F.filter(F.array(low, *cut_end), lambda x: x.isNotNull())
    cut_front = lambda x: F.array(x, *(F.when(x.startswith(p) & (F.length(x) - len(p) >= least), F.substring(x, F.lit(len(p) + 1), F.length(x))) for p in prefixes))
    forms = F.array_distinct(F.filter(F.flatten(F.transform(stems, cut_front)), lambda x: x.isNotNull()))
    rest = F.transform(F.sort_array(F.transform(F.array_except(forms, F.array(low)), lambda x: F.struct((-F.length(x)).alias("l"), x.alias("w")))), lambda s: s["w"])
    return F.concat(F.array(low), rest)
