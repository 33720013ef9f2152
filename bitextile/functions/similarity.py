"""Likeness of words, and small statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def edit_distance(a: Column, b: Column, cap: int = 3) -> Column:
    """Levenshtein distance; cap + 1 for all above the cap."""
    d = F.levenshtein(a, b, cap)
    return F.when(d < 0, cap + 1).otherwise(d)


def word_score(a: Column, b: Column) -> Column:
    """Arrays of forms, the word itself first: 1.0 equal words, .9 a shared form, .7 by prefix (four letters at least:
    one begins the other, or the same first four and lengths within three), .6 one edit (five letters at least), else 0."""
    x, y = F.element_at(a, 1), F.element_at(b, 1)
    n, m = F.length(x), F.length(y)
    prefix = (F.least(n, m) >= 4) & (x.startswith(y) | y.startswith(x) | ((F.left(x, F.lit(4)) == F.left(y, F.lit(4))) & (F.abs(n - m) <= 3)))
    return F.when(x == y, 1.0).when(F.arrays_overlap(a, b), 0.9).when(prefix, 0.7).when((F.least(n, m) >= 5) & (edit_distance(x, y, 1) <= 1), 0.6).otherwise(0.0)


def name_form(gloss: Column) -> Column:
    """A name in lower case without points and commas at its ends."""
    return F.lower(F.regexp_replace(gloss, "^[.,]+|[.,]+$", ""))


def name_score(gloss: Column, token: Column) -> Column:
    """.98 equal, .92 one edit, .82 two edits (four letters at least), .75 the same first four, else 0."""
    return form_score(name_form(gloss), F.lower(token))


def form_score(g: Column, t: Column) -> Column:
    """name_score of a name_form() and a token in lower case."""
    d, least = edit_distance(g, t, 3), F.least(F.length(g), F.length(t))
    return F.when((g == "") | (t == ""), 0.0).when(g == t, 0.98).when(d <= 1, 0.92).when((d <= 2) & (least >= 4), 0.82).when((least >= 4) & (F.left(g, F.lit(4)) == F.left(t, F.lit(4))), 0.75).otherwise(0.0)


def stem(word: Column, suffixes: Sequence[str]) -> Column:
    """The word without the first of the suffixes that it ends with and that leaves three letters or more."""
    out = F.when(F.lit(False), word)
    for x in suffixes:
        out = out.when(word.endswith(x) & (F.length(word) > len(x) + 2), F.left(word, F.length(word) - len(x)))
    return out.otherwise(word)


def lexical_agree(a: Column, b: Column, prefix: int = 4, suffixes: Sequence[str] = (), stem_prefix: int = 3) -> Column:
    """Whether any words of two arrays are equal, share `prefix` letters in front, or the stem of one, of `stem_prefix`
    letters or more, begins the stem of the other."""
    starts = lambda x, y, n: (F.least(F.length(x), F.length(y)) >= n) & (x.startswith(y) | y.startswith(x))
    front = lambda x, y: (F.least(F.length(x), F.length(y)) >= prefix) & (F.left(x, F.lit(prefix)) == F.left(y, F.lit(prefix)))
    stems = F.lit(False)
    if suffixes:
        of = lambda words: F.transform(words, lambda w: stem(w, suffixes))
        stems = F.exists(of(a), lambda x: F.exists(of(b), lambda y: starts(x, y, stem_prefix)))
    return F.exists(a, lambda x: F.exists(b, lambda y: (x == y) | front(x, y))) | stems


def wilson(correct: Column, n: Column, z: float = 1.96) -> Column:
    """Lower bound of the Wilson interval; 0 for n = 0."""
    p = correct / n
    mid = p + z * z / (2 * n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.when(n == 0, 0.0).otherwise((mid - half) / (1 + z * z / n))


def contiguous(idx: Column) -> Column:
    """Whether an array of two or more places is one run."""
    return (F.size(idx) >= 2) & (F.array_max(idx) - F.array_min(idx) + 1 == F.size(idx))


def encode_span(idx: Column) -> Column:
    """One place as itself, a run as a-b, others as a sorted list with commas."""
    one = F.array_min(idx).cast("string")
    run = F.concat_ws("-", one, F.array_max(idx).cast("string"))
    return F.when(F.size(idx) == 1, one).when(contiguous(idx), run).otherwise(F.array_join(F.transform(F.array_sort(idx), lambda x: x.cast("string")), ","))


def decode_span(span: Column) -> Column:
    ends = F.split(span, "-")
    return F.when(span.contains("-"), F.sequence(F.element_at(ends, 1).cast("int"), F.element_at(ends, -1).cast("int"))).otherwise(F.split(span, ",").cast("array<int>"))
