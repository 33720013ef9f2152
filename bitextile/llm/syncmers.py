"""Document fingerprints from closed syncmers.

A text is a row of words (runs without white space; in scripts written without spaces, characters). Each run of K words is
a k-mer and each run of S words inside it an inner substring. A k-mer is chosen if the least hash of its inner substrings
is that of the first or the last one. Whether a k-mer is chosen depends on its own words alone, so a passage gives the
same anchors wherever it stands. About 2 / (K - S + 1) of all k-mers are chosen.

anchors() returns every anchor with its place; a fingerprint holds them all, none is left out: 31 bits of the hash and
32 of the place in one number, sorted, written as base64. An anchor that its text has had before is hashed together with
how often, so the i-th one in a text meets the i-th in another. Two fingerprints are matched by position: anchors of equal
hash are a match if at least one more match has the same distance of places (in a text of one anchor, at once). The
likeness is the share of such matches in the anchors of both.

Built-in functions only. Defined results: null and empty texts have the empty fingerprint; two empty ones are alike
(1.0), an empty and another one are not (0.0); a text whose k-mers are none or all unchosen has one anchor, the hash of
all its words; repeated rows are kept, and count as neighbours of each other in edited_pairs(); a null doc_id is ordered as
the least id, and rows of one id, null included, follow each other in the order of their text, in one block; extra columns
are left out; an empty table gives no rows; a very long text is read and matched in time n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .native import below, let

K, S = 5, 2
HASH, PLACE = 0x7FFFFFFF, 0xFFFFFFFF
#: Fixed value: scripts written without spaces between words.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
WORD = rf"[{UNSPACED}]|[^\s{UNSPACED}]+"


def word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def chosen(h: Column, inner: Column) -> Column:
    """Numbers (from 0) of the chosen k-mers; inner: the hash of each run of S words."""
    last = F.size(h) - K

    def closed(i: Column) -> Column:
        at = [F.get(inner, i + j) for j in range(K - S + 1)]
        return F.least(at[0], at[-1]) <= F.least(*at[1:-1])

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), closed)).otherwise(F.array().cast("array<int>"))


def anchors(text: Column) -> Column:
    """Array of (place, hash) of all anchors of a text; place is the number of the first word."""

    def of(h: Column) -> Column:
        inner = F.when(F.size(h) >= S, F.transform(F.sequence(F.lit(0), F.size(h) - S), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(S)))))
        places = let(inner, lambda g: chosen(h, g))
        one = lambda i: F.struct(i.alias("place"), F.xxhash64(*(F.get(h, i + j) for j in range(K))).alias("hash"))
        whole = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(h).alias("hash")))
        found = let(places, lambda p: F.when(F.size(p) > 0, F.transform(p, one)).otherwise(whole))
        return F.when(F.size(h) == 0, F.array().cast("array<struct<place:int,hash:bigint>>")).otherwise(found)

    return let(word_hashes(text), of)


def packed(text: Column) -> Column:
    """All anchors as sorted numbers: the hash, different for each of a text, in the high bits, the place in the low ones."""
    number = lambda h, place: F.shiftleft(h.bitwiseAND(F.lit(HASH)), 32).bitwiseOR(place.cast("long"))
    plain = F.sort_array(F.transform(anchors(text), lambda x: number(x["hash"], x["place"])))

    def counted(p: Column) -> Column:
        again = lambda x, i: number(F.xxhash64(F.shiftright(x, 32), i - below(p, F.shiftleft(F.shiftright(x, 32), 32))), x.bitwiseAND(F.lit(PLACE)))
        return F.sort_array(F.transform(p, lambda x, i: F.when((i > 0) & (F.shiftright(F.get(p, i - 1), 32) == F.shiftright(x, 32)), again(x, i)).otherwise(x)))

    return let(plain, counted)


def written(a: Column) -> Column:
    return F.replace(F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), ""))), F.lit("\r\n"), F.lit(""))


def read(fingerprint: Column) -> Column:
    digits = F.hex(F.unbase64(fingerprint))
    n = (F.length(digits) / 16).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(F.substring(digits, i * 16 + 1, F.lit(16)), 16, 10).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 for two arrays of packed anchors, matched by hash and by distance of places."""
    return let(a, lambda x: let(b, lambda y: _likeness(x, y)))


def _likeness(a: Column, b: Column) -> Column:
    """Both arrays are merged by sorting, with one more bit for the side: equal hashes are neighbours then."""
    tagged = lambda x, side: F.shiftleft(x, 1).bitwiseOR(F.lit(side).cast("long"))
    merged = F.sort_array(F.concat(F.transform(a, lambda x: tagged(x, 0)), F.transform(b, lambda x: tagged(x, 1))))
    place = lambda x: F.shiftright(x, 1).bitwiseAND(F.lit(PLACE))
    distance = lambda x, y: F.when(x.bitwiseAND(F.lit(1)) == 0, place(x) - place(y)).otherwise(place(y) - place(x))

    def matched(m: Column) -> Column:
        found = F.filter(F.transform(m, lambda x, i: F.when(F.shiftright(x, 33) == F.shiftright(F.get(m, i + 1), 33), distance(x, F.get(m, i + 1)))), lambda x: x.isNotNull())
        return let(F.sort_array(found), of)

    def of(d: Column) -> Column:
        alone = F.least(F.size(a), F.size(b)) < 2
        good = F.size(F.filter(d, lambda x, i: alone | (F.coalesce(F.get(d, i - 1), x + 1) == x) | (F.coalesce(F.get(d, i + 1), x + 1) == x)))
        return let(good, lambda n: n / (F.size(a) + F.size(b) - n))

    return F.when(a == b, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(let(merged, matched))


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document."""
    return documents.select("doc_id", written(packed(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("fingerprint"))


def with_next(rows: DataFrame, ids: DataFrame, carried: list[str], blocks: int, made: dict[str, Column] | None = None) -> DataFrame:
    """Add next_<name> for each carried column: the value in the row that follows in descending doc_id, round the end.
    Columns `made` are computed once rows are dealt, so they are not shuffled, and are carried too.

    Rows are cut into blocks by quantiles of doc_id, which are ids that occur. The row with a block's greatest id is
    also sent to the block above as its last row (the greatest of all to the lowest block), so each block finds its
    neighbours alone. Blocks, not rows, reach the driver. Rows of equal doc_id are ordered by text.
    """
    least = -(1 << 63)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(least))
    cuts = sorted(set(map(int, _quantiles(ids, blocks))))
    if not cuts:
        return rows.withColumns(made or {}).select("*", *(F.col(c).alias(f"next_{c}") for c in [*carried, *(made or {})]))
    key_of = F.col("__key")
    block = _place(cuts, key_of)
    is_top = F.get(_numbers(cuts), F.col("__block")) == key_of
    over = F.when(is_top, F.array(F.col("__block"), (F.col("__block") + 1) % len(cuts))).otherwise(F.array("__block"))
    sent = rows.withColumn("__key", key).withColumn("__block", block).select("*", F.posexplode(over).alias("__ghost", "__to"))
    order = [F.col("__ghost"), F.col("__key").desc(), F.col("text").asc_nulls_first()]
    w = Window.partitionBy("__to").orderBy(*order)
    sent = sent.repartition("__to").withColumns(made) if made else sent
    out = sent.select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in [*carried, *(made or {})]))
    return out.where("__ghost = 0").drop("__key", "__block", "__to", "__ghost")


def _numbers(values: list[int]) -> Column:
    """An array of numbers; the optimizer folds it into one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _place(cuts: list[int], key: Column, step: int = 256) -> Column:
    """How many of the sorted cuts are below the key: first among every step-th, then among those between."""
    below = lambda c: F.size(F.filter(c, lambda x: x < key))
    if len(cuts) <= 2 * step:
        return below(_numbers(cuts))
    base = lambda n: (n - 1) * step
    return let(below(_numbers(cuts[::step])), lambda n: F.when(n == 0, 0).otherwise(base(n) + below(F.slice(_numbers(cuts), base(n) + 1, F.lit(step)))))


def _quantiles(ids: DataFrame, blocks: int) -> list[int]:
    """At most blocks + 1 ids that occur, the greatest among them, about evenly spaced by rank."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    row = ids.agg(F.percentile_approx(key, [i / blocks for i in range(1, blocks)] or [1.0], 20 * blocks).alias("q"), F.max(key).alias("m")).first()
    return [] if row["m"] is None else [*(row["q"] or []), row["m"]]


def edited_pairs(documents: DataFrame, blocks: int | None = None) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    The edited text has the last half of the code points replaced by the first as many of the next document in
    descending doc_id.
    """
    spark = documents.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = with_next(documents.select("doc_id", text.alias("text")), documents.select("doc_id"), ["text"], blocks, {"anchors": packed(F.col("text"))})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "anchors", "next_anchors")
    both = both.withColumn("edited_anchors", packed(F.col("edited")))
    return both.select(
        "doc_id", "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("anchors")).alias("fingerprint"),
        written(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
