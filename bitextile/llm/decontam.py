"""Benchmark decontamination by winnowing.

A text's words are hashed in k-grams; from every window of w neighbouring k-grams the least hash is kept. A shared
span of k + w - 1 words holds such a window whole, so both sides keep its least hash: any shared span of that length
meets in the join of fingerprints. With window = 13 words, k = 5 gives w = 9. Each hit is then extended: the 13 words
of both sides are compared by a 64-bit hash of the whole run, and the words that a match covers are counted.

Fingerprints of the test items go to the executors as one sorted array while there are at most `limit` of them;
beyond that, training and test fingerprints are joined by a shuffle and only pairs that meet are compared.

Defined results: a null or empty text has no words and is never contaminated; an item without words is ignored; an item
of fewer than 13 words is one window; equal item_ids are counted once; repeated document rows give repeated results;
empty tables give empty results or no hits; other columns are ignored; windows that overlap hit a word once. Very long: a
text is held whole by one worker with some 30 to 60 bytes for each of its own. item_id must be a number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALPHANUMERIC, Slices, Words, chunks, key_of, lists, materialize, texts_of, unused, window_min, words

WINDOW, K = 13, 5
SENT = 1_000_000  # keys of contaminated texts that are broadcast at most; beyond it their join shuffles
LIMIT = 2_000_000  # fingerprints and windows of test items that are sent to every executor (16 bytes each)


def fingerprints(ws: Words, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each run of `window` words inside one text: the least k-gram hash in it; and the run's first word."""
    grams, _ = _all_grams(ws, k)
    least = window_min(grams, window - k + 1)
    at = np.arange(len(least))
    last = ws.first[1:][np.searchsorted(ws.first[1:], at, "right")] if len(at) else at
    inside = at + window <= last
    return least[inside], at[inside]


def _all_grams(ws: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of k words, also across texts: positions stay aligned with words."""
    one = Words(ws.hashes, ws.start, ws.end, np.array([0, len(ws.hashes)]))
    return one.grams(k)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values at the start of each run of equal neighbours, and the run's number for each place."""
    if not len(x):
        return x, np.zeros(0, np.int64)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new], np.cumsum(new) - 1


def isin(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which x are in the sorted table."""
    if not len(table) or not len(x):
        return np.zeros(len(x), bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


class Index:
    """The windows of test items: fingerprints, and the hash of each window by its length with the items that have it."""

    def __init__(self, window: int, k: int, lengths: np.ndarray, prints: np.ndarray, hashes: np.ndarray, items: np.ndarray):
        self.window, self.k, self.prints = window, k, np.unique(prints)
        self.tables = {}
        for n in np.unique(lengths):
            own = lengths == n
            order = np.argsort(hashes[own], kind="stable")
            self.tables[int(n)] = hashes[own][order], items[own][order]

    def matches(self, ws: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each window length: the first word of each matching run, and bounds of its items in the table."""
        for n, (table, _) in self.tables.items():
            if n == self.window:
                least, at = fingerprints(ws, self.k, self.window)
                values, run = _runs(least)
                at = at[isin(values, self.prints)[run]] if len(at) else at  # the join of fingerprints
                if not len(at):
                    continue
                h = _at(ws, n, at)
            else:  # whole items of fewer words than a window
                h, at = ws.grams(n)
            ok = isin(h, table)
            if ok.any():
                yield n, at[ok], np.searchsorted(table, h[ok], "left"), np.searchsorted(table, h[ok], "right")


def _at(ws: Words, n: int, at: np.ndarray) -> np.ndarray:
    return Slices(ws.hashes).hash(at, at + n)


def _windows(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows (item_id, n, print, hash): each distinct window of each item."""
    for c in chunks(batches):
        ws = words(c, ALPHANUMERIC)
        items = np.asarray(c.column("item_id"))
        counts = np.diff(ws.first)
        least, at = fingerprints(ws, k, window)
        short = np.flatnonzero((counts > 0) & (counts < window))
        start = np.concatenate([at, ws.first[short]])
        n = np.concatenate([np.full(len(at), window), counts[short]])
        prints = np.concatenate([least, np.zeros(len(short), np.uint64)])
        h = Slices(ws.hashes).hash(start, start + n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items[ws.text_of(start)]), pa.array(n, pa.int32()), pa.array(prints.view(np.int64)), pa.array(h.view(np.int64))],
            ["item_id", "n", "print", "hash"],
        )


def _hits(c, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the texts of a chunk: words, hit words, and (text, item) pairs without repeats."""
    ws = words(c, ALPHANUMERIC)
    cover = np.zeros(len(ws.hashes) + 1, np.int32)
    rows, found = [], []
    for n, at, lo, hi in index.matches(ws):
        np.add.at(cover, at, 1)
        np.add.at(cover, at + n, -1)
        items = index.tables[n][1]
        reps = hi - lo
        take = np.repeat(lo, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        rows.append(np.repeat(ws.text_of(at), reps))
        found.append(items[take])
    hit = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
    n_hit = hit[ws.first[1:]] - hit[ws.first[:-1]]
    pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(found)], 1), axis=0) if rows else np.zeros((0, 2), np.int64)
    return np.diff(ws.first), n_hit, pairs[:, 0], pairs[:, 1]


def _scan(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        n, hit, rows, items = _hits(c, index)
        per = np.bincount(rows, minlength=c.n) if len(rows) else np.zeros(c.n, np.int64)
        yield pa.RecordBatch.from_arrays(
            [c.column("doc_id"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), lists(items, per, pa.int64())],
            ["doc_id", "n_words", "n_hit", "items"],
        )


def windows(benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """The distinct windows of the test items: item_id, n, print, hash. Null item_ids are left out."""
    texts = texts_of(benchmark, F.col("item_id").cast("long").alias("item_id")).where("item_id is not null")
    return texts.mapInArrow(lambda b: _windows(b, window, k), "item_id long, n int, print long, hash long").distinct()


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, limit: int = LIMIT, kind: str = "long") -> DataFrame:
    """doc_id, n_words, n_hit and items (array of item_ids with an occurring window) for each document row; doc_id is read
    as `kind`."""
    own = windows(benchmark, window, k)
    docs = texts_of(documents, F.col("doc_id").cast(kind).alias("doc_id"))
    some = own.limit(limit + 1).toPandas()  # at most limit + 1 rows of 28 bytes
    if len(some) <= limit:
        index = Index(window, k, some["n"].to_numpy(), some.loc[some["n"] == window, "print"].to_numpy().astype(np.int64).view(np.uint64), some["hash"].to_numpy().astype(np.int64).view(np.uint64), some["item_id"].to_numpy().astype(np.int64))
        sent = documents.sparkSession.sparkContext.broadcast(index)
        return docs.mapInArrow(lambda b: _scan(b, sent.value), f"doc_id {kind}, n_words long, n_hit long, items array<long>")
    return _by_join(docs, own, window, k, kind)


def _prints(batches: Iterator[pa.RecordBatch], window: int, k: int, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows (row_id, n, print): distinct fingerprints of a text; for short windows, its runs of n words."""
    for c in chunks(batches):
        ws = words(c, ALPHANUMERIC)
        for n in lengths:
            h, at = fingerprints(ws, k, window) if n == window else ws.grams(n)
            if not len(at):
                continue
            text = ws.text_of(at)
            new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))  # a run of equal prints ends with its text
            rows = c.column("row_id").take(pa.array(text[new]))
            yield pa.RecordBatch.from_arrays([rows, pa.array(np.full(len(rows), n), pa.int32()), pa.array(h[new].view(np.int64))], ["row_id", "n", "print"])


def _extend(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows (row_id, doc_id, text, n, hash, item_id lists): the words that the given windows cover."""
    for c in chunks(batches):
        n_col, h_col, i_col = (c.column(x).to_pylist() for x in ("n", "hash", "item_id"))
        ws = words(c, ALPHANUMERIC)
        n_hit, found = np.zeros(c.n, np.int64), []
        for row in range(c.n):
            own = Words(*(x[ws.first[row] : ws.first[row + 1]] for x in (ws.hashes, ws.start, ws.end)), np.array([0, ws.first[row + 1] - ws.first[row]]))
            cover, items = np.zeros(len(own.hashes) + 1, np.int32), set()
            ns = np.array(n_col[row], np.int64)
            for n in np.unique(ns):
                h, at = own.grams(int(n))
                want = np.array(h_col[row], np.int64).view(np.uint64)[ns == n]
                ids = np.array(i_col[row], np.int64)[ns == n]
                ok = isin(h, np.sort(want))
                np.add.at(cover, at[ok], 1)
                np.add.at(cover, at[ok] + int(n), -1)
                items |= set(ids[np.isin(want, h)].tolist())
            n_hit[row] = (np.cumsum(cover)[:-1] > 0).sum()
            found.append(sorted(items))
        yield pa.RecordBatch.from_arrays([c.column("row_id"), pa.array(n_hit), pa.array(found, pa.list_(pa.int64()))], ["row_id", "n_hit", "items"])


def _by_join(docs: DataFrame, own: DataFrame, window: int, k: int, kind: str) -> DataFrame:
    """The same result for test sets of any size: fingerprints meet in a shuffled join."""
    docs = docs.withColumn("row_id", key_of(F.col("doc_id"), F.col("text")))
    once = docs.dropDuplicates(["row_id"])
    lengths = sorted(r["n"] for r in own.select("n").distinct().collect())  # at most `window` rows
    prints = once.select("row_id", "text").mapInArrow(lambda b: _prints(b, window, k, lengths), "row_id binary, n int, print long").distinct()
    own = own.withColumn("print", F.when(F.col("n") == window, F.col("print")).otherwise(F.col("hash")))
    met = prints.join(own, ["n", "print"]).select("row_id", "n", "hash", "item_id").distinct()
    per = met.groupBy("row_id").agg(F.collect_list("n").alias("n"), F.collect_list("hash").alias("hash"), F.collect_list("item_id").alias("item_id"))
    extended = once.select("row_id", "text").join(per, "row_id").mapInArrow(lambda b: _extend(b, window, k), "row_id binary, n_hit long, items array<long>")
    counts = docs.select("row_id", "doc_id", "text").mapInArrow(_counts, f"row_id binary, doc_id {kind}, n_words long")
    out = counts.join(extended, "row_id", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<long>")).alias("items"))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        yield pa.RecordBatch.from_arrays([c.column("row_id"), c.column("doc_id"), pa.array(np.diff(words(c, ALPHANUMERIC).first), pa.int64())], ["row_id", "doc_id", "n_words"])


def report(documents: DataFrame, benchmark: DataFrame, **how: int | str) -> DataFrame:
    """hits() with the contamination rule: at least one word in 20 is hit."""
    h = hits(documents, benchmark, **how)
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return h.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, **how: int) -> DataFrame:
    """The documents that are not contaminated, with all their columns. Rows with a null doc_id are judged too."""
    key = unused(documents, "row")
    keyed = documents.withColumn(key, key_of(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    judged = report(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark, kind="binary", **how)
    bad = materialize(judged.where("contaminated").select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    bad = F.broadcast(bad) if bad.count() <= SENT else bad
    return keyed.join(bad, key, "left_anti").drop(key)
