"""Removal of long repeated byte strings by blockwise suffix naming with cover samples.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else, in the same text or another. Such strings
are suffixes cut at LENGTH bytes; the work is to tell which of them are equal.

1. Buckets. Every window of LENGTH bytes names its anchor: of its K-byte substrings the one with the least hash, the first
   of equal ones. Equal windows have equal anchors at equal offsets, so suffixes are put in buckets by anchor, and a bucket
   whose anchor occurs once holds nothing equal and is not looked at.
2. Cover samples. Positions are counted from the anchor, so the only difference between equal suffixes is 0, and every
   STEP-th position covers it. Each sample position q stands for the suffixes of the STEP positions up to q: its rank is a
   name of the bytes that all of them share. A rank that occurs once settles all its suffixes; where the bytes from the
   first to the last of these suffixes occur twice, all are repeated.
3. Long ties. Suffixes of equal rank that are not settled, near the ends of repeated passages, are named one by one.

Names are 64-bit hashes rather than places in an order, as only equality matters; names of one task's bucket are never held
together: Spark groups them, with partial counts before the shuffle. Texts that are equal as a whole are taken once.

The full difference-cover construction is not used: see the README.

Defined results: null and empty texts have no bytes and keep none; texts under LENGTH bytes lose nothing; repeated rows are
repeated texts; an empty table gives no rows; other columns, whatever their names, are ignored. Very long: a text is held
whole by one worker with some 30 to 60 bytes for each of its own; in texts over 2^28 bytes equal hashes of anchors go by the
low bits of their places, so equal passages there may be told apart and stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TABLE, Chunk, Slices, chunks, lists, materialize, mix, texts_of, window_min

LENGTH, K, STEP = 400, 64, 32
PLACE = 28  # low bits of a key that hold the place, so that the first of equal hashes is the least
ODD = np.uint64(0x9E3779B97F4A7C15)


class Runs:
    """Runs of window starts with one anchor: text row, first and last start, anchor place and its hash."""

    def __init__(self, c: Chunk):
        n = len(c.data)
        self.slices = Slices(TABLE[c.data])
        empty = np.zeros(0, np.int64)
        self.row = self.first = self.last = self.anchor = empty
        self.hash = np.zeros(0, np.uint64)
        if n < LENGTH:
            return
        at = np.arange(n - K + 1)
        h = self.slices.hash(at, at + K)
        mask = np.uint64((1 << PLACE) - 1)
        key = (h & ~mask) | (at.astype(np.uint64) & mask)
        least = window_min(key, LENGTH - K + 1)
        high = at[: len(least)] & ~int(mask)
        pick = (least & mask).astype(np.int64) | high
        pick = np.where(pick < at[: len(least)], pick + (1 << PLACE), pick)
        ends = c.offsets[1:]
        inside = np.zeros(n + 1, np.int32)  # window starts that fit in their text
        size = np.diff(c.offsets)
        fits = size >= LENGTH
        np.add.at(inside, c.offsets[:-1][fits], 1)
        np.add.at(inside, ends[fits] - LENGTH + 1, -1)
        valid = np.cumsum(inside[: len(least)]) > 0
        new = np.ones(len(least), bool)
        new[1:] = (pick[1:] != pick[:-1]) | ~valid[:-1]
        starts = c.offsets[:-1]
        new[starts[starts < len(least)]] = True
        first = np.flatnonzero(new & valid)
        stop = np.ones(len(least), bool)
        stop[:-1] = new[1:] | ~valid[1:]
        self.first, self.last = first, np.flatnonzero(stop & valid)
        self.anchor = pick[first]
        self.hash = h[self.anchor]
        self.row = np.searchsorted(c.offsets, first, "right") - 1


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """tid, doc_id, n_bytes, sha of the whole text, and its distinct anchors with their counts (2 for more)."""
    for c in chunks(batches):
        r = Runs(c)
        order = np.lexsort((r.hash, r.row))
        row, h = r.row[order], r.hash[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
        first = np.flatnonzero(new)
        count = np.minimum(np.diff(np.append(first, len(row))), 2)
        per = np.bincount(row[first], minlength=c.n) if len(first) else np.zeros(c.n, np.int64)
        whole = [hashlib.sha256(c.data[a:b]).hexdigest() for a, b in zip(c.offsets[:-1], c.offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [c.column("tid"), c.column("doc_id"), pa.array(np.diff(c.offsets)), pa.array(whole), lists(h[first].view(np.int64), per, pa.int64()), lists(count.astype(np.int32), per, pa.int32())],
            ["tid", "doc_id", "n_bytes", "whole", "anchors", "counts"],
        )


def _in_row(c: Chunk, name: str, row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which (row, value) are in that row's list of the column."""
    col = c.column(name)
    own = np.repeat(np.arange(c.n), np.diff(np.asarray(col.offsets)))
    listed = np.sort(mix(np.asarray(col.flatten()).view(np.uint64) + own.astype(np.uint64) * ODD))
    want = mix(value + row.astype(np.uint64) * ODD)
    return listed[np.minimum(np.searchsorted(listed, want), len(listed) - 1)] == want if len(listed) else np.zeros(len(want), bool)


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each sample position of shared anchors: the name that its suffixes share (core), the name of all they cover
    (span), and its first and last suffix. Spans that a text holds twice come once, with k = 2; their suffixes also come
    as rows without names, which are repeated for sure."""
    for c in chunks(batches):
        r = Runs(c)
        ok = _in_row(c, "shared", r.row, r.hash)
        row, p0, p1, a, h = r.row[ok], r.first[ok], r.last[ok], r.anchor[ok], r.hash[ok]
        j0, j1 = (a - p1) // STEP, (a - p0) // STEP
        reps = j1 - j0 + 1
        j = np.repeat(j0, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        row, p0, p1, a, h = (np.repeat(x, reps) for x in (row, p0, p1, a, h))
        q = a - STEP * j
        lo, hi = np.maximum(p0, q - STEP + 1), np.minimum(p1, q)
        core = mix(r.slices.hash(q, q + LENGTH - STEP + 1) + h + j.astype(np.uint64) * ODD)
        span = mix(r.slices.hash(lo, hi + LENGTH) ^ mix(h + (a - lo).astype(np.uint64) * ODD + (a - hi).astype(np.uint64)))
        start = c.offsets[row]
        order = np.lexsort((span, row))
        new = np.ones(len(order), bool)
        new[1:] = (row[order][1:] != row[order][:-1]) | (span[order][1:] != span[order][:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(order)))
        once = order[first]
        twice = order[np.repeat(size > 1, size)] if len(first) else order
        tid = np.asarray(c.column("tid"))
        blank = pa.nulls(len(twice), pa.int64())
        for rows, names, k in ((once, (pa.array(core[once].view(np.int64)), pa.array(span[once].view(np.int64))), np.minimum(size, 2)), (twice, (blank, blank), np.full(len(twice), 2))):
            yield pa.RecordBatch.from_arrays(
                [*names, pa.array(k, pa.int32()), pa.array(tid[row[rows]]), pa.array((lo - start)[rows], pa.int32()), pa.array((hi - start)[rows], pa.int32())],
                ["core", "span", "k", "tid", "lo", "hi"],
            )


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The name of each suffix in the ranges of a text."""
    for c in chunks(batches):
        s = Slices(TABLE[c.data])
        lo_col, hi_col = c.column("lo"), c.column("hi")
        row = np.repeat(np.arange(c.n), np.diff(np.asarray(lo_col.offsets)))
        lo, hi = np.asarray(lo_col.flatten()).astype(np.int64), np.asarray(hi_col.flatten()).astype(np.int64)
        reps = hi - lo + 1
        p = np.repeat(lo, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        row = np.repeat(row, reps)
        g = p + c.offsets[row]
        yield pa.RecordBatch.from_arrays([pa.array(s.hash(g, g + LENGTH).view(np.int64)), pa.array(np.asarray(c.column("tid"))[row]), pa.array(p, pa.int32())], ["name", "tid", "p"])


def _cut(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """What is left of each text without the bytes that its ranges of suffixes cover."""
    for c in chunks(batches):
        lo_col, hi_col = c.column("lo"), c.column("hi")
        starts = np.asarray(lo_col.offsets)
        starts = starts - starts[0]
        los, his = np.asarray(lo_col.flatten()), np.asarray(hi_col.flatten())
        removed, spans, sha, left = [], [], [], []
        for k in range(c.n):
            data = c.data[c.offsets[k] : c.offsets[k + 1]]
            edge = np.zeros(len(data) + 1, np.int32)
            np.add.at(edge, los[starts[k] : starts[k + 1]], 1)
            np.add.at(edge, his[starts[k] : starts[k + 1]].astype(np.int64) + LENGTH, -1)
            gone = np.cumsum(edge)[:-1] > 0
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            kept = data[~gone].tobytes()
            sha.append(hashlib.sha256(kept).hexdigest())
            left.append(kept if with_text else None)
        yield pa.RecordBatch.from_arrays([c.column("tid"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha), pa.array(left, pa.binary())], ["tid", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated(documents: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row; with_text adds the remaining bytes."""
    docs = texts_of(documents, F.col("doc_id").cast("long").alias("doc_id")).withColumn("tid", F.xxhash64("text"))
    kind = "tid long, doc_id long, n_bytes long, whole string, anchors array<long>, counts array<int>"
    own = materialize(docs.select("tid", "doc_id", "text").mapInArrow(_anchors, kind), "anchors")
    texts = own.groupBy("tid").agg(F.count("*").alias("copies"), F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("carrier"), F.first("anchors").alias("anchors"), F.first("counts").alias("counts"))
    texts = materialize(texts, "texts")
    each = texts.select("tid", "carrier", F.explode(F.arrays_zip("anchors", "counts")).alias("x")).select("tid", "carrier", F.col("x.anchors").alias("h"), F.col("x.counts").alias("k"))
    shared = each.groupBy("h").agg(F.sum("k").alias("k")).where("k > 1").select("h")
    with_shared = each.join(shared, "h").groupBy("tid", "carrier").agg(F.collect_list("h").alias("shared"))
    carried = docs.withColumn("carrier", F.coalesce("doc_id", F.lit(-(1 << 63))))
    some = materialize(carried.join(with_shared, ["tid", "carrier"]).select("tid", "text", "shared").dropDuplicates(["tid"]), "some")

    samples = materialize(some.mapInArrow(_samples, "core long, span long, k int, tid long, lo int, hi int"), "samples")
    named = samples.where("span is not null")
    spans = materialize(named.groupBy("core", "span").agg(F.sum("k").alias("k"), F.min(F.struct("tid", "lo", "hi")).alias("one")), "spans")
    sure = named.join(spans.where("k > 1").select("span", "core"), ["core", "span"], "left_semi").select("tid", "lo", "hi").union(samples.where("span is null").select("tid", "lo", "hi"))
    tied = spans.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    open_ = spans.join(tied, "core", "left_semi").select("one.tid", "one.lo", "one.hi").groupBy("tid").agg(F.collect_list(F.struct("lo", "hi")).alias("x")).select("tid", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"))
    names = materialize(some.select("tid", "text").join(open_, "tid").mapInArrow(_suffixes, "name long, tid long, p int"), "names")
    again = names.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    single = names.join(again, "name", "left_semi").select("tid", F.col("p").alias("lo"), F.col("p").alias("hi"))

    ranges = sure.union(single).groupBy("tid").agg(F.collect_list(F.struct("lo", "hi")).alias("x")).select("tid", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"))
    cut = some.select("tid", "text").join(ranges, "tid").mapInArrow(lambda b: _cut(b, with_text), "tid long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    whole = texts.select("tid", "copies").join(cut, "tid", "left")
    out = own.select("tid", "doc_id", "n_bytes", "whole").join(whole, "tid")
    all_gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    none = hashlib.sha256(b"").hexdigest()
    out = out.select(
        "tid", "doc_id", "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_gone, F.lit(none)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        F.when(all_gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
    if not with_text:
        return out.drop("tid", "kept")
    full = docs.groupBy("tid").agg(F.first("text").alias("text"))
    return out.join(full, "tid").withColumn("kept", F.coalesce("kept", F.col("text").cast("binary"))).drop("tid", "text")
