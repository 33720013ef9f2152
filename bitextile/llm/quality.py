"""A quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; the web text, labelled or not, is the unlabelled set. An additive model
over binned statistics of a text minimises the non-negative unbiased risk: with class prior p,
p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives)) under the logistic loss; where the second part is negative
its gradient is turned round. The prior is estimated from the scores of the two sets alone, as the least ratio of unlabelled to
positive documents above a score; documents labelled bad are not used. The logistic loss makes the score an estimate of the chance of label 1.

The model is fitted on hash samples of about `SAMPLE` positives and as many unlabelled documents, whose 17 numbers each
reach the driver; every document is scored from its whole text.

Defined results: null and empty texts are scored as texts with no words; labels of null quality or null doc_id are left
out; repeated label rows count once (the least quality holds); with no positives every score is 0.5;
repeated document rows get equal scores; other columns are ignored; a score at the threshold is good; an empty table gives
no rows. Very long: a text is read once, whole, with some 30 to 60 bytes for each of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, Chunk, byte_class, chunks, mix, texts_of, unused, words

SAMPLE, BINS, STEPS, RATE, DECAY = 20_000, 12, 300, 0.05, 1e-4
THRESHOLD = 0.7
CLASS = np.zeros(256, np.int64)
for _i, _members in enumerate((range(97, 123), range(65, 91), range(48, 58), range(128, 256), b" \t\n\r\x0b\x0c", b"|", b"!?", b",;:", b".", b"'\"()-")):
    CLASS[list(_members)] = _i + 1
NOT_NEWLINE = ~byte_class(b"\n")
NAMES = ("words", "distinct", "echoes", "width", "short", "long", "letters", "upper", "digits", "symbols", "bars", "calls", "commas", "stops", "marks", "lines", "line_repeats")


def _distinct(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    keys = mix(hashes + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(keys, return_index=True)
    return np.bincount(rows[at], minlength=n)


def features(c: Chunk) -> np.ndarray:
    """The statistics NAMES of each text of a chunk."""
    n, size = c.n, np.diff(c.offsets)
    row = np.repeat(np.arange(n), size)
    per = np.bincount(row * 11 + CLASS[c.data], minlength=n * 11).reshape(n, 11).astype(float)
    other, lower, upper, digit, wide, _, bar, call, comma, stop, mark = per.T
    ws, ls = words(c, NOT_SPACE), words(c, NOT_NEWLINE)
    w_row, l_row = np.repeat(np.arange(n), np.diff(ws.first)), np.repeat(np.arange(n), np.diff(ls.first))
    count, lines, length = np.diff(ws.first).astype(float), np.diff(ls.first).astype(float), ws.end - ws.start
    echo = np.zeros(len(w_row), bool)
    echo[1:] = (ws.hashes[1:] == ws.hashes[:-1]) & (w_row[1:] == w_row[:-1])
    of = lambda flag: np.bincount(w_row[flag], minlength=n)
    some, bytes_, some_lines = np.maximum(count, 1), np.maximum(size, 1), np.maximum(lines, 1)
    return np.stack(
        [
            np.log1p(count), _distinct(ws.hashes, w_row, n) / some, of(echo) / some, np.bincount(w_row, length, n) / some, of(length <= 3) / some, of(length >= 12) / some,
            (lower + upper + wide) / bytes_, upper / bytes_, digit / bytes_, other / some, bar / some, call / some, comma / some, stop / some, mark / some,
            np.log1p(count / some_lines), 1 - _distinct(ls.hashes, l_row, n) / some_lines,
        ],
        1,
    )


class Model:
    """An additive model over bins: cuts of each statistic, and a weight for each bin."""

    def __init__(self, cuts: list[np.ndarray], weights: np.ndarray, bias: float):
        self.cuts, self.weights, self.bias = cuts, weights, bias

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], "right") + k * (BINS + 1) for k, c in enumerate(self.cuts)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[self.bins(x)].sum(1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative unbiased risk by Adam, from zero weights."""
    cuts = [np.unique(np.quantile(unlabelled[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(unlabelled.shape[1])]
    m = Model(cuts, np.zeros(len(cuts) * (BINS + 1)), math.log(prior / (1 - prior)))
    p, u = m.bins(positive), m.bins(unlabelled)
    theta = np.append(m.weights, m.bias)
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def back(bins: np.ndarray, g: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(bins.ravel(), np.repeat(g, bins.shape[1]), len(theta) - 1), g.sum())

    for t in range(1, STEPS + 1):
        zp, zu = theta[:-1][p].sum(1) + theta[-1], theta[:-1][u].sum(1) + theta[-1]
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        negative = back(u, su / len(u)) - prior * back(p, sp / len(p))
        g = negative * -1.0 if rest < 0 else prior * back(p, (sp - 1) / len(p)) + negative
        g[:-1] += DECAY * theta[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta = theta - RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    m.weights, m.bias = theta[:-1], float(theta[-1])
    return m


def prior_from_scores(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The least share of unlabelled to positive documents above a score that half of the positives reach."""
    at = np.quantile(positive, np.linspace(0, 0.5, 26))
    return float(min((unlabelled >= t).mean() / (positive >= t).mean() for t in at))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives in the unlabelled set, from those two alone: each half is scored by a model of the other, so
    that no model scores what it has learned, and the two estimates are averaged."""
    p, u = (x[np.lexsort(x.T)] for x in (positive, unlabelled))
    (p0, p1), (u0, u1) = ([x[k::2] for k in (0, 1)] for x in (p, u))
    if min(map(len, (p0, u0, p1, u1))) < 1:
        return 0.5
    found = [prior_from_scores(m.score(p), m.score(u)) for m, p, u in ((fit(p0, u0, 0.5), p1, u1), (fit(p1, u1, 0.5), p0, u0))]
    return float(np.clip(np.mean(found), 0.05, 0.95))


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        x = features(c)
        yield pa.RecordBatch.from_arrays([pa.array(x[:, k]) for k in range(len(NAMES))], list(NAMES))


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        s = model.score(features(c))
        yield pa.RecordBatch.from_arrays([c.column("doc_id"), c.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])


def sampled(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """About `size` rows, at most twice as many, chosen by a hash of the key."""
    share = min(1.0, size / max(df.count(), 1))
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) < math.ceil(share * 1e6)).limit(2 * size)


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on bounded samples; of labels, rows that are held out are never read."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    docs = texts_of(documents, F.col("doc_id").cast("long").alias("doc_id"))
    schema = ", ".join(f"{x} double" for x in NAMES)

    def matrix(ids: DataFrame) -> np.ndarray:
        rows = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text")  # ids: at most 2 * sample numbers
        return rows.mapInArrow(_rows, schema).limit(4 * sample).toPandas().to_numpy()

    positive = matrix(sampled(known.where("quality = 1").select("doc_id"), "doc_id", sample, 1))
    unlabelled = matrix(sampled(docs.select("doc_id"), "doc_id", sample, 2))
    if not len(positive) or not len(unlabelled):
        return Model([np.zeros(0)] * len(NAMES), np.zeros(len(NAMES) * (BINS + 1)), 0.0)
    return fit(positive, unlabelled, estimated_prior(positive, unlabelled))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    docs = texts_of(documents, F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"))
    return docs.mapInArrow(lambda b: _score(b, sent.value), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that the model does not reject, with all their columns."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    names = documents.columns
    text = unused(documents, "text")
    kept = documents.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, text):
            good = sent.value.score(features(c)) >= THRESHOLD
            own = c.batch.slice(c.first, c.n).filter(pa.array(good))
            yield own.select(names)

    return kept.mapInArrow(run, documents.schema)
