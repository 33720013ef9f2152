"""Statistical alignment: IBM model 1 by EM, in both directions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import hmm

NULL = hmm.NULL


def cells(source: DataFrame, target: DataFrame) -> DataFrame:
    """Co-occurrences in a verse: ref, w, place, s and how often s stands in the verse; with the null word once.

    source: ref, s; target: ref, place, w. A verse bounds the product.
    """
    counts = source.groupBy("ref", "s").agg(F.count("*").alias("k"))
    counts = counts.unionByName(source.select("ref").distinct().select("ref", F.lit(NULL).alias("s"), F.lit(1).cast("long").alias("k")))
    return target.join(counts, "ref")


def start(c: DataFrame) -> DataFrame:
    """Uniform t(w | s) over the words that s meets."""
    met = c.select("s", "w").distinct()
    return met.join(met.groupBy("s").agg(F.count("*").alias("n")), "s").select("s", "w", (1 / F.col("n")).alias("t"))


def expected(c: DataFrame, t: DataFrame) -> DataFrame:
    """Expected counts (s, w, c): in a target place each source word counts by its share of the probability."""
    p = c.join(t, ["s", "w"]).withColumn("p", F.col("k") * F.col("t"))
    share = F.col("p") / F.sum("p").over(Window.partitionBy("ref", "place"))
    return p.withColumn("c", share).groupBy("s", "w").agg(F.sum("c").alias("c"))


def normalized(counts: DataFrame) -> DataFrame:
    """t(w | s) of counts. The null word meets every word, so its sum is an aggregate and no window."""
    return counts.join(counts.groupBy("s").agg(F.sum("c").alias("n")), "s").select("s", "w", (F.col("c") / F.col("n")).alias("t"))


def step(c: DataFrame, t: DataFrame) -> DataFrame:
    """One round of EM."""
    return normalized(expected(c, t))


def train(source: DataFrame, target: DataFrame, rounds: int = 6, cut: bool = True) -> DataFrame:
    """t(w | s) after `rounds`, over blocks of verses, each round written; with cut=False in one plan of joins."""
    if not cut:
        c = cells(source, target)
        t = start(c)
        for _ in range(rounds):
            t = step(c, t)
        return t
    return Trained.of(source, target, rounds, (0,)).t.select("s", "w", "t")


@dataclass
class Trained:
    """Model 1 over blocks of verses: the blocks, their word pairs, and t (side, s, w, t) of the directions asked for. What it says
    of verses is found in the blocks: pairs of a verse are never rows of a join."""

    v: DataFrame
    pairs: DataFrame
    t: DataFrame

    @classmethod
    def of(cls, source: DataFrame, target: DataFrame, rounds: int = 6, sides: tuple[int, ...] = (0, 1)) -> Trained:
        v = hmm.verses(source, target).where(F.col("side").isin(*sides))
        pairs = hmm.word_pairs(v)
        return cls(v, pairs, hmm.model_1(v, pairs, rounds))

    def candidates(self, least: float = 0.05) -> DataFrame:
        """ref, h_idx, place and probability of the pairs of a verse at `least`, of the first direction."""

        def pick(b: hmm.Block, x: hmm.Stack) -> tuple[np.ndarray, ...]:
            r, j, i = np.nonzero(x.e >= least)
            return r, i, j, x.e[r, j, i]

        return hmm.within(self.v.where("side = 0"), self.pairs.where("side = 0"), self.t, pick, "score double").select("ref", F.col("a").alias("h_idx"), F.col("b").alias("place"), "score")

    def links(self, digits: int = 9) -> tuple[DataFrame, DataFrame]:
        """For each target place its most likely source place (none where the null word is as likely), in both directions; written
        once. Probabilities count to `digits`, among equal ones the first place goes."""

        def pick(b: hmm.Block, x: hmm.Stack) -> tuple[np.ndarray, ...]:
            best = x.e.argmax(2)  # words lie in the order of their places
            r, j = np.nonzero(np.take_along_axis(x.e, best[:, :, None], 2)[:, :, 0] > x.e0)
            return r, best[r, j], j

        return hmm.two_sides(written(hmm.within(self.v, self.pairs, self.t.withColumn("t", F.round("t", digits)), pick), "links"))

    def one_to_one(self, least: float, near: Callable[[np.ndarray, np.ndarray], np.ndarray], digits: int = 9) -> DataFrame:
        """What kernels.greedy takes of the candidates at `least`: ref, h_idx, t_idx, score (to `digits`) and near, which is told of
        source and target places. The verses of a stack take their best free pair at once."""

        def pick(b: hmm.Block, x: hmm.Stack) -> tuple[np.ndarray, ...]:
            n, m, k = x.e.shape
            hs, ws = b.places(x)
            wide = lambda a, axis: np.broadcast_to(np.expand_dims(a, axis), (n, m, k)).reshape(n, m * k)
            h, w, score = wide(hs, 1), wide(ws, 2), np.round(x.e, digits).reshape(n, m * k)
            far = near(h, w)
            order = np.lexsort((w, h, far, -score), axis=1)
            rank = np.empty((n, m * k), np.int64)
            np.put_along_axis(rank, order, np.broadcast_to(np.arange(m * k), (n, m * k)), 1)
            rank = np.where(x.e >= least, rank.reshape(n, m, k), m * k)
            taken = []
            while len(live := np.flatnonzero(rank.min((1, 2), initial=m * k) < m * k)):
                best = rank[live].reshape(len(live), -1).argmin(1)
                j, i = best // k, best % k
                rank[live, j], rank[live, :, i] = m * k, m * k
                taken.append(np.stack([live, j, i]))
            r, j, i = np.concatenate([np.zeros((3, 0), np.int64), *taken], 1)
            return r, i, j, score[r, j * k + i], far[r, j * k + i]

        found = hmm.within(self.v.where("side = 0"), self.pairs.where("side = 0"), self.t, pick, "score double, near double")
        return found.select("ref", F.col("a").alias("h_idx"), F.array("b").alias("t_idx"), "score", "near")


def train_both(source: DataFrame, target: DataFrame, rounds: int = 6) -> tuple[DataFrame, DataFrame]:
    """t(w | s) and t(s | w), in the same jobs: the columns s and w are those of what is given and what is made of it."""
    t = Trained.of(source, target, rounds).t
    return tuple(t.where(f"side = {k}").select("s", "w", "t") for k in (0, 1))


def log_likelihood(source: DataFrame, target: DataFrame, t: DataFrame) -> DataFrame:
    """The mean log-likelihood of a target word."""
    p = cells(source, target).join(t, ["s", "w"]).groupBy("ref", "place").agg(F.sum(F.col("k") * F.col("t")).alias("p"), F.sum("k").alias("n"))
    return p.agg(F.avg(F.log(F.col("p") / F.col("n"))).alias("log_likelihood"))


def candidates(source: DataFrame, target: DataFrame, t: DataFrame, least: float = 0.05) -> DataFrame:
    """ref, h_idx, place and probability of pairs of a verse at `least`."""
    return source.join(target, "ref").join(t, ["s", "w"]).where(F.col("t") >= least).select("ref", "h_idx", "place", F.col("t").alias("score"))


def links(source: DataFrame, target: DataFrame, t: DataFrame) -> DataFrame:
    """For each target place its most likely source place (none where the null word is likelier)."""
    null = t.where(F.col("s") == NULL).select("w", F.col("t").alias("t0"))
    best = Window.partitionBy("ref", "place").orderBy(F.desc("t"), F.asc("h_idx"))
    scored = source.join(target, "ref").join(t, ["s", "w"]).withColumn("r", F.row_number().over(best)).where("r = 1").join(null, "w", "left")
    return scored.where(F.col("t") > F.coalesce("t0", F.lit(0.0))).select("ref", "h_idx", "place")
