"""Statistical alignment with jumps and fertilities: a hidden Markov model over source places, trained in both directions.

A target word comes from the source place its predecessor came from by a jump, or from the null word, which keeps that place.
A round of training is one job: verses are dealt in blocks of a fixed number, the probabilities that a block needs are
joined to its distinct word pairs alone, and forward and backward passes run over stacks of verses of equal shape. What
leaves a block are sums: expected counts of word pairs, of jumps, of null words and of the number of target words of each
source word. Both directions (side 0: source to target, 1: back) are trained in the same jobs with parameters of their own.

Verses bound the passes, blocks the memory of a task, and only jump counts (a few dozen rows) reach the driver. A word pair
that every verse has is one row in each block, not one in each verse.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import release, written

NULL, JUMP, FERTILE, VERSES, P0 = "<null>", 6, 5, 2000, 0.2
FLOOR, TINY = 1e-6, 1e-300
COUNTS = "kind string, side int, s string, w string, k int, c double"


@dataclass
class Model:
    """t: side, s, w, t; jumps: by side the weight of each distance from -JUMP to JUMP; p0: by side the share of null words;
    fertility: side, s and the chances of 0 to FERTILE target words or more; scores: by side and round the mean
    log-likelihood of a target word, before the round's update."""

    t: DataFrame
    jumps: dict[int, np.ndarray]
    p0: dict[int, float]
    fertility: DataFrame | None = None
    scores: dict[int, list[float]] = field(default_factory=lambda: {0: [], 1: []})


def verses(source: DataFrame, target: DataFrame, size: int = VERSES) -> DataFrame:
    """Blocks of the verses that have both sides, one row for each block and side; written once, so that rounds deal out packed
    numbers and no words.

    source: ref, h_idx, s; target: ref, place, w. A row has the distinct words of each role (sw, the null word included, and ww),
    the lengths of its verses (sn, wn), their words by number (si, wi), the pairs of words that meet (ps, pw), and for links
    the verses' ref and the places hs and ws.
    """
    line = lambda df, at, word, name: df.groupBy("ref").agg(F.sort_array(F.collect_list(F.struct(F.col(at).cast("long").alias("p"), F.col(word).alias("x")))).alias(name))
    both = written(line(source.where("s IS NOT NULL"), "h_idx", "s", "a").join(line(target.where("w IS NOT NULL"), "place", "w", "b").hint("merge"), "ref"), "verses")
    blocks = max(1, -(-both.count() // size))
    dealt = both.select(F.pmod(F.xxhash64("ref"), F.lit(blocks)).cast("int").alias("block"), "ref", "a", "b")
    kind = both.schema["ref"].dataType.simpleString()
    schema = f"block int, side int, sw array<string>, ww array<string>, sn array<int>, wn array<int>, si array<int>, wi array<int>, ps array<int>, pw array<int>, ref array<{kind}>, hs array<long>, ws array<long>"
    out = written(dealt.groupBy("block").applyInArrow(_packed, schema), "blocks")
    release(both)
    return out


def _packed(lines: pa.Table) -> pa.Table:
    """The two rows of a block."""

    def role(name: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        column = lines.column(name).combine_chunks()
        flat = column.flatten()
        words = flat.field("x").dictionary_encode()
        return words.dictionary.to_pylist(), np.asarray(words.indices, np.int64), np.asarray(pa.compute.list_value_length(column), np.int64), np.asarray(flat.field("p"))

    two, rows = (role("a"), role("b")), []
    for side, (x, y) in enumerate((two, two[::-1])):
        sw = x[0] if NULL in x[0] else [*x[0], NULL]
        keys = [sw.index(NULL) * len(y[0]) + np.unique(y[1])]
        for at in shapes(x[2], y[2]):
            s, w = spread(x[1], x[2], at), spread(y[1], y[2], at)
            keys.append(np.unique(s[:, None, :] * len(y[0]) + w[:, :, None]))
        met = np.unique(np.concatenate(keys))
        rows.append([lines.column("block")[0].as_py(), side, sw, y[0], x[2], y[2], x[1], y[1], met // len(y[0]), met % len(y[0]), lines.column("ref").to_pylist(), x[3], y[3]])
    names = ["block", "side", "sw", "ww", "sn", "wn", "si", "wi", "ps", "pw", "ref", "hs", "ws"]
    ints = pa.list_(pa.int32())
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), *[ints] * 6, pa.list_(lines.schema.field("ref").type), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, zip(*rows, strict=True), kinds, strict=True)})


def shapes(k: np.ndarray, m: np.ndarray, most: int = 400_000) -> Iterator[np.ndarray]:
    """The verses of each shape (k source words, m target words), in stacks of `most` cells."""
    order = np.lexsort((m, k))
    for same in np.split(order, np.flatnonzero((np.diff(k[order]) != 0) | (np.diff(m[order]) != 0)) + 1) if len(order) else []:
        step = max(1, most // int(k[same[0]] * m[same[0]]))
        for at in range(0, len(same), step):
            yield same[at : at + step]


def spread(flat: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What lies flat for verses of n items each, as [verse, item] for verses of one length."""
    return flat[(np.cumsum(n) - n)[at][:, None] + np.arange(n[at[0]])]


def word_pairs(v: DataFrame) -> DataFrame:
    """The distinct pairs of words that meet in a block, the null word included, i being their number there; written once."""
    named = lambda ids, words: F.transform(ids, lambda i: F.get(words, i))
    met = v.select("block", "side", F.posexplode(F.arrays_zip(named("ps", "sw").alias("s"), named("pw", "ww").alias("w"))).alias("i", "x"))
    return written(met.select("block", "side", "i", "x.s", "x.w"), "pairs")


def uniform(pairs: DataFrame) -> DataFrame:
    """t(w | s) alike for all words that s meets."""
    met = pairs.select("side", "s", "w").distinct()
    return met.join(met.groupBy("side", "s").agg(F.count(F.lit(1)).alias("n")), ["side", "s"]).select("side", "s", "w", (1 / F.col("n")).alias("t"))


def transitions(n: int, jumps: np.ndarray | None) -> np.ndarray:
    """The chance to go from place to place among n; alike for all without jumps."""
    if jumps is None:
        return np.full((n, n), 1 / n)
    d = np.clip(np.arange(n)[None, :] - np.arange(n)[:, None], -JUMP, JUMP) + JUMP
    a = np.maximum(jumps, FLOOR)[d]
    return a / a.sum(1, keepdims=True)


def passes(e: np.ndarray, e0: np.ndarray, a: np.ndarray, p0: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward over a stack of verses of one shape.

    e: [verse, target place, source place] chances of the words, e0: [verse, target place] those by the null word. Gives the
    posteriors of source places and of null, the summed posteriors of the moves from place to place, and log-likelihoods.
    """
    n, m, k = e.shape
    real, null, scale = np.empty((n, m, k)), np.empty((n, m, k)), np.empty((n, m))
    at = np.full((n, k), 1 / k)
    for j in range(m):
        come = at if j == 0 else at @ a
        real[:, j], null[:, j] = (1 - p0) * come * e[:, j], p0 * at * e0[:, j, None]
        scale[:, j] = real[:, j].sum(1) + null[:, j].sum(1) + TINY
        real[:, j] /= scale[:, j, None]
        null[:, j] /= scale[:, j, None]
        at = real[:, j] + null[:, j]
    later, moves = np.ones((n, k)), np.zeros((k, k))
    post, none = np.empty((n, m, k)), np.empty((n, m))
    for j in range(m - 1, -1, -1):
        post[:, j], none[:, j] = real[:, j] * later, (null[:, j] * later).sum(1)
        if j:
            before = real[:, j - 1] + null[:, j - 1]
            out = (1 - p0) * e[:, j] * later / scale[:, j, None]
            moves += before.T @ out * a
            later = out @ a.T + p0 * e0[:, j, None] * later / scale[:, j, None]
    return post, none, moves, np.log(scale).sum(1)


def fertilities(post: np.ndarray) -> np.ndarray:
    """[verse, source place, 0 to FERTILE]: the chances of so many target words, the last of so many or more."""
    n, m, k = post.shape
    p = np.zeros((n, k, FERTILE + 1))
    p[:, :, 0] = 1
    for j in range(m):
        q = np.clip(post[:, j], 0, 1)[:, :, None]
        moved = p * q
        p = p * (1 - q)
        p[:, :, 1:] += moved[:, :, :-1]
        p[:, :, -1] += moved[:, :, -1]
    return p


@dataclass
class Stack:
    """Verses of one shape: their rows, pairs by number, those of the null word, and chances."""

    rows: np.ndarray
    s: np.ndarray
    at: np.ndarray
    at0: np.ndarray
    e: np.ndarray
    e0: np.ndarray


class Block:
    """The words, chances and verses of one block and side. known: i, t; lines: one row of verses()."""

    def __init__(self, known: pa.Table, lines: pa.Table):
        one = lambda c: lines.column(c).combine_chunks().flatten()
        number = lambda c: np.asarray(one(c), np.int64)
        self.side, self.s_words, self.w_words = lines.column("side")[0].as_py(), one("sw"), one("ww")
        self.sn, self.wn, self.si, self.wi, self.pair_s, self.pair_w = (number(c) for c in ("sn", "wn", "si", "wi", "ps", "pw"))
        self.keys = self.pair_s * len(self.w_words) + self.pair_w
        self.t = np.zeros(len(self.keys))
        self.t[np.asarray(known.column("i"), np.int64)] = np.asarray(known.column("t"), float)
        self.null = self.s_words.index(NULL).as_py()
        self.lines = lines

    def place(self, s: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, s * len(self.w_words) + w)

    def stacks(self) -> Iterator[Stack]:
        for rows in shapes(self.sn, self.wn):
            s, w = spread(self.si, self.sn, rows), spread(self.wi, self.wn, rows)
            at, at0 = self.place(s[:, None, :], w[:, :, None]), self.place(np.full_like(w, self.null), w)
            yield Stack(rows, s, at, at0, self.t[at], self.t[at0])

    def places(self, x: Stack) -> tuple[np.ndarray, np.ndarray]:
        """The places of the source words and target words of a stack."""
        own = lambda c, n: spread(np.asarray(self.lines.column(c).combine_chunks().flatten(), np.int64), n, x.rows)
        return own("hs", self.sn), own("ws", self.wn)

    def refs(self) -> pa.Array:
        return self.lines.column("ref").combine_chunks().flatten()


def _counts(known: pa.Table, lines: pa.Table, jumps: dict[int, np.ndarray] | None, p0: dict[int, float], fertile: bool) -> pa.Table:
    """The sums of one block. Without jumps a target word's posteriors are its chances over their sum."""
    b = Block(known, lines)
    pairs, fert = np.zeros(len(b.keys)), np.zeros((len(b.s_words), FERTILE + 1))
    moved, nulls, words, score = np.zeros(2 * JUMP + 1), 0.0, 0, 0.0
    for x in b.stacks():
        n, m, k = x.e.shape
        if jumps is None:
            whole = x.e.sum(2) + x.e0 + TINY
            post, none, ll = x.e / whole[:, :, None], x.e0 / whole, np.log(whole / (k + 1)).sum(1)
        else:
            post, none, moves, ll = passes(x.e, x.e0, transitions(k, jumps[b.side]), p0[b.side])
            d = np.clip(np.arange(k)[None, :] - np.arange(k)[:, None], -JUMP, JUMP) + JUMP
            np.add.at(moved, d, moves)
        pairs += np.bincount(x.at.ravel(), post.ravel(), len(pairs)) + np.bincount(x.at0.ravel(), none.ravel(), len(pairs))
        nulls, words, score = nulls + none.sum(), words + n * m, score + ll.sum()
        if fertile:
            np.add.at(fert, x.s, fertilities(post))
    have = np.flatnonzero(pairs > 0)
    rows = [("jump", c, k - JUMP) for k, c in enumerate(moved.tolist())] + [("null", float(nulls), words), ("score", float(score), words)]
    small = pa.table({"kind": [r[0] for r in rows], "s": pa.nulls(len(rows), pa.string()), "w": pa.nulls(len(rows), pa.string()), "k": pa.array([r[2] for r in rows], pa.int32()), "c": [r[1] for r in rows]})
    parts = [small, pa.table({"kind": ["t"] * len(have), "s": b.s_words.take(pa.array(b.pair_s[have])), "w": b.w_words.take(pa.array(b.pair_w[have])), "k": pa.nulls(len(have), pa.int32()), "c": pairs[have]}, schema=small.schema)]
    if fertile:
        fert[b.null] = 0
        s, k = np.nonzero(fert > 0)
        parts.append(pa.table({"kind": ["fertility"] * len(s), "s": b.s_words.take(pa.array(s)), "w": pa.nulls(len(s), pa.string()), "k": pa.array(k, pa.int32()), "c": fert[s, k]}, schema=small.schema))
    out = pa.concat_tables(parts)
    return out.add_column(1, "side", pa.array([b.side] * len(out), pa.int32()))


TRAINED = ["sw", "ww", "sn", "wn", "si", "wi", "ps", "pw"]


def expected(v: DataFrame, pairs: DataFrame, t: DataFrame, jumps: dict[int, np.ndarray] | None, p0: dict[int, float], fertile: bool = False) -> DataFrame:
    """The expected counts of a round over all verses; without jumps, those of model 1."""
    known = pairs.join(t, ["side", "s", "w"]).select("block", "side", "i", "t")
    blocks = known.groupBy("block", "side").cogroup(v.select("block", "side", *TRAINED).groupBy("block", "side"))
    found = blocks.applyInArrow(lambda x, y: _counts(x, y, jumps, p0, fertile), COUNTS)
    told = F.col("kind").isin("null", "score")  # their k is a number of words
    sums = found.groupBy("kind", "side", "s", "w", F.when(~told, F.col("k")).alias("at")).agg(F.sum("c").alias("c"), F.sum(F.when(told, F.col("k"))).alias("n"))
    return sums.select("kind", "side", "s", "w", F.coalesce("at", "n").alias("k"), "c")


def updated(counts: DataFrame) -> DataFrame:
    """t(w | s) of the counts of word pairs."""
    sums = counts.where("kind = 't'").groupBy("side", "s", "w").agg(F.sum("c").alias("c"))
    whole = counts.where("kind = 't'").groupBy("side", "s").agg(F.sum("c").alias("n"))
    return sums.join(whole, ["side", "s"]).select("side", "s", "w", (F.col("c") / F.col("n")).alias("t"))


def model_1(v: DataFrame, pairs: DataFrame, rounds: int) -> DataFrame:
    """t after `rounds` of model 1; each is written, and what it replaces is deleted."""
    t = written(uniform(pairs), "t")
    for _ in range(rounds):
        counts = written(expected(v, pairs, t, None, {}).where("kind = 't'"), "counts")
        release(t)
        t = written(updated(counts), "t")
        release(counts)
    return t


def fertility_of(counts: DataFrame, weight: float = 1.0) -> DataFrame:
    """side, s and the chances of 0 to FERTILE target words, drawn to those of all words of the side with `weight`."""
    own = counts.where("kind = 'fertility'").groupBy("side", "s", "k").agg(F.sum("c").alias("c"))
    every = own.groupBy("side", "k").agg(F.sum("c").alias("c"))
    every = every.join(every.groupBy("side").agg(F.sum("c").alias("n")), "side").select("side", "k", (F.col("c") / F.col("n")).alias("g"))
    row = lambda value: F.map_from_entries(F.collect_list(F.struct("k", value)))  # noqa: E731  at most FERTILE + 1 entries
    have = own.groupBy("side", "s").agg(row("c").alias("c"), F.sum("c").alias("n"))
    base = every.groupBy("side").agg(row("g").alias("g"))
    at = lambda m, k: F.coalesce(F.try_element_at(F.col(m), F.lit(k)), F.lit(0.0))
    chance = [((at("c", k) + weight * at("g", k)) / (F.col("n") + weight)) for k in range(FERTILE + 1)]
    return have.join(base, "side").select("side", "s", F.array(*chance).alias("f"))


def train(source: DataFrame, target: DataFrame, first: int = 3, rounds: int = 4, size: int = VERSES) -> tuple[DataFrame, DataFrame, Model]:
    """The verses, their word pairs and the model after `first` rounds of model 1 and `rounds` with jumps.

    Each round is written, and what it replaces is deleted.
    """
    v = verses(source, target, size)
    pairs = word_pairs(v)
    model = Model(written(uniform(pairs), "t"), {k: np.ones(2 * JUMP + 1) for k in (0, 1)}, {0: P0, 1: P0})
    for r in range(first + rounds):
        last = r == first + rounds - 1
        counts = written(expected(v, pairs, model.t, None if r < first else model.jumps, model.p0, last), "counts")
        release(model.t)
        model.t = written(updated(counts), "t")
        small = counts.where("kind IN ('jump', 'null', 'score')").groupBy("kind", "side", F.when(F.col("kind") == "jump", F.col("k")).alias("d")).agg(F.sum("c").alias("c"), F.sum("k").alias("n")).collect()
        for x in small:
            if x["kind"] == "score":
                model.scores[x["side"]].append(x["c"] / max(x["n"], 1))
            elif x["kind"] == "null" and r >= first:
                model.p0[x["side"]] = min(max(x["c"] / max(x["n"], 1), 0.01), 0.9)
            elif x["kind"] == "jump" and r >= first:
                model.jumps[x["side"]][x["d"] + JUMP] = x["c"]
        if last:
            model.fertility = written(fertility_of(counts), "fertility")
        release(counts)
    return v, pairs, model


def decoded(post: np.ndarray, none: np.ndarray, fert: np.ndarray) -> np.ndarray:
    """[verse, target place]: the source place of each target word, or their number for null.

    From the likeliest place of each word, single moves that raise the product of posteriors and fertilities most are made in
    all verses at once until none does; among equal moves the first target place and source place goes.
    """
    n, m, k = post.shape
    score = np.log(np.round(np.concatenate([post, none[:, :, None]], 2), 9) + 1e-9)
    f = np.log(np.concatenate([fert, np.ones((n, 1, FERTILE + 1))], 1) + 1e-9)
    link, rows = score.argmax(2), np.arange(n)
    for _ in range(2 * m * (k + 1)):
        used = (link[:, :, None] == np.arange(k + 1)).sum(1)
        count = lambda c: np.take_along_axis(f, np.clip(c, 0, FERTILE)[:, :, None], 2)[:, :, 0]
        more, less = count(used + 1) - count(used), count(used - 1) - count(used)
        now = np.take_along_axis(score, link[:, :, None], 2) - np.take_along_axis(less, link, 1)[:, :, None]
        gain = np.round(score - now + more[:, None, :], 9)
        np.put_along_axis(gain, link[:, :, None], 0, 2)
        best = gain.reshape(n, -1).argmax(1)
        better = gain.reshape(n, -1)[rows, best] > 0
        if not better.any():
            break
        link[rows[better], best[better] // (k + 1)] = best[better] % (k + 1)
    return link


def _links(known: pa.Table, lines: pa.Table, jumps: dict[int, np.ndarray], p0: dict[int, float]) -> pa.Table:
    b = Block(known.filter(pa.compute.is_valid(known.column("i"))), lines)
    fert = np.ones((len(b.s_words), FERTILE + 1))
    own = known.filter(pa.compute.is_null(known.column("i")))
    number = {x: i for i, x in enumerate(b.s_words.to_pylist())}
    for s, f in zip(own.column("s").to_pylist(), own.column("f").to_pylist(), strict=True):
        fert[number[s]] = f
    found = [np.zeros((3, 0), np.int64)]
    for x in b.stacks():
        k = x.e.shape[2]
        post, none, _, _ = passes(x.e, x.e0, transitions(k, jumps[b.side]), p0[b.side])
        link, (hs, ws) = decoded(post, none, fert[x.s]), b.places(x)
        r, j = np.nonzero(link < k)
        found.append(np.stack([x.rows[r], hs[r, link[r, j]], ws[r, j]]))
    row, h, w = np.concatenate(found, 1)
    return pa.table({"side": pa.array(np.full(len(row), b.side), pa.int32()), "ref": b.refs().take(pa.array(row)), "a": h, "b": w})


def two_sides(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    return found.where("side = 0").select("ref", F.col("a").alias("h_idx"), F.col("b").alias("place")), found.where("side = 1").select("ref", F.col("b").alias("h_idx"), F.col("a").alias("place"))


def links(v: DataFrame, pairs: DataFrame, model: Model) -> tuple[DataFrame, DataFrame]:
    """The links ref, h_idx, place of the two sides: posterior places under fertilities."""
    known = pairs.join(model.t, ["side", "s", "w"]).select("block", "side", "i", "t", F.lit(None).cast("string").alias("s"), F.lit(None).cast("array<double>").alias("f"))
    of = pairs.select("block", "side", "s").distinct().join(model.fertility, ["side", "s"]).select("block", "side", F.lit(None).cast("int").alias("i"), F.lit(None).cast("double").alias("t"), "s", "f")
    blocks = known.union(of).groupBy("block", "side").cogroup(v.groupBy("block", "side"))
    jumps, p0 = model.jumps, model.p0
    return two_sides(written(blocks.applyInArrow(lambda x, y: _links(x, y, jumps, p0), f"side int, ref {ref_kind(v)}, a long, b long"), "links"))


def ref_kind(v: DataFrame) -> str:
    return v.schema["ref"].dataType.elementType.simpleString()


def within(v: DataFrame, pairs: DataFrame, t: DataFrame, pick: Callable[[Block, Stack], tuple[np.ndarray, ...]], columns: str = "") -> DataFrame:
    """side, ref, a (source place), b (target place) and more columns of what `pick` takes of the verses of a stack under t: arrays
    of verses, source words and target words by number in the stack, and of the further columns."""
    known = pairs.join(t, ["side", "s", "w"]).select("block", "side", "i", "t")
    names = [c.split()[0] for c in columns.split(",") if c]

    def one(x: pa.Table, y: pa.Table) -> pa.Table:
        b = Block(x, y)
        refs = b.refs()
        parts = []
        for stack in b.stacks():
            r, i, j, *more = pick(b, stack)
            hs, ws = b.places(stack)
            parts.append(pa.table({"side": pa.array(np.full(len(r), b.side), pa.int32()), "ref": refs.take(pa.array(stack.rows[r])), "a": hs[r, i], "b": ws[r, j]} | dict(zip(names, more, strict=True))))
        return pa.concat_tables(parts)

    blocks = known.groupBy("block", "side").cogroup(v.groupBy("block", "side"))
    return blocks.applyInArrow(lambda x, y: one(x, y), f"side int, ref {ref_kind(v)}, a long, b long{', ' + columns if columns else ''}")
