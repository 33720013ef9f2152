"""The jump model with fertilities against plain versions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitextile.operators import em, hmm, kernels


def test_passes_equal_sums_over_all_paths():
    r = random.Random(2)
    s, w = ["a", "b", "a"], ["x", "y", "x", "z"]
    t = {(p, q): r.random() for p in [*s, hmm.NULL] for q in w}
    jumps, p0 = np.array([r.random() for _ in range(2 * hmm.JUMP + 1)]), 0.3
    e = np.array([[[t[p, q] for p in s] for q in w]])
    e0 = np.array([[t[hmm.NULL, q] for q in w]])
    post, none, moves, ll = hmm.passes(e, e0, hmm.transitions(3, jumps), p0)
    # a null word keeps a place, at the start any: so each state is a place and whether its word is null
    a = hmm.transitions(3, jumps)
    total, want, null, jumped = 0.0, np.zeros((4, 3)), np.zeros(4), np.zeros((3, 3))
    for places in itertools.product(range(3), repeat=4):
        for nulls in itertools.product((0, 1), repeat=4):
            if any(nulls[j] and j and places[j] != places[j - 1] for j in range(4)):
                continue
            p = 1.0
            for j in range(4):
                start = 1 / 3 if j == 0 else (1.0 if nulls[j] else a[places[j - 1], places[j]])
                if j == 0 and not nulls[0]:
                    start = 1 / 3
                p *= start * (p0 * e0[0, j] if nulls[j] else (1 - p0) * e[0, j, places[j]])
            total += p
            for j in range(4):
                if nulls[j]:
                    null[j] += p
                else:
                    want[j, places[j]] += p
                    if j:
                        jumped[places[j - 1], places[j]] += p
    assert np.allclose(post[0], want / total) and np.allclose(none[0], null / total) and np.allclose(moves, jumped / total)
    assert math.isclose(ll[0], math.log(total), rel_tol=1e-9)


def test_fertilities_are_those_of_independent_words():
    post = np.array([[[0.2, 0.8], [0.5, 0.1], [1.0, 0.0]]])
    f = hmm.fertilities(post)[0]
    want = np.zeros((2, hmm.FERTILE + 1))
    for i in range(2):
        for hit in itertools.product((0, 1), repeat=3):
            want[i, sum(hit)] += math.prod(post[0, j, i] if h else 1 - post[0, j, i] for j, h in enumerate(hit))
    assert np.allclose(f, want)


def test_decoding_raises_the_product_and_stops_where_no_single_move_helps():
    g = np.random.default_rng(1)
    post = g.dirichlet(np.ones(4), (30, 5))
    post, none = post[:, :, :3], post[:, :, 3]
    fert = g.dirichlet(np.ones(hmm.FERTILE + 1), (30, 3))

    def value(v, link):
        p = sum(math.log(round(float(none[v, j] if i == 3 else post[v, j, i]), 9) + 1e-9) for j, i in enumerate(link))
        return p + sum(math.log(fert[v, i, min(link.count(i), hmm.FERTILE)] + 1e-9) for i in range(3))

    out = hmm.decoded(post, none, fert).tolist()
    for v, link in enumerate(out):
        first = [max(range(4), key=lambda i: (none[v, j] if i == 3 else post[v, j, i])) for j in range(5)]
        assert value(v, link) >= value(v, first) - 1e-9
        assert all(value(v, [*link[:j], i, *link[j + 1 :]]) <= value(v, link) + 1e-6 for j in range(5) for i in range(4))


def texts(n=120, seed=3):
    """Verses whose words translate one by one with local swaps, one word with two, one word with none."""
    r = random.Random(seed)
    source, target, gold = [], [], set()
    for ref in range(n):
        words, place = [r.randrange(14) for _ in range(r.randint(2, 7))], 0
        order = list(range(len(words)))
        if len(order) > 2 and r.random() < 0.3:
            i = r.randrange(len(order) - 1)
            order[i], order[i + 1] = order[i + 1], order[i]
        source += [(ref, h, f"S{x}") for h, x in enumerate(words)]
        for h in order:
            for part in [] if words[h] == 13 else ["a", "b"] if words[h] == 12 else [""]:
                target.append((ref, place, f"w{words[h]}{part}"))
                gold.add((ref, h, place))
                place += 1
    return source, target, gold


@pytest.fixture(scope="module")
def trained(spark):
    source, target, gold = texts()
    s = spark.createDataFrame(source, "ref long, h_idx long, s string")
    t = spark.createDataFrame(target, "ref long, place long, w string")
    return s, t, gold, source, target, hmm.train(s, t, first=3, rounds=4, size=50)


def test_likelihood_rises_and_passes_that_of_model_1(trained):
    s, t, _, _, _, (_, _, model) = trained
    for side in (0, 1):
        scores = model.scores[side]
        assert len(scores) == 7 and all(b > a - 1e-9 for a, b in zip(scores[:3], scores[1:3], strict=False)) and all(b > a - 1e-6 for a, b in zip(scores[3:], scores[4:], strict=False))
    one = em.log_likelihood(s, t, em.train(s, t, rounds=4, cut=False)).first()[0]
    assert model.scores[0][-1] > one


def test_rounds_equal_plain_ones(spark, trained):
    """Model 1 rounds equal those of em; a round with jumps equals one in plain Python."""
    s, t, _, source, target, _ = trained
    v = hmm.verses(s, t, 50)
    pairs = hmm.word_pairs(v)
    own = hmm.uniform(pairs)
    counts = hmm.expected(v, pairs, own, None, {0: 0, 1: 0})
    first = {(r["s"], r["w"]): r["t"] for r in hmm.updated(counts).where("side = 0").collect()}
    want = {(r["s"], r["w"]): r["t"] for r in em.train(s, t, rounds=1, cut=False).collect()}
    assert first.keys() == want.keys() and all(math.isclose(first[k], want[k], abs_tol=1e-9) for k in want)

    jumps = np.linspace(1, 2, 2 * hmm.JUMP + 1)
    rows = hmm.expected(v, pairs, hmm.updated(counts), {0: jumps, 1: jumps}, {0: 0.2, 1: 0.2}, True).where("side = 0").collect()
    got = {}
    for r in rows:
        key = (r["kind"], r["s"], r["w"], r["k"] if r["kind"] in ("jump", "fertility") else None)
        got[key] = got.get(key, 0.0) + r["c"]
    plain = {}

    def add(key, c):
        plain[key] = plain.get(key, 0.0) + c

    by_s, by_w = {}, {}
    for ref, h, x in source:
        by_s.setdefault(ref, []).append((h, x))
    for ref, p, x in target:
        by_w.setdefault(ref, []).append((p, x))
    for ref in by_s.keys() & by_w.keys():
        ss, ws = [x for _, x in sorted(by_s[ref])], [x for _, x in sorted(by_w[ref])]
        k, m = len(ss), len(ws)
        a = [[max(jumps[min(max(j - i, -hmm.JUMP), hmm.JUMP) + hmm.JUMP], hmm.FLOOR) for j in range(k)] for i in range(k)]
        a = [[x / sum(row) for x in row] for row in a]
        fr, fn = [], []
        for j, w in enumerate(ws):
            at = [1 / k] * k if j == 0 else [x + y for x, y in zip(fr[-1], fn[-1], strict=True)]
            come = at if j == 0 else [sum(at[i] * a[i][b] for i in range(k)) for b in range(k)]
            fr.append([0.8 * come[b] * first[ss[b], w] for b in range(k)])
            fn.append([0.2 * at[b] * first[hmm.NULL, w] for b in range(k)])
        z = sum(fr[-1]) + sum(fn[-1])
        back = [[1.0] * k]
        for j in range(m - 1, 0, -1):
            back.append([sum(a[i][b] * 0.8 * first[ss[b], ws[j]] * back[-1][b] for b in range(k)) + 0.2 * first[hmm.NULL, ws[j]] * back[-1][i] for i in range(k)])
        back.reverse()
        post = [[fr[j][i] * back[j][i] / z for i in range(k)] for j in range(m)]
        for j, w in enumerate(ws):
            for i in range(k):
                add(("t", ss[i], w, None), post[j][i])
                for b in range(k) if j else []:
                    add(("jump", None, None, min(max(b - i, -hmm.JUMP), hmm.JUMP)), (fr[j - 1][i] + fn[j - 1][i]) * a[i][b] * 0.8 * first[ss[b], w] * back[j][b] / z)
            none = sum(fn[j][i] * back[j][i] for i in range(k)) / z
            add(("t", hmm.NULL, w, None), none)
            add(("null", None, None, None), none)
        add(("score", None, None, None), math.log(z))
        for i in range(k):
            f = [1.0] + [0.0] * hmm.FERTILE
            for j in range(m):
                p = post[j][i]
                f = [f[c] * (1 - p if c < hmm.FERTILE else 1) + (f[c - 1] * p if c else 0) for c in range(hmm.FERTILE + 1)]
            for c, x in enumerate(f):
                add(("fertility", ss[i], None, c), x)
    assert all(math.isclose(got.get(key, 0.0), c, rel_tol=1e-6, abs_tol=1e-7) for key, c in plain.items())
    assert all(key in plain or abs(c) < 1e-7 for key, c in got.items())


def test_links_find_the_words_and_feed_symmetrize(trained):
    _, _, gold, _, _, (v, pairs, model) = trained
    forward, back = hmm.links(v, pairs, model)
    for links in (forward, back):
        own = {tuple(r) for r in links.collect()}
        assert len(own & gold) / len(gold) > 0.9 and len(own & gold) / len(own) > 0.9
    both = {(r["ref"], r["h_idx"], p) for r in kernels.symmetrize(forward, back).collect() for p in r["t_idx"]}
    assert len(both & gold) / len(gold) > 0.93
    f = {r["s"]: r["f"] for r in model.fertility.where("side = 0").collect()}
    assert f["S12"].index(max(f["S12"])) == 2 and f["S13"].index(max(f["S13"])) == 0 and f["S1"].index(max(f["S1"])) == 1
    assert all(math.isclose(sum(x), 1, abs_tol=1e-6) for x in f.values())


def test_empty_one_sided_and_null_words(spark):
    s = spark.createDataFrame([(1, 0, "a"), (1, 1, None), (2, 0, "b")], "ref long, h_idx long, s string")
    t = spark.createDataFrame([(1, 0, "x"), (3, 0, "y")], "ref long, place long, w string")
    v, pairs, model = hmm.train(s, t, 1, 1)
    forward, back = hmm.links(v, pairs, model)
    assert {tuple(r) for r in forward.collect()} <= {(1, 0, 0)} and {tuple(r) for r in back.collect()} <= {(1, 0, 0)}
    v, pairs, model = hmm.train(s.limit(0), t, 1, 1)
    assert hmm.links(v, pairs, model)[0].collect() == []
