"""Numbering schemes, pooling over moved verses, and editions of like texts against plain versions."""

import random

import pytest

from bitextile.operators import editions, sequence, versification


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# -- schemes

MAP = "ref string, to string"


def test_the_last_line_of_a_table_counts(spark):
    lines = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", None), (4, "a", "y")], "line int, source string, standard string")
    assert rows(versification.table_map(lines, "source", "standard"), "ref", "to") == [("a", "y"), ("b", "x")]
    assert rows(versification.table_map(lines, "standard", "source"), "ref", "to") == [("x", "b"), ("y", "a")]


@pytest.mark.parametrize("seed", range(3))
def test_maps_compose_invert_and_show_their_conflicts(spark, seed):
    r = random.Random(seed)
    names = [f"r{i:02}" for i in range(30)]
    draw = lambda: {a: r.choice(names) for a in r.sample(names, 18)}
    f, g = ({a: b for a, b in draw().items() if a != b} for _ in range(2))
    go = lambda m, a: m.get(a, a)
    df = [spark.createDataFrame(sorted(m.items()), MAP) for m in (f, g)]
    both = dict(rows(versification.composed(*df), "ref", "to"))
    assert both == {a: go(g, go(f, a)) for a in names if go(g, go(f, a)) != a}
    moved = spark.createDataFrame([(a,) for a in names], "ref string").select("ref", "ref")
    assert moved.count() == 30
    once = versification.remapped(spark.createDataFrame([(a, a) for a in names], "own string, ref string"), df[0])
    assert dict(rows(once, "own", "ref")) == {a: go(f, a) for a in names}
    pre = {}
    for a in names:
        pre.setdefault(go(f, a), []).append(a)
    hit = set(f.values())
    assert rows(versification.conflicts(df[0]), "to", "refs") == sorted((b, v) for b, v in pre.items() if len(v) > 1 and b in hit)
    back = {a: (b, c) for a, b, c in rows(versification.inverted(df[0]), "ref", "to", "conflict")}
    assert back == {b: (max(a for a in f if f[a] == b), len(pre[b]) > 1) for b in hit}
    assert {x[0] for x in rows(versification.lost(df[0]), "ref")} == {a for b in hit for a in pre[b] if back[b][0] != a}


def test_round_trip_of_a_one_to_one_map(spark):
    f = spark.createDataFrame([("PSA 10:1", "PSA 9:22"), ("PSA 9:22", "PSA 10:1"), ("PSA 11:1", "PSA 10:2"), ("PSA 10:2", "PSA 11:1")], MAP)
    assert versification.lost(f).count() == 0 and versification.conflicts(f).count() == 0
    back = versification.inverted(f).drop("conflict")
    assert versification.composed(f, back).count() == 0 and versification.composed(back, f).count() == 0


def test_only_listed_books_tell_and_only_the_sensitive_one_judges(spark):
    schemes = spark.createDataFrame([("eng", "PSA", 3, 8), ("org", "PSA", 3, 9), ("eng", "MAT", 1, 25), ("org", "MAT", 1, 99)], "scheme string, book string, chapter int, last int")
    own = spark.createDataFrame([("rus", "PSA", 3, 9), ("rus", "MAT", 1, 25), ("deu", "PSA", 3, 7)], "iso string, book string, chapter int, last int")
    tables = spark.createDataFrame([("eng", "protestant", 0), ("org", "hebrew", 1)], "scheme string, label string, nth int")
    found = versification.detected(schemes, own, tables, ["PSA"])
    assert rows(found, "iso", "scheme", "label", "share") == [("deu", "eng", "protestant", 0.0), ("rus", "org", "hebrew", 1.0)]
    pairs = spark.createDataFrame(
        [("rus", "hebrew", "PSA", True, True, True), ("rus", "protestant", "PSA", True, True, False), ("rus", "protestant", "MAT", True, True, True), ("rus", "protestant", "MAT", True, True, True), ("rus", "protestant", "PSA", False, True, True), ("deu", "hebrew", "PSA", True, False, False), ("deu", "protestant", "PSA", True, False, False)],
        "iso string, label string, book string, content boolean, covered boolean, high boolean",
    )
    out = rows(versification.judged(pairs, tables, found, "PSA"), "iso", "label", "content", "covered", "high", "agrees")
    assert out == [("deu", "protestant", 1, 0, 0, True), ("rus", "hebrew", 1, 1, 1, True)]


# -- pooling


def test_pooling_over_moved_verses(spark):
    verses = [(1, v) for v in range(1, 8)] + [(2, v) for v in range(1, 4)]
    tokens = spark.createDataFrame([("GEN", c, v, i, f"{c}.{v}.{i}") for c, v in verses for i in range(2)], "book string, chapter long, verse long, idx long, word string")
    moved = spark.createDataFrame([("GEN", 1, 5, 2, 1), ("GEN", 1, 6, 2, 2), ("GEN", 1, 7, 2, 2), ("GEN", 2, 1, 2, 3), ("GEN", 1, 2, 1, 1)], "book string, chapter long, verse long, to_chapter long, to_verse long")
    ranges = spark.createDataFrame([("GEN", 1, 1, 2), ("GEN", 1, 2, 3), ("GEN", 2, 3, 4), ("GEN", 1, 9, 8)], "book string, chapter long, verse_start long, verse_end long")
    out = {}
    for r in sorted(sequence.verse_groups(ranges, tokens, tokens, moved).collect(), key=lambda r: r["pooled_idx"]):
        out.setdefault((r["chapter"], r["to_chapter"], r["verse_start"], r["verse_end"], r["anchor"]), []).append(r["word"])
    assert {k: [w[:3] for w in v[::2]] for k, v in out.items()} == {
        (1, 1, 1, 3, 1): ["1.1", "1.2", "1.3"],  # overlapping ranges are one; verse 2 folds on verse 1
        (1, 1, 4, 4, 4): ["1.4"],
        (1, 2, 1, 1, 5): ["1.5"],
        (1, 2, 2, 2, 6): ["1.6", "1.7"],  # the chapter is split, and two verses fold
        (2, 2, 3, 4, 1): ["2.1", "2.3"],  # verse 3 stays and falls on the start of the range too
        (2, 2, 2, 2, 2): ["2.2"],
    }


# -- editions


def in_order(keys, verdicts, rank):
    """The rule as a walk over sorted keys."""
    seen, dropped = set(keys), set()
    for key in sorted(verdicts):
        if key in dropped or key not in seen:
            continue
        c = next((c for likely, c in verdicts[key] if likely in editions.REDUNDANT and c in seen and c not in dropped), None)
        if c is not None:
            dropped.add(c if rank[key] < rank[c] else key)
    return seen - dropped


KINDS = "iso string, key string, nth int, likely string, closest string"


def unlike(spark, keys, verdicts, source):
    own = spark.createDataFrame([(g, k, source[k]) for g in ("a", "b") for k in keys], "iso string, key string, source string")
    said = spark.createDataFrame([("a", k, n, likely, c) for k, v in verdicts.items() for n, (likely, c) in enumerate(v)], KINDS)
    out = editions.drop_like(own, said, ["pkf", "helloao", "dbt"]).collect()
    assert {r["key"] for r in out if r["iso"] == "b"} == set(keys)
    return {r["key"] for r in out if r["iso"] == "a"}


@pytest.mark.parametrize("shape", ["chain", "reverse", "cycle", "hub", "gone"])
def test_near_copies_go_in_key_order(spark, shape):
    keys = [f"k{i}" for i in range(6)]
    near = {
        "chain": {k: [("near_identical", n)] for k, n in zip(keys, keys[1:], strict=False)},
        "reverse": {n: [("dialect_variant", k)] for k, n in zip(keys, keys[1:], strict=False)},
        "cycle": {k: [("near_identical", n)] for k, n in zip(keys, keys[1:] + keys[:1], strict=True)},
        "hub": {k: [("distinct_translation", "k1"), ("orthography_convention", "k3")] for k in keys if k != "k3"},
        "gone": {k: [("near_identical", "elsewhere"), ("near_identical", keys[0])] for k in keys[1:]},
    }[shape]
    for source in ({k: "pkf" for k in keys}, {k: ["dbt", "pkf", "helloao"][i % 3] for i, k in enumerate(keys)}):
        rank = {k: ["pkf", "helloao", "dbt"].index(s) for k, s in source.items()}
        assert unlike(spark, keys, near, source) == in_order(keys, near, rank)


@pytest.mark.parametrize("seed", range(4))
def test_near_copies_of_any_graph(spark, seed):
    r = random.Random(seed)
    keys = [f"k{i:02}" for i in range(24)]
    source = {k: r.choice(["pkf", "helloao", "dbt", "other"]) for k in keys}
    near = {k: [(r.choice([*editions.REDUNDANT, "distinct_translation"]), r.choice([*keys, "elsewhere"])) for _ in range(r.randint(1, 3))] for k in r.sample(keys, 18)}
    rank = {k: ["pkf", "helloao", "dbt", "other"].index(s) for k, s in source.items()}
    assert unlike(spark, keys, near, source) == in_order(keys, near, rank)


def test_catalog_of_clusters_and_index(spark):
    clusters = spark.createDataFrame(
        [("ind", "nt", ["pkf:INDPKF", "helloao:ind_obo"], None, None, None), ("ind", "otp", ["helloao:ind_obo"], True, "dialect_variant", "dbt:INDASV"), ("ind", "ot", ["dbt:INDASV"], True, None, None), ("ind", "ot", ["dbt:DEAD"], False, None, None)],
        "iso string, canon string, ids array<string>, reachable boolean, likely string, closest string",
    )
    index = spark.createDataFrame([("ind", "nt", "dbt"), ("abc", "ntp", "pkf"), ("abc", "nt", "dbt"), ("abc", "nt", "helloao")], "iso string, canon string, source string")
    listed = spark.createDataFrame([("abc", "dbt", "ABCX", "nt"), ("abc", "dbt", "ABCO", "ot"), ("abc", "helloao", "abc_y", None), ("ind", "dbt", "NO", "nt")], "iso string, source string, edition string, canon string")
    v = editions.catalog_versions(clusters, index, listed)
    assert {r["key"] for r in v.where("iso = 'abc'").collect()} == {"pkf:ABCPKF", "dbt:ABCX", "helloao:abc_y"}
    root = {r["key"]: r["root"] for r in editions.families(v.where("iso = 'ind'")).collect()}
    assert root == {"pkf:INDPKF": "pkf:INDPKF", "helloao:ind_obo": "pkf:INDPKF", "dbt:INDASV": "dbt:INDASV"}  # one testament's word is enough
    assert {r["key"] for r in editions.editions_for(v, ["pkf", "helloao", "dbt"]).collect()} == {"pkf:INDPKF", "dbt:INDASV", "pkf:ABCPKF", "dbt:ABCX", "helloao:abc_y"}


def test_families_follow_links_to_an_end_that_is_not_there(spark):
    clusters = spark.createDataFrame([("hch", "nt", ["dbt:A", "dbt:B"], False, None, None), ("hch", "ot", ["dbt:B", "dbt:C"], True, None, None), ("hch", "nt", ["dbt:A", "dbt:D"], True, None, None)], "iso string, canon string, ids array<string>, reachable boolean, likely string, closest string")
    none = spark.createDataFrame([], "iso string, canon string, source string")
    v = editions.catalog_versions(clusters, none, spark.createDataFrame([], "iso string, source string, edition string, canon string"))
    lone = v.where("key <> 'dbt:A'")
    assert {r["key"]: r["root"] for r in editions.families(lone).collect()} == {"dbt:B": "dbt:B", "dbt:C": "dbt:B", "dbt:D": "dbt:A"}


@pytest.mark.parametrize("seed", range(4))
def test_roots_of_chains_and_circles(spark, seed):
    from bitextile.operators import graph

    r = random.Random(seed)
    n = 40
    parent = {i: r.choice([None, *range(n)]) if seed else i + 1 for i in range(n)}
    parent[n - 1] = None if seed % 2 else parent[n - 1]
    if not seed:
        parent[n - 1] = None
    parent = {i: None if p == i else p for i, p in parent.items()}
    links = spark.createDataFrame(sorted(parent.items()), "id long, parent long")

    def walk(x):
        seen = set()
        while parent.get(x) is not None and x not in seen:
            seen.add(x)
            x = parent[x]
        return x

    want = {i: walk(i) for i in range(n)}
    assert {x["id"]: x["root"] for x in graph.roots(links, cut=True).collect()} == want
    if any(parent[w] is not None for w in want.values()):
        with pytest.raises(ValueError, match="cycle"):
            graph.roots(links)
    else:
        assert {x["id"]: x["root"] for x in graph.roots(links).collect()} == want
