"""Operators on small tables."""

import json

from pyspark.sql import functions as F

from bitextile.operators import corpus, editions, em, gapfill, gloss, graph, induction, joins, kernels, lexicon, scoring, sequence
from bitextile.sources import readers, sinks

PAIR = "ref long, h_idx long, surface string, lexeme string, strong string, method string, base_text string, score double, coherent boolean, content boolean, sense string, stem string, t_idx array<int>"


def pairs(spark, rows):
    return spark.createDataFrame(rows, PAIR)


def pair(surface="a", lexeme="hbo:0001a", score=0.9, coherent=None, content=True, sense=None, t_idx=(0,), h=0):
    return (1, h, surface, lexeme, "H0001", "eflomal", "F", score, coherent, content, sense, "qal", list(t_idx))


def test_unknown_coherence_is_high(spark):
    lex = lexicon.additive_union(pairs(spark, [pair(coherent=None), pair(coherent=False), pair(score=0.6)])).first()
    assert (lex["count"], lex["hi_conf"]) == (3, 0.3333)


def test_share_before_min_count(spark):
    rows = [pair(lexeme="hbo:0001a")] * 3 + [pair(lexeme="hbo:0001b")]
    out = lexicon.lexicon(pairs(spark, rows), min_count=2).collect()
    assert [(r["count"], r["share"]) for r in out] == [(3, 0.75)]


def test_exclusion_renormalizes(spark):
    rows = [pair("A", sense="1")] * 3 + [pair("b", sense="1")]
    rules = spark.createDataFrame([("A",)], "surface string")
    out = lexicon.attested_senses(pairs(spark, rows), rules).collect()
    assert [(r["surface"], r["count"], r["share"]) for r in out] == [("b", 1, 1.0)]


def test_empty_tables(spark):
    none = pairs(spark, [])
    for f in (lexicon.lexicon, lexicon.multiword, lexicon.scattered, lexicon.attested_senses, lexicon.known_surfaces):
        assert f(none).collect() == []


def test_shares_sum_to_one(spark):
    rows = [pair(s, l) for s in "ab" for l in ("hbo:0001a", "hbo:0002b", "grc:0003c") for _ in range(3)]
    out = lexicon.lexicon(pairs(spark, rows)).groupBy("surface").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-3 for r in out)


def test_entropy(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("b", "x", 1)], "k string, v string, n long")
    assert {r["k"]: r["entropy"] for r in lexicon.entropy(df, ["k"]).collect()} == {"a": 1.0, "b": 0.0}


def test_nth_occurrence(spark):
    left = spark.createDataFrame([(1, "S", i) for i in range(3)], "ref long, strong string, h long")
    right = spark.createDataFrame([(1, "S", 7, "x"), (1, "S", 9, "y")], "ref long, strong string, t long, v string")
    out = joins.nth_occurrence(left, right, ["ref", "strong"], ["h"], ["t"]).orderBy("h").collect()
    assert [r["v"] for r in out] == ["x", "y", None]


def test_queue_absorbs(spark):
    source = spark.createDataFrame([(1, 0, "S"), (1, 1, "S"), (1, 2, "T")], "ref long, h_idx long, strong string")
    target = spark.createDataFrame([(1, 0, "S", "word", None), (1, 1, None, " ", None)], "ref long, t_idx long, strong string, text string, elided boolean")
    out = {tuple(r["source_ids"]): r["kind"] for r in kernels.queue_groups(source, target).collect()}
    assert out == {(0, 1): "many:1", (2,): "dropped"}


def test_queue_elided(spark):
    source = spark.createDataFrame([(1, 0, "S"), (1, 1, "S")], "ref long, h_idx long, strong string")
    target = spark.createDataFrame([(1, 0, "S", "vvv", None)], "ref long, t_idx long, strong string, text string, elided boolean")
    out = {tuple(r["source_ids"]): r["kind"] for r in kernels.queue_groups(source, target).collect()}
    assert out == {(0,): "elided", (1,): "dropped"}


def test_suffix_ids(spark):
    source = spark.createDataFrame([(1, i, f"w{i}", "L") for i in (309, 310, 311)], "ref long, id long, text string, lemma string")
    target = spark.createDataFrame([(1, 0, "309", "son"), (1, 1, "309-01", None), (1, 2, "309-02", None)], "ref long, seq int, id string, gloss string")
    out = sorted((r["source_ids"], r["kind"]) for r in kernels.suffix_groups(source, target).collect())
    assert out == [([309], "1:1"), ([310], "suffix_pending"), ([311], "suffix_pending")]


def test_suffix_extension_and_run(spark):
    source = spark.createDataFrame([(1, i, f"w{i}", "L") for i in (1, 2, 3)], "ref long, id long, text string, lemma string")
    target = spark.createDataFrame([(1, 0, "1", "a"), (1, 1, "1-8", "b")], "ref long, seq int, id string, gloss string")
    out = kernels.suffix_groups(source, target).collect()
    assert [(r["source_ids"], r["target_ids"], r["kind"]) for r in out] == [([1, 2, 3], [1, 9], "many:many")]


def test_components_kind(spark):
    edges = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (1, 2, 2), (2, 5, 5)], "ref long, s long, t long")
    out = {r["ref"]: (r["source_ids"], r["target_ids"], r["kind"]) for r in kernels.link_components(edges).collect()}
    assert out == {1: ([1, 2], [1, 2], "many:many"), 2: ([5], [5], "1:1")}


def test_graph(spark):
    links = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (9, 8)], "id long, parent long")
    assert {r["id"]: r["root"] for r in graph.roots(links).collect()} == {1: 1, 2: 1, 3: 1, 4: 1}
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 51)], "a long, b long")
    out = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert set(out.values()) == {1, 50} and len(out) == 32


def test_greedy_takes_spans_whole(spark):
    rows = [(1, 0, [0, 1], 0.95, 0.0), (1, 1, [1], 0.9, 0.0), (1, 2, [2], 0.9, 0.1), (1, 1, [2], 0.9, 0.2)]
    out = kernels.greedy(spark.createDataFrame(rows, "ref long, h_idx long, t_idx array<long>, score double, near double")).collect()
    assert sorted((r["h_idx"], r["t_idx"]) for r in out) == [(0, [0, 1]), (2, [2])]


def test_symmetrize(spark):
    df = lambda x: spark.createDataFrame([(1, *p) for p in x], "ref long, h_idx long, place long")
    out = {r["h_idx"]: (r["t_idx"], r["score"]) for r in kernels.symmetrize(df([(0, 0), (1, 1), (5, 5)]), df([(0, 0), (2, 1)])).collect()}
    assert out == {0: ([0], 0.9), 1: ([1], 0.6), 2: ([1], 0.6), 5: ([5], 0.6)}


def test_em_rows_sum_to_one_and_learn(spark):
    verses = [(i, w) for i in range(20) for w in ([("A", "x"), ("B", "y")], [("A", "x"), ("C", "z")])[i % 2]]
    source = spark.createDataFrame([(r, k % 2, w[0]) for k, (r, w) in enumerate(verses)], "ref long, h_idx long, s string")
    target = spark.createDataFrame([(r, k % 2, w[1]) for k, (r, w) in enumerate(verses)], "ref long, place long, w string")
    t = em.train(source, target, 4)
    assert all(abs(r["p"] - 1) < 1e-9 for r in t.groupBy("s").agg(F.sum("t").alias("p")).collect())
    best = {r["s"]: r["w"] for r in t.where("t > 0.5").collect()}
    assert (best["B"], best["C"]) == ("y", "z")
    first, last = (em.log_likelihood(source, target, x).first()[0] for x in (em.start(em.cells(source, target)), t))
    assert last > first


def test_sequence(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate("aabba")], "ref long, i long, v string")
    out = sequence.islands(df, ["ref"], ["i"], "v").orderBy("first").collect()
    assert [(r["v"], r["first"], r["last"]) for r in out] == [("a", 0, 1), ("b", 2, 3), ("a", 4, 4)]
    run = sequence.leading_run(df, ["ref"], ["i"], F.col("v") == "a").where("leading").count()
    assert run == 2
    rows = spark.createDataFrame([(1, 0, 2), (1, 1, None), (1, 2, 6), (1, 3, None)], "ref long, p long, t int").withColumn("n", F.lit(4)).withColumn("m", F.lit(8))
    assert [r["expected"] for r in sequence.interpolate(rows, ["ref"], "p", "t", "n", "m").orderBy("p").collect()] == [2.0, 4.0, 6.0, 6.0]


def test_range_pool(spark):
    ranges = spark.createDataFrame([("GEN", 1, 3, 4)], "book string, chapter int, verse_start int, verse_end int")
    tokens = spark.createDataFrame([("GEN", 1, v, i) for v in (2, 3, 4) for i in range(2)], "book string, chapter int, verse int, idx int")
    out = sequence.verse_groups(ranges, tokens.select("book", "chapter", "verse").distinct(), tokens).orderBy("anchor", "pooled_idx").collect()
    assert [(r["anchor"], r["pooled_idx"]) for r in out] == [(2, 0), (2, 1), (3, 0), (3, 1), (3, 2), (3, 3)]


def test_contest(spark):
    ef = spark.createDataFrame([(1, 0, "a", 0.6, "score 0.6"), (1, 1, "a", 0.9, "score 0.9")], "ref long, h_idx long, target string, score double, tier string")
    gl = spark.createDataFrame([(1, 0, "b", 1.0, "exact", False), (1, 1, "b", 1.0, "exact", True), (1, 2, "c", 0.9, "stem", False)], "ref long, h_idx long, target string, score double, tier string, light boolean")
    gap = spark.createDataFrame([(1, 3, "d", 0.75)], "ref long, h_idx long, target string, score double")
    rule = spark.createDataFrame([("score 0.6", "exact", "gl")], "ef_tier string, gl_tier string, rule string")
    out = {r["h_idx"]: (r["target"], r["source"]) for r in scoring.merge_contest(ef, gl, gap, rule).collect()}
    assert out == {0: ("b", "gl"), 1: ("a", "ef"), 2: ("c", "gl"), 3: ("d", "gap")}


def test_head_to_head_counts(spark):
    df = lambda x: spark.createDataFrame(x, "ref long, h_idx long, target string")
    a, b = df([(1, 0, "x"), (1, 1, "y"), (1, 2, "z")]), df([(1, 0, "x"), (1, 1, "n"), (1, 3, "m")])
    kinds = {r["kind"]: r["count"] for r in joins.head_to_head(a, b).groupBy("kind").count().collect()}
    assert kinds == {"agree": 1, "disagree": 1, "ef_only": 1, "gl_only": 1}


def test_state_diff_and_upsert(spark):
    df = lambda x: spark.createDataFrame(x, "k string, v string")
    out = {r["k"]: r["change"] for r in joins.state_diff(df([("a", "1"), ("b", "1"), ("c", "1")]), df([("b", "1"), ("c", "2"), ("d", "1")]), "k", "v").collect()}
    assert out == {"a": "delete", "b": "unchanged", "c": "update", "d": "add"}
    assert sorted(map(tuple, joins.upsert(df([("a", "1"), ("b", "1")]), df([("b", "2")]), ["k"]).collect())) == [("a", "1"), ("b", "2")]


def test_affixes(spark):
    words = spark.createDataFrame([("x", s + e) for s in (f"stem{c}{d}" for c in "abcd" for d in "abc") for e in ("", "ing", "s")], "lang string, word string")
    out = {r["affix"] for r in induction.affixes(words, "lang", "suffix").collect()}
    assert {"ing", "s"} <= out


def test_gloss_alignment(spark):
    source = spark.createDataFrame([(1, 0, "H1", "L1", None, False), (1, 1, "H2", "L2", "Ruth", True), (1, 2, "H3", "L3", None, False)], "ref long, h_idx long, strong string, lexeme string, gloss_en string, is_name boolean")
    target = spark.createDataFrame([(1, i, w, w == "de") for i, w in enumerate(["anak", "perempuan", "Rut", "de", "rumah"])], "ref long, place long, token string, blocked boolean")
    priors = spark.createDataFrame([("H1", [["anak", "perempuan"]]), ("H3", [["rumah"]])], "strong string, variants array<array<string>>")
    out = {r["h_idx"]: (r["t_idx"], r["method"]) for r in gloss.align(source, target, priors).collect()}
    assert out == {0: ([0, 1], "multi"), 1: ([2], "name"), 2: ([4], "exact")}


def test_gapfill_two_passes(spark):
    c = spark.createDataFrame([(1, 0, 0, 0.4, "phrase", False), (1, 1, 0, 0.5, "strong", True), (1, 0, 1, 0.3, "phrase", False)], "ref long, h_idx long, place long, score double, prior string, vocab boolean")
    out = {r["h_idx"]: (r["place"], r["score"], r["prior"]) for r in gapfill.fill(c).collect()}
    assert out == {1: (0, 0.9, "strong"), 0: (1, 0.75, "phrase")}


def test_superscription(spark):
    t = spark.createDataFrame([(1, 0, True, "psalm"), (1, 1, False, "of"), (1, 2, True, "song"), (1, 3, True, "praise"), (1, 4, True, "psalm")], "ref long, h_idx long, content boolean, word string")
    out = corpus.superscriptions(t, F.col("word").isin("psalm", "song")).where("is_superscription").count()
    assert out == 2


def test_editions(spark):
    tags = spark.createDataFrame([("ind_ayt",), ("old",), ("swe",), ("x1",)], "tag string")
    m = spark.createDataFrame([("ind_ayt", "ind")], "tag string, iso string")
    l = spark.createDataFrame([("old", "heb")], "tag string, iso string")
    r = editions.resolve_iso(tags, m, l)
    assert {x["tag"]: x["iso"] for x in r.collect()} == {"ind_ayt": "ind", "old": "heb", "swe": "swe", "x1": None}
    assert editions.safe_to_clean(r, m).count() == 1


def test_usj_and_files(spark, tmp_path):
    tree = {"type": "USJ", "content": [
        {"type": "chapter", "number": "1"}, "before",
        {"type": "para", "marker": "s1", "content": ["Heading"]},
        {"type": "para", "marker": "p", "content": [{"type": "verse", "number": "1"}, "In the ", {"type": "note", "content": ["note"]}, {"type": "char", "marker": "nd", "content": ["beginning"]}]},
        {"type": "para", "marker": "q2", "content": [{"type": "verse", "number": "2-3"}, "And", {"type": "char", "marker": "vp", "content": ["2b"]}, "then"]},
    ]}
    (tmp_path / "01-GEN.json").write_text(json.dumps(tree))
    out = readers.verse_ranges(readers.usj_pieces(spark, str(tmp_path))).orderBy("verse_start").collect()
    assert [(r["book"], r["chapter"], r["verse_start"], r["verse_end"], r["text"]) for r in out] == [("GEN", 1, 1, 1, "In the beginning"), ("GEN", 1, 2, 3, "And then")]


def test_pair_files_match_whole_tags(spark, tmp_path):
    line = json.dumps({"ref": 1001001, "book": "GEN", "chapter": 1, "verse": 1, "pairs": [{"h_idx": 0, "target": "x", "t_idx": [0]}]})
    for tag in ("ind", "ind_ayt"):
        (tmp_path / f"align_gloss_{tag}_GEN.jsonl").write_text(line + "\n")
    assert readers.pair_files(spark, str(tmp_path), "gloss", "ind").count() == 1
    assert readers.pair_files(spark, str(tmp_path)).count() == 2


def test_more_readers(spark, tmp_path):
    (tmp_path / "a.vrs").write_text("# text\nGEN 1:31 2:25\nXYZ 1:1\n")
    assert [tuple(r) for r in readers.vrs(spark, str(tmp_path / "a.vrs")).collect()] == [("GEN", 1, 31), ("GEN", 2, 25)]
    (tmp_path / "g.csv").write_text("﻿lex,default,qal\nL1,anak; putra,\nL2,,rumah\n")
    out = {(r["lexeme"], r["stem"]): r["variants"] for r in readers.gloss_csv(spark, str(tmp_path / "g.csv")).collect()}
    assert out == {("L1", "default"): [["anak"], ["putra"]], ("L2", "qal"): [["rumah"]]}
    (tmp_path / "rule.json").write_text('{"score 0.6 | exact": "gl"}')
    assert tuple(readers.rules_json(spark, str(tmp_path / "rule.json")).first()) == ("score 0.6", "exact", "gl")
    rows = spark.createDataFrame([('{"heb": {"GEN 1:1": [["a", "H1"], ["b", null]]}}',)], "value string")
    assert [(r["idx"], r["text"], r["strong"]) for r in readers.spans_json(rows, "heb").collect()] == [(0, "a", "H1"), (1, "b", None)]
    (tmp_path / "w.json").write_text(json.dumps({"chapters": [{"verses": [{"id": "1001001", "words": [{"id": "1", "text": "x", "lemma": "H1"}]}]}]}))
    assert readers.words_json(spark, str(tmp_path / "w.json")).first()["lemma"] == "H1"
    spine = spark.createDataFrame([("GEN", 1, 0, 0, 1, "a", 1), ("MAT", 1, 1, 0, 26, "b", 0)], "book string, chapter int, verse int, idx int, strong int, lemma string, is_content int")
    assert [(r["strong"], r["lexeme"], r["ref"], r["sense"]) for r in readers.spine(spine).collect()] == [("G0026", "G0026|b", 40001001, None)]
    gold = spark.createDataFrame([("00100100101", "H1", "Haus!"), ("00100100102", "H1", "haus")], "ref string, strong string, surface string")
    assert readers.gold_positions(gold).first()["surfaces"] == ["haus"]
    pages = spark.createDataFrame([("p", "<b>H1</b> <i>one</i> <b>H1</b> <i>two</i>")], "page string, html string")
    assert tuple(readers.lexicon_html(pages, r"<b>(H\d+)</b> <i>(.*?)</i>").first()) == ("H1", "one")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.123456, "x"), ("b", 0.5, "y")], "iso string, hi_conf double, surface string")
    sinks.parquet(df, str(tmp_path / "lex"), digits={"hi_conf": 4})
    sinks.parquet(df.where("iso = 'a'").withColumn("surface", F.lit("z")), str(tmp_path / "lex"), digits={"hi_conf": 4})
    out = {r["iso"]: (r["surface"], round(r["hi_conf"], 4)) for r in readers.published(spark, str(tmp_path / "lex")).collect()}
    assert out == {"a": ("z", 0.1235), "b": ("y", 0.5)}
    counts = spark.createDataFrame([("H1", "a", 5), ("H1", "b", 7), ("H1", "c", 1)], "strong string, gloss string, count long")
    assert sinks.priors_rows(counts).first()["gloss"] == "b; a"
    assert sinks.report(df).count("|") > 8


def test_every_query_runs_empty_rows_ok(spark):
    from bitextile.plans import registry

    registry.load()
    assert len(registry.QUERIES) > 60
    assert set(registry.ORACLES) <= set(registry.QUERIES)
