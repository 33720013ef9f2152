"""Lookups, phrases, editions and small statistics on small tables."""

import pytest
from pyspark.sql import functions as F

from bitextile.operators import editions, gapfill, gloss, joins, lexicon, scoring
from bitextile.sources import readers, sinks


def test_lookup_keeps_order_and_drops_repeats(spark):
    v = "array<array<string>>"
    tokens = spark.createDataFrame([("L1", "qal", "H1"), ("L2", "qal", "H2")], "lexeme string, stem string, strong string")
    stem = spark.createDataFrame([("L1", "qal", [["go"]])], f"lexeme string, stem string, variants {v}")
    default = spark.createDataFrame([("L1", [["walk"], ["go"]])], f"lexeme string, variants {v}")
    strong = spark.createDataFrame([("H1", [["come"]])], f"strong string, variants {v}")
    title = spark.createDataFrame([("H1", [["journey"]])], f"strong string, variants {v}")
    out = {r["lexeme"]: r["variants"] for r in gloss.lookup(tokens, stem, default, strong, title).collect()}
    assert out == {"L1": [["go"], ["walk"], ["come"], ["journey"]], "L2": []}


def test_lexical_and_bootstrap_priors(spark):
    m = spark.createDataFrame([("H1", "A", "exact"), ("H1", "a", "multi"), ("H1", "b", "fuzzy")], "strong string, word1 string, method string")
    assert [tuple(r) for r in gloss.lexical_priors(m).collect()] == [("H1", "a", 2)]
    lex = spark.createDataFrame([("H1", "big house", 9), ("H1", "rare", 1)], "strong string, surface string, count long")
    assert gloss.bootstrap_priors(lex, k=1).first()["variants"] == [["big", "house"]]


def test_span_extension_and_light(spark):
    source = spark.createDataFrame([(1, 0, "H1", "L1", None, False)], "ref long, h_idx long, strong string, lexeme string, gloss_en string, is_name boolean")
    priors = spark.createDataFrame([("H1", [["baal"]])], "strong string, variants array<array<string>>")
    wide = spark.createDataFrame([("L1", 0.7)], "lexeme string, multiword_rate double")
    light = spark.createDataFrame([("L1",)], "lexeme string")
    for words, want in ((["baal", "hanan"], [0, 1]), (["baal", "de"], [0]), (["x", "baal"], [1])):
        target = spark.createDataFrame([(1, i, w, w == "de") for i, w in enumerate(words)], "ref long, place long, token string, blocked boolean")
        r = gloss.align(source, target, priors, multiword=wide, light=light).first()
        assert r["t_idx"] == want and r["light"] and r["method"] == ("multi" if len(want) == 2 else "exact")


def test_phrase_mates(spark):
    rows = [(1, 0, 5, "NA", "Pred"), (1, 1, 5, "rec", "Pred"), (1, 2, 5, "x", "Pred"), (1, 9, 6, "NA", "Subj")]
    source = spark.createDataFrame(rows, "ref long, h_idx long, phrase_id long, rela string, function string")
    anchors = spark.createDataFrame([(1, 0, 4)], "ref long, h_idx long, anchor long")
    out = {r["h_idx"]: r["p_exp"] for r in gapfill.phrase_expected(source, anchors).collect()}
    assert out == {1: 5.0, 2: 5.0}
    assert {r["h_idx"]: r["p_exp"] for r in gapfill.phrase_expected(source, anchors, dependent_after=False).collect()}[1] == 3.0
    phrases = spark.createDataFrame([(1, 0, "Pred", 4.0)], "ref long, src long, function string, tgt double")
    order = spark.createDataFrame([("Pred", "Subj", 0.9)], "fa string, fb string, rate double")
    cross = {r["h_idx"]: r["p_exp"] for r in gapfill.cross_phrase_expected(source.where("h_idx = 9"), phrases, order).collect()}
    assert cross == {9: 5.0}
    flipped = order.withColumn("rate", F.lit(0.1))
    assert gapfill.cross_phrase_expected(source.where("h_idx = 9"), phrases, flipped).first()["p_exp"] == 3.0


def test_gap_scores(spark):
    source = spark.createDataFrame([(1, 0, "H1", "L1", True, 5, "NA"), (1, 1, "H2", "L2", True, 5, "rec")], "ref long, h_idx long, strong string, lexeme string, content boolean, phrase_id long, rela string")
    target = spark.createDataFrame([(1, i, w) for i, w in enumerate(["a", "b", "c"])], "ref long, place long, token string")
    covered = spark.createDataFrame([(1, 0, 0)], "ref long, h_idx long, anchor long")
    known = spark.createDataFrame([("H2", "c")], "strong string, word string")
    vocab = spark.createDataFrame([("L2", "b")], "lexeme string, word string")
    priors = spark.createDataFrame([("L2", "verb", None)], "lexeme string, pos string, translit string")
    pos = spark.createDataFrame([("c", "verb")], "word string, pos string")
    out = {r["place"]: (r["prior"], r["score"]) for r in gapfill.scored(source, target, covered, known, vocab, priors, pos).collect()}
    assert set(out) == {1, 2} and out[2][0] == "strong" and out[1][0] == "cross_edition"
    assert abs(out[2][1] - (0.6 + 0.15 - 0.2 * 2 / 3)) < 1e-6  # expected place: the anchor's, 0


def test_editions_versions_and_families(spark):
    s = "iso string, source string, edition string, canon string"
    out = editions.versions(spark.createDataFrame([("ind", "pkf", "A", "nt")], s), spark.createDataFrame([("ind", "pkf", "A", "ntp")], s)).first()
    assert out["canon"] == "nt+ntp"
    f = spark.createDataFrame([("r", "dbt", "x"), ("r", "pkf", "y"), ("q", "other", "z")], "root string, source string, edition string")
    assert {r["root"]: r["edition"] for r in editions.pick_family(f, ["pkf", "helloao", "dbt"]).collect()} == {"r": "y", "q": "z"}
    t = spark.createDataFrame([(1, None, 1), (5, 4, 1), (1, 4, 5), (1, 4, 2)], "p int, o int, q int")
    assert [r["s"] for r in t.select(editions.is_stale(F.col("p"), F.col("o"), F.col("q")).alias("s")).collect()] == [True, True, True, False]


def test_predicates(spark):
    df = spark.createDataFrame([("eflomal", 0.9, None, None), ("gloss", 0.5, "exact", None), ("gapfill", 0.9, None, "strong"), ("x", 0.1, None, None)], "m string, s double, k string, p string")
    got = [r["t"] for r in df.select(lexicon.tier(F.col("m"), F.col("s"), F.col("k"), F.col("p")).alias("t")).collect()]
    assert got == ["score 0.9", "exact", "strong", "all"]
    high = [r["h"] for r in df.select(lexicon.method_high(F.col("m"), F.col("s")).alias("h")).collect()]
    assert high == [True, False, True, False]


def test_trust_and_votes(spark):
    judged = spark.createDataFrame([("eflomal", "a", i % 10 != 0) for i in range(100)] + [("eflomal", "b", i % 2 == 0) for i in range(100)], "method string, iso string, hit boolean")
    r = scoring.trust(judged, ["method"]).first()
    assert r["langs"] == 2 and r["pooled"] == 0.7 and abs(r["spread"] - 0.4) < 1e-6 and abs(r["weight"] - 0.4331) < 1e-3
    votes = spark.createDataFrame([(1, 0, "x", 0.6, "eflomal"), (1, 0, "y", 0.9, "gloss"), (1, 0, "y", 0.7, "gapfill"), (1, 1, "z", 0.6, "gloss")], "ref long, h_idx long, target string, score double, method string")
    out = {r["h_idx"]: (r["target"], r["agree"], r["score"]) for r in scoring.merge_vote(votes).collect()}
    assert out == {0: ("y", 2, 0.97), 1: ("z", 1, 0.6)}


def test_remap_and_fallback_gold(spark):
    rows = spark.createDataFrame([("PSA", 1), ("GEN", 1)], "book string, chapter int")
    t = spark.createDataFrame([("PSA", 1, "PSA", 2)], "book string, chapter int, b string, c int")
    out = {r["book"]: r["std_chapter"] for r in joins.remap(rows, t, ["book", "chapter"], ["b", "c"]).collect()}
    assert out == {"PSA": 2, "GEN": 1}
    lex = spark.createDataFrame([("a", "L1", 5), ("a", "L2", 5), ("b", "L3", 1)], "surface string, lexeme string, count long")
    g = spark.createDataFrame([("a", "L1"), ("b", "L9"), ("c", "L1")], "surface string, lexeme string")
    more = spark.createDataFrame([("b", "L3")], "surface string, lexeme string")
    assert joins.top1_accuracy(lex, g).first()["correct_types"] == 1
    assert joins.top1_accuracy(lex, g, more).first()["correct_types"] == 2


def test_jsonl_round_trip(spark, tmp_path):
    p = spark.createDataFrame([(1001001, "GEN", 1, 1, "gloss", "ind", h, f"t{h}", [h], 0.9) for h in (1, 0)], "ref int, book string, chapter int, verse int, method string, tag string, h_idx int, target string, t_idx array<int>, score double")
    sinks.pair_jsonl(p, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out")).select("book", "tag", F.explode("pairs").alias("p")).select("book", "tag", "p.h_idx", "p.target").collect()
    assert [tuple(r) for r in back] == [("GEN", "ind", 0, "t0"), ("GEN", "ind", 1, "t1")]
    assert readers.pos_and_translit(spark.createDataFrame([("L",)], "lexeme string")).first()["pos"] == "?"


def test_markers_that_hold_no_verse_text():
    """Fixed values of the marker lists, each met once."""


    part = lambda kind, marker, text: {"type": kind, "marker": marker, "content": [text]}
    for marker in "b ca cl cp d h ib ide ie ili im imi imt io iot ip ipi iq is lit mr ms mt periph r rem restore s sd sp sr toc s2 mt1".split():
        tree = {"type": "USJ", "content": [{"type": "chapter", "number": "1"}, {"type": "verse", "number": "1"}, part("para", marker, "no"), part("para", "q1", "yes")]}
        assert [x[3] for x in readers.walk_usj(tree)] == ["yes"], marker
    for marker in "ca cp fm fv va vp".split():
        tree = {"type": "USJ", "content": [{"type": "chapter", "number": "1"}, {"type": "verse", "number": "1"}, part("char", marker, "no"), part("char", "wj", "yes")]}
        assert [x[3] for x in readers.walk_usj(tree)] == ["yes"], marker
    tree = {"type": "USJ", "content": [{"type": "chapter", "number": "1"}, {"type": "verse", "number": "1"}, part("para", "qa", "Aleph")]}
    assert [x[3] for x in readers.walk_usj(tree)] == ["Aleph"]


def test_exclusion_rules_by_the_fields_they_set(spark):
    rows = spark.createDataFrame([("a", "X", 1), ("a", "Y", 1), ("b", "x", 2), ("c", "z", 3)], "lexeme string, surface string, sense int")
    rules = spark.createDataFrame([("a", "Y", None), (None, "X", 2), (None, None, 3)], "lexeme string, surface string, sense int")
    low = rows.selectExpr("lexeme", "lower(surface) AS surface", "sense")
    assert sorted(tuple(r) for r in lexicon.exclude(low, rules).collect()) == [("a", "x", 1)]
    assert lexicon.exclude(low, rules.limit(0)).count() == 4


def test_majority_that_differs(spark):
    rows = spark.createDataFrame([("H1", "H2")] * 9 + [("H1", "H1")] + [("H3", "H3")] * 10 + [("H4", "G4")] * 10, "own string, to string")
    out = lexicon.majority(rows, ["own"], "to", 10, 0.9, other_than="own", like="^H")
    assert [(r["own"], r["to"]) for r in out.collect()] == [("H1", "H2")]


def test_overlap_has_precision_and_recall(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "w string") for v in ("abcd", "cde"))
    r = joins.lexicon_overlap(a, b, "w").first()
    assert (r["both"], r["precision"], r["recall"]) == (2, 0.5, 0.666667)
    assert joins.lexicon_overlap(a.limit(0), b, "w").first()["precision"] == 0


def test_ids_in_overlapping_ranges(spark):
    rows = spark.createDataFrame([(5,), (999,), (1000,), (2500,)], "ref long")
    ranges = spark.createDataFrame([(1, 5, 1000), (2, 999, 3000)], "range_id int, first long, last long")
    assert sorted((r["range_id"], r["ref"]) for r in joins.ids_in_ranges(rows, ranges).collect()) == [(1, 5), (1, 999), (1, 1000), (2, 999), (2, 1000), (2, 2500)]


def test_stems_agree(spark):
    from bitextile.functions import similarity as S

    words = lambda *w: F.array(*map(F.lit, w))
    ok = lambda a, b, **k: spark.range(1).select(S.lexical_agree(a, b, **k)).first()[0]
    assert not ok(words("judar"), words("juda"), prefix=5) and ok(words("judar"), words("juda"), prefix=5, suffixes=("ar", "a"))
    assert not ok(words("en"), words("et"), suffixes=("n", "t"))
    assert spark.range(1).select(S.name_score(F.lit("a.b."), F.lit("a.b"))).first()[0] == 0.98


def test_gap_filling_priors(spark):
    """Blocked and taken places stay, morphology raises the score, and wide lexemes take the place behind."""
    source = spark.createDataFrame([(1, 0, "S1", "L1", True, "sg"), (1, 1, "S2", "L2", True, "pl"), (1, 2, "S3", "L3", False, None)], "ref long, h_idx long, strong string, lexeme string, content boolean, number string")
    target = spark.createDataFrame([(1, k, w, b) for k, (w, b) in enumerate([("the", True), ("man", False), ("men", False), ("big", False), ("the", True)])], "ref long, place long, token string, blocked boolean")
    covered = spark.createDataFrame([(1, 0, 1, [1, 3])], "ref long, h_idx long, anchor long, places array<long>")
    known = spark.createDataFrame([("S2", w) for w in ("the", "man", "men", "big")], "strong string, word string")
    vocab, priors, pos = (spark.createDataFrame([], x) for x in ("lexeme string, word string", "lexeme string, pos string, translit string", "word string, pos string"))
    morph = spark.createDataFrame([("S2", "number", "pl", "men")], "strong string, feature string, value string, word string")
    plain = gapfill.scored(source, target, covered, known, vocab, priors, pos).collect()
    better = gapfill.scored(source, target, covered, known, vocab, priors, pos, morph=morph).collect()
    assert [(r["h_idx"], r["place"]) for r in plain] == [(1, 2)] and abs(better[0]["score"] - plain[0]["score"] - 0.1) < 1e-9
    wide = spark.createDataFrame([("L2", 0.7)], "lexeme string, multiword_rate double")
    grown = gapfill.scored(source, target, spark.createDataFrame([(1, 0, 0)], "ref long, h_idx long, anchor long"), known, vocab, priors, pos, morph=morph, wide=wide)
    assert [(r["place"], r["places"]) for r in gapfill.fill(grown).collect()] == [(2, [2, 3])]
    one = gapfill.fill(grown)
    assert gapfill.self_trained(one, one).count() == 1


def test_suffix_groups_carry_their_words(spark):
    from bitextile.operators import kernels

    source = spark.createDataFrame([(1, i, f"w{i}", f"L{i}") for i in (1, 2, 4)], "ref long, id long, text string, lemma string")
    target = spark.createDataFrame([(1, 0, "1", None), (1, 1, "4", "d")], "ref long, seq int, id string, gloss string")
    out = sorted((r["source_ids"], r["source_text"], r["source_strong"], r["target_ids"], r["target_gloss"], r["kind"]) for r in kernels.suffix_groups(source, target).collect())
    assert out == [([1], ["w1"], ["L1"], [1], [None], "unglossed"), ([2], ["w2"], ["L2"], [], [], "dropped"), ([4], ["w4"], ["L4"], [4], ["d"], "1:1")]


def test_scratch_of_a_cluster_must_be_shared(monkeypatch):
    from types import SimpleNamespace

    from bitextile.sources import scratch

    for master in ("yarn", "local-cluster[2,1,1024]"):
        session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.folder(session, "x")
