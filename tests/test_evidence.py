"""Priors from an earlier lexicon, keys, features, tables and plans on small tables."""

import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from bitextile.functions import keys as K
from bitextile.operators import editions, gloss, joins, lexicon, scoring
from bitextile.sources import readers


def one(spark, c):
    return spark.range(1).select(c).first()[0]


def test_bootstrap_takes_links_skips_function_words_and_bridges(spark):
    lex = spark.createDataFrame(
        [("hbo:0001a", "H0001", "Big  House", "eflomal", 9), ("hbo:0001a", "H0001", "big house!", "eflomal", 8), ("hbo:0001a", "H0001", "rare", "eflomal", 1), ("hbo:0001a", "H0001", "glossed", "gloss", 99), ("hbo:0002", None, "the", None, 5), ("hbo:0003", "H0003", "123", "eflomal", 5)],
        "lexeme string, strong string, surface string, method string, count long",
    )
    pack = spark.createDataFrame(
        [("hbo:0001a", "H0001", "OT", 5.0, ["G0009", "G0008"]), ("hbo:0002", "H0002", "OT", None, ["G0009"]), ("grc:0009", "G0009", "NT", 1.0, None), ("grc:0008", "G0008", "NT", None, None), ("hbo:0099", "G0009", "OT", 1.0, None)],
        "lexeme string, strong string, testament string, keyness double, lxx_greek array<string>",
    )
    by_lexeme, by_strong, over = gloss.bootstrap(lex, pack, share=0.06)
    assert {r["lexeme"]: r["variants"] for r in by_lexeme.collect()} == {"hbo:0001a": [["big", "house"]]}  # equal words once, no share for the rare one
    assert {r["strong"]: r["variants"] for r in by_strong.collect()} == {"H0001": [["big", "house"]], "H0002": [["the"]]}
    assert {r["lexeme"]: r["variants"] for r in over.collect()} == {"grc:0009": [["big", "house"], ["the"]]}
    tokens = spark.createDataFrame([("hbo:0001a", "H0002"), ("grc:0009", "G0009"), (None, None)], "lexeme string, strong string")
    out = {r["lexeme"]: r["variants"] for r in gloss.bootstrapped(tokens, by_lexeme, by_strong, over).collect()}
    assert out == {"hbo:0001a": [["big", "house"], ["the"]], "grc:0009": [["big", "house"], ["the"]], None: []}


def test_keys_of_a_grain(spark):
    loose = unicodedata.normalize("NFD", "ἀγάπη")
    assert one(spark, K.strong_key(F.lit("g25x"), F.lit(" Ἀγάπη "), "lexeme")) == one(spark, K.strong_key(F.lit("25G"), F.lit(loose), "lexeme")) == "G0025|ἀγάπη"
    assert one(spark, K.strong_key(F.lit("7225"), F.lit("רֵאשִׁית"), "lexeme")) == "H7225|ראשית"
    assert one(spark, K.strong_key(F.lit("none"), F.lit("x"), "lexeme")) is None and one(spark, K.strong_key(F.lit("1"), F.lit(None), "lexeme")) == "H0001|"
    with pytest.raises(ValueError, match="grain"):
        K.strong_key(F.lit("1"), F.lit("x"), "verse")


def test_presence_codes_are_read_letter_by_letter(spark):
    assert one(spark, K.presence(F.lit("atz"), K.MEDIA)) == ["audio", "audio_timed"] and one(spark, K.presence(F.lit(None).cast("string"), K.CODEX)) == []
    assert [one(spark, K.sound_media(F.lit(c))) for c in ("", "a", "avts", "t", "as")] == [True, True, True, False, False]
    assert one(spark, K.presence_code({"o": F.lit(True), "n": F.lit(False), "d": F.lit(None).cast("boolean")})) == "o"


def test_stopword_shares_of_nothing(spark):
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    truth = spark.createDataFrame([("a", 20, 500), ("c", 20, 500), ("b", 1, 900)], "word string, partners int, freq int")
    r = scoring.stopword_check(words, truth, 10, 100).first()
    assert (r["tp"], r["fp"], r["fn"], r["precision"], r["recall"], r["f1"]) == (1, 1, 1, 0.5, 0.5, 0.5)
    assert scoring.stopword_check(words.limit(0), truth.limit(0), 10, 100).first()["precision"] is None


def test_features_and_tilt(spark):
    ef = spark.createDataFrame([("x", 1, i, "a", 0.9 if i < 2 else 0.6, "H1" if i != 3 else "H9") for i in range(5)], "iso string, ref long, h_idx long, target string, score double, strong string")
    gl = spark.createDataFrame([(1, i, "a" if i == 0 else "b") for i in range(4)], "ref long, h_idx long, target string")
    r = scoring.gold_free(ef, gl, spark.createDataFrame([(1, "H1"), (1, "H1")], "ref long, strong string")).first()
    assert (r["both"], r["agree_rate"], r["ef09_share"], r["contested_share"]) == (4, 0.25, 0.5, 0.5)
    rows = [("x", "e", "g", False, True)] * 4 + [("y", "e", "g", True, False)] * 9 + [("y", "e", "h", True, True)]
    t = {r["iso"]: r for r in scoring.tilt(spark.createDataFrame(rows, "iso string, ef_tier string, gl_tier string, ef_hit boolean, gl_hit boolean"), 3).collect()}
    assert (t["x"]["gl_share"], t["x"]["tailored"], t["x"]["universal"], t["x"]["always_ef"], t["x"]["oracle"]) == (1.0, 1.0, 0.0, 0.0, 1.0)
    assert (t["y"]["contested"], t["y"]["gl_share"], t["y"]["universal"]) == (10, 0.0, 1.0)


def test_plans_without_a_source_and_excluded_testaments(spark):
    iso = lambda *x: spark.createDataFrame([(i,) for i in x], "iso string")
    eds = spark.createDataFrame([("a", "pkf"), ("b", "dbt"), ("b", "pkf"), ("c", "pkf")], "iso string, source string")
    got = lambda **k: sorted(r["iso"] for r in editions.plan(iso("a", "b", "c", "d"), iso("c"), iso(), **k).collect())
    assert got() == ["a", "b", "d"] and got(editions=eds) == ["a", "b"] and got(editions=eds, without="dbt") == ["a"]
    rules = spark.createDataFrame([("a", "nt"), ("b", "all")], "iso string, testament string")
    assert sorted(tuple(r) for r in editions.tested(rules).collect()) == [("a", "nt"), ("b", "nt"), ("b", "ot")]


def test_occurrences_in_order_with_columns_that_one_lacks(spark):
    a = spark.createDataFrame([("02", "x"), ("01", "y")], "verse_ref string, text string")
    b = spark.createDataFrame([("01", 7)], "verse_ref string, gloss int")
    assert [tuple(r) for r in joins.occurrence_union({"b": a, "a": b}).select("verse_ref", "source", "text", "gloss").collect()] == [("01", "a", None, 7), ("01", "b", "y", None), ("02", "b", "x", None)]


def test_recipes_have_their_orders(spark):
    gap = spark.createDataFrame([("a", 99, 1), ("b", 3, 1), ("c", 3, 9)], "lexeme string, rank_confidence int, spine_freq long")
    assert [r["lexeme"] for r in joins.recipe_order(gap, "gap").collect()] == ["c", "b", "a"]
    sense = spark.createDataFrame([("a", "extra", None), ("b", "missing", 0.1), ("c", "confirmed", 0.2), ("d", "confirmed", 0.9)], "lexeme string, status string, prior_share double")
    assert [r["lexeme"] for r in joins.recipe_order(sense, "sense").collect()] == ["d", "c", "b", "a"]
    key = spark.createDataFrame([("b", 0.1, 5), ("a", 0.1, 5), ("a", 0.9, 1), ("a", 0.1, 9)], "lexeme string, hi_conf double, count long")
    assert [tuple(r) for r in joins.recipe_order(key, "keyness").collect()] == [("a", 0.9, 1), ("a", 0.1, 9), ("a", 0.1, 5), ("b", 0.1, 5)]
    bridge = spark.createDataFrame([(1, 1), (0, 1), (0, 9)], "nt_total long, ot_count long")
    assert [tuple(r) for r in joins.recipe_order(bridge, "bridge").collect()] == [(0, 9), (0, 1), (1, 1)]


def test_remap_table_votes_by_surface_and_guards(spark):
    pairs = [("hbo:1", "H1", "go", True)] * 9 + [("hbo:1", "H1", "went", True)] * 2 + [("hbo:1", "H1", "two words", True)] * 50 + [("hbo:2", "H2", "greek", True)] * 20 + [("hbo:3", "H5", "go", True)] * 20 + [("hbo:4", "H4", "go", True)] * 20
    gold = [("go", "H5")] * 3 + [("go", "H1")] * 2 + [("went", "H1")] * 900 + [("greek", "G1")]
    df = spark.createDataFrame(pairs, "lexeme string, strong string, surface string, content boolean")
    g = spark.createDataFrame(gold, "surface string, strong string")
    c = spark.createDataFrame([("hbo:1",), ("hbo:2",), ("hbo:3",)], "lexeme string")
    table = lambda purity: {r["lexeme"]: (r["to_key"], r["n"], r["total"]) for r in lexicon.remap_table(df, g, c, purity=purity).collect()}
    assert table(0.8) == {"hbo:1": ("H5", 9, 11)} and table(0.9) == {}
    assert set(table(0.8)) == {"hbo:1"}  # hbo:2 would become Greek, hbo:3 keeps its own key, hbo:4 is no candidate


def test_vocabulary_takes_multiword_surfaces_word_by_word(spark):
    lex = spark.createDataFrame([("L1", "to go, out", 0.5), ("L1", "no", 0.0)], "lexeme string, surface string, hi_conf double")
    assert sorted(tuple(r) for r in lexicon.vocabulary(lex, sure=True).collect()) == [("L1", "go"), ("L1", "out"), ("L1", "to")]
    assert lexicon.vocabulary(lex).count() == 4


def test_readers_of_titles_tables_and_exclusions(spark, tmp_path):
    (tmp_path / "tw.tsv").write_text("strong\tarticle\nH1\tgod\nH1\tlord\nH2\tgod\nH3\tnone\nH4\tlord\textra\n")
    (tmp_path / "articles.json").write_text(json.dumps({"god": {"title": "Allah, Tuhan"}, "lord": {"title": "Tuhan"}, "none": {"title": ""}}, indent=2))
    out = {r["strong"]: r["variants"] for r in readers.title_variants(spark, str(tmp_path / "tw.tsv"), str(tmp_path / "articles.json")).collect()}
    assert out == {"H1": [["allah"], ["tuhan"]], "H2": [["allah"], ["tuhan"]], "H4": [["tuhan"]]}
    (tmp_path / "table.json").write_text('{\n"a": "H1",\n"b": "H2"}')
    assert sorted(tuple(r) for r in readers.table_json(spark, str(tmp_path / "table.json"), "lexeme", "to_key").collect()) == [("a", "H1"), ("b", "H2")]
    for name, doc in (("x.json", {"exclude": [{"surface": " Go ", "stem": "qal"}, {"note": "nothing"}]}), ("y.json", [{"base_text": "swe_fol"}])):
        (tmp_path / name).write_text(json.dumps(doc, indent=1))
    rules = readers.exclusions_json(spark, str(tmp_path / "x.json")).unionByName(readers.exclusions_json(spark, str(tmp_path / "y.json")))
    assert sorted((r["surface"] or "", r["stem"] or "", r["base_text"] or "") for r in rules.collect()) == [("", "", "swe_fol"), ("go", "qal", "")]
    rows = spark.createDataFrame([("L", "qal", "1", "go", "a"), ("L", "hif", "1", "go", "a"), ("L", "hif", "1", "x", "swe_fol")], "lexeme string, stem string, sense string, surface string, base_text string")
    assert lexicon.exclude(rows, rules).count() == 1
