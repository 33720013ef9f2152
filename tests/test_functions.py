"""Keys, text and similarity functions on small examples."""

import pytest
from pyspark.sql import functions as F

from bitextile.functions import keys as K
from bitextile.functions import similarity as S
from bitextile.functions import text as T


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_verse_refs(spark):
    ref = lambda b, c, v: value(spark, K.verse_ref(F.lit(b), F.lit(c), F.lit(v)))
    assert ref("GEN", 1, 1) == 1001001
    assert ref("RUT", 1, 16) == 8001016
    with pytest.raises(Exception, match="no verse"):
        ref("GEN", 0, 1)
    assert value(spark, K.try_verse_ref(F.lit("XXX"), F.lit(1), F.lit(1))) is None
    assert tuple(value(spark, K.parse_ref(F.lit("GEN 3:16")))) == ("GEN", 3, 16)


def test_number_keys(spark):
    assert value(spark, K.strong_of(F.lit("hbo:6498a"))) == "H6498"
    assert value(spark, K.strong_of(F.lit("grc:26"))) == "G0026"
    assert value(spark, K.norm_strong(F.lit("hbo:0430"))) == "H0430"
    assert value(spark, K.norm_strong(F.lit("7225"))) == "H7225"
    assert value(spark, K.norm_strong(F.lit("x"))) is None
    assert value(spark, K.padded_strong(F.lit(40), F.lit(26))) == "G0026"
    assert value(spark, K.padded_strong(F.lit(1), F.lit(0))) is None
    assert value(spark, K.fallback_lexeme(F.lit("H0001"), F.lit("ab"))) == "H0001|ab"
    assert value(spark, K.fallback_lexeme(F.lit(None).cast("string"), F.lit("ab"))) == "ab"
    assert value(spark, K.edition_id(F.lit("ind"), F.lit("IND_tb"))) == "IND_tb"
    assert value(spark, K.edition_tag(F.lit("ind"), F.lit("ind"))) == "ind_2"


def test_tokens(spark):
    tok = lambda t: value(spark, T.tokens(F.lit(t)))
    assert tok("Selama 40 hari") == ["Selama", "hari"]
    assert len(tok("فِي")) == 1
    assert tok("दाऊद") == ["दाऊद"]
    assert tok("") == []
    assert value(spark, T.strip_notes(F.lit("a [b [c] d] e"))).split() == ["a", "e"]
    assert "[" in value(spark, T.strip_notes(F.lit("a [b c")))
    assert value(spark, T.norm_surface(F.lit("«Straße!»"))) == "strasse"
    assert value(spark, T.variants(F.lit("Anak perempuan; putri atau gadis"))) == [["anak", "perempuan"], ["putri"], ["gadis"]]
    assert value(spark, T.base_marker(F.lit("q12"))) == "q"
    assert value(spark, T.affix_forms(F.lit("Menulisnya"), ["nya"], ["me"]))[0] == "menulisnya"


def test_scores(spark):
    name = lambda a, b: value(spark, S.name_score(F.lit(a), F.lit(b)))
    word = lambda a, b: value(spark, S.word_score(F.array(*map(F.lit, a)), F.array(*map(F.lit, b))))
    assert name("Ruth", "Rut") == 0.92
    assert name("Boaz", "Boas") == 0.92
    assert name("Ruth", "ruth") == 0.98
    assert word(["rumah"], ["rumah"]) == 1.0
    assert word(["rumahnya", "rumah"], ["rumahku", "rumah"]) == 0.9
    assert word(["isteri"], ["istri"]) == 0.6
    assert word(["kata"], ["batu"]) == 0.0
    assert value(spark, S.edit_distance(F.lit("abc"), F.lit("xyzzy"))) == 4
    assert value(spark, S.wilson(F.lit(0), F.lit(0))) == 0
    assert abs(value(spark, S.wilson(F.lit(10), F.lit(10))) - 0.722) < 1e-3
    assert value(spark, S.lexical_agree(F.array(F.lit("house")), F.array(F.lit("houses")))) is True


def test_spans(spark):
    enc = lambda x: value(spark, S.encode_span(F.array(*map(F.lit, x))))
    dec = lambda x: value(spark, S.decode_span(F.lit(x)))
    for idx, text in (([5], "5"), ([5, 6], "5-6"), ([6, 4], "4,6")):
        assert enc(idx) == text
        assert dec(text) == sorted(idx)
    contiguous = lambda x: value(spark, S.contiguous(F.array(*map(F.lit, x))))
    assert contiguous([3, 4]) and not contiguous([4, 6]) and not contiguous([3])


def test_notes_of_any_depth_and_composed_forms(spark):
    assert value(spark, T.strip_notes(F.lit("a" + "[" * 12 + "x" + "]" * 12))).strip() == "a"
    assert value(spark, T.strip_notes(F.lit("a [x [y] z] b ] [c"))) == "a   b ] [c"
    assert value(spark, T.composed(F.lit("é"))) == "é" and value(spark, T.composed(F.lit("plain é"))) == "plain é"
