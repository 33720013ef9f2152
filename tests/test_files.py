"""Files of their own names, kept results, USFM, and the stream of signed counts."""

import hashlib
import itertools
import json
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from bitextile.functions import normalizers
from bitextile.operators import gloss
from bitextile.sources import artefacts, named, readers, usfm
from bitextile.streaming import retractions


def tree(top):
    return sorted(os.path.relpath(os.path.join(d, f), top) for d, _, fs in os.walk(top) for f in fs if not f.endswith(".crc"))


# -- named files


def test_files_have_their_names_and_an_index(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id")).repartition(5)
    named.save(rows, str(tmp_path), F.format_string("a/%d.json", "k"), named.quoted(F.concat(F.lit('x"é\n'), F.col("id").cast("string"))), ["id"])
    assert tree(tmp_path) == [f"a/{k}.json" for k in range(7)] + ["index.json"]
    for r in named.index_of(spark, str(tmp_path)).collect():
        data = (tmp_path / r["file"]).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
        k = int(r["file"][2])
        assert json.loads(data) == [f'x"é\n{i}' for i in range(1000) if i % 7 == k] and r["rows"] == len(json.loads(data))


def test_a_second_job_adds_or_replaces(spark, tmp_path):
    one = lambda name, mode: named.save(spark.range(2), str(tmp_path), F.lit(name), F.col("id").cast("string"), ["id"], mode=mode)
    one("a.json", "append")
    one("b.json", "append")
    assert tree(tmp_path) == ["a.json", "b.json", "index.json"]
    one("c.json", "overwrite")
    assert tree(tmp_path) == ["c.json", "index.json"]


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    @F.udf("string")
    def fails(i):
        if i == 977:
            raise ValueError("no")
        return str(i)

    with pytest.raises(Exception, match="no"):
        named.save(spark.range(1000), str(tmp_path), F.format_string("%d.json", F.col("id") % 5), fails("id"), ["id"])
    assert tree(tmp_path) == []


def test_what_repeated_tasks_left_goes_on_commit(tmp_path):
    import pyarrow as pa

    w = named.NamedWriter({"path": str(tmp_path)}, False)
    batch = lambda *names: iter([pa.RecordBatch.from_arrays([pa.array(list(names)), pa.array(["1"] * len(names))], ["file", "piece"])])
    w.write(batch("a", "b"))  # an attempt that was lost after it wrote
    w.commit([w.write(batch("a", "b")), None, w.write(batch("c"))])
    assert tree(tmp_path) == ["a", "b", "c"] and not [x for x in os.listdir(tmp_path) if x.startswith("_job")]
    w = named.NamedWriter({"path": str(tmp_path)}, False)
    with pytest.raises(ValueError, match="two tasks"):
        w.commit([w.write(batch("d")), w.write(batch("d"))])
    assert tree(tmp_path) == ["a", "b", "c"]


def test_compact_files_follow_the_index_of_their_book(spark, tmp_path):
    spine = spark.createDataFrame([("GEN", r, [f"L{r}"]) for r in (3, 1, 2)] + [("MAT", 9, ["x"])], "book string, ref long, lexemes array<string>")
    verses = spark.createDataFrame([("eng", "bsb", "GEN", "abcde", 1, "0:1"), ("eng", "bsb", "GEN", "abcde", 3, "2:2")], "iso string, edition string, book string, book_hash string, ref long, compact string")
    named.publish_compact(verses, spine, f"{tmp_path}/out", f"{tmp_path}/books")
    assert tree(tmp_path) == ["books/GEN_lexemes.json", "books/index.json", "out/e/eng/bsb/GEN_abcde.json", "out/index.json"]
    assert json.loads((tmp_path / "out/e/eng/bsb/GEN_abcde.json").read_text()) == ["0:1", "", "2:2"]
    assert json.loads((tmp_path / "books/GEN_lexemes.json").read_text()) == {"1": ["L1"], "2": ["L2"], "3": ["L3"]}


# -- kept results


def test_results_are_kept_until_an_input_or_a_setting_changes(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/in")
    calls = []

    def get(settings):
        data = spark.read.parquet(f"{tmp_path}/in")

        def build():
            calls.append(settings)
            return data.agg(F.sum("id").alias("s"))

        return artefacts.kept(spark, f"{tmp_path}/kept", "sums", [data], settings, build).first()["s"]

    assert (get({"a": 1}), get({"a": 1}), len(calls)) == (45, 45, 1)
    assert (get({"a": 2}), len(calls)) == (45, 2)
    spark.range(10, 11).write.mode("append").parquet(f"{tmp_path}/in")
    assert (get({"a": 1}), len(calls)) == (55, 3)
    assert not [x for x in os.listdir(f"{tmp_path}/kept/sums") if x.startswith(".") and not x.endswith(".crc")]


def test_inputs_without_files_are_known_by_their_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, t string")
    assert artefacts.files_digest(df) is None
    assert artefacts.rows_digest(df) == artefacts.rows_digest(df.orderBy(F.desc("k"))) != artefacts.rows_digest(df.union(df))
    assert artefacts.rows_digest(df) != artefacts.rows_digest(spark.createDataFrame([(1, None), (2, "a")], "k int, t string"))


def test_two_writers_of_one_result(spark, tmp_path):
    gate, out = threading.Barrier(2), []

    def build():
        gate.wait(60)
        return spark.range(5)

    one = lambda: out.append(artefacts.kept(spark, str(tmp_path), "r", [spark.range(3)], {}, build).count())
    threads = [threading.Thread(target=one) for _ in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert out == [5, 5] and len([x for x in os.listdir(f"{tmp_path}/r") if not x.startswith(".")]) == 1


# -- USFM


def both(r):
    """A random book as a USJ tree and as USFM."""
    words = iter(range(10_000))
    text = lambda: " ".join(f"w{next(words)}" for _ in range(r.randint(1, 3)))
    usj, lines, verse = [{"type": "book", "marker": "id", "code": "GEN", "content": ["a title"]}], ["\\id GEN a title"], 0

    def inline(depth=0):
        out, raw = [], ""
        for _ in range(r.randint(1, 3)):
            kind = r.choice(["text", "add", "note", "nest", "va", "w"])
            t = text()
            if kind == "text" or depth:
                out.append(t)
                raw += t + " "
            elif kind == "note":
                out.append({"type": "note", "marker": "f", "content": [{"type": "char", "marker": "ft", "content": [t]}]})
                raw += f"\\f + \\ft {t}\\f* "
            elif kind == "nest":
                out.append({"type": "char", "marker": "add", "content": [t, {"type": "char", "marker": "nd", "content": [u := text()]}, v := text()]})
                raw += f"\\add {t} \\+nd {u}\\+nd* {v}\\add* "
            elif kind == "w":
                out.append({"type": "char", "marker": "w", "content": [t]})
                raw += f'\\w {t}|lemma="x" strong="H1"\\w* '
            else:
                out.append({"type": "char", "marker": kind, "content": [t]})
                raw += f"\\{kind} {t}\\{kind}* "
        return out, raw

    for chapter in range(1, 4):
        usj.append({"type": "chapter", "marker": "c", "number": str(chapter)})
        lines.append(f"\\c {chapter}")
        verse = 0
        for _ in range(r.randint(1, 4)):
            marker = r.choice(["p", "q1", "s1", "m", "d", "pi2", "b"])
            content, raw = inline() if verse and r.random() < 0.5 else ([], "")
            if marker in ("s1", "d"):
                content, raw = inline()
            else:
                for _ in range(r.randint(0, 3) if marker != "b" else 0):
                    verse += 1
                    number = f"{verse}-{verse + 1}" if r.random() < 0.2 else str(verse)
                    verse += "-" in number
                    own, more = inline()
                    content = [*content, {"type": "verse", "marker": "v", "number": number}, *own]
                    raw += f"\n\\v {number} {more}"
            usj.append({"type": "para", "marker": marker, "content": content})
            lines.append(f"\\{marker} {raw}")
    return {"type": "USJ", "content": usj}, "\n".join(lines) + "\n"


@pytest.mark.parametrize("seed", range(25))
def test_usfm_gives_the_pieces_of_the_same_tree(seed):
    tree_, text = both(random.Random(seed))
    joined = lambda ps: [(k, " ".join(p[3] for p in g)) for k, g in itertools.groupby(ps, key=lambda p: p[:3])]
    assert joined(p[1:] for p in usfm.pieces(text)) == joined(readers.walk_usj(tree_))
    assert {p[0] for p in usfm.pieces(text)} <= {"GEN"}


def test_unclosed_markers_end_with_their_paragraph_or_verse():
    text = "\\id EXO x\n\\c 2\n\\p\n\\v 1 a \\f + \\ft lost\n\\v 2 b \\add c\n\\v 3 d \\x - lost\n\\q e \\s head \\v 9 no\n\\p f\\add* g\n\\v 4~h // i \\zaln-s |x=\"y\"\\*j\\zaln-e\\*"
    got = {}
    for _, c, v, _, t in usfm.pieces(text):
        got.setdefault((c, v), []).append(t)
    assert {k: " ".join(v) for k, v in got.items()} == {(2, 1): "a", (2, 2): "b c", (2, 3): "d e f g", (2, 4): "h i j"}
    assert list(usfm.pieces("")) == [] and list(usfm.pieces("\\c x \\v \\p")) == []


def test_verses_go_to_usfm_and_back(spark, tmp_path):
    rows = [("GEN", 1, 1, " In the beginning "), ("GEN", 1, 2, ""), ("GEN", 1, 10, "ten"), ("GEN", 2, 1, "two"), ("EXO", 1, 1, None), ("EXO", 1, 3, "three")]
    made = usfm.rendered(spark.createDataFrame(rows, "book string, chapter int, verse int, text string"))
    assert made.where("book = 'GEN'").first()["usfm"] == "\\id GEN\n\\c 1\n\\p\n\\v 1 In the beginning\n\\v 10 ten\n\\c 2\n\\p\n\\v 1 two\n"
    back = usfm.verses(usfm.parsed(made.select(F.col("book").alias("file"), F.col("usfm").alias("value"))))
    assert sorted((r["book"], r["chapter"], r["verse_start"], r["text"]) for r in back.collect()) == sorted((b, c, v, t.strip()) for b, c, v, t in rows if t)
    (tmp_path / "x.usfm").write_text(made.where("book = 'EXO'").first()["usfm"])
    assert [(r["file"], r["book"], r["text"]) for r in usfm.usfm_pieces(spark, str(tmp_path)).collect()] == [("x.usfm", "EXO", "three")]


# -- signed counts

LEX = "edition string, sha string, surface string, method string, base_text string, lexeme string, count long, high long"


def state(spark, **editions):
    return spark.createDataFrame([(e, sha, s, "m", "b", x, n, h) for e, (sha, rows) in editions.items() for s, x, n, h in rows], LEX)


def test_replaced_and_deleted_editions_give_the_batch_table(spark, tmp_path):
    states = [
        state(spark),
        state(spark, A=("1", [("go", "L1", 3, 1), ("go", "L2", 1, 1), ("house", "L3", 5, 5)]), B=("1", [("go", "L1", 1, 0), ("tree", "L4", 2, 2)])),
        state(spark, A=("2", [("go", "L1", 1, 1), ("house", "L3", 5, 5), ("new", "L5", 1, 0)]), B=("1", [("go", "L1", 99, 0)])),  # B has the old digest: it counts as unchanged
        state(spark, C=("1", [("house", "L3", 1, 1)])),
    ]
    states[2] = state(spark, A=("2", [("go", "L1", 1, 1), ("house", "L3", 5, 5), ("new", "L5", 1, 0)]), B=("1", [("go", "L1", 1, 0), ("tree", "L4", 2, 2)]))
    touched = []
    for old, new in zip(states, states[1:], strict=False):
        signed = retractions.signed_counts(old, new)
        touched.append({r["surface"] for r in signed.collect()})
        signed.coalesce(1).write.mode("append").parquet(f"{tmp_path}/signed")
        retractions.advance(spark, f"{tmp_path}/signed", str(tmp_path))
        sums = new.groupBy("surface", "method", "base_text", "lexeme").agg(F.sum("count").alias("count"), F.sum("high").alias("high"))
        want = {(r["surface"], r["lexeme"], r["count"], r["high"]) for r in sums.collect()}
        rows = retractions.lexicon(spark, str(tmp_path)).collect()
        assert {(r["surface"], r["lexeme"], r["count"], r["high"]) for r in rows} == want
        total = {}
        for r in rows:
            total[r["surface"]] = total.get(r["surface"], 0) + r["count"]
        assert all(r["share"] == r["count"] / total[r["surface"]] and r["hi_conf"] == r["high"] / r["count"] for r in rows)
    assert touched == [{"go", "house", "tree"}, {"go", "new"}, {"go", "house", "tree", "new"}]  # house kept its count in the second
    counts = {r["batch"]: r["rows"] for r in retractions.recomputed(spark, str(tmp_path)).collect()}
    assert counts == {0: 4, 1: 3, 2: 4}  # go: L1, and L2 gone; new: L5
    retractions.advance(spark, f"{tmp_path}/signed", str(tmp_path))  # nothing new: nothing is read again
    assert {r["batch"] for r in retractions.recomputed(spark, str(tmp_path)).collect()} == {0, 1, 2}


# -- normalizers by language


def test_one_job_serves_languages_with_rules_of_their_own(spark):
    words = spark.createDataFrame([("ind", "Mengatakannya"), ("ind", "itu"), ("eng", "walking"), ("xxx", "Walking"), ("eng", None)], "iso string, word string")
    forms = normalizers.forms_table(words, normalizers.REGISTERED | {"eng": normalizers.Affixes(("ing",))})
    got = {(r["iso"], r["word"]): r["forms"] for r in forms.collect()}
    assert got == {("ind", "mengatakannya"): ["mengatakannya", "ngatakannya", "gatakannya", "mengatakan", "atakannya", "ngatakan", "gatakan", "atakan"], ("ind", "itu"): ["itu"], ("eng", "walking"): ["walking", "walk"], ("xxx", "walking"): ["walking"]}
    source = spark.createDataFrame([("eng", 1, 0, "H1", "L1", None, False), ("xxx", 2, 0, "H1", "L1", None, False)], "iso string, ref long, h_idx long, strong string, lexeme string, gloss_en string, is_name boolean")
    target = spark.createDataFrame([("eng", 1, 0, "walking", False), ("xxx", 2, 0, "walking", False)], "iso string, ref long, place long, token string, blocked boolean")
    priors = spark.createDataFrame([("eng", "H1", [["walk"]]), ("xxx", "H1", [["walk"]])], "iso string, strong string, variants array<array<string>>")
    assert {r["ref"]: r["method"] for r in gloss.align(source, target, priors, forms=forms).collect()} == {1: "stem", 2: "prefix"}
    normalizers.register("eng", lambda w: [w.lower(), "same"])
    try:
        assert {tuple(r["forms"]) for r in normalizers.forms_table(words.where("iso = 'eng'")).collect()} == {("walking", "same")}
    finally:
        normalizers.REGISTERED.pop("eng")


def test_files_of_many_lines_are_read_whole(spark, tmp_path):
    tree_, _ = both(random.Random(1))
    (tmp_path / "01-GEN.json").write_text(json.dumps(tree_, indent=1))
    rows = readers.usj_pieces(spark, str(tmp_path / "*.json")).orderBy("piece").collect()
    assert [(r["chapter"], r["verse_start"], r["verse_end"], r["text"]) for r in rows] == list(readers.walk_usj(tree_))
    (tmp_path / "rules").mkdir()
    (tmp_path / "rules" / "r.json").write_text('{\n "a | b": "ef",\n "c | d": "gl"\n}')
    assert sorted(tuple(r) for r in readers.rules_json(spark, str(tmp_path / "rules")).collect()) == [("a", "b", "ef"), ("c", "d", "gl")]


# -- readers and writers of plain files


def test_gold_chapter_ends_titles_and_tables_of_tabs(spark, tmp_path):
    from bitextile.functions import text as T
    from bitextile.sources import sinks

    (tmp_path / "gold.tsv").write_text("# a comment\nref\tsurface\tstrong\tbase_text\n010010010001\tGo,\tH1\tbsb\n010010010002\tgo\tH2\tbsb\n010010020001\tGo\tH1\tweb\n")
    gold = readers.gold_tsv(spark, str(tmp_path / "gold.tsv"))
    assert [tuple(r) for r in readers.gold_sets(gold, "strong").collect()] == [("go", ["H1", "H2"], 3)]
    assert [tuple(r) for r in readers.gold_sets(gold, "strong", "web").collect()] == [("go", ["H1"], 1)]
    assert sorted((r["ref"], r["strong"], r["surfaces"]) for r in readers.gold_positions(gold).collect()) == [("01001001", "H1", ["go"]), ("01001001", "H2", ["go"]), ("01001002", "H1", ["go"])]

    pieces = spark.createDataFrame([("01-GEN.json", 0, 1, 1, 2, "a"), ("01-GEN.json", 1, 1, 5, 7, "b"), ("02-EXO.json", 0, 3, 4, 4, "c")], "file string, piece int, chapter int, verse_start int, verse_end int, text string")
    assert sorted(tuple(r) for r in readers.chapter_ends(pieces).collect()) == [("EXO", 3, 4), ("GEN", 1, 7)]
    assert spark.range(1).select(T.title_words(F.lit("Anak Allah (2), Yesus"))).first()[0] == ["anak", "allah", "yesus"]

    sinks.tsv(spark.createDataFrame([("a", 1), ("b", None)], "k string, n int").coalesce(1), str(tmp_path / "out"))
    lines = [x for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == ["k\tn", "a\t1", 'b\t""'] or lines == ["k\tn", "a\t1", "b\t"]


def test_compact_folders_hold_verses_in_order(spark, tmp_path):
    from bitextile.sources import sinks

    verses = spark.createDataFrame([("eng", "bsb", "GEN", "abcde", r, f"0:{r}") for r in (3, 1, 2)] + [("eng", "bsb", "EXO", "11111", 9, "")], "iso string, edition string, book string, book_hash string, ref long, compact string")
    sinks.compact(verses, str(tmp_path / "c"))
    files = sorted((tmp_path / "c").rglob("*.json"))
    assert [f.parent.relative_to(tmp_path / "c").as_posix() for f in files] == ["iso=eng/edition=bsb/file=EXO-11111", "iso=eng/edition=bsb/file=GEN-abcde"]
    assert [json.loads(x)["compact"] for x in files[1].read_text().splitlines()] == ["0:1", "0:2", "0:3"]
