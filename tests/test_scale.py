"""What grows with the tables does not reach the driver whole, and blocks of verses give what plain passes give."""

import os
import re

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def many_parts(spark, top):
    """The smallest tables with over 50,000 parts, still few bytes of Parquet."""
    for name in os.listdir(SF):
        if name != "part.parquet":
            os.symlink(f"{SF}/{name}", f"{top}/{name}")
    part = spark.read.parquet(f"{SF}/part.parquet")
    times = 60_000 // part.count() + 1
    part.crossJoin(spark.range(times)).withColumn("p_partkey", F.col("p_partkey") + F.col("id") * 1_000_000).drop("id").coalesce(1).write.parquet(f"{top}/part.parquet")
    return str(top)


def test_many_parts_are_not_sent_to_all(spark, tmp_path):
    from bitextile.plans.proxy import pairs

    d = many_parts(spark, tmp_path)
    assert "Broadcast" not in plan(pairs(spark, d))
    assert pairs(spark, d).count() == pairs(spark, SF).count()


def test_verse_joins_of_gap_filling_are_merges(spark):
    import __spark_entry__ as e

    text = plan(e.queries()["gapfill_scored"](spark, SF))
    assert not re.search(r"BroadcastHashJoin[^\n]*\n(?:[^\n]+\n)*?Left keys \[\d\]: \[ref", text)


def test_links_of_blocks_are_those_of_joins(spark):
    import numpy as np
    from bitextile.operators import em, hmm, kernels
    from bitextile.plans.corpus_queries import parallel

    source, target = parallel(spark, SF)
    v = hmm.verses(source, target, 100)
    assert v.groupBy("block", "side").count().where("count > 1").count() == 0 and "s" not in v.columns  # rounds deal out one row of numbers for each block
    own = em.Trained(v, hmm.word_pairs(v), hmm.model_1(v, hmm.word_pairs(v), 2))
    t = own.t.where("side = 0")
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert rows(own.links()[0]) == rows(em.links(source, target, t.withColumn("t", F.round("t", 9))))
    found = em.candidates(source, target, t, 0.03)
    assert rows(own.candidates(0.03)) == rows(found)
    near = F.abs(F.col("h_idx") - F.col("place") / 2).alias("near")
    plain = kernels.greedy(found.select("ref", "h_idx", F.array("place").alias("t_idx"), F.round("score", 9).alias("score"), near))
    assert rows(own.one_to_one(0.03, lambda h, p: np.abs(h - p / 2)).select("ref", "h_idx", "t_idx")) == rows(plain.select("ref", "h_idx", "t_idx"))


def test_votes_read_the_lines_once(spark):
    import __spark_entry__ as e

    for name in ("merge_vote", "vote_histogram"):
        assert len(re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*lineitem", plan(e.queries()[name](spark, SF)))) == 1, name


def test_compact_files_are_dealt_in_runs_of_verses(spark, tmp_path, monkeypatch):
    import json

    import __spark_entry__ as e
    from bitextile.sources import named

    dealt, save = [], named.save
    monkeypatch.setattr(named, "save", lambda rows, *a, **k: (dealt.append(rows.count()), save(rows, *a, **k)))
    out = e.queries()["compact_files"](spark, SF)
    orders = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey").distinct().count()
    files = out.count()
    assert out.agg(F.sum("rows")).first()[0] == files * orders // 20 and dealt[0] <= files * 3  # not one row for each verse and edition
    spine = spark.createDataFrame([("GEN", r, ["x"]) for r in (-1, 0, 8191, 8192, 20000)], "book string, ref long, lexemes array<string>")
    verses = spark.createDataFrame([("eng", "b", "GEN", "h", r, f'{r}:"') for r in (20000, -1, 8191)], "iso string, edition string, book string, book_hash string, ref long, compact string")
    named.publish_compact(verses, spine, f"{tmp_path}/out", f"{tmp_path}/books")
    assert json.loads((tmp_path / "out/e/eng/b/GEN_h.json").read_text()) == ['-1:"', "", '8191:"', "", '20000:"']
    assert list(json.loads((tmp_path / "books/GEN_lexemes.json").read_text())) == ["-1", "0", "8191", "8192", "20000"]
    assert named.index_of(spark, f"{tmp_path}/out").first()["rows"] == 5


def test_phrase_mates_are_found_with_one_deal_of_each_table(spark):
    from bitextile.operators import gapfill

    source = spark.createDataFrame([(1, h, p, r) for h, p, r in ((0, 1, "rec"), (1, 1, "NA"), (2, None, "NA"), (3, 1, "rec"))], "ref long, h_idx long, phrase_id long, rela string")
    anchors = spark.createDataFrame([(1, 1, 4), (1, 3, 9), (1, 2, 0)], "ref long, h_idx long, anchor long")
    out = gapfill.phrase_expected(source, anchors)
    assert len(re.findall(r"\n\(\d+\) Exchange", plan(out))) == 2
    assert sorted((r["h_idx"], r["p_exp"]) for r in out.collect()) == [(0, 5.0), (1, 8.0), (3, 5.0)]


def test_columns_of_verses_become_lists():
    import pyarrow as pa
    from bitextile.operators.kernels import values

    lists = pa.array([[1, 2], None, [], [3]])
    for a in (lists, lists.slice(1, 3), lists.slice(0, 1), lists.slice(4), pa.array([1, None]), pa.array([1.5]), pa.array([True, False]), pa.array(["a", None, "b", "a"]).slice(1), pa.array([["a"], ["b", None]]), pa.array([], pa.string())):
        assert values(a) == a.to_pylist()


def test_contests_are_told_from_one_pass_over_the_pairs(spark):
    import __spark_entry__ as e

    assert len(re.findall(r"\n\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*lineitem", plan(e.queries()["merge_contest"](spark, SF)))) <= 2


def test_suffix_groups_deal_the_verses_once(spark, tmp_path):
    import __spark_entry__ as e

    text = plan(e.queries()["suffix_groups"](spark, many_parts(spark, tmp_path)))
    assert len(re.findall(r"\n\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*lineitem", text)) == 1
    assert len(re.findall(r"\n\(\d+\) Exchange", text)) == 3  # lines and parts by part, pairs by verse
