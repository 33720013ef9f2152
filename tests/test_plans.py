"""Plans of registered queries over the smallest tables: pruned scans, no products of tables, no lost SQL."""

import os
import re

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(spark, name):
    import __spark_entry__ as e

    return e.queries()[name](spark, SF)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", ["lexicon_additive_union", "mwe_contiguous", "senses_attested", "head_to_head", "tier_precision", "merge_vote", "merge_contest", "recipe_gap", "interpolate_position", "coherence", "stopwords", "gapfill_fill"])
def test_no_products_of_tables(spark, name):
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan(spark, name))


def test_scans_are_pruned(spark):
    text = plan(spark, "lexicon_additive_union")
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    assert schemas and not any("l_shipdate" in s or "p_retailprice" in s or "l_extendedprice" in s for s in schemas)
    assert len(re.findall(r"\(\d+\) Window\n", text)) == 1  # the share; the places of source tokens are pruned



def test_every_key_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.oracle_sql()) >= 70


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


def test_results_match_sql_on_small_tables(spark):
    """A sample of queries against DuckDB, value by value."""
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as e

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents labels benchmark conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name in ("lexicon_additive_union", "senses_excluded", "merge_trust", "ibm1_em_3", "phrase_expected", "link_components", "canonical_hash"):
        ours = e.queries()[name](spark, SF).toPandas()
        theirs = con.execute(e.oracle_sql()[name]).df()
        key = lambda df: sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))
        assert key(ours) == key(theirs), name
