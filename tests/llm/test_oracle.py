"""Queries that SQL can express, against their SQL on the smallest tables; the others are held against brute force."""

import pytest

from oracle_compare import compare, duck_connect, first_difference
from pos360.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
#: DuckDB has no boosted trees, XXH64, Viterbi paths, binomial tests, draws or recursive links, and no one right text of a page.
NO_SQL = {"op2_tag_path_extraction", "op3_boosted_tree_quality", "op4_simhash_byte_index", "op5_sentencepiece_unigram",
          "op7_risk_controlled_rules", "op9_hypergeometric_shards", "op10_quotation_threads"}


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_DIR)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLE) == NO_SQL and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, con, key):
    df = QUERIES[key](spark, SF_DIR)
    r = compare(df, con, ORACLE[key])
    assert r["ok"], (r, first_difference(df, con, ORACLE[key]))
