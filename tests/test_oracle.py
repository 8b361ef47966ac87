"""Registered queries vs their DuckDB oracle on the smallest scale factor
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import SPARK_TO_DUCK, TABLES, digest_rows  # noqa: E402

SF = "/root/testdata/sf0.001"
FAST = ["recent_articles", "short_summary", "exclude_keywords", "keyword_score", "candidates",
        "title_key", "no_abstract_marker", "comment_count", "published_time", "site_label",
        "domain_filter", "per_source_cap", "html_text", "link_pairs", "containment_pairs",
        "candidate_stats", "source_counts", "unseen_articles", "history_expire",
        "history_expired", "model_input", "model_requests", "summary_overlay", "digest_empty",
        "top_stories", "digest_lines", "story_components", "stream_dedupe", "site_trend",
        "feed_items", "search_items", "model_replies", "model_ledger", "full_run_components"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_a_callable_and_oracles_are_registered():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 40


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    types = {f.name: SPARK_TO_DUCK.get(f.dataType.typeName()) for f in df.schema.fields}
    assert types == {d[0]: str(d[1]) for d in res.description}
    assert len(srows) == len(drows)
    assert digest_rows(df.columns, srows)[0] == digest_rows(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10 + 5
    assert "cluster_id" in df.columns and "links" in df.columns
