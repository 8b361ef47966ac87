"""Physical-plan properties the design relies on (checked without running
the heavy parts): pushdown and pruning, partial top-n, no nested-loop or
cartesian joins in the grouping plans."""

import re

from storyloom.operators.asof import latest_before
from storyloom.operators.candidates import containment_pairs, distinct_keys, ratio_pairs
from storyloom.plans.queries import REGISTRY, candidates

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_recency_pushed_to_scan_and_columns_pruned(spark):
    p = plan(candidates(spark, SF))
    assert "GreaterThanOrEqual(ts," in p
    assert "n_chars" not in p  # documents read without unused columns
    assert "props" not in p and "event_type" not in p  # events pruned


def test_per_source_cap_is_a_partial_window_group_limit(spark):
    p = plan(REGISTRY["per_source_cap"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_grouping_plans_have_no_nested_loop_or_cartesian_joins(spark):
    keys = spark.createDataFrame([("", "abcdefg"), ("", "xabcdefgy"), ("", "hello")],
                                 "digest_key string, key string")
    k = distinct_keys(keys)
    items = spark.createDataFrame([("", "a", 1), ("", "a", 5), ("", "b", 3)],
                                  "digest_key string, g string, ord long")
    for df in (containment_pairs(k), ratio_pairs(k, 0.65),
               latest_before(items, items, ["digest_key", "g"], bucket_bits=1)):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_as_of_windows_are_bounded_by_bucket(spark):
    items = spark.createDataFrame([("", "a", 1)], "digest_key string, g string, ord long")
    p = plan(latest_before(items, items, ["digest_key", "g"], bucket_bits=4))
    # the per-row window is partitioned by the key *and* the bucket
    assert re.search(r"Window \[.*\], \[digest_key#\d+, g#\d+, __b#\d+L?\]", p), p


def test_ranking_shuffles_carry_no_texts(spark):
    from storyloom.operators.ranking import rank_keys, top_groups
    cols = ("item_id long, site string, title string, link string, summary string, pub_time timestamp, "
            "pub_date date, comments long, kw_score int, ord long, digest_key string, leader_ord long")
    members = spark.createDataFrame([], cols)
    members = members.join(spark.range(3).withColumnRenamed("id", "leader_ord"), "leader_ord")
    p = plan(top_groups(rank_keys(members), 5))
    assert "Exchange" in p and "summary" not in p.split("Scan")[0] and "title" not in p.split("Scan")[0]


def test_texts_are_searched_behind_the_joins_and_titles_are_cut_ahead_of_them(spark):
    """Keywords are looked for in articles that are recent, not in all documents; titles alone shuffle no whole texts."""
    p = REGISTRY["candidates"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {name: [i for i, line in enumerate(p) if name in line] for name in ("ArrowEvalPython", "Join Inner")}
    assert depth["ArrowEvalPython"] and max(depth["ArrowEvalPython"]) < min(depth["Join Inner"])
    from storyloom.sources.tables import articles
    p = articles(spark, SF).select("item_id", "title")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = min(i for i, line in enumerate(p) if "Join" in line)
    assert not any("text#" in line for line in p[:first + 1]) and any("substring_index" in line for line in p[first + 1:])
