"""The registered whole run against independent models of its steps."""

import os
import tempfile

import row_model as RM
from pyspark.sql import functions as F

from storyloom.functions.html import page_body
from storyloom.operators.arrival import arrival_key
from storyloom.operators.filters import prepare_candidates
from storyloom.operators.history import expire, read_history
from storyloom.params import MODEL_FALLBACK_CONTENT, MODEL_FALLBACK_TITLE, MODEL_SUMMARY_SUFFIX, NO_ABSTRACT_PROBE, PAGE_BODY_USABLE
from storyloom.plans import queries as Q
from storyloom.plans.fixture import fixture_params

SF = "/root/testdata/sf0.001"


def test_full_run_equals_the_models(spark):
    p = fixture_params(spark, SF, history_days=1)
    base = tempfile.mkdtemp(prefix="storyloom-test-", dir="/tmp")
    raw = Q.run_inputs(spark, SF, base, p)
    kept = expire(read_history(spark, os.path.join(base, "history")), p.as_of, 1)
    old = {r.url for r in kept.collect()}
    c = prepare_candidates(raw, p, kept)
    items = [r.asDict() for r in c.orderBy(*arrival_key()).collect()]
    top = RM.rank_groups(items, RM.first_fit(items), p.max_news_count)
    html = {r.url: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").select("url", "html").collect()}
    got = Q.REGISTRY["full_run"](spark, SF).collect()
    (digest,) = [r.value for r in got if r.kind == "digest"]
    assert {r.key for r in got if r.kind == "history"} == old | {t["link"] for t in top}
    at = 0
    for t in top:
        body = page_body(html.get(t["link"]))
        text = t["summary"]
        if len(text) < p.short_content_threshold or NO_ABSTRACT_PROBE in text:
            usable = len(body) > PAGE_BODY_USABLE
            text = body if usable else MODEL_FALLBACK_TITLE + t["title"] + MODEL_FALLBACK_CONTENT + t["summary"]
        said = text.split(".")[0].strip()
        summary = said + MODEL_SUMMARY_SUFFIX if said else t["summary"]
        at = digest.index(t["title"], at)
        at = digest.index(summary, at)
    assert len(top) == 15
    assert raw.where(F.col("item_id").isNull()).count() == 0
