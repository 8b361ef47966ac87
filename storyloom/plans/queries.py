"""Registered queries: one per operator group, each over the whole driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame. The
matching DuckDB statements live in :mod:`storyloom.plans.oracle`; column
names agree one to one. Timestamps leave as TIMESTAMP_NTZ (wall time in
UTC), the type DuckDB's ``TIMESTAMP`` has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions.text import short_summary
from storyloom.operators import filters
from storyloom.operators.materialize import materialize
from storyloom.plans.fixture import fixture_params
from storyloom.sources.tables import articles

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def ntz(c):
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")


def candidates(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    p = fixture_params(spark, sf_dir, **kw)
    return filters.prepare_candidates(articles(spark, sf_dir), p)


@register("recent_articles")
def q_recent_articles(spark, sf_dir):
    p = fixture_params(spark, sf_dir)
    return filters.recent(articles(spark, sf_dir), p).select(
        "item_id", "site", "title", "link", ntz("pub_time").alias("pub_time"))


@register("short_summary")
def q_short_summary(spark, sf_dir):
    s = short_summary("content", 300)
    return articles(spark, sf_dir).select("item_id", s.alias("summary"),
                                          F.length(s).cast("bigint").alias("summary_len"))


@register("exclude_keywords")
def q_exclude_keywords(spark, sf_dir):
    p = fixture_params(spark, sf_dir)
    a = filters.with_summary(articles(spark, sf_dir), p)
    return filters.exclude(a, p).select("item_id", "title")


@register("keyword_score")
def q_keyword_score(spark, sf_dir):
    p = fixture_params(spark, sf_dir)
    a = filters.with_summary(articles(spark, sf_dir), p)
    return filters.score(a, p).select("item_id", "kw_score")


@register("candidates")
def q_candidates(spark, sf_dir):
    return candidates(spark, sf_dir).select(
        "item_id", "site", "title", "link", "summary", ntz("pub_time").alias("pub_time"),
        "pub_date", "comments", "kw_score")


# ---------------------------------------------------------------- helpers
def _top_columns(top: DataFrame) -> DataFrame:
    from storyloom.functions.render import link_line
    return top.select(
        F.col("rank").cast("bigint").alias("rank"),
        F.col("leader_item_id").alias("cluster_id"), "item_id", "site", "title", "link",
        "summary", ntz("pub_time").alias("pub_time"), "pub_date", "kw_score", "comments",
        "multi_source_bonus", "source_count", link_line("link", "other_links").alias("links"))


def _groups(spark, sf_dir, exact: bool, use_ratio: bool, digest_key=None):
    from storyloom.plans.batch import group_stories
    p = fixture_params(spark, sf_dir)
    c = materialize(filters.prepare_candidates(articles(spark, sf_dir), p), "candidates")  # the sort reads them twice
    return c, group_stories(c, p, exact=exact, digest_key=digest_key, use_ratio=use_ratio)


def _ranked(spark, sf_dir, exact=False, use_ratio=False, digest_key=None):
    from storyloom.operators.ranking import rank_groups
    c, members = _groups(spark, sf_dir, exact, use_ratio, digest_key)
    return c, rank_groups(members)


def top_components(spark, sf_dir, digest_key=None):
    """C7 on link + containment edges -> T2 -> T3."""
    from storyloom.plans.batch import select_top_stories
    p = fixture_params(spark, sf_dir)
    c = materialize(filters.prepare_candidates(articles(spark, sf_dir), p), "candidates")
    return c, materialize(select_top_stories(c, p, exact=False, digest_key=digest_key, use_ratio=False), "top")


# ---------------------------------------------------------------- scalars
@register("title_key")
def q_title_key(spark, sf_dir):
    from storyloom.functions.text import title_key
    return articles(spark, sf_dir).select("item_id", title_key("title").alias("key"))


@register("no_abstract_marker")
def q_no_abstract_marker(spark, sf_dir):
    # the page URL plays the feed URL; marked: one site name and one URL part
    from storyloom.sources.tables import table
    p = fixture_params(spark, sf_dir, marker_sites=("src3",), marker_url_parts=("blog.",))
    pg = table(spark, sf_dir, "pages").select(F.col("page_id").alias("item_id"),
                                              F.col("url").alias("page_url"))
    a = articles(spark, sf_dir).join(pg, "item_id", "left") \
        .withColumn("feed_url", F.coalesce("page_url", F.lit("")))
    a = filters.apply_marker(filters.with_summary(a, p), p)
    return a.select("item_id", "summary")


@register("comment_count")
def q_comment_count(spark, sf_dir):
    from storyloom.sources.tables import table
    ev = table(spark, sf_dir, "events")
    cc = filters.comment_count
    return ev.select("event_id",
                     cc("props").alias("from_props"),
                     cc(F.col("value").cast("string")).alias("from_value"),
                     cc(F.floor("value").cast("string")).alias("from_floor"),
                     cc(F.get_json_object("props", "$.k")).alias("from_k"))


@register("published_time")
def q_published_time(spark, sf_dir):
    """F2/X15 on RFC 822, ISO and junk texts made from ``events.ts``."""
    from storyloom.functions.time import resolve_feed_time
    from storyloom.sources.tables import table
    p = fixture_params(spark, sf_dir)
    ev = table(spark, sf_dir, "events").select("event_id", "event_type",
                                               F.col("ts").cast("timestamp").alias("ts"))
    rfc = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss")
    text = (F.when(F.col("event_type") == "signup", F.concat(rfc, F.lit(" +0800")))
            .when(F.col("event_type") == "view", F.concat(rfc, F.lit(" GMT")))
            .when(F.col("event_type") == "purchase", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(F.col("event_type") == "click", F.lit("not a date"))
            .otherwise(F.lit(None).cast("string")))
    updated = F.when(F.col("event_type") == "error", rfc.substr(F.lit(6), F.lit(100)))
    return ev.select("event_id", ntz(resolve_feed_time(text, F.concat(updated, F.lit(" -0100")),
                                                       p.as_of)).alias("pub_time"))


@register("site_label")
def q_site_label(spark, sf_dir):
    from storyloom.functions.url import netloc, search_site_label
    from storyloom.sources.tables import table
    pg = table(spark, sf_dir, "pages")
    return pg.select("page_id", netloc("url").alias("netloc"),
                     search_site_label("url").alias("site"))


@register("domain_filter")
def q_domain_filter(spark, sf_dir):
    from storyloom.sources.search import restrict_domains
    from storyloom.sources.tables import table
    pg = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("link"))
    return restrict_domains(pg, ("example.net", "Example.COM")).select("page_id", "link")


@register("per_source_cap")
def q_per_source_cap(spark, sf_dir):
    from storyloom.sources.search import cap_per_source
    a = articles(spark, sf_dir)
    return cap_per_source(a, 10).select("item_id", "site", F.col("position").cast("bigint"))


@register("html_text")
def q_html_text(spark, sf_dir):
    from storyloom.functions.text import html_to_text_native
    from storyloom.sources.tables import table
    return table(spark, sf_dir, "pages").select("page_id", html_to_text_native("html").alias("text"))


@register("html_text_dom")
def q_html_text_dom(spark, sf_dir):
    from storyloom.functions.html import html_text_dom
    from storyloom.sources.tables import table
    return table(spark, sf_dir, "pages").select("page_id", html_text_dom("html").alias("text"))


@register("page_body")
def q_page_body(spark, sf_dir):
    from storyloom.functions.html import page_body_dom
    from storyloom.sources.tables import table
    return table(spark, sf_dir, "pages").select("page_id", page_body_dom("html").alias("body"))


# ---------------------------------------------------------------- grouping
@register("link_pairs")
def q_link_pairs(spark, sf_dir):
    """Same-link chain edges (each item -> previous item with its link).
    The link variant is the page's host, else the site's front page."""
    from storyloom.functions.url import netloc
    from storyloom.operators.arrival import with_arrival_order
    from storyloom.operators.asof import latest_before
    from storyloom.sources.tables import table
    p = fixture_params(spark, sf_dir)
    pg = table(spark, sf_dir, "pages").select(F.col("page_id").alias("item_id"),
                                              F.col("url").alias("page_url"))
    a = articles(spark, sf_dir).join(pg, "item_id", "left").withColumn(
        "link", F.when(F.col("page_url").isNotNull(), F.concat(F.lit("https://"), netloc("page_url")))
        .otherwise(F.concat(F.lit("https://"), F.col("site"), F.lit(".example/"))))
    o = with_arrival_order(filters.recent(a, p))
    e = latest_before(o.select("link", "ord"), o.select("link", "ord"), ["link"])
    ids = o.select("ord", "item_id")
    e = e.filter(F.col("prev").isNotNull()).join(ids, "ord").join(
        ids.select(F.col("ord").alias("prev"), F.col("item_id").alias("prev_item_id")), "prev")
    return e.select("link", "item_id", "prev_item_id")


@register("containment_pairs")
def q_containment_pairs(spark, sf_dir):
    from storyloom.functions.text import title_key
    from storyloom.operators.candidates import containment_pairs, distinct_keys
    items = articles(spark, sf_dir).select(F.lit("").alias("digest_key"),
                                           title_key("title").alias("key"))
    return containment_pairs(distinct_keys(items)).select(F.col("inner").alias("inner_key"),
                                                          F.col("outer").alias("outer_key"))


@register("similar_pairs")
def q_similar_pairs(spark, sf_dir):
    from storyloom.functions.text import title_key
    from storyloom.operators.candidates import distinct_keys, similar_key_pairs
    p = fixture_params(spark, sf_dir)
    c = filters.prepare_candidates(articles(spark, sf_dir), p)
    items = c.select(F.lit("").alias("digest_key"), title_key("title").alias("key"))
    return similar_key_pairs(distinct_keys(items), p.similarity_threshold) \
        .select("a", "b", "a_later", "b_later")


def _leader_ids(members: DataFrame) -> DataFrame:
    ids = members.select(F.col("ord").alias("leader_ord"), F.col("item_id").alias("cluster_id"))
    return members.join(ids, "leader_ord").select("item_id", "cluster_id")


@register("story_components")
def q_story_components(spark, sf_dir):
    _, members = _groups(spark, sf_dir, exact=False, use_ratio=False)
    return _leader_ids(members)


@register("story_groups")
def q_story_groups(spark, sf_dir):
    _, members = _groups(spark, sf_dir, exact=True, use_ratio=True)
    return _leader_ids(members)


@register("representatives")
def q_representatives(spark, sf_dir):
    _, r = _ranked(spark, sf_dir)
    return r.select(F.col("leader_item_id").alias("cluster_id"), "item_id", "kw_score",
                    "comments", "pub_date")


@register("source_bonus")
def q_source_bonus(spark, sf_dir):
    _, r = _ranked(spark, sf_dir)
    return r.select(F.col("leader_item_id").alias("cluster_id"), "source_count",
                    "multi_source_bonus")


@register("alternative_links")
def q_alternative_links(spark, sf_dir):
    from storyloom.functions.render import link_line
    _, r = _ranked(spark, sf_dir)
    return r.select(F.col("leader_item_id").alias("cluster_id"),
                    link_line("link", "other_links").alias("links"))


@register("top_stories")
def q_top_stories(spark, sf_dir):
    _, top = top_components(spark, sf_dir)
    return _top_columns(top)


@register("top_stories_exact")
def q_top_stories_exact(spark, sf_dir):
    from storyloom.plans.batch import select_top_stories
    p = fixture_params(spark, sf_dir)
    c = materialize(filters.prepare_candidates(articles(spark, sf_dir), p), "candidates")  # the sort reads them twice
    return _top_columns(select_top_stories(c, p, exact=True))


# ---------------------------------------------------------------- statistics
@register("candidate_stats")
def q_candidate_stats(spark, sf_dir):
    from storyloom.operators.stats import candidate_stats
    return candidate_stats(candidates(spark, sf_dir)).select(
        "total_candidates", "sources", "source_sites")


@register("onboard_by_site")
def q_onboard_by_site(spark, sf_dir):
    from storyloom.operators.stats import onboard_by_site
    _, top = top_components(spark, sf_dir)
    return onboard_by_site(top).select("site", "onboard", F.col("first_rank").cast("bigint"))


@register("source_counts")
def q_source_counts(spark, sf_dir):
    from storyloom.operators.stats import source_counts
    return source_counts(candidates(spark, sf_dir))


# ---------------------------------------------------------------- history
def fixture_history(spark, sf_dir) -> DataFrame:
    """Published history derived from the tables: links of the articles
    with a quality label, fetched at their publish time."""
    from storyloom.sources.tables import table
    lab = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select(
        F.col("doc_id").alias("item_id"))
    return articles(spark, sf_dir).join(lab, "item_id", "left_semi").select(
        F.col("link").alias("url"), "title", F.col("pub_time").alias("fetch_time"))


@register("unseen_articles")
def q_unseen_articles(spark, sf_dir):
    from storyloom.operators.history import unseen
    p = fixture_params(spark, sf_dir)
    return unseen(filters.recent(articles(spark, sf_dir), p), fixture_history(spark, sf_dir)) \
        .select("item_id", "link")


@register("history_append")
def q_history_append(spark, sf_dir):
    from storyloom.operators.history import merged_history
    p = fixture_params(spark, sf_dir)
    hist = fixture_history(spark, sf_dir)
    _, top = top_components(spark, sf_dir)
    return merged_history(top, hist, p.as_of).select("url", "title",
                                                     ntz("fetch_time").alias("fetch_time"))


@register("history_expire")
def q_history_expire(spark, sf_dir):
    from storyloom.operators.history import expire
    p = fixture_params(spark, sf_dir)
    return expire(fixture_history(spark, sf_dir), p.as_of, 1).select(
        "url", ntz("fetch_time").alias("fetch_time"))


@register("history_expired")
def q_history_expired(spark, sf_dir):
    from storyloom.operators.history import expired
    p = fixture_params(spark, sf_dir)
    return expired(fixture_history(spark, sf_dir), p.as_of, 1).agg(
        F.count("*").alias("expired"))


# ---------------------------------------------------------------- model stage
def _with_native_body(spark, sf_dir):
    from storyloom.functions.html import page_body_native
    from storyloom.operators.enrich import model_input, with_page_body
    from storyloom.sources.tables import table
    p = fixture_params(spark, sf_dir)
    c = candidates(spark, sf_dir)
    b = with_page_body(c, table(spark, sf_dir, "pages"), page_body_native)
    return p, b.withColumn("model_input", model_input(short_threshold=p.short_content_threshold))


@register("model_input")
def q_model_input(spark, sf_dir):
    _, b = _with_native_body(spark, sf_dir)
    return b.select("item_id", "model_input")


@register("model_requests")
def q_model_requests(spark, sf_dir):
    from storyloom.operators.enrich import requests
    p, b = _with_native_body(spark, sf_dir)
    r = requests(b, p)
    return r.select("item_id", "system_prompt", "user_content",
                    F.col("temperature").cast("string").alias("temperature"),
                    F.col("max_tokens").cast("bigint").alias("max_tokens"))


def echo_model(batch):
    """Deterministic stand-in for a model client: replies with the first
    sentence of the content, padded with spaces; no reply for empty content."""
    import json
    out = []
    for text in batch["user_content"]:
        first = (text or "").split(".")[0].strip()
        out.append(json.dumps({"choices": [{"message": {"content": "  " + first + " \n"}}]})
                   if first else None)
    return out


@register("model_replies")
def q_model_replies(spark, sf_dir):
    from storyloom.operators.enrich import parse_reply, requests, run_model
    p, b = _with_native_body(spark, sf_dir)
    rep = run_model(requests(b, p), echo_model)
    return rep.select("item_id", parse_reply("reply").alias("new_summary"))


@register("model_ledger")
def q_model_ledger(spark, sf_dir):
    """M2 with a reply ledger: the requests of even items are answered first; the run over all of them then sends
    only what the ledger does not hold. The replies to all items, read from the ledger."""
    from storyloom.operators.enrich import parse_reply, requests
    from storyloom.operators.ledger import answer_once
    p, b = _with_native_body(spark, sf_dir)
    req = requests(b, p)
    ledger = _scratch(spark, "ledger")
    answer_once(req.where("item_id % 2 = 0"), ledger, echo_model)
    rep = answer_once(req, ledger, echo_model)
    return rep.select("item_id", parse_reply("reply").alias("new_summary"))


@register("summary_overlay")
def q_summary_overlay(spark, sf_dir):
    """F10/J4 with replies taken from the first assistant turn of the
    conversation whose id is the item's id."""
    from storyloom.operators.enrich import overlay, parse_reply
    from storyloom.sources.tables import table
    conv = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    first = conv.groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    replies = first.select(F.col("conv_id").alias("item_id"),
                           F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content"))
                                                               .alias("message"))).alias("choices")))
                           .alias("reply"))
    answers = replies.select("item_id", parse_reply("reply").alias("new_summary"))
    return overlay(candidates(spark, sf_dir), answers).select("item_id", "summary")


# ---------------------------------------------------------------- digest
@register("digest_lines")
def q_digest_lines(spark, sf_dir):
    from storyloom.operators.digest import digest_lines, display_time_text
    from storyloom.operators.stats import candidate_stats
    p = fixture_params(spark, sf_dir)
    c, top = top_components(spark, sf_dir)
    lines = digest_lines(top, candidate_stats(c), display_time_text(p.as_of))
    return lines.select(F.col("line_no").cast("bigint").alias("line_no"), "value")


@register("digest_by_language")
def q_digest_by_language(spark, sf_dir):
    from storyloom.operators.digest import display_time_text
    from storyloom.plans.batch import digest_documents
    p = fixture_params(spark, sf_dir)
    c, top = top_components(spark, sf_dir, digest_key="lang")
    return digest_documents(c, top, display_time_text(p.as_of), "lang") \
        .select(F.col("digest_key").alias("lang"), "document")


@register("digest_empty")
def q_digest_empty(spark, sf_dir):
    """A run whose recency window holds nothing renders the empty text."""
    import datetime as dt
    from storyloom.operators.digest import display_time_text
    p = fixture_params(spark, sf_dir)
    later = dt.datetime.fromisoformat(str(p.as_of)) + dt.timedelta(days=365)
    p = p.with_(as_of=later.isoformat(sep=" "))
    from storyloom.plans.batch import run_digest
    c = filters.prepare_candidates(articles(spark, sf_dir), p)
    return run_digest(c, p, display_time_text(p.as_of), exact=False).select("document")


# ---------------------------------------------------------------- sources
def _scratch(spark, name: str) -> str:
    import uuid
    from storyloom.session import scratch_path
    return scratch_path(spark, f"landing/{name}-{uuid.uuid4().hex[:10]}")


def _feed_table(a: DataFrame) -> DataFrame:
    """S12 derived from the data: one feed per site, in name order. The
    distinct-site table is bounded by the number of feeds."""
    from pyspark.sql import Window
    sites = a.select("site").distinct()
    return sites.select("site", F.concat(F.lit("https://"), "site", F.lit(".example/feed")).alias("url"),
                        F.dense_rank().over(Window.orderBy("site")).cast("int").alias("source_order"))


@register("feed_items")
def q_feed_items(spark, sf_dir):
    """The articles landed as RSS payloads, read back as candidates."""
    from storyloom.sources import feeds as FD
    p = fixture_params(spark, sf_dir)
    a = articles(spark, sf_dir)
    path = _scratch(spark, "rss")
    FD.write_rss(a, path)
    raw = FD.feed_items(FD.read_feeds(spark, path), _feed_table(a), p.as_of)
    c = filters.prepare_candidates(raw, p)
    return c.select("site", "title", "link", "summary", ntz("pub_time").alias("pub_time"),
                    "comments", "kw_score")


def _land_search(a: DataFrame, path: str) -> None:
    """Articles as search responses: one response per site and id block, results in id order."""
    block = F.floor(F.col("item_id") / 400)
    resp = a.groupBy("site", block.alias("blk")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("item_id").alias("k"), F.col("title"), F.col("link").alias("url"),
        F.col("content"),
        F.date_format("pub_time", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("published_date")))).alias("r"))
    resp.select(F.concat("site", F.lit("/"), F.col("blk").cast("string")).alias("query"),
                F.col("blk").cast("int").alias("query_order"),
                F.transform("r", lambda x: x.dropFields("k")).alias("results")) \
        .write.mode("overwrite").option("compression", "gzip").json(path)


@register("search_items")
def q_search_items(spark, sf_dir):
    """The articles landed as search responses and read back; of
    each response the first ten results count."""
    from storyloom.sources.search import read_responses, search_items
    p = fixture_params(spark, sf_dir)
    path = _scratch(spark, "search")
    _land_search(articles(spark, sf_dir), path)
    c = filters.prepare_candidates(search_items(read_responses(spark, path), p.as_of), p)
    return c.select("site", "title", "link", "summary", ntz("pub_time").alias("pub_time"),
                    "pub_date", "kw_score")


def run_inputs(spark, sf_dir, base, p):
    """Lands the articles as feeds (even items) and search responses (odd items) and a history under ``base``;
    returns the raw records read back from them."""
    from storyloom.sources import feeds as FD
    from storyloom.sources.search import read_responses, search_items
    a = articles(spark, sf_dir)
    FD.write_rss(a.where("item_id % 2 = 0"), base + "/rss")
    _land_search(a.where("item_id % 2 = 1"), base + "/search")
    fixture_history(spark, sf_dir).withColumn("fetch_date", F.to_date("fetch_time")) \
        .write.partitionBy("fetch_date").parquet(base + "/history")
    return FD.feed_items(FD.read_feeds(spark, base + "/rss"), _feed_table(a), p.as_of).unionByName(
        search_items(read_responses(spark, base + "/search"), p.as_of))


def _run_rows(spark, docs, base):
    from storyloom.operators.history import read_history
    after = read_history(spark, base + "/history")
    return docs.select(F.lit("digest").alias("kind"), F.col("digest_key").alias("key"), F.col("document").alias("value")) \
        .unionByName(after.select(F.lit("history").alias("kind"), F.col("url").alias("key"), F.concat(
            "title", F.lit(" @ "), F.date_format("fetch_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("value")))


@register("full_run")
def q_full_run(spark, sf_dir):
    """The whole job over feeds (even items) and search (odd items): expiry, history, exact first-fit groups by
    links, containment and ratio, bodies of the given pages by their tree, model summaries of the top N, digest,
    append. Rows: the digest and the history after the run."""
    from storyloom.functions.html import page_body_dom
    from storyloom.plans.batch import run_job
    from storyloom.sources.tables import table
    p = fixture_params(spark, sf_dir, history_days=1)
    base = _scratch(spark, "whole-run")
    raw = run_inputs(spark, sf_dir, base, p)
    docs = run_job(raw, p, base + "/history", base + "/digests", "fixture", exact=True, call=echo_model,
                   pages=table(spark, sf_dir, "pages").select("url", "html"), body_fn=page_body_dom)
    return _run_rows(spark, docs, base)


@register("full_run_components")
def q_full_run_components(spark, sf_dir):
    """The job in the form that SQL can follow: groups are components over links and containment, and no page
    has been fetched, so short summaries take the fallback."""
    from storyloom.plans.batch import run_job
    p = fixture_params(spark, sf_dir, history_days=1, use_ratio_edges=False)
    base = _scratch(spark, "run")
    raw = run_inputs(spark, sf_dir, base, p)
    docs = run_job(raw, p, base + "/history", base + "/digests", "fixture", exact=False, call=echo_model,
                   pages=spark.createDataFrame([], "url string, html string"))
    return _run_rows(spark, docs, base)


# ---------------------------------------------------------------- streaming
@register("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """ST3: events streamed in time order, repeats of a user dropped within a
    watermark longer than the data's span; the surviving keys."""
    from storyloom.sources.tables import table
    from storyloom.streaming import stream as S
    from storyloom.streaming.landed import land, read_landed
    base = _scratch(spark, "events")
    ev = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    land(ev, base + "/in", "ts", files=4)
    src = read_landed(spark, base + "/in", ev.schema)
    out = S.dedupe_seen(src.withWatermark("ts", "60 days"), ["user_id"]).select("user_id", "event_id")
    S.run_available(out, base + "/out", base + "/ckpt")
    return spark.read.parquet(base + "/out").select("user_id")


@register("site_trend")
def q_site_trend(spark, sf_dir):
    """ST5: daily counts per site over the streamed articles (complete mode)."""
    from storyloom.streaming import stream as S
    from storyloom.streaming.landed import land
    base = _scratch(spark, "trend")
    land(articles(spark, sf_dir), base + "/in", "pub_time", files=4)
    src = S.read_articles_stream(spark, base + "/in")
    S.run_available(S.site_trend(src), base + "/out", base + "/ckpt", output_mode="complete")
    return spark.read.parquet(base + "/out").select(
        ntz("window_start").alias("window_start"), "site", "n")


@register("stream_digest")
def q_stream_digest(spark, sf_dir):
    """ST1/ST2/ST4: the articles landed by day and streamed in that order, repeats of a record dropped; each
    day runs the selection at its own time against the history of earlier days."""
    from storyloom.streaming import stream as S
    from storyloom.streaming.landed import day_edges, land
    p = fixture_params(spark, sf_dir)
    base = _scratch(spark, "digest")
    raw = articles(spark, sf_dir)
    land(raw, base + "/in", "pub_time", edges=day_edges(raw, "pub_time"))
    # a record that arrives twice is one; two sources with one link are two (A2 rewards them)
    src = S.dedupe_seen(S.with_late_bound(S.read_articles_stream(spark, base + "/in"),
                                          p.days_limit), ["site", "item_id"])
    fn = S.digest_per_batch(p, base + "/out", base + "/history", exact=False)
    S.drain(src.writeStream.foreachBatch(fn).option("checkpointLocation", base + "/ckpt"))
    return spark.read.parquet(base + "/out").select("batch_id", "digest_key", "document")


@register("push_message")
def q_push_message(spark, sf_dir):
    """The digest as a pushed message titled with the run date."""
    from storyloom.operators.digest import display_time_text, push_message, push_title
    from storyloom.plans.batch import digest_documents
    p = fixture_params(spark, sf_dir)
    c, top = top_components(spark, sf_dir)
    docs = digest_documents(c, top, display_time_text(p.as_of))
    return push_message(docs, push_title(p.as_of), empty_run=c.isEmpty()).select("message")
