"""Item-level expressions against row models (edge cases E1-E11)."""

import datetime as dt

from pyspark.sql import functions as F

from storyloom.functions.scoring import is_excluded, keyword_score
from storyloom.functions.text import collapse_ws, short_summary, title_key
from storyloom.functions.time import parse_feed_time, resolve_feed_time, resolve_search_time
from storyloom.functions.url import netloc, search_site_label
from storyloom.operators.filters import comment_count, prepare_candidates
from storyloom.params import NO_ABSTRACT_MARKER, DigestParams
import row_model as RM


def py_score(title, summary, kws):
    s = 0
    for k in kws:
        k = k.lower()
        s += 100 if k in title.lower() else 0
        s += 50 if k in summary.lower() else 0
    return s


def test_keyword_score_and_exclusion(spark):
    rows = [("Taiwan said", "nothing"), ("AI news", "more AI"), ("", ""), ("Élan", "élan vital")]
    df = spark.createDataFrame(rows, "title string, summary string")
    for kws in [["AI"], ["ai", "AI"], ["élan"], [""], []]:
        got = [r[0] for r in df.select(keyword_score("title", "summary", kws)).collect()]
        assert got == [py_score(t, s, kws) for t, s in rows], kws
        exc = [r[0] for r in df.select(is_excluded("title", "summary", kws)).collect()]
        assert exc == [any(k.lower() in t.lower() or k.lower() in s.lower() for k in kws)
                       for t, s in rows]


def test_many_keywords_nested_repeated_and_null_texts(spark):
    kws = [f"{a}{b}" for a in ("ab", "b", "Ü", "中") for b in ("", "b", "bc", "c😀", "x" * 30)] * 2 + ["", "abbc"]
    rows = [("xabbcx", "BBC ü中c😀"), ("", "ÜBC" * 50), ("none", "x" * 500 + "b" + "x" * 30)]
    df = spark.createDataFrame(rows, "title string, summary string")
    assert [r[0] for r in df.select(keyword_score("title", "summary", kws)).collect()] == [py_score(*r, kws) for r in rows]
    many = [f"word{i}" for i in range(3000)]
    rows = [(f"word{i}", f"word{i}1 word{i + 7}") for i in (1, 29, 2999)]
    df = spark.createDataFrame(rows, "title string, summary string")
    assert [r[0] for r in df.select(keyword_score("title", "summary", many)).collect()] == [py_score(*r, many) for r in rows]
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, "b"), (None, None)], "title string, summary string")
    assert [r[0] for r in df.select(keyword_score("title", "summary", ["a"])).collect()] == [50, 100, 0, 0]
    assert [r[0] for r in df.select(keyword_score("title", "summary", ["a", ""])).collect()] == [100, 200, 50, 0]
    assert [r[0] for r in df.select(is_excluded("title", "summary", ["a"])).collect()] == [True, True, None, None]


def test_short_summary_code_points(spark):
    n = 5
    rows = [("abcde",), ("abcdef",), ("ab😀cd",), ("ab😀cde",), ("",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(short_summary("t", n)).collect()]
    assert got == [t if len(t) <= n else t[:n] + "..." for (t,) in rows]


def test_title_key_matches_python(spark):
    rows = [("Hello, World! 2024",), ("Ünïcödé—ß",), ("!!!",), ("中文 标题",), ("Mixed_Case-42",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(title_key("t")).collect()]
    assert got == [RM.norm(t) for (t,) in rows]


def test_collapse_ws_python_space_set(spark):
    rows = [(" a   b　c\x1c d\t\n",), ("x",)]
    df = spark.createDataFrame(rows, "t string")
    import re
    got = [r[0] for r in df.select(collapse_ws("t")).collect()]
    assert got == [re.sub(r"\s+", " ", t).strip() for (t,) in rows]


def test_feed_time_forms(spark):
    rows = [("Mon, 30 Mar 2026 08:00:00 +0800",), ("Mon, 30 Mar 2026 08:00:00 GMT",),
            ("2026-03-30T23:00:00-05:00",), ("junk",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(parse_feed_time("t").cast("timestamp_ntz")).collect()]
    assert got[0] == dt.datetime(2026, 3, 30, 0, 0)  # E4
    assert got[1] == dt.datetime(2026, 3, 30, 8, 0)
    assert got[2] == dt.datetime(2026, 3, 31, 4, 0)
    assert got[3] is None and got[4] is None
    as_of = "2026-04-01 00:00:00"
    res = df.select(resolve_feed_time("t", F.lit(None).cast("string"), as_of)
                    .cast("timestamp_ntz")).collect()
    assert res[3][0] == dt.datetime(2026, 4, 1) and res[4][0] == dt.datetime(2026, 4, 1)  # E3
    s = spark.createDataFrame([("2026-03-30T23:00:00Z",), ("bad",)], "t string")
    r = s.select(resolve_search_time("t", as_of).cast("timestamp_ntz")).collect()
    assert r[0][0] == dt.datetime(2026, 3, 30, 23) and r[1][0] == dt.datetime(2026, 4, 1)


def test_search_pub_date_keeps_source_offset(spark):
    from storyloom.functions.time import search_pub_date
    df = spark.createDataFrame([("2026-03-30T23:00:00-05:00",)], "t string")
    d = df.select(search_pub_date("t", resolve_search_time("t", "2026-04-01 00:00:00"))).first()[0]
    assert d == dt.date(2026, 3, 30)  # E5


def test_comment_count(spark):
    rows = [("12",), ("007",), ("https://x/item?id=1",), ("",), (None,), ("12a",)]
    df = spark.createDataFrame(rows, "c string")
    got = [r[0] for r in df.select(comment_count("c")).collect()]
    assert got == [12, 7, 0, 0, 0, 0]


def test_netloc_and_label(spark):
    from urllib.parse import urlparse
    urls = ["https://user@a.b.com:8080/x?y", "http://a b.com/x", "no-scheme", "//h/p", ""]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(netloc("u")).collect()]
    assert got == [urlparse(u).netloc for u in urls]
    lab = df.select(search_site_label("u")).first()[0]
    assert lab.endswith("(user@a.b.com:8080)")
    bad = spark.createDataFrame([("http://[::1/x",)], "u string").select(search_site_label("u")).first()[0]
    assert bad == "Tavily"  # the parser raises on unbalanced brackets: bare label


def _raw(spark, rows):
    from storyloom.sources.tables import RAW_COLUMNS
    base = []
    for i, r in enumerate(rows):
        d = dict(item_id=i, source_kind=0, source_order=0, source="s", item_order=i,
                 site="s", title="t", link=f"l{i}", content="", pub_time=None, pub_date=None,
                 comments=0, feed_url="", lang="en")
        d.update(r)
        base.append(tuple(d[c] for c in RAW_COLUMNS))
    schema = ("item_id long, source_kind int, source_order int, source string, item_order long, "
              "site string, title string, link string, content string, pub_time timestamp, "
              "pub_date date, comments long, feed_url string, lang string")
    return spark.createDataFrame(base, schema)


def test_recency_marker_exclusion_order(spark):
    as_of = dt.datetime(2026, 4, 1)
    p = DigestParams(as_of="2026-04-01 00:00:00", days_limit=2, summary_max_length=10,
                     exclude_keywords=("secret",), high_weight_keywords=("ai",))
    rows = [
        dict(pub_time=as_of - dt.timedelta(days=2)),                      # E1 kept
        dict(pub_time=as_of + dt.timedelta(days=5)),                      # E2 kept
        dict(pub_time=as_of - dt.timedelta(days=2, seconds=1)),           # dropped
        dict(pub_time=as_of, content="0123456789 secret"),                # E9 kept (after cut)
        dict(pub_time=as_of, content="secret", site="Hacker News"),       # E11 kept (marker)
        dict(pub_time=as_of, content="a secret"),                         # dropped
        dict(pub_time=as_of, title="Taiwan said", content="x"),           # E6: +100
    ]
    c = prepare_candidates(_raw(spark, rows), p).orderBy("item_id").collect()
    ids = [r.item_id for r in c]
    assert ids == [0, 1, 3, 4, 6]
    assert c[3].summary == NO_ABSTRACT_MARKER
    assert c[4].kw_score == 100
    e8 = prepare_candidates(_raw(spark, rows), p.with_(exclude_keywords=("",)))
    assert e8.count() == 0  # E8
