"""Dated lists against a plain replay of the log."""

import random

from storyloom.llm.url_filter import evaluate, host_of, intervals


def replay(entries, key, kind, t):
    """(listed at t, since)"""
    own = sorted((at, not on) for k, x, at, on in entries if (k, x) == (kind, key) and at is not None and at <= t)
    state, since, last = False, None, None
    for at, off in own:
        if at == last:  # a listing wins over an unlisting of the same instant
            continue
        last = at
        if state == off:
            state, since = not off, at
    return state, since


def test_captures_are_judged_by_the_entries_of_their_time(spark):
    r = random.Random(4)
    hosts = ["a.example.com", "b.example.com", "x.y.example.org", "example.net", "localhost"]
    domains = ["example.com", "example.org", "y.example.org", "example.net", "localhost"]
    hour = 3_600_000_000
    entries = [(k, r.choice(hosts if k == "host" else domains), r.randrange(40) * hour // 4, r.random() < 0.6)
               for k in r.choices(["host", "domain"], k=80)]
    entries += [(None, "a", 1, True), ("host", None, 1, True), ("host", "a.example.com", None, True)]
    urls = [(i, f"https://u:p@{h.upper()}:80/p?q#f", r.randrange(45) * hour // 4) for i, h in enumerate(r.choices(hosts, k=120))]
    urls += [(500, None, 5), (501, "not a url", 5), (502, "http://a.example.com./", None), (3, *urls[3][1:])]
    caps = spark.createDataFrame([(*u, 1, "k") for u in urls], "capture_id long, url string, fetched long, n int, key string")
    log = spark.createDataFrame([(*e, "z") for e in entries], "kind string, key string, at long, listed boolean, host string")
    got = sorted(((x["capture_id"], x["blocked"], x["n_active"], x["since"]) for x in evaluate(caps, log).collect()), key=str)
    want = []
    for i, url, t in urls:
        h = url.split("@")[-1].split(":80")[0].lower() if url and "@" in url else None
        hits = []
        if h and t is not None:
            parts = h.split(".")
            names = [("host", h)] + [("domain", ".".join(parts[k:])) for k in range(max(len(parts) - 1, 1))]
            hits = [s for k, x in names for on, s in [replay(entries, x, k, t)] if on]
        want.append((i, bool(hits), len(hits), min(hits) if hits else None))
    assert got == sorted(want, key=str)


def test_intervals_close_where_the_next_turn_begins(spark):
    log = spark.createDataFrame([("host", "h", 1, True), ("host", "h", 2, True), ("host", "h", 5, False),
                                 ("host", "h", 7, False), ("host", "h", 9, True), ("host", "g", 3, False)],
                                "kind string, key string, at long, listed boolean")
    assert sorted((r["valid_from"], r["valid_to"]) for r in intervals(log).collect()) == [(1, 5), (9, None)]
    assert intervals(log.limit(0)).collect() == []


def test_hosts(spark):
    urls = ["HTTP://Www.Example.COM.:8080/a", "https://u@h/x", "ftp://h?x", "//h/x", "", None, "http:///x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(host_of("url")).collect()] == ["www.example.com", "h", "h", None, None, None, None]
