"""Story grouping against brute force (property tests of SURVEY 5.3, E12-E18)."""

import datetime as dt
import difflib
import random

import numpy as np

from pyspark.sql import functions as F

from storyloom.operators.arrival import arrival_key, with_arrival_order
from storyloom.operators.asof import latest_before
from storyloom.operators.candidates import containment_pairs, distinct_keys, similar_key_pairs
from storyloom.operators.grouping import assign_groups, grouping_items
from storyloom.operators.ranking import rank_groups, top_groups
from storyloom.plans.batch import group_stories
from storyloom.plans.fixture import fixture_params
from storyloom.plans.queries import candidates
import row_model as RM

SF = "/root/testdata/sf0.001"


def test_latest_before_matches_brute_force_across_buckets(spark):
    rnd = random.Random(7)
    rows = []
    for o in range(400):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(12)}"
        rows.append((key, o * 3 + rnd.randrange(3), rnd.random() < 0.5))
    df = spark.createDataFrame(rows, "k string, ord long, is_build boolean")
    probes = df.select("k", "ord")
    builds = df.filter("is_build").select("k", "ord")
    got = {(r.k, r.ord): r.prev for r in latest_before(probes, builds, ["k"], bucket_bits=3).collect()}
    for k, o, _ in rows:
        prev = [b for kk, b, ib in rows if kk == k and ib and b < o]
        assert got[(k, o)] == (max(prev) if prev else None)


def _items_in_arrival(spark):
    c = candidates(spark, SF)
    return c, [r.asDict() for r in c.orderBy(*arrival_key()).collect()]


def _spark_groups(members, items):
    idx = {it["item_id"]: i for i, it in enumerate(items)}
    by = {}
    for r in members.select("item_id", "leader_ord").collect():
        by.setdefault(r.leader_ord, []).append(idx[r.item_id])
    return sorted(sorted(v) for v in by.values())


def test_first_fit_equals_brute_force(spark):
    c, items = _items_in_arrival(spark)
    p = fixture_params(spark, SF)
    members = group_stories(c, p, exact=True)
    assert _spark_groups(members, items) == sorted(RM.first_fit(items))


def test_components_equal_union_find(spark):
    c, items = _items_in_arrival(spark)
    p = fixture_params(spark, SF)
    members = group_stories(c, p, exact=False, use_ratio=False)
    assert _spark_groups(members, items) == RM.components(items, ratio=False)


def test_ranking_equals_row_model(spark):
    c, items = _items_in_arrival(spark)
    p = fixture_params(spark, SF)
    members = group_stories(c, p, exact=True)
    top = top_groups(rank_groups(members), 15).orderBy("rank").collect()
    expect = RM.rank_groups(items, RM.first_fit(items), 15)
    assert [r.item_id for r in top] == [e["item_id"] for e in expect]
    assert [r.leader_item_id for r in top] == [e["leader"] for e in expect]
    assert [[(o.site, o.link) for o in r.other_links] for r in top] == \
        [e["other_links"] for e in expect]
    assert [r.multi_source_bonus for r in top] == [e["multi_source_bonus"] for e in expect]


def _pairs_by_definition(keys):
    want = {}
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            ab, ba = RM.similar(a, b), RM.similar(b, a)
            if ab or ba:
                want[a, b] = (ab, ba)
    return want


def test_similar_pairs_are_those_of_the_definition(spark, monkeypatch):
    from storyloom.operators import candidates as C
    from storyloom.operators import envelopes
    monkeypatch.setattr(C, "BLOCK_KEYS", 8)  # several blocks a leaf
    monkeypatch.setattr(envelopes, "LEAF_KEYS", 20)
    _, items = _items_in_arrival(spark)
    keys = sorted({RM.norm(it["title"]) for it in items} - {""})
    keys += ["x" * 3000 + "y", "x" * 2900 + "z" * 50, "字" * 300, "字" * 290]  # long ones take the same path
    keys = sorted(set(keys))
    kdf = distinct_keys(spark.createDataFrame([("", k) for k in keys], "digest_key string, key string"))
    got = {(r.a, r.b): (r.a_later, r.b_later) for r in similar_key_pairs(kdf, 0.65).collect()}
    assert got == _pairs_by_definition(keys)


def test_hot_title_contained_in_many_makes_few_edges(spark):
    """A third of the rows carry one title that lies in many others."""
    from storyloom.operators.grouping import story_edges
    rows = [("market rally", f"https://h/{i}", "a") for i in range(100)]
    rows += [(f"{w} market rally {w} {i}" * 2, f"https://o/{w}{i}", "b")
             for i, w in enumerate(["zebra", "quartz", "jumbo", "vixen"] * 25)]
    rows += [(f"{i}" * 30, f"https://n/{i}", "c") for i in range(1000, 1100)]
    random.Random(2).shuffle(rows)
    df = with_arrival_order(_raw_rows(spark, rows))
    order = [r.item_id for r in df.orderBy("ord").collect()]
    items = [dict(title=rows[i][0], link=rows[i][1]) for i in order]
    edges = story_edges(grouping_items(df))
    n_pairs = similar_key_pairs(distinct_keys(grouping_items(df)), 0.65).count()
    assert n_pairs >= 100
    assert edges.count() <= 2 * len(rows) + 2 * 2 * n_pairs  # chains, and two lookups from the rarer title a pair
    pos = {iid: k for k, iid in enumerate(order)}
    for exact in (True, False):
        by = {}
        for r in assign_groups(grouping_items(df), exact=exact).collect():
            by.setdefault(r.leader_ord, []).append(pos[r.item_id])
        want = sorted(RM.first_fit(items)) if exact else RM.components(items)
        assert sorted(sorted(v) for v in by.values()) == want


def test_ladder_of_200_pairs(spark):
    """Each item matches its predecessor and an older group of its own."""
    from storyloom.operators.grouping import propagate_min
    n = 200
    edges = [(n + i, i) for i in range(n)] + [(n + i, n + i - 1) for i in range(1, n)]
    nodes = spark.range(2 * n).withColumnRenamed("id", "ord")
    got = {r.ord: r.label for r in propagate_min(nodes, spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: i for i in range(n)}, **{n + i: 0 for i in range(n)}}
    # the same with the older groups in falling order: labels differ all along the ladder
    edges = [(n + i, n - 1 - i) for i in range(n)] + [(n + i, n + i - 1) for i in range(1, n)]
    got = {r.ord: r.label for r in propagate_min(nodes, spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: i for i in range(n)}, **{n + i: n - 1 - i for i in range(n)}}


def test_first_fit_on_whole_titles_at_the_larger_scale(spark):
    sf = "/root/testdata/sf0.01"
    c = candidates(spark, sf)
    items = [r.asDict() for r in c.orderBy(*arrival_key()).collect()]
    assert max(len(it["title"]) for it in items) > 80
    members = group_stories(c, fixture_params(spark, sf), exact=True)
    assert _spark_groups(members, items) == sorted(RM.first_fit(items))


def _raw_rows(spark, rows):
    base = dt.datetime(2026, 4, 1)
    data = []
    for i, (title, link, site) in enumerate(rows):
        data.append((i, 0, 0, "feed", i, site, title, link, "", base, base.date(), 0, 0, "", "en"))
    cols = ("item_id long, source_kind int, source_order int, source string, item_order long, "
            "site string, title string, link string, summary string, pub_time timestamp, "
            "pub_date date, comments long, kw_score int, feed_url string, lang string")
    return spark.createDataFrame(data, cols)


def _group_titles(spark, rows, exact=True):
    df = with_arrival_order(_raw_rows(spark, rows))
    g = assign_groups(grouping_items(df), exact=exact)
    by = {}
    for r in g.collect():
        by.setdefault(r.leader_ord, []).append(r.item_id)
    return sorted(sorted(v) for v in by.values())


def test_edge_cases_e12_to_e17(spark):
    # Link '' shared, unlike titles -> one group
    assert _group_titles(spark, [("alpha story", "", "a"), ("zzz qqq", "", "b"),
                                 ("12345 67890", "", "c")]) == [[0, 1, 2]]
    # Two untitled items (same default title), different links -> one group
    assert _group_titles(spark, [("无标题", "x", "a"), ("无标题", "y", "b")]) == [[0, 1]]
    # Punctuation-only titles, different links -> separate
    assert _group_titles(spark, [("!!!", "x", "a"), ("???", "y", "b")]) == [[0], [1]]
    # Contained title of 4 vs 5 characters inside a long other title
    long_t = "completely unrelated headline text abcde here"
    assert _group_titles(spark, [("abcd", "x", "a"), (long_t, "y", "b")]) == [[0], [1]]
    assert _group_titles(spark, [("abcde", "x", "a"), (long_t, "y", "b")]) == [[0, 1]]
    # a~c, b~c, a and b unlike; order a, b, c
    a, b = "aaaaaaaaaa", "bbbbbbbbbb"
    cc = "aaaaaaaaaabbbbbbbbbb"
    rows = [(a, "1", "s"), (b, "2", "s"), (cc, "3", "s")]
    assert _group_titles(spark, rows, exact=True) == [[0, 2], [1]]
    assert _group_titles(spark, rows, exact=False) == [[0, 1, 2]]


def test_ratio_boundary_e16():
    import difflib
    a, b = "abcdefghijklm", "abcdefghijxyz"
    r = difflib.SequenceMatcher(None, a, b).ratio()
    assert RM.similar(a, b, threshold=r) is False  # strictly greater


def test_hot_keys_first_fit_and_components(spark):
    """A third of the items share the empty link, a sixth share one title:
    chains and as-of edges (tiny buckets: many carries) still reproduce
    brute-force first-fit and components exactly."""
    rnd = random.Random(11)
    words = ["market", "rally", "storm", "vote", "chip", "robot", "league", "flood"]
    rows = []
    for i in range(240):
        r = rnd.random()
        if r < 1 / 3:
            link = ""
        else:
            link = f"https://s{rnd.randrange(40)}/{i}"
        if rnd.random() < 1 / 6:
            title = "Breaking: markets rally"
        else:
            title = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4)))
        rows.append((title, link, f"site{rnd.randrange(5)}"))
    df = with_arrival_order(_raw_rows(spark, rows))
    order = [r.item_id for r in df.orderBy("ord").collect()]
    items = [dict(title=rows[i][0], link=rows[i][1]) for i in order]
    pos = {iid: k for k, iid in enumerate(order)}
    for exact in (True, False):
        g = assign_groups(grouping_items(df), exact=exact, bucket_bits=2)
        by = {}
        for r in g.collect():
            by.setdefault(r.leader_ord, []).append(pos[r.item_id])
        got = sorted(sorted(v) for v in by.values())
        want = sorted(RM.first_fit(items)) if exact else RM.components(items)
        assert got == want, exact


def test_ranking_invariant_under_repartitioning(spark):
    from storyloom.plans.batch import select_top_stories
    p = fixture_params(spark, SF)
    c = candidates(spark, SF)
    cols = ["rank", "item_id", "leader_item_id", "multi_source_bonus", "source_count"]
    base = [tuple(r) for r in select_top_stories(c, p, exact=False).select(*cols).orderBy("rank").collect()]
    for n in (1, 7):
        again = [tuple(r) for r in select_top_stories(c.repartition(n), p, exact=False)
                 .select(*cols).orderBy("rank").collect()]
        assert again == base


def _least_reachable(n, edges, directed):
    label = list(range(n))
    both = edges if directed else edges + [(b, a) for a, b in edges]
    while True:
        new = list(label)
        for a, b in both:
            new[a] = min(new[a], new[b])
        if new == label:
            return dict(enumerate(label))
        label = new


def test_labels_inside_a_block_take_no_round(spark):
    from storyloom.operators.grouping import propagate_min
    n = 200
    edges = [(n + i, n - 1 - i) for i in range(n)] + [(n + i, n + i - 1) for i in range(1, n)]
    rounds = []
    nodes = spark.range(2 * n).withColumnRenamed("id", "ord")
    got = {r.ord: r.label for r in propagate_min(nodes, spark.createDataFrame(edges, "src long, dst long"), rounds=rounds).collect()}
    assert got == _least_reachable(2 * n, edges, True) and len(rounds) == 1


def test_rounds_over_many_blocks(spark):
    """A chain, a ladder and a zig-zag over 25 blocks of 16: rounds, not steps."""
    from storyloom.operators.grouping import propagate_min
    n = 200
    chain = [(i, i - 1) for i in range(1, 2 * n)]
    ladder = [(n + i, n - 1 - i) for i in range(n)] + [(n + i, n + i - 1) for i in range(1, n)]
    zigzag = [(max(a, b), min(a, b)) for a, b in zip(range(n), [(i * 77 + 31) % n + n for i in range(n)])] \
        + [(max(a, b), min(a, b)) for a, b in zip([(i * 77 + 31) % n + n for i in range(n - 1)], range(1, n))]
    rnd = random.Random(5)
    mixed = [(max(a, b), min(a, b)) for a, b in ((rnd.randrange(2 * n), rnd.randrange(2 * n)) for _ in range(2 * n)) if a != b]
    nodes = spark.range(2 * n).withColumnRenamed("id", "ord")
    most = {("chain", True): 7, ("ladder", True): 8, ("zigzag", False): 12, ("mixed", True): 12, ("mixed", False): 12}
    for name, edges in (("chain", chain), ("ladder", ladder), ("zigzag", zigzag), ("mixed", mixed)):
        for directed in (True, False):
            if (name, directed) in most:
                rounds = []
                df = spark.createDataFrame(edges, "src long, dst long")
                got = {r.ord: r.label for r in propagate_min(nodes, df, directed, block_bits=4, rounds=rounds).collect()}
                assert got == _least_reachable(2 * n, edges, directed), (name, directed)
                assert len(rounds) <= most[name, directed], (name, directed, rounds)


def test_arrival_numbers_are_dense(spark):
    df = with_arrival_order(_raw_rows(spark, [(f"t{i}", f"l{i}", "s") for i in range(57)]).repartition(5))
    assert sorted(r.ord for r in df.collect()) == list(range(57))
    assert with_arrival_order(_raw_rows(spark, [("t", "l", "s")]).where("false")).count() == 0


def test_containment_over_many_automata(spark, monkeypatch):
    """Parts by grams, blocks inside parts, and one gram that every key holds."""
    from storyloom.operators import candidates as C
    monkeypatch.setattr(C, "INNER_CHARS", 150)
    monkeypatch.setattr(C, "OUTER_CHARS", 200)
    rnd = random.Random(3)
    keys = {"".join(rnd.choice("abc") for _ in range(rnd.randrange(3, 40))) for _ in range(150)}
    keys |= {"hotgram" + k for k in list(keys)[:60]} | {"hotgram"}
    rows = [("d" + str(i % 2), k) for i, k in enumerate(sorted(keys))]
    got = {tuple(r) for r in C.containment_pairs(distinct_keys(spark.createDataFrame(rows, "digest_key string, key string"))).collect()}
    want = {(d, a, b) for d, a in rows for e, b in rows if d == e and a != b and len(a) >= 5 and a in b}
    assert got == want and len(want) > 80


def test_verdicts_of_long_keys_follow_the_matcher():
    """Around 200 characters, where common characters stop starting matches: shared beginnings, runs and near copies."""
    from storyloom.functions.similarity import block_verdicts
    rnd = random.Random(8)
    keys = set()
    for _ in range(24):
        base = "".join(rnd.choice("ab" * 20 + "cdefghij") for _ in range(rnd.randrange(150, 420)))
        keys |= {base, base[:rnd.randrange(60, 140)] + "".join(rnd.choice("abz") for _ in range(rnd.randrange(80, 200)))}
        cut = rnd.randrange(20, 100)
        keys.add(base[cut:] + base[:cut])
    keys |= {"ab" * 120, "ab" * 115 + "zzz", "ab" * 90, "ba" * 130, "x" + "ab" * 120}
    keys = sorted(keys)
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio() > 0.65
    want = {(a, b): (ratio(a, b), ratio(b, a)) for i, a in enumerate(keys) for b in keys[i + 1:]}
    want = {k: v for k, v in want.items() if any(v)}
    got = {(a, b): (x, y) for a, b, x, y in block_verdicts(keys, keys, 0.65, True)}
    assert got == want and len(want) > 8
    half = len(keys) // 2
    got = {(a, b): (x, y) for a, b, x, y in block_verdicts(keys[half:], keys[:half], 0.65, False)}
    assert got == {k: v for k, v in want.items() if (k[0] in keys[half:]) != (k[1] in keys[half:])}


def test_subsequences_of_a_key_with_many_at_a_time(monkeypatch):
    """Keys around the edges of words, and characters beyond 16 bits; only keys that the masks have no room for go one by one."""
    from storyloom.functions import similarity as S
    rnd = random.Random(9)
    keys = [c * n for c in ("a", "\U0001f600") for n in (1, 63, 64, 65, 127, 128, 129)]
    keys += ["".join(rnd.choice("abcd é\U0001f600你") for _ in range(rnd.randrange(1, 300))) for _ in range(60)]
    alphabet = np.unique(S.codes(keys + ["xyz"]))
    one_by_one = []
    real = S.lcs_length
    monkeypatch.setattr(S, "lcs_length", lambda *a: one_by_one.append(a) or real(*a))
    for room in (S.MASK_BYTES, 2000, 0):
        monkeypatch.setattr(S, "MASK_BYTES", room)
        packed, some = S.Packed(keys, alphabet), np.array(sorted(rnd.sample(range(len(keys)), 40)))
        one_by_one.clear()
        for x in [*keys[::5], "xyz"]:
            assert packed.lcs(x, some).tolist() == [real(x, keys[j]) for j in some.tolist()]
        assert bool(one_by_one) == (room < 64_000_000)
    monkeypatch.undo()
    titles = ["".join(rnd.choice("etaoin shrdlu") for _ in range(150)) for _ in range(80)] + ["etaoin shrdlu" * 11]
    monkeypatch.setattr(S, "lcs_length", lambda *a: one_by_one.append(a) or real(*a))
    one_by_one.clear()
    assert list(S.block_verdicts(titles, titles, 0.9, True)) == [] and not one_by_one


def test_title_keys_are_made_once(spark, monkeypatch):
    """The grouping reads its items many times; it gets a narrow table of them, not the projection of the texts."""
    from storyloom.plans import batch
    seen, real = [], batch.assign_groups
    monkeypatch.setattr(batch, "assign_groups", lambda items, *a, **k: seen.append(items) or real(items, *a, **k))
    c = candidates(spark, "/root/testdata/sf0.001")
    members = batch.group_stories(c, fixture_params(spark, "/root/testdata/sf0.001"), exact=False, use_ratio=False)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Project" not in plan and "title" not in plan
    assert members.count() == c.count()


def test_envelopes_prune_blocks_and_copies(spark, monkeypatch):
    """Work grows clearly slower than the square of the keys, on titles of several alphabets and lengths."""
    from storyloom.operators import candidates as C
    from storyloom.operators import envelopes
    monkeypatch.setattr(envelopes, "LEAF_KEYS", 16)
    monkeypatch.setattr(C, "BLOCK_KEYS", 32)
    rnd = random.Random(4)
    alphabets = ["abcdefgh", "ijklmnop", "qrstuvwx", "абвгдежз", "你好新闻世界天地"]
    keys = sorted({"".join(rnd.choice(rnd.choice(alphabets[:1 + i % 5])) if i % 7 == 0 else rnd.choice(alphabets[i % 5])
                           for _ in range(rnd.randrange(10, 80))) for i in range(1200)})
    copies = {}
    for n in (300, 1200):
        kdf = distinct_keys(spark.createDataFrame([("", k) for k in rnd.sample(keys, min(n, len(keys)))], "digest_key string, key string"))
        blocks, left, right = C.ratio_work(kdf, 0.65)
        copies[n] = left.count() + right.count()
        assert blocks.where("rleaf < lleaf").count() == 0
    assert copies[1200] < 10 * copies[300]  # the square would be 16
    assert copies[1200] < 0.3 * 2 * 1200 * (1200 / 16)  # of every key to every leaf, both sides


def test_long_keys_with_common_words_are_told_apart_without_their_subsequences(monkeypatch):
    """Long titles out of one small vocabulary share grams of five characters, but too few of longer ones."""
    from storyloom.functions import similarity as S
    rnd = random.Random(12)
    words = ["".join(rnd.choice("eeetaaoinshrdlu") for _ in range(rnd.randrange(3, 8))) for _ in range(300)]
    keys = sorted({"".join(rnd.choice(words) for _ in range(60))[:rnd.randrange(210, 280)] + "qxzj" for _ in range(60)})
    keys = sorted({*keys, keys[0][:150] + "wordsofitsown" + keys[0][150:]})
    assert sum(not {a[i:i + 5] for i in range(len(a) - 4)}.isdisjoint(b[i:i + 5] for i in range(len(b) - 4))
               for a in keys for b in keys if a < b) > 500
    asked, real = [], S.Packed.lcs
    monkeypatch.setattr(S.Packed, "lcs", lambda self, x, others: asked.extend(others) or real(self, x, others))
    found = {tuple(r) for r in S.block_verdicts(keys, keys, 0.65, True)}
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio() > 0.65
    want = {(a, b, ratio(a, b), ratio(b, a)) for a in keys for b in keys if a < b}
    assert found == {r for r in want if r[2] or r[3]} and len(found) >= 1
    assert len(asked) < 40


def test_pairs_of_keys_carry_no_texts(spark, monkeypatch):
    """Pairs are many and titles long: from the keys on, grouping holds numbers, and what led to the edges is deleted."""
    import os
    from storyloom.operators import candidates as C
    from storyloom.operators import grouping as G
    from storyloom.operators import materialize as M
    paths, texts = {}, []

    def noted(df, label):
        out = M.materialize(df, label)
        paths.setdefault(label, M._WRITTEN[-1])
        texts.extend((label, f.name) for f in df.schema if f.dataType.typeName() == "string")
        return out
    monkeypatch.setattr(G, "materialize", noted)
    monkeypatch.setattr(C, "materialize", noted)
    rows = [(f"{'long story about one city ' * (1 + i % 4)}{i}", f"https://h/{i % 9}", "a") for i in range(60)]
    items = M.materialize(grouping_items(with_arrival_order(_raw_rows(spark, rows))), "items")
    for exact in (True, False):
        paths.clear()
        texts.clear()
        got = assign_groups(items, use_ratio=exact, exact=exact)
        assert {c for label, c in texts if label not in ("keys", "placed-keys")} <= {"digest_key", "link"}
        assert not any(os.path.exists(paths[k].removeprefix("file:")) for k in ("keys", "contained", "directed-pairs"))
        assert got.count() == 60


def test_an_inner_title_is_cut_out_of_the_outer_one(spark):
    """Of a pair the outer text alone is read: one join, and an inner title that stands in the outer one twice is one pair."""
    keys = ["berlin", "berlin und berlin", "und berlin", "vonberlinundberlinnachberlin", "\U0001f600\U0001f600berlin\U0001f600"]
    pairs = containment_pairs(distinct_keys(spark.createDataFrame([(d, k) for d in "pq" for k in keys], "digest_key string, key string")))
    want = {(d, a, b) for d in "pq" for a in keys for b in keys if a != b and a in b}
    assert sorted(tuple(r) for r in pairs.collect()) == sorted(want)
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
