"""N-gram Jaccard join against all pairs in plain Python."""

import random
import re

import pytest

from storyloom.llm import ngram_join
from storyloom.llm.components import components
from storyloom.llm.ngram_join import keep_one_per_group, ngram_components

SCHEMA = "doc_id long, text string, cls string, token int, a int"


def _sets(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def brute(rows, width, num, den):
    sets = [_sets(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            x, y = sets[i], sets[j]
            if x and y and den * len(x & y) >= num * len(x | y):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids and sets[i] else d))
    return sorted(out, key=str)


def run(spark, rows, width, num, den):
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA)
    got = ngram_components(df.repartition(3), width, num, den).collect()
    return sorted([tuple(r) for r in got], key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    base = [[r.choice(vocab) for _ in range(r.randint(20, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.2:
            w = w[:-r.randint(1, 5)]
        rows.append((i, " ".join(w)))
    return rows


EDGE = [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "ONE"), (105, "one two"), (106, "one  two\n"),
        (107, "é É"), (108, "É É"), (109, "a b c"), (110, "A B\x0bC"), (110, "A B\x0bC"), (None, "a b c"),
        (None, "only null"), (111, "x " * 5000), (112, "x " * 4990 + "y")]


@pytest.mark.parametrize("seed,width,num,den", [(1, 3, 90, 100), (2, 3, 90, 100), (3, 5, 80, 100), (4, 2, 60, 100)])
def test_same_components_as_all_pairs(spark, seed, width, num, den):
    rows = corpus(seed) + EDGE
    assert run(spark, rows, width, num, den) == brute(rows, width, num, den)


@pytest.mark.parametrize("light,rows_a_block,entries", [(1, 5, 50), (3, 1000, 20), (8, 4, 10)])
def test_small_blocks_and_buckets_give_the_same(spark, monkeypatch, light, rows_a_block, entries):
    from storyloom.llm import ngram_join
    monkeypatch.setattr(ngram_join, "LIGHT", light)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(ngram_join, "BUCKET_ENTRIES", entries)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    rows = corpus(11, 90) + EDGE
    assert run(spark, rows, 3, 85, 100) == brute(rows, 3, 85, 100)


def test_large_group_of_near_copies_with_few_pairs(spark):
    r = random.Random(5)
    base = [f"v{r.randrange(500)}" for _ in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 250):
        w = list(base)
        for _ in range(r.randint(1, 3)):
            w[r.randrange(200)] = f"n{i}"
        rows.append((i, " ".join(w)))
    assert run(spark, rows, 3, 90, 100) == brute(rows, 3, 90, 100)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_components(df).collect() == []
    assert keep_one_per_group(df).collect() == []


def test_one_of_each_group_stays_with_all_columns(spark):
    text = " ".join(f"k{i}" for i in range(60))
    rows = [(3, text, 1), (1, text + " more", 2), (2, "quite another text with words of its own here", 3),
            (9, None, 4), (None, text, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((tuple(x) for x in kept.collect()), key=str) == sorted([rows[1], rows[2], rows[3], rows[4]], key=str)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (300, 299)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 299: 299, 300: 299}


def chain_texts():
    """Three texts of which neighbours have a similarity of 16 / 17 in single words, the ends less."""
    w = [f"w{i}" for i in range(40)]
    return " ".join(w[:33]), " ".join(w[1:34]), " ".join(w[2:35])


def test_a_text_with_null_ids_only_links_its_neighbours(spark):
    a, b, c = chain_texts()
    rows = [(1, a), (None, b), (2, c), (None, b), (3, "nothing like it at all " * 3), (None, "own words only " * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.ngram_components(df, 1, 93, 100).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (None, 1), (None, 1), (3, 3), (None, None)], key=str)


def test_repeated_rows_are_fetched_and_verified_once(spark, monkeypatch):
    a, b, _ = chain_texts()
    rows = [(1, a)] * 300 + [(2, b)] * 300 + [(3, "unlike " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    links = ngram_join._links

    def counted(pairs, texts, *rest):
        seen.append((pairs.count(), texts.count()))
        return links(pairs, texts, *rest)
    monkeypatch.setattr(ngram_join, "_links", counted)
    got = {(r["doc_id"], r["component_id"]) for r in ngram_join.ngram_components(df, 1, 93, 100).collect()}
    assert got == {(1, 1), (2, 1), (3, 3)}
    assert seen == [(1, 2)]


def test_counters_of_many_tasks_add_up(spark):
    import numpy as np
    texts = [f"a{i % 7} b{i % 11} c" for i in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(37)
    schema = "doc_id long, n_shingles long, cls long, inside array<int>, slice int, counts binary"
    one = ngram_join.frequencies(df.coalesce(1).mapInArrow(ngram_join._profile(1), schema))
    many = ngram_join.frequencies(df.mapInArrow(ngram_join._profile(1), schema))
    assert np.array_equal(one, many) and int(many.sum()) == 1500
