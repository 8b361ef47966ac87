"""Containment by landmarks: what a key picks, keys of all levels, and work that does not grow with the square."""

import random

import pytest
from pyspark.sql import functions as F

from storyloom.operators.candidates import containment_pairs, distinct_keys
from storyloom.operators.landmarks import Picker, bit_set, common_landmarks, least, level_of, looked_up, sent


def _keys(spark, keys, dk=""):
    return distinct_keys(spark.createDataFrame([(dk, k) for k in keys], "digest_key string, key string"))


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij", "字符你好世界", "a"])
def test_a_longer_key_picks_what_an_inner_one_does(alphabet):
    rnd = random.Random(5)
    for _ in range(120):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(6, 300)))
        n = rnd.randrange(5, len(text))
        at = rnd.randrange(len(text) - n + 1)
        picker = Picker(["z" * 400, text, text[at:at + n], "y" * 5])
        level = level_of(n)
        assert least(level) <= n < least(level + 1)
        key, place, mark = picker.at(level, 0, int((picker.length >= least(level)).sum()))
        inner = {(p + at, m) for k, p, m in zip(key.tolist(), place.tolist(), mark.tolist()) if k == 2}
        outer = {(p, m) for k, p, m in zip(key.tolist(), place.tolist(), mark.tolist()) if k == 1}
        assert inner and inner <= outer


def test_containment_equals_the_definition_at_all_lengths(spark):
    rnd = random.Random(11)
    whole = ["".join(rnd.choice("abcdeé字𝄞") for _ in range(rnd.randrange(3, 900))) for _ in range(60)]
    keys = set(whole) | {"a" * n for n in (4, 5, 7, 8, 9, 31, 32, 500)} | {"ab" * 200, "ba" * 31}
    for w in whole:
        for _ in range(6):
            a = rnd.randrange(len(w))
            keys.add(w[a:a + rnd.randrange(1, len(w))])
            keys.add(w[:a] + w[a + 1:])
    keys = sorted(k for k in keys if k)
    got = {(r.inner, r.outer) for r in containment_pairs(_keys(spark, keys)).collect()}
    want = {(a, b) for a in keys for b in keys if a != b and len(a) >= 5 and a in b}
    assert got == want and len(want) > 300


def test_no_keys_and_short_keys(spark):
    assert containment_pairs(_keys(spark, [])).count() == 0
    assert containment_pairs(_keys(spark, ["abc", "abcd"])).count() == 0


def test_rows_sent_grow_with_the_keys(spark):
    """Titles of one language: copies of keys went to nearly all parts, so four times the keys were sent 16 times as often."""
    rnd = random.Random(2)
    words = ["".join(rnd.choice("aeiounrst") for _ in range(rnd.randrange(2, 7))) for _ in range(300)]
    every = sorted({"".join(rnd.choice(words) for _ in range(rnd.randrange(8, 60))) for _ in range(4000)})
    rows, sc = {}, spark.sparkContext
    for n in (1000, 4000):
        keys = _keys(spark, every[:n]).withColumn("kid", F.monotonically_increasing_id())
        inner = looked_up(keys, sc.broadcast(common_landmarks(keys)), 20_000)
        assert inner.count() == keys.count()
        rows[n] = sent(keys, sc.broadcast(bit_set(inner)), 20_000).count()
    assert rows[1000] >= 1000 and rows[4000] < 5 * rows[1000]
    assert rows[4000] < 4 * 4000
