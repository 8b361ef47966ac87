"""Keyword score (X1) and keyword exclusion.

Matching is a case-insensitive substring test without word boundaries,
and an empty keyword matches everything. Keywords are lower-cased once
on the driver; a text is lower-cased in the JVM and read once, by one
automaton of all keywords (Aho-Corasick, in Arrow batches), so the cost
follows the text and its matches, not the length of the list. A worker
builds the automaton of a list once. A keyword given twice counts twice.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from storyloom.functions.text import col_
from storyloom.params import SUMMARY_SCORE, TITLE_SCORE


@lru_cache(maxsize=4)
def _automaton(words: tuple[tuple[str, int], ...]):
    import ahocorasick
    machine = ahocorasick.Automaton()
    for place, (word, times) in enumerate(words):
        machine.add_word(word, (place, times))
    machine.make_automaton()
    return machine


def _count(text, words: tuple[tuple[str, int], ...]) -> Column:
    """How many of the keywords a text holds, each once per mention in the list; null for a null text."""

    @F.pandas_udf("int")
    def found(texts: pd.Series) -> pd.Series:
        machine = _automaton(words)
        return pd.Series([None if t is None else sum(times for _, times in {hit for _, hit in machine.iter(t)})
                          for t in texts], dtype="Int32")
    # else the optimizer moves it ahead of joins, where it reads the texts of all rows, not of those that are left
    return found.asNondeterministic()(F.lower(col_(text)))


def _listed(keywords) -> tuple[tuple[tuple[str, int], ...], int]:
    """The different keywords with their numbers, and the number of empty ones."""
    words = Counter(k.lower() for k in keywords)
    empty = words.pop("", 0)
    return tuple(sorted(words.items())), empty


def keyword_score(title, summary, keywords) -> Column:
    """+100 per keyword found in the title, +50 per keyword in the summary; a null text holds none."""
    words, empty = _listed(keywords)

    def part(text, points: int) -> Column:
        always = F.when(col_(text).isNotNull(), F.lit(empty * points)).otherwise(0)
        return always + F.coalesce(_count(text, words), F.lit(0)) * points if words else always
    return part(title, TITLE_SCORE) + part(summary, SUMMARY_SCORE)


def is_excluded(title, summary, keywords) -> Column:
    """true when any keyword is a substring of the lower-cased title or summary."""
    words, empty = _listed(keywords)
    if not words and not empty:
        return F.lit(False)

    def holds(text) -> Column:
        return F.when(col_(text).isNotNull(), F.lit(True)) if empty else _count(text, words) > 0
    return holds(title) | holds(summary)
