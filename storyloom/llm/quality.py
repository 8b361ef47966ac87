"""Quality rules (operator 5): a table of thresholds compiled into one projection.

Every measure and rule is a built-in expression over the text; there are no user functions and no
shuffle. ``RULES`` lists (name, ratio or count, least, most); ``quality`` turns it into columns.

Words are ``[^\\x20\\x09-\\x0D]+``. ``n_repeat_words`` counts the words inside 5-word windows that
occur twice or more in the text: windows are hashed, and only texts with a repeated hash sort
(hash, position) pairs, mark windows with an equal neighbour, and add up the union of the marked
windows by walking their positions in order. The cost is n log n in a text's words, however long.

Defined results: a null or empty text has zero words and fails the base rules. Repeated rows give
a row each, a null id stays null, and other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, symbols, and stop words of four languages.
NOT_SPACE = r"[^\x20\x09-\x0D]++"
NOT_SYMBOL = r"[^#*$%&|<>]++"
STOP_WORDS = (
    "the be to of and that have with a in is it for on was as at by an this are from or",
    "der die das und ist in zu den von mit sich des auf für nicht ein eine als im dem",
    "le la les de des du et est en un une que qui dans pour pas sur au il elle avec",
    "el la los las de del y en que un una es se no por con para su al lo",
)
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A text passes if ``least <= measure <= most``; None is no bound."""
    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: SQL over the measures of ``_measures``; shares of words, characters or lines.
RULES = (
    Rule("length", "n_words", least=10),
    Rule("repetition", "n_repeat_words / n_words", most=0.2),
    Rule("word_length", "word_chars / n_words", least=2, most=14),
    Rule("symbols", "n_symbols / n_words", most=0.1),
    Rule("stop_words", "n_stop_words / n_words", least=0.02),
    Rule("letters", "n_letter_words / n_words", least=0.6),
    Rule("duplicate_lines", "n_dup_lines / n_lines", most=0.3),
    Rule("bullet_lines", "n_bullet_lines / n_lines", most=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines / n_lines", most=0.3),
)
BASE = ("length", "repetition")


def _stop_list() -> list[str]:
    words = sorted({w for line in STOP_WORDS for w in line.split()})
    return words + [w.capitalize() for w in words] + [w.upper() for w in words]


def _repeat_words() -> Column:
    """From ``grams`` (hash of the window at each position) and ``sorted_grams``."""
    return F.expr(f"""
        CASE WHEN sorted_grams IS NULL THEN 0L ELSE
          aggregate(
            array_sort(transform(
              filter(sorted_grams, (x, j) ->
                 (j > 0 AND x.g = sorted_grams[j - 1].g)
                 OR (j + 1 < size(sorted_grams) AND x.g = sorted_grams[j + 1].g)),
              x -> x.i)),
            named_struct('n', 0L, 'last', -{WINDOW}L),
            (acc, i) -> named_struct('n', acc.n + least({WINDOW}L, i - acc.last), 'last', i),
            acc -> acc.n) END""")


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measures that rules may use."""
    nonblank = r"[^\\x20\\x09-\\x0D]"
    stop = ", ".join("'" + w + "'" for w in _stop_list())
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .select("doc_id", "text",
                F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')").alias("w"),
                F.expr(f"filter(split(text, '\\n'), l -> l rlike '{nonblank}')").alias("lines"))
    grams = split.select(
        "*", F.size("w").cast("long").alias("n_words"),
        F.expr(f"""CASE WHEN size(w) >= {WINDOW} THEN
                   transform(sequence(1, size(w) - {WINDOW - 1}), i -> xxhash64(slice(w, i, {WINDOW})))
                   ELSE cast(array() AS array<bigint>) END""").alias("grams"))
    counted = grams.select(
        "doc_id", "n_words",
        F.expr("""CASE WHEN size(array_distinct(grams)) < size(grams) THEN
                  array_sort(transform(grams, (g, i) -> named_struct('g', g, 'i', cast(i AS bigint)))) END""")
        .alias("sorted_grams"),
        (F.length("text") - F.length(F.regexp_replace("text", NOT_SPACE, "")))
        .cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"size(filter(w, x -> x IN ({stop})))").cast("long").alias("n_stop_words"),
        F.expr(r"size(filter(w, x -> x rlike '\\p{L}'))").cast("long").alias("n_letter_words"),
        F.expr(r"size(filter(lines, l -> l rlike '^[\\x20\\t]*[-*\\u2022\\u25cf]'))").cast("long").alias("n_bullet_lines"),
        F.expr(r"size(filter(lines, l -> l rlike '(\\.\\.\\.|\\u2026)[\\x20\\t\\r]*$'))").cast("long").alias("n_ellipsis_lines"))
    return counted.select(*[c for c in counted.columns if c != "sorted_grams"],
                          _repeat_words().alias("n_repeat_words"))


def passes(rule: Rule) -> Column:
    """The compiled rule: no division by zero, and an absent ratio passes."""
    top, _, bottom = rule.measure.partition(" / ")
    value = F.col(top).cast("double")
    if bottom:
        value = value / F.nullif(F.col(bottom), F.lit(0))
    parts = [value >= rule.least] if rule.least is not None else []
    parts += [value <= rule.most] if rule.most is not None else []
    whole = parts[0] if len(parts) == 1 else parts[0] & parts[1]
    return F.coalesce(whole, F.lit(True))


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, ``base_failed``, ``failed`` (names of the failed rules) and ``kept``."""
    m = measures(docs)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    failed = F.filter(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules if r.name not in BASE]),
                      lambda x: x.isNotNull())
    return m.select("*", base.alias("base_failed"), failed.alias("failed")) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
