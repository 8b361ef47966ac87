"""Text expressions: truncation, title keys, whitespace, native HTML-to-text.

All of these are built-in Spark expressions so they stay inside
whole-stage codegen. The regular expressions avoid engine-specific
classes (``\\s`` differs between Java, RE2 and Python) by spelling the
whitespace set out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set, spelled out so Java and RE2 agree.
WS_CLASS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
WS_RUN = WS_CLASS + "+"
NON_ALNUM = r"[^\p{L}\p{N}]"

# Named entities decoded by the native HTML-to-text path.
NAMED_ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&mdash;", "—"),
    ("&ndash;", "–"),
    ("&hellip;", "…"),
    ("&amp;", "&"),
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def short_summary(text, max_length: int) -> Column:
    """First ``max_length`` code points plus ``...`` only when longer."""
    t = col_(text)
    return F.when(F.length(t) > F.lit(max_length),
                  F.concat(F.substring(t, 1, max_length), F.lit("..."))).otherwise(t)


def title_key(title) -> Column:
    """Lower-case, keep only letters and digits."""
    return F.regexp_replace(F.lower(col_(title)), NON_ALNUM, "")


def collapse_ws(text) -> Column:
    """Runs of whitespace to one space, then strip both ends."""
    t = F.regexp_replace(col_(text), WS_RUN, " ")
    return F.regexp_replace(t, "^ | $", "")


def first_line(text) -> Column:
    """First line of a text (up to the first newline), whole."""
    return F.substring_index(col_(text), "\n", 1)


def html_to_text_native(html) -> Column:
    """X3, native form: drop comments, script/style/template bodies and tags,
    decode the common named entities, collapse whitespace.

    Text nodes are separated by one space, as the tree form does; this form
    treats the markup as well formed.
    """
    h = F.coalesce(col_(html), F.lit(""))
    h = F.regexp_replace(h, r"(?s)<!--.*?-->", " ")
    for tag in ("script", "style", "template"):
        h = F.regexp_replace(h, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    h = F.regexp_replace(h, r"<[^>]*>", " ")
    for ent, ch in NAMED_ENTITIES:
        h = F.replace(h, F.lit(ent), F.lit(ch))
    return collapse_ws(h)
