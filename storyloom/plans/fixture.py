"""Parameters used when the registered queries run over the driver tables."""

from __future__ import annotations

from storyloom.params import DigestParams
from storyloom.sources.tables import articles_as_of

FIXTURE_EXCLUDE = ("nicht",)
FIXTURE_KEYWORDS = ("elle", "wh")
FIXTURE_TOP_N = 15
FIXTURE_DAYS = 2


def fixture_params(spark, sf_dir: str, **kw) -> DigestParams:
    base = DigestParams(
        as_of=articles_as_of(spark, sf_dir),
        days_limit=FIXTURE_DAYS,
        summary_max_length=300,
        max_news_count=FIXTURE_TOP_N,
        exclude_keywords=FIXTURE_EXCLUDE,
        high_weight_keywords=FIXTURE_KEYWORDS,
    )
    return base.with_(**kw) if kw else base
