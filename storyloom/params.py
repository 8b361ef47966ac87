"""Run parameters and the fixed texts of the digest.

A run is fully described by :class:`DigestParams`; nothing reads the
wall clock, so re-running a job with the same ``as_of`` gives the same
answer.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results (and the
# rendered digest) to agree with the behaviour the engine reproduces.
# ---------------------------------------------------------------------------
DEFAULT_TITLE = "无标题"
NO_ABSTRACT_MARKER = "该文章无摘要内容，请点击阅读原文查看。"
NO_ABSTRACT_PROBE = "该文章无摘要内容"
NO_ABSTRACT_URL_PART = "hnrss.org"
NO_ABSTRACT_SITE = "Hacker News"
SEARCH_SITE_PREFIX = "Tavily检索 ("
SEARCH_SITE_SUFFIX = ")"
SEARCH_SITE_BARE = "Tavily"
MODEL_SUMMARY_SUFFIX = " ✨(AI摘要)"
MODEL_DEFAULT_PROMPT = "请对以下科技新闻内容进行摘要，提取核心技术突破或动态，限制在300字以内，直接输出摘要内容："
MODEL_FALLBACK_TITLE = "标题: "
MODEL_FALLBACK_CONTENT = "\n内容: "
DIGEST_TITLE = "# 科技新闻汇总\n"
DIGEST_EMPTY = "# 科技新闻汇总\n没有抓取到最近的新闻。\n"
DIGEST_TIME_LABEL = "**生成时间:** "
DIGEST_STATS_HEADING = "### 📊 今日抓取大盘"
DIGEST_STATS_TOTAL = ("- **总计抓取候选:** ", " 条")
DIGEST_STATS_ONBOARD = ("- **最终上榜:** ", " 条")
DIGEST_STATS_SITES = "- **上榜来源分布:** "
DIGEST_RULE_AFTER_STATS = "---\n"
DIGEST_ITEM_SITE = "**来源:** "
DIGEST_ITEM_TIME = "**时间:** "
DIGEST_ITEM_SCORE = "**热度:** "
DIGEST_SCORE_LABEL = ("[多源:", " | 关键词:", " | 热度:", "]")
DIGEST_ITEM_SUMMARY = "**摘要:**\n> "
DIGEST_READ_MORE = "阅读原文"
DIGEST_OTHER_SOURCES = " | 其他来源: "
DIGEST_ITEM_RULE = "---"
DIGEST_BADGE_MARK = "🔥"
DIGEST_BADGE_COUNT = ("(", "源)")
DIGEST_LOCAL_ZONE = "Asia/Shanghai"
DIGEST_TIME_FORMAT = "yyyy-MM-dd HH:mm"
PUSH_TITLE_PREFIX = "📰 全球科技新闻汇总 "
PUSH_TITLE_DATE_FORMAT = "yyyy年MM月dd日"
PUSH_EMPTY_NOTICE = "⚠️ 今日未抓取到符合条件的科技新闻，请检查配置或网络。"
TITLE_SCORE = 100
SUMMARY_SCORE = 50
SOURCE_BONUS = 200
CONTAINMENT_MIN_LEN = 5
PAGE_PARAGRAPH_MIN = 20
PAGE_BODY_MAX = 4000
PAGE_BODY_USABLE = 50
SEARCH_RESULTS_PER_QUERY = 10
MODEL_TEMPERATURE = 0.8
MODEL_MAX_TOKENS = 10000
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class DigestParams:
    """Everything one digest run depends on.

    ``as_of`` replaces "now": recency, missing dates and history expiry
    are all measured from it.
    """

    as_of: _dt.datetime | None = None
    days_limit: int = 2
    summary_max_length: int = 300
    max_news_count: int = 10
    exclude_keywords: tuple[str, ...] = ()
    high_weight_keywords: tuple[str, ...] = ()
    include_domains: tuple[str, ...] = ()
    similarity_threshold: float = 0.65
    short_content_threshold: int = 100
    history_days: int = 7
    model_prompt: str = MODEL_DEFAULT_PROMPT
    model_temperature: float = MODEL_TEMPERATURE
    model_max_tokens: int = MODEL_MAX_TOKENS
    # Feeds whose summary is replaced by the no-abstract marker.
    marker_sites: tuple[str, ...] = (NO_ABSTRACT_SITE,)
    marker_url_parts: tuple[str, ...] = (NO_ABSTRACT_URL_PART,)
    # Edge kinds used by story grouping; ratio edges are the only costly ones.
    use_ratio_edges: bool = True

    def with_(self, **kw) -> "DigestParams":
        return replace(self, **kw)
