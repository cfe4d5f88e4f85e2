"""Anchors of stored pages: resolving, filtering, scoring."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from callsheet import dims
from callsheet.functions import html, urls
from callsheet.functions.regex import any_of
from callsheet.functions.stages import computed
from callsheet.functions.text import contains_any


@dataclass(frozen=True)
class LinkRules:
    target: list = field(default_factory=lambda: dims.TARGET_LINK_KEYWORDS)
    critical: list = field(default_factory=lambda: dims.CRITICAL_KEYWORDS)
    high: list = field(default_factory=lambda: dims.HIGH_KEYWORDS)
    excluded: list = field(default_factory=lambda: dims.EXCLUDED_PATH_PATTERNS)
    max_segments: int = 3
    min_score: int = 40


def extract_anchors(pages: DataFrame, url: str = "page_url") -> DataFrame:
    """One row per non-empty ``<a href>``: other columns, link_ord, href, link_text."""
    kept = [c for c in pages.columns if c != "html"]
    tags = (pages.filter(F.lower("html").contains("href"))
            .select(*kept, F.posexplode(html.anchors(F.col("html"))).alias("link_ord", "tag")))
    parts = computed(tags, href=html.anchor_href(F.col("tag")), link_text=html.anchor_text(F.col("tag")))
    return parts.drop("tag").filter(F.col("href") != "")


def resolve_links(anchors: DataFrame, url: str = "page_url") -> DataFrame:
    """Adds the normalised absolute ``link_url``; ``url`` must be normalised."""
    raw = computed(anchors, link_url=urls.resolve_link(F.col(url), F.col("href")))
    return computed(raw, link_url=urls.normalize_url(F.col("link_url")))


def internal_links(links: DataFrame, url: str = "page_url") -> DataFrame:
    return links.filter(urls.is_http(F.col("link_url"))
                        & (urls.url_host(F.col("link_url")) == urls.url_host(F.col(url))))


def keyword_gate(text: Column, url: Column, rules: LinkRules) -> Column:
    return contains_any(text, rules.target) | contains_any(F.lower(url), rules.target)


def excluded_path(url: Column, rules: LinkRules) -> Column:
    return contains_any(F.lower(urls.path(url)), rules.excluded)


def _has_segment(p: Column, words) -> Column:
    return p.rlike(rf"(?:^|/){any_of(words)}(?:/|$)") if words else F.lit(False)


def link_score(path: Column, text: Column, rules: LinkRules) -> Column:
    """Score of a lower-case path and link text: segment keywords beat partial
    keywords beat link text; deep paths lose up to 20 points."""
    n = F.size(F.regexp_extract_all(path, F.lit("[^/]+"), 0))
    malus = F.least(F.lit(20), 5 * F.greatest(n - rules.max_segments, F.lit(0)))
    plain = [w for w in rules.target if "/" not in w]
    return F.greatest(
        F.when(_has_segment(path, rules.critical), 100 - malus).otherwise(0),
        F.when(_has_segment(path, rules.high), 90 - malus).otherwise(0),
        F.when(contains_any(path, plain), 50).otherwise(0),
        F.when(contains_any(text, rules.target), 40).otherwise(0))


def score_links(pages: DataFrame, rules: LinkRules = LinkRules(), url: str = "page_url") -> DataFrame:
    """Internal links of ``pages`` worth following, with their score."""
    links = internal_links(resolve_links(extract_anchors(pages, url), url), url)
    gated = links.filter(keyword_gate(F.col("link_text"), F.col("link_url"), rules)
                         & ~excluded_path(F.col("link_url"), rules))
    kept = [c for c in pages.columns if c != "html"]
    scored = computed(computed(gated, path=F.lower(urls.path(F.col("link_url")))),
                      score=link_score(F.col("path"), F.col("link_text"), rules))
    return scored.filter(F.col("score") >= rules.min_score).select(
        *kept, "link_ord", "link_url", "link_text", "score")
