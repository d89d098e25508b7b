"""Extracting records from a table of stored web pages ``(page_id, url, html)``.

The original crawler fetched review pages and read review blocks with CSS
selectors. Here the fetch is out of scope and the parse runs on stored
pages: each layout is a set of regular expressions (a block pattern and one
pattern per field), applied with ``regexp_extract_all`` + ``explode`` and
``regexp_extract``, all inside the JVM. Pages are independent, so the work
is a narrow map over the page table.

Layouts:
- ``review``: elements ``<div ... data-hook="review" ...>`` up to their own end tags; fields and
  defaults as the crawler had them (rating 0, helpful 0, reviewer
  'UNKNOWN', blank strings).
- ``article``: one block per ``<article>``; title is the ``<h1>`` text and
  the body is the remaining text with tags removed and spaces collapsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.functions import lexicons as lx

Q = "[\"']"  # attribute quote

# A review's block: a div element with this start tag, up to its own end tag.
REVIEW_START = rf"^<div(?=\s)[^>]*\sdata-hook={Q}review{Q}"
DIV_TAG = r"(?=<div[\s>]|</div\s*>)"
# Block pattern: group 1 is the block content.
ARTICLE_BLOCK = r"(?s)<article[^>]*>(.*?)</article>"

# Field patterns of the review layout (group 1 is the value).
REVIEW_FIELDS = {
    "review_id": rf"^<div(?:[^>]*\s)?id={Q}([^\"']*){Q}",
    "reviewer_id": r"/profile/([A-Z0-9]+)",
    "reviewer_name": rf"(?s)<span[^>]*class={Q}a-profile-name{Q}[^>]*>([^<]*)",
    "rating_text": rf"(?s)data-hook={Q}review-star-rating{Q}[^>]*>\s*<span[^>]*>([^<]*)",
    "title": rf"(?s)<a[^>]*data-hook={Q}review-title{Q}[^>]*>.*?<span[^>]*>([^<]*)</span>\s*</a>",
    "body": rf"(?s)<span[^>]*data-hook={Q}review-body{Q}[^>]*>\s*<span[^>]*>([^<]*)",
    "date": rf"(?s)<span[^>]*data-hook={Q}review-date{Q}[^>]*>([^<]*)",
    "helpful_text": rf"(?s)<span[^>]*data-hook={Q}helpful-vote-statement{Q}[^>]*>([^<]*)",
}
VERIFIED_BADGE = rf"data-hook={Q}avp-badge{Q}"
ASIN_IN_URL = r"/product-reviews/([A-Z0-9]+)"

SPACE_RUN = r"[ \t\n\r\f]+"


def _ex(col: Column, pattern: str) -> Column:
    return F.regexp_extract(col, pattern, 1)


# FIXED VALUES: the named entities of running text; the ampersand's own comes last.
ENTITIES = {"&nbsp;": " ", "&quot;": '"', "&#34;": '"', "&apos;": "'", "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def _decoded(col: Column) -> Column:
    for entity, text in ENTITIES.items():
        col = F.replace(col, F.lit(entity), F.lit(text))
    return F.trim(col)


def _clean_text(col: Column) -> Column:
    no_tags = F.regexp_replace(col, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(no_tags, SPACE_RUN, " "))


def elements(html: str, start: str) -> tuple[Column, Column]:
    """The div elements whose start tag matches ``start``: a column ``c`` to select first, and over it the
    array of the elements' whole texts.

    The page is cut before every div tag; the running number of open divs at each cut tells where an
    element's own end tag is. An element that is never closed runs to the end of the page.
    """
    cuts = F.split(F.coalesce(F.col(html), F.lit("")), DIV_TAG)
    depth = F.aggregate(
        F.transform(cuts, lambda c: F.when(F.startswith(c, F.lit("</div")), -1).when(c.rlike(r"^<div[\s>]"), 1).otherwise(0)),
        F.array().cast("array<int>"), lambda d, x: F.concat(d, F.array(F.coalesce(F.try_element_at(d, F.lit(-1)), F.lit(0)) + x)))
    at = F.filter(F.sequence(F.lit(1), F.size("c.cuts")), lambda i: F.element_at("c.cuts", i).rlike(start))

    def whole(i: Column) -> Column:
        left = F.size("c.cuts") - i
        end = F.array_position(F.slice("c.depth", i + 1, left), F.element_at("c.depth", i) - 1)
        return F.array_join(F.slice("c.cuts", i, F.when(end > 0, end).otherwise(left + 1).cast("int")), "")

    return F.struct(cuts.alias("cuts"), depth.alias("depth")).alias("c"), F.transform(at, whole)


def extract_review_blocks(pages: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    """Raw-review rows from pages in the review layout (one row per block).

    A field is its element's first text node, entities decoded. ``scraped_at``
    defaults to the current timestamp.
    """
    cut, found = elements("html", REVIEW_START)
    blocks = pages.select("page_id", "url", cut).select("page_id", "url", F.posexplode(found).alias("block_no", "block"))
    b = F.col("block")
    rid = _ex(b, REVIEW_FIELDS["review_id"])
    rating_tok = F.split(F.trim(_ex(b, REVIEW_FIELDS["rating_text"])), " ").getItem(0)
    helpful = _ex(_ex(b, REVIEW_FIELDS["helpful_text"]), r"(\d+)")
    asin = _ex(F.col("url"), ASIN_IN_URL)
    reviewer = _ex(b, REVIEW_FIELDS["reviewer_id"])
    return blocks.select(
        "page_id", "block_no",
        F.when(rid != "", rid).alias("review_id"),
        F.when(asin != "", asin).otherwise(F.lit(lx.UNKNOWN_ID)).alias("product_asin"),
        F.when(reviewer != "", reviewer).otherwise(F.lit(lx.UNKNOWN_ID)).alias("reviewer_id"),
        _decoded(_ex(b, REVIEW_FIELDS["reviewer_name"])).alias("reviewer_name"),
        F.coalesce(rating_tok.try_cast("double"), F.lit(0.0)).alias("rating"),
        _decoded(_ex(b, REVIEW_FIELDS["title"])).alias("title"),
        _decoded(_ex(b, REVIEW_FIELDS["body"])).alias("body"),
        _decoded(_ex(b, REVIEW_FIELDS["date"])).alias("date"),
        F.regexp_like(b, F.lit(VERIFIED_BADGE)).alias("verified_purchase"),
        F.coalesce(F.when(helpful != "", helpful).try_cast("int"), F.lit(0)).alias("helpful_votes"),
        (scraped_at if scraped_at is not None else F.current_timestamp()).alias("scraped_at"),
    )


def extract_articles(pages: DataFrame) -> DataFrame:
    """One row per ``<article>``: page_id, url, block_no, title, body, n_paragraphs."""
    blocks = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(ARTICLE_BLOCK), 1))
                          .alias("block_no", "block"))
    b = F.col("block")
    title = _clean_text(_ex(b, r"(?s)<h1[^>]*>(.*?)</h1>"))
    rest = F.regexp_replace(b, r"(?s)<h1[^>]*>.*?</h1>", " ")
    return blocks.select("page_id", "url", "block_no", title.alias("title"), _clean_text(rest).alias("body"),
                         F.regexp_count(b, F.lit(r"<p[ >]")).cast("int").alias("n_paragraphs"))


def extract_with_rules(pages: DataFrame, block: str, fields: dict[str, str]) -> DataFrame:
    """Generic extraction: one row per match of ``block`` (group 1 = block text)
    and one string column per field pattern (group 1, trimmed; '' when absent)."""
    blocks = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(block), 1))
                          .alias("block_no", "block"))
    return blocks.select("page_id", "url", "block_no",
                         *[F.trim(_ex(F.col("block"), pat)).alias(name) for name, pat in fields.items()])


def extract_page_records(pages: DataFrame, layout: str | dict = "review") -> DataFrame:
    """Records from stored pages: a layout name (``review``, ``article``) or
    rules ``{"block": pattern, "fields": {name: pattern}}``."""
    if isinstance(layout, dict):
        return extract_with_rules(pages, layout["block"], layout["fields"])
    if layout == "review":
        return extract_review_blocks(pages)
    if layout == "article":
        return extract_articles(pages)
    raise ValueError(f"unknown page layout {layout!r}")
