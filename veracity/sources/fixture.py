"""The ``reviews`` stand-in table, built from the driver's test tables.

The review layer needs rows of the raw-review schema. This module only maps
test-table columns onto that schema; it computes no signal, flag, score or
label. Every ``events`` row becomes one review and its body is the *whole*
text of one ``documents`` row (assigned round-robin by ``event_id``), so the
work of every query grows with both tables. A short trigger phrase is
appended to some bodies and some bodies are upper-cased, so the spam,
sentiment, URL and caps signals have something to find; ``labels`` supplies a
model-like ``fake_probability``. Two hot keys are built in on purpose: all
``error`` events belong to reviewer ``UNKNOWN`` and all ``view`` events to
product ``PHOT`` (a fifth of the rows each), so skew handling is exercised.

The same mapping is given twice: as DataFrame code for Spark and as SQL text
for the DuckDB oracle. ``tests/test_fixture.py`` checks the two agree row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.sources.tables import read_table

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Suffix appended to the body, chosen by event_id % 13 (index = remainder).
_SUFFIXES = [" Buy now", " free", " terrible scam", " great love best", " http://x.example",
             "!!!!!!", " freedom loved", " Check out our website", " awful but great",
             " hate it", "", "", ""]

RAW_COLUMNS = ["review_id", "product_asin", "reviewer_id", "reviewer_name", "rating", "title",
               "body", "date", "verified_purchase", "helpful_votes", "product_name", "brand",
               "category", "scraped_at"]


def _suffix(event_id: Column) -> Column:
    r = F.pmod(event_id, F.lit(13))
    expr = F.lit("")
    for i, s in enumerate(_SUFFIXES):
        if s:
            expr = F.when(r == i, F.lit(s)).otherwise(expr)
    return expr


def reviews_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews (plus ``fake_probability``) derived from events/documents/labels."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id",
                                                         "event_type", "value")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")

    # One-row aggregate: a broadcast of exactly one row is size-bounded.
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    # Hash-partition the (narrow) events on the join key with the session's
    # shuffle width: a shuffle join on doc_key reuses this partitioning, and
    # when AQE broadcasts ``documents`` instead, the text-heavy work after the
    # join still runs in that many tasks rather than in one per input file.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = (events.crossJoin(F.broadcast(n_docs))
         .withColumn("doc_key", F.pmod(F.col("event_id"), F.col("n_docs")))
         .drop("n_docs")
         .repartition(parts, "doc_key"))
    j = (e.join(docs, e["doc_key"] == docs["doc_id"], "inner")
         .join(labels, "doc_id", "left"))

    eid, uid = F.col("event_id"), F.col("user_id")
    value_bucket = F.floor(F.col("value")).cast("bigint")
    text = F.when(F.pmod(eid, F.lit(17)) == 0, F.translate("text", _LOWER, _UPPER)).otherwise(F.col("text"))
    rating = F.when(F.pmod(uid, F.lit(6)) == 0,
                    F.when(F.pmod(eid, F.lit(2)) == 0, F.lit(5)).otherwise(F.lit(1))
                    ).otherwise(F.lit(1) + F.pmod(eid * 7 + uid, F.lit(5))).cast("double")
    et = F.col("event_type")
    verified = (F.when(F.pmod(uid, F.lit(4)) == 0, F.lit(False))
                .when(F.pmod(uid, F.lit(4)) == 1, et == "purchase")
                .otherwise(et.isin("purchase", "click", "view")))
    product_no = F.pmod(value_bucket, F.lit(20))
    return j.select(
        eid.cast("string").alias("review_id"),
        F.when(et == "view", F.lit("PHOT")).otherwise(F.concat(F.lit("P"), product_no.cast("string"))).alias("product_asin"),
        F.when(et == "error", F.lit("UNKNOWN")).otherwise(F.concat(F.lit("U"), uid.cast("string"))).alias("reviewer_id"),
        F.concat(F.lit("Customer "), uid.cast("string")).alias("reviewer_name"),
        rating.alias("rating"),
        F.concat(F.initcap(F.col("lang")), F.lit(" review")).alias("title"),
        F.concat(text, _suffix(eid)).alias("body"),
        F.when(F.pmod(eid, F.lit(29)) == 0, F.lit("Unknown"))
         .otherwise(F.concat(F.lit("Reviewed in the United States on "),
                             F.date_format("ts", "MMMM dd, yyyy"))).alias("date"),
        verified.alias("verified_purchase"),
        F.pmod(value_bucket, F.lit(7)).cast("int").alias("helpful_votes"),
        F.concat(F.lit("Product "), product_no.cast("string")).alias("product_name"),
        F.col("source").alias("brand"),
        F.col("lang").alias("category"),
        F.col("ts").alias("scraped_at"),
        F.when(F.col("quality").isNull() & F.col("toxic").isNull(), F.lit(None).cast("double"))
         .otherwise((F.lit(1) - F.col("quality")) * F.lit(0.6) + F.col("toxic") * F.lit(0.3))
         .alias("fake_probability"),
    )


def _sql_suffix() -> str:
    whens = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SUFFIXES) if s)
    return f"CASE e.event_id % 13 {whens} ELSE '' END"


# DuckDB form of ``reviews_from_tables`` (tables are pre-registered views).
REVIEWS_SQL = f"""
SELECT CAST(e.event_id AS VARCHAR) AS review_id,
  CASE WHEN e.event_type = 'view' THEN 'PHOT'
       ELSE 'P' || CAST(CAST(floor(e.value) AS BIGINT) % 20 AS VARCHAR) END AS product_asin,
  CASE WHEN e.event_type = 'error' THEN 'UNKNOWN'
       ELSE 'U' || CAST(e.user_id AS VARCHAR) END AS reviewer_id,
  'Customer ' || CAST(e.user_id AS VARCHAR) AS reviewer_name,
  CAST(CASE WHEN e.user_id % 6 = 0 THEN CASE WHEN e.event_id % 2 = 0 THEN 5 ELSE 1 END
            ELSE 1 + (e.event_id * 7 + e.user_id) % 5 END AS DOUBLE) AS rating,
  upper(substr(d.lang, 1, 1)) || lower(substr(d.lang, 2)) || ' review' AS title,
  CASE WHEN e.event_id % 17 = 0 THEN translate(d.text, '{_LOWER}', '{_UPPER}')
       ELSE d.text END || {_sql_suffix()} AS body,
  CASE WHEN e.event_id % 29 = 0 THEN 'Unknown'
       ELSE 'Reviewed in the United States on ' || strftime(e.ts, '%B %d, %Y') END AS date,
  CASE WHEN e.user_id % 4 = 0 THEN false
       WHEN e.user_id % 4 = 1 THEN e.event_type = 'purchase'
       ELSE e.event_type IN ('purchase', 'click', 'view') END AS verified_purchase,
  CAST(CAST(floor(e.value) AS BIGINT) % 7 AS INTEGER) AS helpful_votes,
  'Product ' || CAST(CAST(floor(e.value) AS BIGINT) % 20 AS VARCHAR) AS product_name,
  d.source AS brand,
  d.lang AS category,
  e.ts AS scraped_at,
  CASE WHEN l.quality IS NULL AND l.toxic IS NULL THEN NULL
       ELSE (1 - l.quality) * 0.6e0 + l.toxic * 0.3e0 END AS fake_probability
FROM (SELECT ev.*, ev.event_id % n.n_docs AS doc_key
      FROM events ev CROSS JOIN (SELECT count(*) AS n_docs FROM documents) n) e
JOIN documents d ON d.doc_id = e.doc_key
LEFT JOIN labels l ON l.doc_id = d.doc_id
"""


def with_reviews(sql: str) -> str:
    """Prefix an oracle query with the ``reviews`` CTE."""
    return f"WITH reviews AS ({REVIEWS_SQL})\n{sql}"


def review_source_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review dump in the layout of a public CSV export (dotted column names).

    Maps every ``events`` row (with the whole text of one document) onto the
    source columns a normaliser has to resolve, including the kinds of bad
    values such dumps contain: blank and "nan" texts, unparseable ratings and
    dates, out-of-range ratings, fractional vote counts, over-long names and
    missing ids. All values are strings, as a CSV reader yields them.
    """
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = (events.crossJoin(F.broadcast(n_docs))
         .withColumn("doc_key", F.pmod(F.col("event_id"), F.col("n_docs"))).drop("n_docs")
         .repartition(parts, "doc_key"))
    j = e.join(docs, e["doc_key"] == docs["doc_id"], "inner")
    eid, uid = F.col("event_id"), F.col("user_id")

    def m(k):
        return F.pmod(eid, F.lit(k))
    none = F.lit(None).cast("string")
    return j.select(
        eid.alias("source_row"),
        F.when(m(23) == 0, F.lit("   ")).when(m(31) == 0, F.lit("nan")).when(m(37) == 0, none)
         .otherwise(F.concat(F.lit("  "), F.col("text"), F.lit(" "))).alias("reviews.text"),
        F.when(m(11) == 0, F.lit("x")).when(m(11) == 1, F.lit("0")).when(m(11) == 2, F.lit("7"))
         .when(m(11) == 3, none).when(m(11) == 4, F.lit("4.5"))
         .otherwise((F.lit(1) + m(5)).cast("string")).alias("reviews.rating"),
        F.when(m(5) == 0, none).otherwise(F.concat(F.col("lang"), F.lit(" "), F.col("source"), F.lit(" "),
                                                   F.repeat(F.lit("t"), m(120).cast("int")))).alias("reviews.title"),
        F.when(m(19) == 0, none).otherwise(F.concat(F.lit("shopper_"), uid.cast("string"),
                                                    F.repeat(F.lit("z"), m(9).cast("int")))).alias("reviews.username"),
        F.when(m(13) == 0, F.lit("not a date"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("reviews.date"),
        F.when(m(17) == 0, F.lit("x"))
         .otherwise(F.concat(F.floor("value").cast("bigint").cast("string"), F.lit(".7"))).alias("reviews.numHelpful"),
        F.when(m(43) == 0, none).otherwise(F.concat(F.lit("B"), F.lpad(F.pmod(uid, F.lit(50)).cast("string"), 9, "0"))).alias("asins"),
        F.concat(F.lit("Product "), F.pmod(uid, F.lit(50)).cast("string")).alias("name"),
        F.col("source").alias("brand"),
        F.col("lang").alias("primaryCategories"),
    )


REVIEW_SOURCE_SQL = """
SELECT e.event_id AS source_row,
  CASE WHEN e.event_id % 23 = 0 THEN '   ' WHEN e.event_id % 31 = 0 THEN 'nan'
       WHEN e.event_id % 37 = 0 THEN NULL ELSE '  ' || d.text || ' ' END AS "reviews.text",
  CASE WHEN e.event_id % 11 = 0 THEN 'x' WHEN e.event_id % 11 = 1 THEN '0' WHEN e.event_id % 11 = 2 THEN '7'
       WHEN e.event_id % 11 = 3 THEN NULL WHEN e.event_id % 11 = 4 THEN '4.5'
       ELSE CAST(1 + e.event_id % 5 AS VARCHAR) END AS "reviews.rating",
  CASE WHEN e.event_id % 5 = 0 THEN NULL
       ELSE d.lang || ' ' || d.source || ' ' || repeat('t', CAST(e.event_id % 120 AS INTEGER)) END AS "reviews.title",
  CASE WHEN e.event_id % 19 = 0 THEN NULL
       ELSE 'shopper_' || CAST(e.user_id AS VARCHAR) || repeat('z', CAST(e.event_id % 9 AS INTEGER)) END AS "reviews.username",
  CASE WHEN e.event_id % 13 = 0 THEN 'not a date' ELSE strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS "reviews.date",
  CASE WHEN e.event_id % 17 = 0 THEN 'x'
       ELSE CAST(CAST(floor(e.value) AS BIGINT) AS VARCHAR) || '.7' END AS "reviews.numHelpful",
  CASE WHEN e.event_id % 43 = 0 THEN NULL
       ELSE 'B' || lpad(CAST(e.user_id % 50 AS VARCHAR), 9, '0') END AS asins,
  'Product ' || CAST(e.user_id % 50 AS VARCHAR) AS name,
  d.source AS brand,
  d.lang AS "primaryCategories"
FROM (SELECT ev.*, ev.event_id % n.n_docs AS doc_key
      FROM events ev CROSS JOIN (SELECT count(*) AS n_docs FROM documents) n) e
JOIN documents d ON d.doc_id = e.doc_key
"""


def review_pages_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``pages`` row as a page in the review layout: a whole review, one without date, profile, badge,
    rating and votes (and for every fourth page without an id), nested blocks, then a footer and the original
    page, whose marks belong to no review."""
    p = read_table(spark, sf_dir, "pages")
    k = F.col("page_id").cast("string")
    text = F.regexp_extract(F.coalesce("html", F.lit("")), "<title>([^<&]*)", 1)
    badge = F.when(F.col("page_id") % 2 == 0, '<span data-hook="avp-badge">Verified</span>').otherwise("")
    own_id = F.when(F.col("page_id") % 4 > 0, F.concat(F.lit(' id="S'), k, F.lit('"'))).otherwise("")
    whole = F.concat(
        F.lit('<div id="list"><div id="R'), k, F.lit('" data-id="WRONG" data-hook="review" class="review"><div><a href="/profile/A'), k,
        F.lit('"><span class="a-profile-name">Name &amp; '), k, F.lit('</span></a></div><i data-hook="review-star-rating"><span>'),
        (F.col("page_id") % 5 + 1).cast("string"), F.lit('.0 out of 5 stars</span></i><a data-hook="review-title"><i></i><span>Title '), k,
        F.lit('</span></a><span data-hook="review-date">Reviewed in the United States on January 1, 2024</span>'), badge,
        F.lit('<div><span data-hook="review-body"><span>'), text, F.lit('</span></span></div><span data-hook="helpful-vote-statement">'),
        (F.col("page_id") % 9).cast("string"), F.lit(' people found this helpful</span></div>'))
    bare = F.concat(F.lit("<div"), own_id, F.lit(' data-id="WRONG" data-hook="review"><div><div></div><span data-hook="review-body"><span>'),
                    text, F.lit("</span></span></div></div>"))
    footer = F.lit('<div id="foot"><span data-hook="review-date">on May 5, 2020</span><a href="/profile/ZZZ">x</a>'
                   '<span data-hook="avp-badge">v</span></div></div>')
    return p.select("page_id", F.concat(F.lit("https://shop.example/product-reviews/B"), (F.col("page_id") % 7).cast("string")).alias("url"),
                    F.concat(whole, bare, footer, F.coalesce("html", F.lit(""))).alias("html"))
