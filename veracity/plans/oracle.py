"""DuckDB SQL for each registered query: an independent statement of the result.

Each statement runs on the driver's pre-registered views and starts from the
same ``reviews`` mapping as the Spark side (``veracity.sources.fixture``).
The SQL says *what* each operator returns in the most direct form (for
example, bursts with ``lead(day, 4)`` over sorted dates), not how the Spark
operator computes it.

RE2 has no look-around and an ASCII ``\\b``, so word bounds are written as
``(^|[^\\p{L}\\p{N}_])(...)($|[^\\p{L}\\p{N}_])``; counting hits uses word
tokens instead.
"""

from __future__ import annotations

from veracity.functions import lexicons as lx
from veracity.functions.text import WHITESPACE_CLASS
from veracity.sources.fixture import with_reviews

NW = r"[^\p{L}\p{N}_]"


def _bounded(words) -> str:
    return f"(?i)(^|{NW})({'|'.join(words)})($|{NW})"


def _substr(words) -> str:
    return f"(?i)({'|'.join(words)})"


SPAM_SCORING = (f"regexp_matches(body, '{_bounded(lx.SPAM_PHRASES_SCORING)}') "
                f"OR regexp_matches(body, '{_bounded(lx.SPAM_WORDS_SCORING)}') "
                f"OR regexp_matches(body, '(?i)https?://')")
WORDS = f"len(regexp_extract_all(body, '[^{WHITESPACE_CLASS}]+'))"
UPPER = r"(length(body) - length(regexp_replace(body, '\p{Lu}', '', 'g')))"
EXCL = "(length(body) - length(replace(body, '!', '')))"

# Reviews with defaults applied and the per-review signals.
SIGNALS_CTE = f"""
d AS (
  SELECT review_id, product_asin, coalesce(reviewer_id, 'UNKNOWN') AS reviewer_id,
         coalesce(rating, 3.0) AS rating, coalesce(body, '') AS body, date,
         coalesce(verified_purchase, false) AS verified_purchase,
         coalesce(helpful_votes, 0) AS helpful_votes, scraped_at, fake_probability
  FROM reviews),
sig AS (
  SELECT *,
    (length(body) < 20 OR {SPAM_SCORING}
     OR (rating IN (1.0, 5.0) AND helpful_votes = 0 AND length(body) < 50)) AS spam_flag,
    CAST({WORDS} AS INTEGER) AS word_count,
    regexp_matches(body, 'https?://') AS has_url,
    CAST({EXCL} AS INTEGER) AS exclamation_count,
    CAST({UPPER} AS DOUBLE) / greatest(length(body), 1) AS caps_ratio
  FROM d)"""

# Parsed review day: tail after the last ' on ', strict 'Month d, yyyy'.
DAY_EXPR = ("CASE WHEN tail = trim(tail) THEN CAST(try_strptime(tail, '%B %d, %Y') AS DATE) END")
BURSTS_CTE = f"""
dated AS (
  SELECT reviewer_id, {DAY_EXPR} AS day
  FROM (SELECT reviewer_id, string_split(coalesce(date, ''), ' on ')[-1] AS tail FROM sig)),
seq AS (
  SELECT reviewer_id, day, lead(day, 4) OVER (PARTITION BY reviewer_id ORDER BY day) AS day5
  FROM dated WHERE day IS NOT NULL),
bursts AS (
  SELECT r.reviewer_id, coalesce(bool_or(date_diff('day', s.day, s.day5) <= 1), false) AS burst_activity
  FROM (SELECT DISTINCT reviewer_id FROM sig) r LEFT JOIN seq s ON s.reviewer_id = r.reviewer_id
  GROUP BY r.reviewer_id)"""

FLAGS_CTE = f"""
stats AS (
  SELECT reviewer_id, CAST(count(*) AS INTEGER) AS total_reviews,
    round_even(CAST(sum(rating) AS DOUBLE) * 1e2 / count(rating), 0) / 1e2 AS avg_rating,
    round_even(sqrt(greatest(count(*) * sum(rating * rating) - sum(rating) * sum(rating), 0)) / count(*), 2) AS rating_std,
    bool_and(rating IN (1.0, 5.0)) AS all_extreme_ratings,
    CAST(count(*) FILTER (WHERE NOT verified_purchase) AS DOUBLE) / count(*) AS unverified_ratio,
    count(*) FILTER (WHERE NOT verified_purchase) * 5 > count(*) * 4 AS unverified_over_limit
  FROM sig GROUP BY reviewer_id),
flags AS (
  SELECT s.*, b.burst_activity FROM stats s JOIN bursts b USING (reviewer_id)),
scored AS (
  SELECT sig.*, f.total_reviews, f.avg_rating, f.rating_std, f.all_extreme_ratings,
    f.burst_activity, f.unverified_ratio,
    least((CASE WHEN f.all_extreme_ratings THEN 3 ELSE 0 END)
        + (CASE WHEN f.burst_activity THEN 3 ELSE 0 END)
        + (CASE WHEN f.unverified_over_limit THEN 2 ELSE 0 END)
        + (CASE WHEN sig.spam_flag THEN 2 ELSE 0 END), 10) AS score_tenths
  FROM sig JOIN flags f USING (reviewer_id))"""


def _q(ctes: list[str], body: str) -> str:
    return with_reviews("").rstrip() + ",\n" + ",\n".join(c.strip() for c in ctes) + "\n" + body


def _base(body: str, upto: str = "scored") -> str:
    order = ["signals", "bursts", "flags"]
    parts = {"signals": SIGNALS_CTE, "bursts": BURSTS_CTE, "flags": FLAGS_CTE}
    need = {"sig": ["signals"], "bursts": ["signals", "bursts"],
            "scored": ["signals", "bursts", "flags"]}[upto]
    return _q([parts[p] for p in order if p in need], body)


ORACLE: dict[str, str] = {}

ORACLE["review_signals"] = _base("""
SELECT review_id, reviewer_id, spam_flag, word_count, has_url, exclamation_count, caps_ratio
FROM sig""", "sig")

ORACLE["reviewer_bursts"] = _base("""
SELECT reviewer_id, burst_activity FROM bursts""", "bursts")

ORACLE["reviewer_flags"] = _base("""
SELECT reviewer_id, total_reviews, avg_rating, rating_std, all_extreme_ratings, burst_activity,
       unverified_ratio FROM flags""")


def sround(num: str, den: str, digits: int, even: bool = True) -> str:
    """SQL twin of ``functions.numeric.scaled_round``: round(num/den, digits) on the scaled quotient."""
    fn = "round_even" if even else "round"
    return f"({fn}(CAST({num} AS DOUBLE) * 1e{digits} / NULLIF({den}, 0), 0) / 1e{digits})"


def mean6(col: str) -> str:
    return sround(f"sum({col})", f"count({col})", 6, even=False)


POS_B, NEG_B = _bounded(lx.POSITIVE_WORDS), _bounded(lx.NEGATIVE_WORDS)
POS_S, NEG_S, MIS_S = _substr(lx.POSITIVE_WORDS), _substr(lx.NEGATIVE_WORDS), _substr(lx.MISMATCH_WORDS_SQL)


def sentiments_cte(name: str, preset: str) -> str:
    if preset == "hql":
        pos, neg, mis, where = POS_S, NEG_S, MIS_S, "WHERE body IS NOT NULL AND length(body) > 10"
    else:
        pos, neg, mis, where = POS_B, NEG_B, NEG_B, ""
    return f"""
{name} AS (
  SELECT review_id, coalesce(product_asin, 'UNKNOWN') AS product_asin, reviewer_id, rating, body,
    word_count, spam_flag, CAST(score_tenths AS DOUBLE) / 10 AS reviewer_fraud_score,
    CAST(regexp_matches(body, '{pos}') AS INTEGER) AS positive_signal,
    CAST(regexp_matches(body, '{neg}') AS INTEGER) AS negative_signal,
    CAST(rating >= 4.0 AND regexp_matches(body, '{mis}') AS INTEGER) AS rating_sentiment_mismatch,
    date AS review_date, score_tenths
  FROM scored {where})"""


def _scored(body: str, *extra: str) -> str:
    return _q([SIGNALS_CTE, BURSTS_CTE, FLAGS_CTE, *extra], body)


ORACLE["fraud_scores"] = _scored("""
SELECT review_id, reviewer_id, product_asin, spam_flag, total_reviews, avg_rating, rating_std,
       all_extreme_ratings, burst_activity, unverified_ratio,
       CAST(score_tenths AS DOUBLE) / 10 AS reviewer_fraud_score,
       CASE WHEN score_tenths >= 5 THEN 'FAKE' ELSE 'GENUINE' END AS verdict
FROM scored""")

ORACLE["lexicon_signals"] = with_reviews(f"""
SELECT review_id,
  CAST(regexp_matches(b, '{POS_B}') AS INTEGER) AS positive_signal,
  CAST(regexp_matches(b, '{NEG_B}') AS INTEGER) AS negative_signal,
  CAST(r >= 4.0 AND regexp_matches(b, '{NEG_B}') AS INTEGER) AS rating_sentiment_mismatch,
  CAST(regexp_matches(b, '{POS_S}') AS INTEGER) AS positive_signal_hql,
  CAST(regexp_matches(b, '{NEG_S}') AS INTEGER) AS negative_signal_hql,
  CAST(r >= 4.0 AND regexp_matches(b, '{MIS_S}') AS INTEGER) AS rating_sentiment_mismatch_hql
FROM (SELECT review_id, coalesce(body, '') AS b, coalesce(rating, 3.0) AS r FROM reviews)""")

ORACLE["review_sentiments"] = _scored("""
SELECT review_id, product_asin, reviewer_id, rating, body, word_count, spam_flag,
       reviewer_fraud_score, positive_signal, negative_signal, rating_sentiment_mismatch, review_date
FROM sent""", sentiments_cte("sent", "hql"))


def _suspicious(min_reviews: int, preset: str, mismatch_col: str) -> str:
    return _scored(f"""
SELECT reviewer_id, count(*) AS review_count, {mean6('rating')} AS avg_rating,
  count(*) FILTER (WHERE spam_flag) AS spam_count,
  {sround('sum(score_tenths)', 'count(*) * 10', 6, even=False)} AS avg_fraud_score,
  CAST(sum(rating_sentiment_mismatch) AS BIGINT) AS {mismatch_col}
FROM sent GROUP BY reviewer_id HAVING count(*) >= {min_reviews}""", sentiments_cte("sent", preset))


ORACLE["suspicious_reviewers"] = _suspicious(4, "hql", "mismatches")
ORACLE["suspicious_reviewers_min2"] = _suspicious(2, "word", "mismatch_count")


def _product_summary(with_std: bool, preset: str) -> str:
    std = "round(stddev_pop(rating), 6) AS rating_stddev," if with_std else ""
    score_name = "avg_fraud_exposure" if with_std else "avg_fraud_score"
    return _scored(f"""
SELECT product_asin, count(*) AS total_reviews, {mean6('rating')} AS avg_rating, {std}
  count(*) FILTER (WHERE spam_flag) AS spam_reviews,
  {sround('count(*) FILTER (WHERE spam_flag) * 100', 'count(*)', 2, even=False)} AS spam_percentage,
  CAST(sum(rating_sentiment_mismatch) AS BIGINT) AS sentiment_mismatches,
  {sround('sum(score_tenths)', 'count(*) * 10', 6, even=False)} AS {score_name}
FROM sent GROUP BY product_asin""", sentiments_cte("sent", preset))


ORACLE["product_fraud_summary"] = _product_summary(True, "hql")
ORACLE["suspicious_reviewers_head"] = ORACLE["suspicious_reviewers"] + """
ORDER BY avg_fraud_score DESC, reviewer_id LIMIT 10"""
ORACLE["product_fraud_summary_head"] = ORACLE["product_fraud_summary"] + """
ORDER BY spam_percentage DESC, product_asin LIMIT 10"""
ORACLE["product_fraud_summary_basic"] = _product_summary(False, "word")

ORACLE["daily_review_bursts"] = _scored(f"""
SELECT product_asin, review_date, count(*) AS daily_count, {mean6('rating')} AS daily_avg_rating,
  count(*) FILTER (WHERE spam_flag) AS daily_spam_count
FROM sent GROUP BY product_asin, review_date HAVING count(*) > 10""", sentiments_cte("sent", "hql"))

ORACLE["daily_review_bursts_min3"] = _scored(f"""
SELECT product_asin, date_clean, count(*) AS daily_count, {mean6('rating')} AS daily_avg_rating,
  count(*) FILTER (WHERE spam_flag) AS daily_spam_count
FROM (SELECT *, CASE WHEN contains(coalesce(review_date, ''), ' on ')
                     THEN trim(string_split(review_date, ' on ')[-1]) ELSE 'Unknown' END AS date_clean
      FROM sent)
GROUP BY product_asin, date_clean HAVING count(*) >= 3""", sentiments_cte("sent", "word"))

FREQ_SQL = f"""
SELECT reviewer_id, count(*) AS total_reviews, {mean6('rating')} AS avg_rating,
  count(DISTINCT coalesce(product_asin, 'UNKNOWN')) AS unique_products,
  count(*) FILTER (WHERE fake_probability >= 0.5) AS fake_count,
  min(scraped_at) AS first_review_at, max(scraped_at) AS last_review_at,
  {sround("count(*) FILTER (WHERE fake_probability >= 0.5)", "count(*)", 6, even=False)} AS fake_ratio
FROM scored GROUP BY reviewer_id HAVING count(*) >= 3"""
ORACLE["reviewer_frequency"] = _scored(FREQ_SQL)
ORACLE["reviewer_times"] = _scored("""
SELECT reviewer_id, scraped_at FROM scored
WHERE reviewer_id IN (SELECT reviewer_id FROM scored GROUP BY reviewer_id HAVING count(*) >= 3)""")
ORACLE["reviewer_products"] = _scored("""
SELECT DISTINCT reviewer_id, coalesce(product_asin, 'UNKNOWN') AS product_asin FROM scored
WHERE reviewer_id IN (SELECT reviewer_id FROM scored GROUP BY reviewer_id HAVING count(*) >= 3)""")

HOURLY_SQL = f"""
SELECT coalesce(product_asin, 'UNKNOWN') AS product_asin,
  strftime(date_trunc('hour', scraped_at), '%Y-%m-%d-%H') AS hour,
  count(*) AS review_count, {mean6('rating')} AS avg_rating,
  count(*) FILTER (WHERE fake_probability >= 0.5) AS fake_count
FROM scored GROUP BY 1, 2 HAVING count(*) >= 5"""
ORACLE["hourly_bursts"] = _scored(HOURLY_SQL)


def _deviation(fake_cond: str, require_both: bool) -> str:
    having = "HAVING count(*) FILTER (WHERE f) > 0 AND count(*) FILTER (WHERE NOT f) > 0" if require_both else ""
    nf = "greatest(fake_review_count, 1)"
    ng = "greatest(genuine_review_count, 1)"
    return f"""
SELECT product_asin, total_reviews,
  {sround('s_all', 'total_reviews', 2)} AS overall_avg,
  {sround('s_gen', ng, 2)} AS genuine_avg,
  {sround('s_fake', nf, 2)} AS fake_avg,
  {sround(f's_fake * {ng} - s_gen * {nf}', f'{nf} * {ng}', 2)} AS rating_inflation,
  fake_review_count, genuine_review_count
FROM (SELECT product_asin, count(*) AS total_reviews, sum(rating) AS s_all,
        count(*) FILTER (WHERE f) AS fake_review_count,
        coalesce(sum(rating) FILTER (WHERE f), 0.0) AS s_fake,
        count(*) FILTER (WHERE NOT f) AS genuine_review_count,
        coalesce(sum(rating) FILTER (WHERE NOT f), 0.0) AS s_gen
      FROM (SELECT coalesce(product_asin, 'UNKNOWN') AS product_asin, rating,
                   coalesce({fake_cond}, false) AS f FROM scored)
      GROUP BY product_asin {having})"""


DEVIATION_SQL = _deviation("fake_probability >= 0.5", True)
ORACLE["rating_deviation"] = _scored(DEVIATION_SQL)
ORACLE["rating_inflation_report"] = _scored(_deviation("score_tenths >= 5", False))

ORACLE["analytics_snapshot"] = _scored(f"""
SELECT * FROM (
  SELECT 'reviewer_frequency' AS section, reviewer_id AS item_key, CAST(fake_ratio AS DOUBLE) AS metric,
         CAST(total_reviews AS BIGINT) AS item_count, *
  FROM ({FREQ_SQL}) ORDER BY fake_ratio DESC, reviewer_id LIMIT 50)
UNION ALL BY NAME
SELECT 'burst_events' AS section, concat_ws('|', product_asin, hour) AS item_key, CAST(avg_rating AS DOUBLE) AS metric,
       CAST(review_count AS BIGINT) AS item_count, * FROM ({HOURLY_SQL})
UNION ALL BY NAME
SELECT * FROM (
  SELECT 'rating_deviations' AS section, product_asin AS item_key, CAST(rating_inflation AS DOUBLE) AS metric,
         CAST(total_reviews AS BIGINT) AS item_count, *
  FROM ({DEVIATION_SQL}) ORDER BY abs(rating_inflation) DESC, product_asin LIMIT 50)""")

ORACLE["overall_summary"] = _scored(f"""
SELECT count(*) AS total_reviews,
  count(*) FILTER (WHERE score_tenths >= 5) AS fake_reviews,
  count(*) FILTER (WHERE score_tenths < 5) AS genuine_reviews,
  count(*) FILTER (WHERE spam_flag) AS spam_flagged,
  {sround('count(*) FILTER (WHERE score_tenths >= 5) * 100', 'greatest(count(*), 1)', 2)} AS fake_percentage,
  count(DISTINCT reviewer_id) AS distinct_reviewers
FROM scored""")

REPORT_SQL = f"""
SELECT reviewer_id, count(*) AS review_count,
  {sround('sum(rating)', 'count(rating)', 2)} AS avg_rating,
  bool_and(rating IN (1.0, 5.0)) AS all_extreme_ratings,
  {sround('sum(score_tenths)', 'count(*) * 10', 2)} AS avg_fraud_score,
  count(*) FILTER (WHERE NOT verified_purchase) AS unverified_count
FROM scored GROUP BY reviewer_id"""
ORACLE["reviewer_report"] = _scored(f"""
SELECT * FROM ({REPORT_SQL}) ORDER BY avg_fraud_score DESC, reviewer_id LIMIT 5""")
ORACLE["burst_reviewers"] = _scored(f"""
SELECT * FROM ({REPORT_SQL}) WHERE review_count >= 3 AND avg_fraud_score >= 0.5
ORDER BY avg_fraud_score DESC, reviewer_id LIMIT 5""")

ORACLE["top_suspicious_reviews"] = _scored("""
SELECT review_id, reviewer_id, product_asin, rating, CAST(score_tenths AS DOUBLE) / 10 AS reviewer_fraud_score,
  spam_flag, word_count, round_even(caps_ratio, 4) AS caps_ratio, exclamation_count, burst_activity,
  all_extreme_ratings, unverified_ratio, total_reviews, body
FROM scored ORDER BY score_tenths DESC, review_id LIMIT 5""")

ORACLE["feature_preview"] = _scored("""
SELECT review_id, body, word_count, round_even(caps_ratio, 3) AS caps_ratio, exclamation_count, has_url,
  spam_flag, CAST(score_tenths AS DOUBLE) / 10 AS reviewer_fraud_score,
  CASE WHEN score_tenths >= 5 THEN 'FAKE' ELSE 'GENUINE' END AS verdict
FROM scored ORDER BY review_id LIMIT 5""")


# --- normalisation, dates, weak labels ------------------------------------
from veracity.functions.text import WHITESPACE_CHARS  # noqa: E402
from veracity.sources.fixture import REVIEW_SOURCE_SQL  # noqa: E402

WS_LIT = "'" + WHITESPACE_CHARS.replace("'", "''") + "'"


def words_sql(c: str) -> str:
    return f"len(regexp_extract_all({c}, '[^{WHITESPACE_CLASS}]+'))"


def upper_sql(c: str) -> str:
    return rf"(length({c}) - length(regexp_replace({c}, '\p{{Lu}}', '', 'g')))"


def excl_sql(c: str) -> str:
    return f"(length({c}) - length(replace({c}, '!', '')))"


def lexicon_count_sql(c: str, words) -> str:
    return (rf"len(list_filter(regexp_extract_all({c}, '[\p{{L}}\p{{N}}_]+'), "
            f"lambda x: regexp_full_match(x, '(?i)({'|'.join(words)})')))")


def label_points_sql(t: str, r: str) -> str:
    w = words_sql(t)
    return f"""((CASE WHEN {w} < 5 AND {r} IN (1.0, 5.0) THEN 35 ELSE 0 END)
  + (CASE WHEN {excl_sql(t)} > 4 THEN 20 ELSE 0 END)
  + (CASE WHEN {upper_sql(t)} * 10 > greatest(length({t}), 1) * 3 THEN 20 ELSE 0 END)
  + (CASE WHEN regexp_matches({t}, '{_bounded(lx.SPAM_WORDS_LOADER)}') THEN 30 ELSE 0 END)
  + (CASE WHEN {r} >= 4.0 AND regexp_matches({t}, '{_bounded(lx.NEGATIVE_WORDS_LOADER)}') THEN 35 ELSE 0 END)
  + (CASE WHEN {w} < 8 AND {r} = 5.0 THEN 15 ELSE 0 END)
  + (CASE WHEN {lexicon_count_sql(t, lx.POSITIVE_WORDS_LOADER)} >= 3 AND {w} < 15 THEN 20 ELSE 0 END))"""


NORMALISED_SQL = f"""
WITH src AS ({REVIEW_SOURCE_SQL}),
kept AS (
  SELECT * FROM src
  WHERE "reviews.text" IS NOT NULL AND "reviews.rating" IS NOT NULL
    AND trim("reviews.text", {WS_LIT}) <> '' AND trim("reviews.text", {WS_LIT}) <> 'nan'),
p AS (
  SELECT *, TRY_CAST("reviews.rating" AS DOUBLE) AS rnum,
    try_strptime("reviews.date", '%Y-%m-%d %H:%M:%S') AS ts,
    coalesce(TRY_CAST(trunc(TRY_CAST("reviews.numHelpful" AS DOUBLE)) AS INTEGER), 0) AS helpful
  FROM kept),
normalised AS (
  SELECT upper(substr(sha256(CAST(source_row AS VARCHAR)), 1, 32)) AS review_id,
    coalesce(asins, 'UNKNOWN') AS product_asin,
    coalesce("reviews.username", 'UNKNOWN') AS reviewer_id,
    coalesce("reviews.username", 'Anonymous') AS reviewer_name,
    least(5.0, greatest(1.0, coalesce(rnum, 3.0))) AS rating,
    coalesce("reviews.title", '') AS title,
    trim("reviews.text", {WS_LIT}) AS body,
    CASE WHEN ts IS NOT NULL THEN 'Reviewed in the United States on ' || strftime(ts, '%B %d, %Y')
         ELSE 'Reviewed in the United States on January 01, 2024' END AS date,
    helpful > 0 AS verified_purchase, helpful AS helpful_votes,
    coalesce(name, '') AS product_name,
    coalesce(brand, '') AS brand,
    coalesce("primaryCategories", '') AS category,
    CAST({label_points_sql('"reviews.text"', 'coalesce(rnum, 3.0)')} >= 50 AS INTEGER) AS is_fake_ground_truth
  FROM p)"""

ORACLE["normalise_reviews"] = NORMALISED_SQL + "\nSELECT * FROM normalised"

ORACLE["sample_reviews"] = NORMALISED_SQL + """
SELECT review_id, reviewer_id, rating, is_fake_ground_truth FROM normalised
ORDER BY md5(review_id || '42'), review_id LIMIT 5000"""

ORACLE["rating_distribution"] = NORMALISED_SQL + f"""
SELECT CAST(floor(rating) AS INTEGER) AS star, count(*) AS review_count, o.*
FROM normalised CROSS JOIN (
  SELECT {sround('sum(rating)', 'count(rating)', 2)} AS overall_avg_rating,
    count(*) FILTER (WHERE is_fake_ground_truth = 1) AS fake_labels,
    count(*) FILTER (WHERE is_fake_ground_truth = 0) AS genuine_labels FROM normalised) o
GROUP BY ALL"""

ORACLE["review_dates"] = with_reviews(f"""
SELECT review_id,
  CASE WHEN contains(coalesce(date, ''), ' on ') THEN trim(tail, {WS_LIT}) ELSE 'Unknown' END AS date_clean,
  {DAY_EXPR} AS review_day
FROM (SELECT review_id, date, string_split(coalesce(date, ''), ' on ')[-1] AS tail FROM reviews)""")

ORACLE["weak_labels"] = with_reviews(f"""
SELECT review_id, label_points, CAST(label_points >= 50 AS INTEGER) AS is_fake_ground_truth
FROM (SELECT review_id, {label_points_sql('b', 'r')} AS label_points
      FROM (SELECT review_id, coalesce(body, '') AS b, coalesce(rating, 3.0) AS r FROM reviews))""")


# --- ML tables --------------------------------------------------------------
FEATURES_SQL = f"""
SELECT review_id, CAST({WORDS} AS INTEGER) AS word_count,
  {sround(UPPER, 'greatest(length(body), 1)', 4)} AS caps_ratio,
  CAST({EXCL} AS INTEGER) AS exclamation_count,
  CAST(regexp_matches(body, 'https?://') AS INTEGER) AS has_url,
  CAST(regexp_matches(body, '{_bounded(lx.SPAM_WORDS_TRAINER)}') AS INTEGER) AS spam_word_hit,
  CAST(regexp_matches(body, '{POS_B}') AS INTEGER) AS positive_signal,
  CAST(regexp_matches(body, '{NEG_B}') AS INTEGER) AS negative_signal,
  CAST(rating >= 4.0 AND regexp_matches(body, '{NEG_B}') AS INTEGER) AS sentiment_mismatch,
  CAST(all_extreme_ratings AS INTEGER) AS all_extreme, CAST(burst_activity AS INTEGER) AS burst_activity,
  unverified_ratio, total_reviews, CAST(verified_purchase AS INTEGER) AS verified_purchase, rating,
  CAST({label_points_sql('body', 'rating')} >= 50 AS INTEGER) AS label
FROM scored"""
FT_CTE = f"ft AS ({FEATURES_SQL})"

ORACLE["feature_table"] = _scored("SELECT * FROM ft", FT_CTE)

PROXY_SQL = """SELECT review_id, CASE WHEN CAST(score_tenths AS DOUBLE) / 10 > 0.5 THEN 1.0e0 ELSE 0.0e0 END AS label
FROM scored"""
ORACLE["proxy_labels"] = _scored(PROXY_SQL)
ORACLE["class_balance"] = _scored(f"SELECT label, count(*) AS n FROM ({PROXY_SQL}) GROUP BY label")

_TDF = r"""
tk AS (SELECT review_id, regexp_extract_all(lower(coalesce(body, '')), '[\p{L}\p{N}_]{2,}') AS t FROM reviews),
terms AS (
  SELECT review_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM tk)
SELECT term, count(*) AS term_freq, count(DISTINCT review_id) AS doc_freq
FROM terms GROUP BY term HAVING count(DISTINCT review_id) >= 2
ORDER BY term_freq DESC, term LIMIT 300"""
ORACLE["term_doc_freq"] = with_reviews("").rstrip() + "," + _TDF

ORACLE["balanced_counts"] = _scored("""
SELECT review_id, label,
  CASE WHEN label = ml THEN big // m + CASE WHEN rk < big % m THEN 1 ELSE 0 END ELSE 1 END AS copies
FROM (SELECT review_id, label,
        row_number() OVER (PARTITION BY label ORDER BY md5(review_id || '42'), review_id) - 1 AS rk FROM ft) r,
     (SELECT label AS ml, n AS m FROM (SELECT label, count(*) AS n FROM ft GROUP BY label)
      ORDER BY n, CAST(label AS VARCHAR) LIMIT 1) mi,
     (SELECT n AS big FROM (SELECT label, count(*) AS n FROM ft GROUP BY label)
      ORDER BY n DESC, CAST(label AS VARCHAR) DESC LIMIT 1) ma""", FT_CTE)

ORACLE["stratified_split"] = _scored("""
SELECT review_id, label,
  row_number() OVER (PARTITION BY label ORDER BY md5(review_id || '42'), review_id) - 1
    < ceil(0.2 * count(*) OVER (PARTITION BY label)) AS is_test
FROM ft""", FT_CTE)

ORACLE["label_noise"] = _scored("""
SELECT review_id, CASE WHEN flip THEN 1 - label ELSE label END AS label, flip AS noise_flipped
FROM (SELECT review_id, label,
        row_number() OVER (ORDER BY md5(review_id || '42'), review_id) - 1
          < greatest(1, floor(count(*) OVER () * 0.05)) AS flip FROM ft)""", FT_CTE)

EVAL_CTE = f"""
lab AS (SELECT review_id, CAST({label_points_sql('b', 'r')} >= 50 AS INTEGER) AS label, fake_probability AS score
        FROM (SELECT review_id, coalesce(body, '') AS b, coalesce(rating, 3.0) AS r, fake_probability FROM reviews)),
ev AS (SELECT label = 1 AS pos, score, score >= 0.5 AS pred FROM lab WHERE score IS NOT NULL),
ps AS (SELECT score, count(*) FILTER (WHERE pos) AS pos, count(*) FILTER (WHERE NOT pos) AS neg FROM ev GROUP BY score),
cum AS (SELECT *,
          coalesce(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
          coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
        FROM ps)"""


def _eval(body: str) -> str:
    return with_reviews("").rstrip() + "," + EVAL_CTE + "\n" + body


def _rate(num: str, den: str) -> str:
    return f"coalesce({sround(num, den, 4)}, 0.0e0)"


ORACLE["classifier_metrics"] = _eval(f"""
SELECT n, tp, fp, tn, fn,
  {_rate('tp + tn', 'n')} AS accuracy, {_rate('tp', 'tp + fp')} AS precision,
  {_rate('tp', 'tp + fn')} AS recall, {_rate('2 * tp', '2 * tp + fp + fn')} AS f1,
  {_rate('u2', '2 * (tp + fn) * (fp + tn)')} AS auc_roc
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE pos AND pred) AS tp,
        count(*) FILTER (WHERE NOT pos AND pred) AS fp, count(*) FILTER (WHERE NOT pos AND NOT pred) AS tn,
        count(*) FILTER (WHERE pos AND NOT pred) AS fn FROM ev) c,
     (SELECT coalesce(sum(pos * (2 * neg_below + neg)), 0) AS u2 FROM cum) u""")

ORACLE["confusion_matrix"] = _eval("""
SELECT CAST(pos AS INTEGER) AS label, CAST(pred AS INTEGER) AS prediction, count(*) AS n
FROM ev GROUP BY 1, 2""")

ORACLE["roc_curve"] = _eval("""
SELECT score AS threshold, CAST(P - pos_below AS BIGINT) AS tp, CAST(N - neg_below AS BIGINT) AS fp,
  CAST(P - pos_below AS DOUBLE) / NULLIF(P, 0) AS tpr, CAST(N - neg_below AS DOUBLE) / NULLIF(N, 0) AS fpr
FROM cum, (SELECT sum(pos) AS P, sum(neg) AS N FROM ps) t
UNION ALL
SELECT CAST('Infinity' AS DOUBLE), 0, 0, 0e0 / NULLIF(P, 0), 0e0 / NULLIF(N, 0)
FROM (SELECT sum(pos) AS P, sum(neg) AS N FROM ps) t WHERE P IS NOT NULL""")

_CLASS_ROW = """
SELECT '{name}' AS class, {p} AS p, {r} AS r, {f} AS f, {support} AS support FROM c"""


def _ratio(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0e0), 0e0)"


def _weighted(m: str) -> str:
    return _ratio(f"(a.{m} * a.support + b.{m} * b.support)", "n")


ORACLE["per_class_report"] = _eval(f"""
, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE pos AND pred) AS tp, count(*) FILTER (WHERE NOT pos AND pred) AS fp,
          count(*) FILTER (WHERE NOT pos AND NOT pred) AS tn, count(*) FILTER (WHERE pos AND NOT pred) AS fn FROM ev),
a AS ({_CLASS_ROW.format(name="0", p=_ratio("tn", "tn + fn"), r=_ratio("tn", "tn + fp"),
                         f=_ratio("2 * tn", "2 * tn + fn + fp"), support="tn + fp")}),
b AS ({_CLASS_ROW.format(name="1", p=_ratio("tp", "tp + fp"), r=_ratio("tp", "tp + fn"),
                         f=_ratio("2 * tp", "2 * tp + fp + fn"), support="tp + fn")}),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b
  UNION ALL SELECT 'macro avg', (a.p + b.p) / 2, (a.r + b.r) / 2, (a.f + b.f) / 2, n FROM a, b, c
  UNION ALL SELECT 'weighted avg', {_weighted("p")}, {_weighted("r")}, {_weighted("f")}, n FROM a, b, c
  UNION ALL SELECT 'accuracy', {_ratio("tp + tn", "n")}, {_ratio("tp + tn", "n")}, {_ratio("tp + tn", "n")}, n FROM c)
SELECT class, {_rate("p", "1")} AS precision, {_rate("r", "1")} AS recall, {_rate("f", "1")} AS f1, support FROM u""")


# --- stored pages -------------------------------------------------------------
ORACLE["extract_page_records"] = r"""
SELECT page_id, url, block_no,
  trim(regexp_replace(regexp_replace(regexp_extract(block, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'),
                      '[ \t\n\r\f]+', ' ', 'g')) AS title,
  trim(regexp_replace(regexp_replace(regexp_replace(block, '(?s)<h1[^>]*>.*?</h1>', ' ', 'g'), '<[^>]*>', ' ', 'g'),
                      '[ \t\n\r\f]+', ' ', 'g')) AS body,
  CAST(len(regexp_extract_all(block, '<p[ >]')) AS INTEGER) AS n_paragraphs
FROM (SELECT page_id, url, unnest(bl) AS block, CAST(unnest(range(0, len(bl))) AS INTEGER) AS block_no
      FROM (SELECT page_id, url, regexp_extract_all(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS bl FROM pages))"""

_UNIFORM = "('0x' || left(md5(review_id || '42/{draw}'), 13))::BIGINT / 4503599627370496.0e0"

ORACLE["random_split"] = _scored(f"""
SELECT review_id, label, CASE WHEN {_UNIFORM.format(draw='split')} >= 0.8e0 THEN 1 ELSE 0 END AS part FROM ({PROXY_SQL})""")

# Copies: how many values of the Poisson distribution function lie at or below the row's uniform number.
ORACLE["oversampled_labels"] = _scored(f"""
SELECT review_id, label, unnest(range(copies)) AS copy_no
FROM (SELECT p.review_id, p.label, CASE WHEN p.label = 1.0e0 THEN count(c.cdf) ELSE 1 END AS copies
      FROM (SELECT *, {_UNIFORM.format(draw='oversample')} AS u FROM pl) p
      LEFT JOIN cdfs c ON p.label = 1.0e0 AND c.cdf <= p.u GROUP BY p.review_id, p.label)""",
    f"""pl AS ({PROXY_SQL}),
rate AS (SELECT least(count(*) FILTER (WHERE label <> 1.0e0) / greatest(count(*) FILTER (WHERE label = 1.0e0), 1)::DOUBLE,
                      5.0e0) AS r FROM pl),
steps AS (SELECT r, generate_series(1, 51) AS ks FROM rate),
cdfs AS (SELECT sum(p) OVER (ORDER BY k) AS cdf FROM (
  SELECT 0 AS k, exp(-r) AS p FROM rate
  UNION ALL SELECT k, exp(-r) * list_product(list_transform(range(1, k + 1), lambda j: r / j)) FROM (
    SELECT r, unnest(ks) AS k FROM steps)))""")

ORACLE["cv_folds"] = _scored("""
SELECT review_id, label,
  ((row_number() OVER (PARTITION BY label ORDER BY md5(review_id || '42'), review_id) - 1) % 5)::INTEGER AS fold
FROM ft""", FT_CTE)

ORACLE["reviewer_bursts_ts"] = with_reviews("""
SELECT reviewer_id, coalesce(bool_or(last - scraped_at <= INTERVAL 24 HOURS), false) AS burst_activity
FROM (SELECT coalesce(reviewer_id, 'UNKNOWN') AS reviewer_id, scraped_at,
             CASE WHEN scraped_at IS NOT NULL THEN lead(scraped_at, 4) OVER (
               PARTITION BY coalesce(reviewer_id, 'UNKNOWN') ORDER BY scraped_at NULLS LAST) END AS last FROM reviews)
GROUP BY reviewer_id""")

_STOP = ", ".join(f"'{w}'" for w in lx.STOP_WORDS)
ORACLE["tfidf_weights"] = with_reviews("").rstrip() + r""",
tk AS (SELECT review_id, list_filter(regexp_extract_all(lower(coalesce(body, '')), '[\p{L}\p{N}_]{2,}'),
                                     lambda x: x NOT IN (""" + _STOP + r""")) AS t FROM reviews),
terms AS (
  SELECT review_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM tk),
tf AS (SELECT review_id, term, count(*) AS n FROM terms GROUP BY ALL),
vocab AS (SELECT term, sum(n) AS term_freq, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 2
          ORDER BY term_freq DESC, term LIMIT 300),
w AS (SELECT review_id, term, n * ln(((SELECT count(*) FROM reviews) + 1.0e0) / (df + 1.0e0)) AS x FROM tf JOIN vocab USING (term))
SELECT review_id, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY review_id)), 6) AS weight FROM w WHERE x <> 0"""

# Expected records of the pages that ``fixture.review_pages_from_tables`` writes, from the values written.
ORACLE["extract_review_records"] = r"""
WITH t AS (SELECT page_id, trim(regexp_extract(coalesce(html, ''), '<title>([^<&]*)', 1)) AS title
           FROM pages)
SELECT page_id, 0 AS block_no, 'R' || page_id AS review_id, 'B' || page_id % 7 AS product_asin,
       'A' || page_id AS reviewer_id, 'Name & ' || page_id AS reviewer_name, (page_id % 5 + 1)::DOUBLE AS rating,
       'Title ' || page_id AS title, title AS body, 'Reviewed in the United States on January 1, 2024' AS date,
       page_id % 2 = 0 AS verified_purchase, (page_id % 9)::INTEGER AS helpful_votes FROM t
UNION ALL
SELECT page_id, 1, CASE WHEN page_id % 4 > 0 THEN 'S' || page_id END, 'B' || page_id % 7, 'UNKNOWN', '', 0, '', title, '', false, 0
FROM t"""
