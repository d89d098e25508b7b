"""Normalising review dumps of unknown layout into the raw-review schema.

Columns are found by candidate name lists (first present wins); names may
contain dots. Rows without text or rating, or with blank / "nan" text, are
dropped; values are parsed with ``try_`` functions so bad input becomes a
default instead of an error. The weak label is computed from the text and
the unclamped rating, as the loader did.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.functions import lexicons as lx
from veracity.functions.text import strip
from veracity.operators.sampling import sample_reviews
from veracity.operators.signals import fake_label

# FIXED VALUES: candidate source column names per logical field, in priority order.
CANDIDATES = {
    "text": ["reviews.text", "review_text", "reviewText", "text", "body"],
    "rating": ["reviews.rating", "rating", "overall", "stars"],
    "title": ["reviews.title", "review_title", "summary", "title"],
    "user": ["reviews.username", "reviewerName", "username", "reviewer"],
    "date": ["reviews.date", "reviewTime", "date", "review_date"],
    "helpful": ["reviews.numHelpful", "helpful", "helpful_votes"],
    "product": ["asins", "asin", "product_id", "id"],
    "product_name": ["name", "product_name", "productTitle"],
    "brand": ["brand", "manufacturer"],
    "category": ["primaryCategories", "category", "categories"],
}

# FIXED VALUES: length caps of label fields in the original schema. Off by default, and never
# for identifiers: a cut id would merge reviewers or products.
FIELD_CAPS = {"title": 100, "product_name": 100, "brand": 50, "category": 50}

# Date layouts tried in order (the loader accepted any layout its parser knew).
DATE_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss.SSSX", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss",
                "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
                "MM d, yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy",
                "yyyy/MM/dd", "MM/dd/yyyy"]


def resolve_columns(columns: list[str]) -> dict[str, str | None]:
    """Logical field -> first candidate present in ``columns`` (or None)."""
    present = set(columns)
    return {field: next((c for c in cands if c in present), None) for field, cands in CANDIDATES.items()}


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _text(name: str | None) -> Column:
    return _col(name).cast("string") if name else F.lit(None).cast("string")


def _capped(value: Column, field: str, default: str, caps: dict[str, int] | None) -> Column:
    if caps and field in caps and field in FIELD_CAPS:
        value = F.substring(value, 1, caps[field])
    return F.coalesce(value, F.lit(default))


def parse_timestamp(col: Column) -> Column:
    """First layout of DATE_FORMATS that parses; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in DATE_FORMATS])


def normalise_reviews(df: DataFrame, key_col: str | None = None, sample_n: int | None = None,
                      seed: int = 42, scraped_at: Column | None = None, caps: dict[str, int] | None = None) -> DataFrame:
    """Raw-review rows from a source frame; see module docstring.

    The review id is the first 32 hex digits (upper case) of a SHA-256: of
    ``key_col``, a source column that identifies a row, or else of the row's
    whole content, so it depends on neither partitioning nor retries (rows
    that repeat in full share it). ``sample_n`` keeps a seeded sample of that
    many rows. ``scraped_at`` defaults to the current timestamp. ``caps`` cuts
    label fields, e.g. ``FIELD_CAPS``. A rating of "nan" counts as missing.
    """
    cols = resolve_columns(df.columns)
    if not cols["text"] or not cols["rating"]:
        raise ValueError(f"no review text or rating column among {df.columns}")
    text, rating_raw = _col(cols["text"]), _col(cols["rating"])
    kept = df.filter(text.isNotNull() & rating_raw.isNotNull()
                     & (F.lower(strip(rating_raw.cast("string"))) != "nan")
                     & (strip(text.cast("string")) != "") & (strip(text.cast("string")) != "nan"))
    key = (_col(key_col).cast("string") if key_col else
           F.to_json(F.struct(*[_col(c).cast("string").alias(f"c{i}") for i, c in enumerate(sorted(df.columns))])))
    rating_num = rating_raw.cast("string").try_cast("double")
    helpful = F.coalesce(_text(cols["helpful"]).try_cast("double").try_cast("int"), F.lit(0))
    ts = parse_timestamp(_text(cols["date"]))
    user = _text(cols["user"])
    staged = kept.select(
        F.upper(F.substring(F.sha2(key, 256), 1, 32)).alias("review_id"),
        _capped(_text(cols["product"]), "product_asin", lx.UNKNOWN_ID, None).alias("product_asin"),
        _capped(user, "reviewer_id", lx.UNKNOWN_ID, None).alias("reviewer_id"),
        F.coalesce(user, F.lit(lx.ANONYMOUS)).alias("reviewer_name"),
        F.least(F.lit(5.0), F.greatest(F.lit(1.0), F.coalesce(rating_num, F.lit(3.0)))).alias("rating"),
        _capped(_text(cols["title"]), "title", "", caps).alias("title"),
        strip(text.cast("string")).alias("body"),
        F.when(ts.isNotNull(), F.concat(F.lit(lx.DATE_PREFIX), F.date_format(ts, "MMMM dd, yyyy")))
         .otherwise(F.lit(lx.DEFAULT_DATE_TEXT)).alias("date"),
        (helpful > 0).alias("verified_purchase"),
        helpful.cast("int").alias("helpful_votes"),
        _capped(_text(cols["product_name"]), "product_name", "", caps).alias("product_name"),
        _capped(_text(cols["brand"]), "brand", "", caps).alias("brand"),
        _capped(_text(cols["category"]), "category", "", caps).alias("category"),
        (scraped_at if scraped_at is not None else F.current_timestamp()).alias("scraped_at"),
        text.cast("string").alias("_label_text"),
        F.coalesce(rating_num, F.lit(3.0)).alias("_label_rating"),
    )
    out = (staged.withColumn("is_fake_ground_truth", fake_label("_label_text", "_label_rating"))
           .drop("_label_text", "_label_rating"))
    if sample_n is not None:
        out = sample_reviews(out, n=sample_n, seed=seed)
    return out


def unparsed_dates(df: DataFrame) -> DataFrame:
    """One row: ``n_dates`` given and ``n_unparsed`` of them that no layout reads (these would all
    take the default day)."""
    text = _text(resolve_columns(df.columns)["date"])
    given = text.isNotNull() & (strip(text) != "")
    return df.agg(F.count_if(given).alias("n_dates"), F.count_if(given & parse_timestamp(text).isNull()).alias("n_unparsed"))


def parse_review_dates(df: DataFrame) -> DataFrame:
    """Adds date_clean (text after ' on ', else 'Unknown') and review_day (parsed DATE)."""
    from veracity.functions import dates as dt
    return df.select("*", dt.review_day_text(F.col("date")).alias("date_clean"),
                     dt.review_day(F.col("date")).alias("review_day"))
