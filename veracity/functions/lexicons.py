"""Word lists and patterns whose values are fixed by the behaviour we match.

FIXED VALUES. These lists must equal the ones the original review pipeline
used, so they are stated here plainly, in their natural order, together.
Each preset names the stage that used it.
"""

from __future__ import annotations

# --- FIXED VALUES: spam phrases -------------------------------------------
# Per-review spam test of the scoring job: two word groups and any URL.
SPAM_PHRASES_SCORING = ["buy now", "click here", "visit our", "check out our website"]
SPAM_WORDS_SCORING = ["free", "discount", "promo code", "coupon"]
URL_PATTERN = r"https?://"

# Spam words of the label rules applied when reviews are loaded.
SPAM_WORDS_LOADER = ["buy now", "click here", "visit our", "free", "discount", "promo",
                     "coupon", "check out"]

# Spam words of the feature table used for training.
SPAM_WORDS_TRAINER = ["buy now", "click here", "visit our", "free", "discount", "promo",
                      "coupon"]

# --- FIXED VALUES: sentiment words ----------------------------------------
POSITIVE_WORDS = ["great", "excellent", "amazing", "perfect", "love", "best", "awesome",
                  "fantastic"]
NEGATIVE_WORDS = ["terrible", "awful", "horrible", "worst", "hate", "broken", "useless",
                  "scam"]
# The SQL summary's mismatch test omits the last negative word ("scam").
MISMATCH_WORDS_SQL = ["terrible", "awful", "horrible", "worst", "hate", "broken", "useless"]

# Longer lists of the label rules applied when reviews are loaded.
POSITIVE_WORDS_LOADER = ["great", "excellent", "amazing", "perfect", "love", "best",
                         "awesome", "fantastic", "outstanding"]
NEGATIVE_WORDS_LOADER = ["terrible", "awful", "horrible", "worst", "hate", "broken",
                         "useless", "scam", "garbage", "junk", "fake", "fraud"]

# --- FIXED VALUES: weak-label rule points (out of 100; fake at >= 50) -------
LABEL_POINTS_SHORT_EXTREME = 35   # fewer than 5 words and rating 1 or 5
LABEL_POINTS_EXCLAMATIONS = 20    # more than 4 '!'
LABEL_POINTS_CAPS = 20            # caps ratio above 0.30
LABEL_POINTS_SPAM = 30            # a loader spam word
LABEL_POINTS_MISMATCH = 35        # rating >= 4 with a loader negative word
LABEL_POINTS_GENERIC_FIVE = 15    # fewer than 8 words and rating 5
LABEL_POINTS_PRAISE_ONLY = 20     # 3+ loader positive words in fewer than 15 words
LABEL_THRESHOLD = 50

# --- FIXED VALUES: reviewer score terms (in tenths; capped at 10) ----------
SCORE_TENTHS_EXTREME = 3
SCORE_TENTHS_BURST = 3
SCORE_TENTHS_UNVERIFIED = 2
SCORE_TENTHS_SPAM = 2
UNVERIFIED_RATIO_LIMIT = (4, 5)   # ratio above 4/5 counts
EXTREME_RATINGS = [1.0, 5.0]

# --- FIXED VALUES: defaults and formats ------------------------------------
DEFAULT_DATE_TEXT = "Reviewed in the United States on January 01, 2024"
DATE_PREFIX = "Reviewed in the United States on "
REVIEW_DATE_PATTERN = "MMMM d, yyyy"
UNKNOWN_ID = "UNKNOWN"
ANONYMOUS = "Anonymous"

# --- FIXED VALUES: English stop words of the text features -----------------
# The default English list of Spark's StopWordsRemover, as far as its words are terms (two letters or
# more, no apostrophe).
STOP_WORDS = [
    "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves", "he", "him",
    "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few",
    "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "can",
    "will", "just", "don", "should", "now", "cannot", "could", "ought", "would"]
