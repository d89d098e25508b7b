"""The Spark mappings of the test tables equal their SQL twins, row for row."""

from conftest import SF_SMALL
from oracle_harness import compare, duck_connection
from veracity.sources.fixture import (REVIEW_SOURCE_SQL, REVIEWS_SQL, review_source_from_tables,
                                      reviews_from_tables)


def test_reviews_mapping(spark):
    r = compare(spark, SF_SMALL, "reviews", reviews_from_tables, REVIEWS_SQL, duck_connection(SF_SMALL))
    assert r["exact"] and r["spark_rows"] == 1000, r


def test_review_source_mapping(spark):
    r = compare(spark, SF_SMALL, "review_source", review_source_from_tables, REVIEW_SOURCE_SQL,
                duck_connection(SF_SMALL))
    assert r["exact"] and r["spark_rows"] == 1000, r
