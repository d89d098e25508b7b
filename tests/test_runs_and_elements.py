"""Appends that can be run twice, and review elements that end at their own end tags."""

from veracity.ml.score import write_scored
from veracity.sources import sinks as sk
from veracity.sources.pages import extract_review_blocks


def test_a_run_written_twice_is_there_once(spark, tmp_dir):
    df = spark.createDataFrame([(k, k / 2) for k in range(20)], "review_id long, fake_probability double")
    path = f"{tmp_dir}/scored"
    for run in ("monday", "tuesday", "monday"):
        write_scored(df.repartition(3), path, run_id=run)
    n = {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert n == {"monday": 20, "tuesday": 20}
    sk.append_run(df.limit(5), path, "monday")                       # what a run says last is what it has
    assert spark.read.parquet(path).where("run_id = 'monday'").count() == 5


def blocks(spark, html):
    rows = extract_review_blocks(spark.createDataFrame([(1, "https://x/product-reviews/B1", html)],
                                                       "page_id long, url string, html string")).collect()
    return sorted(rows, key=lambda r: r.block_no)


def test_block_ends_at_its_own_end_tag(spark):
    foot = ('<div><span data-hook="review-date">May 5</span><a href="/profile/ZZZ"></a>'
            '<span data-hook="avp-badge">x</span></div>')
    bare = '<div id="R1" data-id="WRONG" data-hook="review"><div><div>a</div></div></div>'
    r, = blocks(spark, f"<div>{bare}</div>{foot}")
    assert (r.review_id, r.date, r.reviewer_id, r.verified_purchase) == ("R1", "", "UNKNOWN", False)
    r, = blocks(spark, '<div data-id="WRONG" data-hook="review">x</div>')
    assert r.review_id is None
    r, = blocks(spark, '<div data-hook="review" id="R2"><span data-hook="review-date">June 6</span>')   # never closed
    assert (r.review_id, r.date) == ("R2", "June 6")
    assert len(blocks(spark, bare * 3 + "</div></div>" + bare)) == 4
    assert blocks(spark, None) == [] and blocks(spark, "<divider data-hook='review'>") == []
