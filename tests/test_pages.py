"""Page extraction in the review layout."""

from veracity.sources.pages import extract_page_records

PAGE = """<html><body>
<div id="R1ABC" data-hook="review" class="a-section">
  <a class="a-profile" href="/gp/profile/AEXAMPLE123/ref=x"><span class="a-profile-name"> Jane D </span></a>
  <i data-hook="review-star-rating" class="a-icon"><span class="a-icon-alt">4.0 out of 5 stars</span></i>
  <a data-hook="review-title" href="#"><span>ignored</span><span>Works well</span></a>
  <span data-hook="review-date">Reviewed in the United States on March 3, 2023</span>
  <span data-hook="avp-badge">Verified Purchase</span>
  <span data-hook="review-body" class="a-size-base"><span> Solid build. </span></span>
  <span data-hook="helpful-vote-statement">12 people found this helpful</span>
</div>
<div id="R2DEF" data-hook='review'>
  <span data-hook="review-body"><span>No rating here</span></span>
</div>
</body></html>"""


def test_review_layout(spark):
    pages = spark.createDataFrame([(1, "https://shop.example/product-reviews/B0TEST1234/?p=1", PAGE)],
                                  "page_id long, url string, html string")
    rows = {r.review_id: r for r in extract_page_records(pages, "review").collect()}
    a, b = rows["R1ABC"], rows["R2DEF"]
    assert (a.reviewer_id, a.reviewer_name, a.rating, a.title) == ("AEXAMPLE123", "Jane D", 4.0, "Works well")
    assert (a.body, a.verified_purchase, a.helpful_votes, a.product_asin) == ("Solid build.", True, 12, "B0TEST1234")
    assert a.date.endswith("March 3, 2023")
    assert (b.reviewer_id, b.rating, b.helpful_votes, b.verified_purchase, b.title) == ("UNKNOWN", 0.0, 0, False, "")


def test_first_text_node_and_entities(spark):
    page = PAGE.replace("<span> Solid build. </span>", "<span>Good &amp; cheap<br>second line</span>")
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    rows = {r.review_id: r for r in extract_page_records(pages, "review").collect()}
    assert rows["R1ABC"].body == "Good & cheap" and rows["R1ABC"].scraped_at is not None


def test_custom_rules(spark):
    pages = spark.createDataFrame([(1, "u", "<li><b>a</b> 1</li><li><b>b</b> 2</li>")],
                                  "page_id long, url string, html string")
    rules = {"block": r"<li>(.*?)</li>", "fields": {"name": r"<b>(.*?)</b>", "num": r"(\d+)"}}
    got = [(r.block_no, r.name, r.num) for r in extract_page_records(pages, rules).orderBy("block_no").collect()]
    assert got == [(0, "a", "1"), (1, "b", "2")]
