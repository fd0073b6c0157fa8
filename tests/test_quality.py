from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.functions import quality
from stallwise.operators import ingest

def as_of():
    return F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")

NOW = dt.datetime(2024, 1, 20)


def frame(spark, schema, **values):
    row = [values.get(f.name) for f in schema.fields]
    return spark.createDataFrame([row], schema)


def product(spark, **changes):
    values = dict(
        product_id="test_123", site="amazon", name="Test Product", category="electronics",
        url="https://amazon.in/test", brand="TestBrand", description="A test product description", scraped_at=NOW,
    )
    return frame(spark, schemas.PRODUCTS, **(values | changes))


def test_product_golden(spark):
    row = quality.with_scores(product(spark), "products", as_of()).first()
    parts = (row.completeness_score, row.accuracy_score, row.consistency_score)
    assert parts == pytest.approx((7 / 9, 0.9, 2 / 3))
    assert row.overall_score == pytest.approx(0.781481, abs=1e-6)
    assert row.issues == ["Brand not found in product name"]


@pytest.mark.parametrize("brand, points", [(None, 0.5), ("", 0.5), ("  ", 0.0), ("Test", 1.0)])
def test_brand_has_three_cases(spark, brand, points):
    row = quality.with_scores(product(spark, brand=brand), "products", as_of()).first()
    assert row.accuracy_score == pytest.approx((3.5 + points) / 5)


def test_product_issues_in_rule_order(spark):
    bad = product(
        spark, name="ab", url="ftp://x", images=["https://a.example.com/i.jpg", "no", "no"], category="",
        scraped_at=dt.datetime(2030, 1, 1), brand=None,
    )
    assert quality.with_scores(bad, "products", as_of()).first().issues == [
        "Missing required field: category", "Invalid name length: 2", "Invalid URL format", "Invalid image URLs: 2",
        "URL domain doesn't match site: amazon", "Invalid scraped timestamp",
    ]


def test_review_golden(spark):
    row = quality.with_scores(frame(
        spark, schemas.REVIEWS, review_id="r", product_id="p", site="amazon", content="Great product!", rating=4.5,
        scraped_at=NOW,
    ), "reviews", as_of()).first()
    assert (row.completeness_score, row.accuracy_score, row.consistency_score) == (0.625, 0.875, 0.75)
    assert row.overall_score == 0.75 >= schemas.GATE["reviews"]


def test_price_without_original_fails_the_gate(spark):
    base = dict(price_id="i", product_id="p", site="amazon", current_price=1000.0, scraped_at=NOW)
    bare = quality.with_scores(frame(spark, schemas.PRICING, **base), "pricing", as_of())
    assert bare.first().overall_score == pytest.approx(0.662698, abs=1e-6)
    assert ingest.gate(bare, "pricing").count() == 0
    offers = quality.with_scores(frame(spark, schemas.PRICING, offers=["x"], **base), "pricing", as_of())
    assert offers.first().overall_score == pytest.approx(0.7103, abs=1e-4)


def test_gate_limits_are_the_double_products():
    assert schemas.GATE["reviews"] == 0.6649999999999999


def test_violations(spark):
    price = frame(
        spark, schemas.PRICING, price_id="i", product_id="p", site="other", current_price=10.0, original_price=5.0,
        discount_percentage=120.0,
    )
    good, bad = ingest.split_valid(price, "pricing")
    assert good.count() == 0
    assert bad.first().violations == [
        "site is unknown", "discount_percentage is out of range", "original_price is below current_price",
    ]
    blank = frame(spark, schemas.REVIEWS, review_id="r", product_id="p", site="amazon", content="  ", rating=6.0)
    assert ingest.with_violations(blank, "reviews").first().violations == [
        "content is blank", "rating is out of range",
    ]


texts = st.one_of(st.none(), st.sampled_from(["", "  ", "x", "amazon", "https://amazon.in/a", "word " * 30]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(texts, texts, texts, texts), min_size=1, max_size=20))
def test_scores_stay_between_zero_and_one(spark, rows):
    df = spark.createDataFrame(
        [(a, "amazon", b or "n", "books", c, d or "u", a, None, [b] if b else None, NOW) for a, b, c, d in rows],
        "product_id string, site string, name string, category string, brand string, url string, description string, "
        "specifications map<string,string>, images array<string>, scraped_at timestamp_ntz",
    )
    for row in quality.with_scores(df, "products", as_of()).collect():
        for part in ("completeness_score", "accuracy_score", "consistency_score", "overall_score"):
            assert 0 <= row[part] <= 1


def test_sums_leave_out_what_no_decimal_holds(spark):
    from pyspark.sql import functions as F

    from stallwise.plans import views

    rows = spark.createDataFrame([(0.00001,), (0.00002,), (None,), (float("nan"),), (float("inf"),), (1e25,)], "v double")
    found = rows.agg(views.exact_sum("v").alias("s"), views.exact_avg("v").alias("a"), views.unsummable("v").alias("n")).first()
    assert (round(found.s, 9), round(found.a, 9), found.n) == (0.00003, 0.000015, 3)
    assert rows.where("v is null").agg(views.exact_avg("v").alias("a")).select(F.col("a").isNull()).first()[0]
