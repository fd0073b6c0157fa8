from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stallwise.functions import text


@pytest.mark.parametrize("shown, price, loose", [
    ("₹1,299.00", 1299.0, 1299.0), ("Rs. 500", 500.0, 500.0), ("n/a", None, None), ("", None, None), (None, None, None),
    ("1 299", 1.0, 1299.0), ("12.5.6", 12.5, 12.5), ("7.", 7.0, 7.0),
])
def test_prices(one, shown, price, loose):
    assert one(text.clean_price, shown) == price
    assert one(text.price_from_text, shown) == loose


def test_first_price_skips_zero_and_null(one):
    types = ["double"] * 3
    assert one(text.first_price, None, 0.0, 5.0, types=types) == 5.0
    assert one(text.first_price, 0.0, None, 0.0, types=types) is None


@pytest.mark.parametrize("current, original, stated, amount, percent", [
    (80.0, 100.0, None, 20.0, 20.0), (80.0, 100.0, 15.0, 20.0, 15.0), (80.0, 100.0, 0.0, 20.0, 20.0),
    (100.0, 80.0, None, None, None), (100.0, 80.0, 5.0, None, 5.0), (100.0, None, None, None, None),
    (0.0, 0.0, None, None, None),
])
def test_discounts(one, current, original, stated, amount, percent):
    types = ["double"] * 3
    assert one(lambda c, o, s: text.discount_amount(c, o), current, original, stated, types=types) == amount
    assert one(text.discount_percentage, current, original, stated, types=types) == percent


@pytest.mark.parametrize("name, masked", [
    ("Abcd", "A**d"), ("Al", "Al"), ("", ""), (None, None), ("Zoë", "Z*ë"),
])
def test_mask(one, name, masked):
    assert one(text.mask_name, name) == masked


@pytest.mark.parametrize("url, valid", [
    ("https://amazon.in/test", True), ("http://localhost", True), ("https://10.0.0.1:80/x?y=1", True),
    ("ftp://a.com", False), ("https://nodots/x", False), ("https://a.com/with space", False), ("", False), (None, False),
    ("HTTPS://A.COM", True), ("https://a.toolongtld/", False),
])
def test_url_validity(one, url, valid):
    assert one(text.is_valid_url, url) is valid


@pytest.mark.parametrize("content, reason", [
    ("a fine and useful thing", None), ("   short   ", "too_short"), ("ab       cd", None),
    ("go go go go go go go go", "repetitive"), ("so goooooooooooood it is", "repeated_character"),
    ("so gOoOoOoOoOoOoOod it is", "repeated_character"), ("please CLICK here now ok", "spam_phrase"),
    ("call me 1234567890 today", "long_number"), ("code x1234567890 is fine", None), ("", "too_short"),
    ("0123456789", "long_number"), ("one\n\n\n\n\n\n\n\n\n\n\n\n\n\ntwo three", None),
])
def test_spam(spark, content, reason):
    row = text.with_spam_checks(spark.createDataFrame([(content,)], "content string"), "content").first()
    assert [c for c in text.SPAM_CHECKS if row[c]] == ([reason] if reason else [])
    assert row["meaningful"] is (reason is None)


def test_null_text_is_not_meaningful(spark):
    row = text.with_spam_checks(spark.createDataFrame([(None,)], "content string"), "content").first()
    assert row["meaningful"] is False


@pytest.mark.parametrize("shown, site, day", [
    ("Reviewed in India on 5 January 2024", "amazon", dt.datetime(2024, 1, 5)),
    ("Reviewed in India on 5 Jan 2024", "amazon", None), ("on 31 February 2024", "amazon", None),
    ("5 Jan 2024", "flipkart", dt.datetime(2024, 1, 5)), ("Jan 5, 2024", "flipkart", dt.datetime(2024, 1, 5)),
    ("5 January 2024", "flipkart", None), ("05/01/2024", "flipkart", None), ("05/01/2024", "myntra", dt.datetime(2024, 1, 5)),
    ("5 JAN 2024", "myntra", dt.datetime(2024, 1, 5)), ("yesterday", "myntra", None), (None, "amazon", None),
])
def test_review_dates(one, shown, site, day):
    assert one(text.review_date, shown, site) == day


@pytest.mark.parametrize("url, made", [
    ("/dp/1", "https://s.example.com/dp/1"), ("//cdn.example.com/x", "https://cdn.example.com/x"),
    ("http://other.example.com/?utm_source=a&id=2#f", "http://other.example.com/?id=2#f"),
    ("page2?ref=x", "https://s.example.com/list/page2"), ("https://a.example.com/?reference=1&tag", "https://a.example.com/?reference=1"),
    ("?page=2", "https://s.example.com/list/index.html?page=2"), ("#part", "https://s.example.com/list/index.html#part"),
    ("../up", "https://s.example.com/up"), ("../../../up", "https://s.example.com/up"), ("./a/../b/.", "https://s.example.com/list/b/"),
    ("mailto:a@b.c", "mailto:a@b.c"), ("http-guide.html", "https://s.example.com/list/http-guide.html"),
])
def test_urls(one, url, made):
    base = F.lit("https://s.example.com/list/index.html")
    assert one(lambda u: text.strip_tracking(text.absolute_url(u, base)), url) == made


@pytest.mark.parametrize("url, domain", [
    ("https://user@a.example.com:80/x", "user@a.example.com:80"), ("//a.example.com?q", "a.example.com"), ("/x", ""),
    (None, ""),
])
def test_domain(one, url, domain):
    assert one(text.domain, url) == domain


def test_clean_text_keeps_letters_of_all_scripts(one):
    assert one(text.clean_text, "  Café \n\t “नमस्ते”  #1 (ok)! ") == "Café नमसत 1 (ok)!"
    assert one(text.clean_text, None) == ""


def test_strip_takes_unicode_space(one):
    assert one(text.strip, "   x y 　\n") == "x y"


def test_label_key_sorts_by_name(spark):
    rows = spark.createDataFrame(
        [("m", {"b": "2", "a": "1", "a-b": "3"}), ("m", {}), ("m", None)], "name string, labels map<string,string>"
    )
    keys = [r[0] for r in rows.select(text.label_key(F.col("name"), F.col("labels"))).collect()]
    assert keys == ["m{a=1,a-b=3,b=2}", "m", "m"]


def test_arrays(spark):
    row = spark.range(1).select(
        text.array_top(F.array(*map(F.lit, "aabcd")), 3).alias("top"),
        text.keyword_offers(F.array(*map(F.lit, ["Big DEAL", "no", "save 5", "offer", "discount"]))).alias("offers"),
        text.in_stock_from_sizes(F.array().cast("array<string>")).alias("none"),
        text.in_stock_from_sizes(F.array(F.lit("M"), F.lit("L"))).alias("gone"),
        text.in_stock_from_sizes(F.array(F.lit("M"), F.lit("L Available"))).alias("some"),
    ).first()
    assert row.top == ["a", "b"] and row.offers == ["Big DEAL", "save 5", "offer"]
    assert (row.none, row.gone, row.some) == (True, False, True)


def test_keys_follow_the_fixed_formats(one):
    from hashlib import md5
    assert one(text.product_key, "amazon", "u", "n") == md5(b"amazon_u_n").hexdigest()
    long = "é" * 150
    assert one(text.review_key, "p", long, None) == md5(("p_" + "é" * 100 + "_").encode()).hexdigest()
    at = one(text.price_key, "p", "2024-01-01 00:00:01", types=["string", "timestamp_ntz"])
    assert at == md5(b"p_1704067201").hexdigest()
