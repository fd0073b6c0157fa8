"""Small hand-written pages of the three shops, and the page walker on malformed markup."""

from __future__ import annotations

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from stallwise.functions import text
from stallwise.operators import pages
from stallwise.plans import bindings
from stallwise.sources import html

T0 = dt.datetime(2024, 1, 5, 10)
AMAZON = """<html><head><title>t</title><script>var a = "<span id='productTitle'>no</span>";</script></head><body>
<span id="productTitle">  Acme
 Phone </span><span class="a-size-base">Other brand</span><a id="bylineInfo" href="#">Visit the Acme Store</a>
<div id="wayfinding-breadcrumbs_feature_div"><a>Home</a> &rsaquo; <a>Kitchen</a></div>
<div id="productDescription"><p>Nice &amp; small</p><!-- hidden --><p>really</p></div>
<table id="productDetails_techSpec_section_1"><tr><th>h</th><td>x</td></tr><tr><td>Size</td><td>5</td></tr>
<tr><td>Size</td><td>6</td></tr><tr><td>Empty</td><td> </td></tr></table>
<img class="big a-dynamic-image" src="a.jpg"><img class="a-dynamic-image" src="a.jpg"><img class="a-dynamic-image" src="b.jpg"/>
<div id="availability"><span>Currently unavailable.</span></div>
<span class="a-price-whole"></span><span class="a-offscreen">₹1,299.00</span><span class="a-text-strike">M.R.P.: ₹2,000</span>
<span class="a-size-base">Bank OFFER</span><span class="a-size-base">plain</span></body></html>"""
FLIPKART = """<div class="_1MR4o5">Clothing</div><h1 class="yhB1nd">Blue Shirt</h1><a class="_2bc4-">Brandy</a>
<ul><li class="_21Ahn-">One</li><li class="_21Ahn-"></li><li class="_21Ahn-">Two</li></ul>
<table class="_14cfVK"><tr><td>Fit</td><td>Slim</td></tr></table><table class="_14cfVK"><tr><td>Fit</td><td>Wide</td></tr></table>
<div class="_396cs4"><img src="x.jpg"></div><button class="_2KpZ6l">SOLD OUT</button>
<div class="_30jeq3">₹0</div><div class="_1_WHN1">₹450</div><div class="_3I9_wc">₹500</div><div class="_3Ay6Sb">12% off</div>
<li class="_16_mp8">Bank offer ten percent</li><li class="_16_mp8">tiny</li><span class="_2Janr0">Special price today</span>"""
MYNTRA = """<h1 class="pdp-title">Zed</h1><h1 class="pdp-name">Jacket</h1><div class="product-details">Warm</div>
<div class="row"><div class="index-rowKey"><span>Fabric</span> type</div><div class="index-rowValue">Wool</div></div>
<div class="image-grid-image"><img src="https://i/w_200/1.jpg"></div><div class="image-grid-image" style="x"></div>
<div class="size-buttons-size-button">M</div><span class="myntraweb-sprite">Available</span>
<span class="pdp-price">Rs. 900</span><span class="pdp-mrp">Rs. 800</span>"""


def page_frame(spark):
    rows = [(1, "amazon", "https://www.amazon.in/dp/A123456789", AMAZON, T0), (2, "flipkart", "https://f/p/1", FLIPKART, T0),
            (3, "myntra", "https://m/buy", MYNTRA, T0), (4, "amazon", "https://www.amazon.in/dp/B", "<p>nothing", T0),
            (5, "myntra", "https://m/x", None, T0)]
    return spark.createDataFrame(rows, "page_id long, site string, url string, html string, fetched_at timestamp_ntz")


def test_products(spark):
    out = {r.page_id: r for r in pages.extract_products(page_frame(spark)).collect()}
    assert set(out) == {1, 2, 3}
    a, f, m = out[1], out[2], out[3]
    assert (a.name, a.brand, a.category, a.description) == ("Acme\n Phone", "Acme", "home-kitchen", "Nice & smallreally")
    assert (a.specifications, a.images, a.in_stock) == ({"Size": "6"}, ["a.jpg", "b.jpg"], False)
    assert (f.name, f.brand, f.category, f.description) == ("Blue Shirt", "Brandy", "clothing", "One. Two")
    assert (f.specifications, f.images, f.in_stock) == ({"Fit": "Wide"}, ["x.jpg"], False)
    assert (m.name, m.brand, m.category, m.description) == ("Zed Jacket", "Zed", "clothing", "Warm")
    assert (m.specifications, m.images, m.in_stock) == ({"Fabric": "Wool"}, ["https://i/w_500/1.jpg"], True)


def test_prices(spark):
    out = {r.page_id: r for r in pages.extract_pricing(page_frame(spark)).collect()}
    assert set(out) == {1, 2, 3}
    a, f, m = out[1], out[2], out[3]
    assert (a.current_price, a.original_price, a.discount_amount) == (1299.0, 2000.0, 701.0)
    assert abs(a.discount_percentage - 35.05) < 1e-9 and a.offers == ["Bank OFFER"]
    assert (f.current_price, f.discount_percentage, f.discount_amount) == (450.0, 12.0, 50.0)
    assert f.offers == ["Bank offer ten percent", "Special price today"]
    assert (m.current_price, m.original_price, m.discount_percentage, m.discount_amount) == (900.0, 800.0, None, None)
    products = {r.page_id: r.product_id for r in pages.extract_products(page_frame(spark)).collect()}
    assert {p: out[p].product_id for p in out} == products


REVIEWS = {
    "amazon": """<div data-hook="review"><a data-hook="review-title">Good</a><i data-hook="review-star-rating" class="a-icon a-star-4"></i>
      <span class="a-profile-name">Abcd</span><span data-hook="avp-badge">V</span><span data-hook="review-date">Reviewed in India on 5 January 2024</span>
      <span data-hook="review-body">Works <b>well</b></span></div><div data-hook="review"><span data-hook="review-body"> </span></div>
      <div data-hook="review"><span data-hook="review-body">Bare</span></div>""",
    "flipkart": """<span class="B_NuCI">Item</span><div class="_27M-vq"><div class="_3LWZlK">3.5</div><p class="_2-N8zT">T</p><div class="t-ZTKy">Fine</div>
      <p class="_2sc7ZR">Al</p><span class="_2V5EHH">Certified Buyer</span><span class="_3PlgRk">Jan 5, 2024</span></div>""",
    "myntra": """<h1 class="pdp-name">Item</h1><div class="review-item"><div class="review-text">Ok</div><span class="review-date">05/01/2024</span></div>""",
}


def test_reviews(spark):
    rows = [(1, "amazon", "https://www.amazon.in/product-reviews/A123456789/x", REVIEWS["amazon"]),
            (2, "flipkart", "https://f/p/1", REVIEWS["flipkart"]), (3, "myntra", "https://m/buy", REVIEWS["myntra"]),
            (4, "flipkart", "https://f/p/2", "<div class='_27M-vq'><div class='t-ZTKy'>no product name</div></div>")]
    df = spark.createDataFrame(rows, "page_id long, site string, url string, html string")
    out = pages.extract_reviews(df).orderBy("page_id", "position").collect()
    shown = [(r.page_id, r.title, r.content, r.rating, r.reviewer_name, r.verified_purchase, r.review_date) for r in out]
    day = dt.datetime(2024, 1, 5)
    assert shown == [
        (1, "Good", "Workswell", 4.0, "A**d", True, day), (1, "", "Bare", 5.0, "", False, None),
        (2, "T", "Fine", 3.5, "Al", True, day), (3, "", "Ok", 5.0, "", True, day),
    ]
    products = spark.createDataFrame([("own", "https://www.amazon.in/dp/A123456789")], "product_id string, url string")
    linked = pages.link_item_codes(pages.extract_reviews(df), products)
    assert {r.product_id for r in linked.filter("page_id = 1").collect()} == {"own"}
    assert pages.extract_reviews(df, max_reviews=1).filter("page_id = 1").count() == 1


def test_listings(spark):
    rows = [
        (1, "amazon", "https://www.amazon.in/s", """<div data-component-type="s-search-result"><a class="a-link-normal" href="/dp/X"></a><span class="a-size-base-plus">N</span>
          <span class="a-offscreen">₹10</span><span class="a-icon-alt">4.1 out of 5</span><img class="s-image" src="i.jpg"></div><div data-component-type="s-search-result"><span class="a-size-medium">no link</span></div>"""),
        (2, "flipkart", "https://f", """<div class="_13oc-S"><a class="_1fQZEK" href="p/1"></a><div class="_4rR01T">M</div></div>"""),
        (3, "myntra", "https://m", """<li class="product-base"><a href="/y"></a><h3 class="product-brand">B</h3><div class="product-price">Rs. 7</div></li><li class="product-base"><a href="/z"></a></li>"""),
    ]
    df = spark.createDataFrame(rows, "page_id long, site string, url string, html string")
    out = [tuple(r)[3:] for r in pages.extract_listings(df).orderBy("page_id").collect()]
    assert out == [
        ("https://www.amazon.in/dp/X", "N", 10.0, 4.1, "i.jpg"), ("https://www.flipkart.com/p/1", "M", None, None, ""),
        ("https://www.myntra.com/y", "B", 7.0, None, ""),
    ]


def test_walker_on_malformed_markup(spark):
    source = "<p>a<p>b</div><b>c</p>d<br>e</b><style>x{}</style>&lt;f&gt;<img src=i.jpg/><svg/>g<"
    df = spark.createDataFrame([(1, source)], "page_id long, html string")
    rows = {(r.idx): (r.tag, r.parent, r.text) for r in html.element_rows(df).collect()}
    assert rows[0] == ("p", -1, "abcde<f>g<") and rows[1] == ("p", 0, "bc")
    assert rows[2] == ("b", 1, "c") and rows[3] == ("br", 0, "")
    assert [rows[i][0] for i in sorted(rows)] == ["p", "p", "b", "br", "style", "img", "svg"]


def test_text_of_missing_element_is_empty(spark):
    df = html.with_found(spark.createDataFrame([(1, "<a>x</a>")], "page_id long, html string"), ["a", "b"], [])
    found = html.Found([])
    row = df.select(
        html.text_of(found.first_of("b")).alias("gone"), html.text_of(found.first_of("b", "a")).alias("there"),
        text.clean_price(html.text_of(found.first_of("b"))).alias("price"),
    ).first()
    assert tuple(row) == ("", "x", None)


def test_found_elements_equal_a_search_through_all(spark):
    rng = random.Random(3)

    def markup(depth):
        tag = rng.choice(("div", "p", "tr", "td", "span", "img"))
        mark = rng.choice(("", " class='a'", " class='b a'", " id='a'", " data-x='a'"))
        inner = "".join(markup(depth - 1) for _ in range(rng.randrange(4))) if depth else "t"
        return f"<{tag}{mark}>{inner}" + (f"</{tag}>" if rng.random() < 0.8 else "")

    pages_ = [(i, "".join(markup(4) for _ in range(3))) for i in range(40)] + [(90, None), (91, "")]
    df = spark.createDataFrame(pages_, "page_id long, html string")
    wanted = ["div", "div.a", "p#a", "span[data-x=a]", "td", "tr.a", "img.b"]
    found = html.Found(wanted)
    shown = [F.transform(found.of(s), lambda e: F.struct(e["idx"], e["last"], html.text_of(e))).alias(f"all_{i}") for i, s in enumerate(wanted)]

    def inside(css):
        return F.transform(found.of("div"), lambda d: F.transform(found.of(css, d), lambda e: e["idx"]))

    shown += [inside(s).alias(f"in_{i}") for i, s in enumerate(wanted)]
    shown += [F.transform(found.of("div"), html.next_text).alias("next")]
    rows = {r.page_id: r for r in html.with_found(df, wanted, wanted).select("page_id", *shown).collect()}
    whole = {r.page_id: r for r in html.with_elements(df).collect()}
    for page, row in rows.items():
        every = whole[page].elements
        text_of = lambda e: "".join(whole[page].texts[e.text_from : e.text_to])
        for i, css in enumerate(wanted):
            s = html.Selector(css)
            held = [e for e in every if e.tag == s.tag and (s.attr is None or (s.value in e.classes if s.attr == "class" else e.attrs.get(s.attr) == s.value))]
            assert [tuple(x) for x in row[f"all_{i}"]] == [(e.idx, e.last, text_of(e)) for e in held]
            assert row[f"in_{i}"] == [[e.idx for e in held if d.idx < e.idx <= d.last] for d in every if d.tag == "div"]
        after = [next((text_of(e) for e in every if e.idx > d.idx and e.parent == d.parent), None) for d in every if d.tag == "div"]
        assert row.next == after


def test_extraction_is_linear_in_the_page(spark):
    def page(n):
        rows = "".join(f"<tr><td>key {i % (n // 2)}</td><td>value {i}</td></tr>" for i in range(n))
        return f"<span id='productTitle'>Item</span><table id='productDetails_techSpec_section_1'>{rows}</table>"

    def seconds(n):
        # As much markup in all, in few long pages or many short ones.
        df = spark.createDataFrame([(i, "amazon", "u", page(n)) for i in range(24_000 // n)], "page_id long, site string, url string, html string").coalesce(1).cache()
        df.count()
        best = []
        for _ in range(3):
            start = time.perf_counter()
            rows = pages.extract_products(df).select(F.size("specifications").alias("n"), F.col("specifications")[f"key {n // 2 - 1}"].alias("v")).collect()
            best.append(time.perf_counter() - start)
        assert {(r.n, r.v) for r in rows} == {(n // 2, f"value {n - 1}")}
        return min(best)

    assert seconds(4000) < 3 * seconds(100) + 0.5


def test_extraction_needs_no_shuffle(spark):
    plan = pages.extract_products(page_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_made_pages_are_dealt_out(spark, tmp_path):
    """A file that one task reads gives pages to as many tasks as a shuffle has, and the same pages."""
    rows = [(k, f"name {k}", "Brand#1", "TYPE", 3) for k in range(80)]
    rows += [(None, "no key", None, None, None)] * 2
    parts = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    made = bindings.load(spark, str(tmp_path), "shop_pages")[0]
    held = [n for n in made.rdd.glom().map(len).collect() if n]
    assert len(held) >= int(spark.conf.get("spark.sql.shuffle.partitions")) and max(held) < 2 * min(held)
    spark.read.parquet(f"{tmp_path}/part.parquet").createOrReplaceTempView("part")
    assert sorted(map(str, bindings.bound(spark, "shop_pages").collect())) == sorted(map(str, made.collect()))
