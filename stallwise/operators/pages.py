"""Products, reviews, prices and listings out of pages.

Selectors per site are data: the page walker indexes a page's elements by them, and the expressions below read that
index, row by row in the JVM. Columns wanted: page_id, site, url, html, and fetched_at for prices. A page of an unknown site is read
with the generic selectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.functions import text
from stallwise.sources import html
from stallwise.sources.html import attribute, next_text, text_of

# Selectors per site, first match first.
PRODUCT = {
    "amazon": {
        "name": ["span#productTitle"], "brand": ["a#bylineInfo", "span.a-size-base"],
        "breadcrumb": ["div#wayfinding-breadcrumbs_feature_div"],
        "description": ["div#feature-bullets", "div#productDescription"],
        "specifications": ["table#productDetails_techSpec_section_1"], "images": ["img.a-dynamic-image"],
        "stock": ["div#availability"],
    },
    "flipkart": {
        "name": ["span.B_NuCI", "h1.yhB1nd"], "brand": ["span.G6XhRU", "a._2bc4-"], "breadcrumb": ["div._1MR4o5"],
        "highlights": ["li._21Ahn-"], "specifications": ["table._14cfVK"], "images": ["div._396cs4", "img._396cs4"],
        "stock": ["div._16FRp0", "button._2KpZ6l"],
    },
    "myntra": {
        "name": ["h1.pdp-name", "span.pdp-name"], "brand": ["h1.pdp-title", "span.pdp-brand"],
        "description": ["div.pdp-product-description-content", "div.product-details"],
        "specification_keys": ["div.index-rowKey", "div.product-details-item"],
        "specification_value": "div.index-rowValue", "images": ["div.image-grid-image", "img.img-responsive"],
        "sizes": ["div.size-buttons-size-button", "span.myntraweb-sprite"],
    },
    "generic": {
        "name": ["h1", "title"], "description": ["p"], "specifications": ["table"], "images": ["img"],
    },
}
REVIEW = {
    "amazon": {
        "container": ["div[data-hook=review]"], "title": ["a[data-hook=review-title]"],
        "content": ["span[data-hook=review-body]"], "rating": ["i[data-hook=review-star-rating]"],
        "reviewer": ["span.a-profile-name"], "verified": ["span[data-hook=avp-badge]"],
        "date": ["span[data-hook=review-date]"],
    },
    "flipkart": {
        "container": ["div._16PBlm", "div._27M-vq"], "title": ["p._2-N8zT"],
        "content": ["div.t-ZTKy", "div._1AtVbE"], "rating": ["div._3LWZlK", "div._1BLPMq"],
        "reviewer": ["p._2sc7ZR", "span._2V5EHH"], "verified": ["span._2V5EHH"],
        "date": ["span._3PlgRk", "p._2sc7ZR"],
    },
    "myntra": {
        "container": ["div.user-review", "div.review-item", "div.user-review-main"],
        "title": ["div.user-review-reviewTitle", "h4.review-title"],
        "content": ["div.user-review-reviewText", "div.review-text"],
        "rating": ["div.user-review-rating", "span.review-rating"],
        "reviewer": ["div.user-review-left", "span.reviewer-name"], "date": ["div.user-review-date", "span.review-date"],
    },
    "generic": {"container": ["article"], "title": ["h1"], "content": ["p"], "rating": [], "reviewer": [], "date": []},
}
PRICE = {
    "amazon": {
        "current": ["span.a-price-whole", "span.a-offscreen", "span#priceblock_dealprice", "span#priceblock_ourprice"],
        "original": ["span.a-text-strike", "span#listPrice"], "discount": [], "offers": ["span.a-size-base"],
    },
    "flipkart": {
        "current": ["div._30jeq3", "div._1_WHN1", "div._16Jk6d"], "original": ["div._3I9_wc", "div._14Jd01"],
        "discount": ["div._3Ay6Sb"], "offers": ["li._16_mp8", "span._2Janr0"],
    },
    "myntra": {
        "current": ["span.pdp-price", "div.product-discountedPrice", "span.product-price"],
        "original": ["span.pdp-mrp", "div.product-strike"], "discount": ["span.pdp-discount", "div.product-discount"],
        "offers": ["div.pdp-offers-content", "span.offer-text"],
    },
    "generic": {"current": ["p"], "original": [], "discount": [], "offers": ["li"]},
}
LISTING = {
    "amazon": {
        "container": ["div[data-component-type=s-search-result]"], "link": ["a.a-link-normal"],
        "title": ["span.a-size-medium", "span.a-size-base-plus"], "price": ["span.a-price-whole", "span.a-offscreen"],
        "rating": ["span.a-icon-alt"], "image": ["img.s-image"],
    },
    "flipkart": {
        "container": ["div._1AtVbE", "div._13oc-S"], "link": ["a.IRpwTa", "a._1fQZEK"],
        "title": ["div._4rR01T", "a.IRpwTa"], "price": ["div._30jeq3", "div._1_WHN1"], "rating": ["div._3LWZlK"],
        "image": ["img._396cs4"],
    },
    "myntra": {
        "container": ["li.product-base", "div.product-productMetaInfo"], "link": ["a"],
        "brand": ["h3.product-brand"], "title": ["h4.product-product"],
        "price": ["span.product-discountedPrice", "div.product-price"], "rating": ["span.product-rating"],
        "image": ["img.img-responsive"],
    },
    "generic": {"container": ["li"], "link": ["a"], "title": ["a"], "price": [], "rating": [], "image": ["img"]},
}
MAX_IMAGES, MAX_HIGHLIGHTS, MAX_SPECIFICATIONS, MAX_OFFERS, MAX_REVIEWS = 5, 5, 10, 3, 100



def _selectors(rules: dict, *fields: str) -> list[str]:
    """The distinct selectors of the named fields (all, if none is named) over all sites."""
    found = [v for site in rules.values() for k, v in site.items() if not fields or k in fields]
    return sorted({css for v in found for css in ([v] if isinstance(v, str) else v)})


# What is looked for inside tables, keys and images, review containers, and cards.
PARTS = ["img", "span", "td", "tr"]
REVIEW_PARTS = _selectors(REVIEW, "title", "content", "rating", "reviewer", "verified", "date")
LISTING_PARTS = _selectors(LISTING, "link", "title", "brand", "price", "rating", "image")
PRODUCTS, REVIEWS, LISTINGS = html.Found(PARTS), html.Found(REVIEW_PARTS), html.Found(LISTING_PARTS)


def _per_site(build) -> Column:
    """One expression per site, chosen by the page's site; only the chosen one is evaluated for a row."""
    chosen = None
    for site in schemas.SITES:
        part = build(site)
        chosen = F.when(F.col("site") == site, part) if chosen is None else chosen.when(F.col("site") == site, part)
    return chosen.otherwise(build("generic"))


def _first_text(found: html.Found, selectors: list[str], within: Column | None = None) -> Column:
    return text_of(found.first_of(*selectors, within=within)) if selectors else F.lit("")


def _name(site: str, found: html.Found) -> Column:
    """Product name, NULL when the page has none. The third site puts the brand in front."""
    rules = PRODUCT[site]
    if site != "myntra":
        named = found.first_of(*rules["name"])
        return F.when(named.isNotNull(), text_of(named))
    brand, name = _first_text(found, rules["brand"]), _first_text(found, rules["name"])
    return text.present(text.strip(F.concat_ws(" ", brand, name)))


def _pairs_of_tables(tables: Column) -> Column:
    """(key, value) of the rows with exactly two cells."""
    rows = F.flatten(F.transform(tables, lambda t: PRODUCTS.of("tr", t)))
    cells = F.filter(F.transform(rows, lambda r: PRODUCTS.of("td", r)), lambda c: F.size(c) == 2)
    return F.transform(cells, lambda c: F.struct(text_of(c[0]).alias("key"), text_of(c[1]).alias("value")))


def _pairs_of_keys(site: str) -> Column:
    """(key, value) of key elements and the element after each."""
    rules = PRODUCT[site]
    keys = F.slice(PRODUCTS.all_of(*rules["specification_keys"]), 1, MAX_SPECIFICATIONS)

    def pair(k: Column) -> Column:
        later = F.filter(PRODUCTS.of(rules["specification_value"]), lambda e: e["idx"] > k["idx"])
        value = F.coalesce(next_text(k), text_of(F.get(later, F.lit(0))))
        key = F.coalesce(F.get(PRODUCTS.of("span", k), F.lit(0)), k)
        return F.struct(text_of(key).alias("key"), value.alias("value"))

    return F.transform(keys, pair)


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value evaluated once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _as_map(pairs: Column) -> Column:
    """Pairs to a map: empty keys and values are left out, and the last value of a key wins.

    Sorted by key and place, the last of a key stands before another key; then back in the order of the places.
    """
    def last_of_each(full: Column) -> Column:
        last = F.filter(full, lambda p, i: ~F.get(full, i + 1)["key"].eqNullSafe(p["key"]))
        placed = F.array_sort(F.transform(last, lambda p: F.struct(p["place"], p["key"], p["value"])))
        return F.map_from_entries(F.transform(placed, lambda p: F.struct(p["key"], p["value"])))

    held = F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != ""))
    placed = F.transform(held, lambda p, i: F.struct(p["key"].alias("key"), i.alias("place"), p["value"].alias("value")))
    return F.coalesce(_bound(F.array_sort(placed), last_of_each), F.create_map().cast("map<string,string>"))


def _specifications(site: str) -> Column:
    rules = PRODUCT[site]
    if "specification_keys" in rules:
        return _as_map(_pairs_of_keys(site))
    tables = PRODUCTS.all_of(*rules["specifications"])
    return _as_map(_pairs_of_tables(F.slice(tables, 1, 1) if site == "amazon" else tables))


def _images(site: str) -> Column:
    found = F.slice(PRODUCTS.first_nonempty(*PRODUCT[site]["images"]), 1, MAX_IMAGES)
    source = F.transform(
        found,
        lambda e: F.when(e["tag"] == "img", attribute(e, "src")).otherwise(
            attribute(F.get(PRODUCTS.of("img", e), F.lit(0)), "src")
        ),
    )
    kept = text.array_top(source, MAX_IMAGES)
    return F.array_distinct(F.transform(kept, text.larger_image)) if site == "myntra" else kept


def _description(site: str) -> Column:
    rules = PRODUCT[site]
    if "highlights" not in rules:
        return _first_text(PRODUCTS, rules["description"])
    lines = F.filter(F.transform(PRODUCTS.all_of(*rules["highlights"]), lambda e: text_of(e)), lambda t: t != "")
    return F.array_join(F.slice(lines, 1, MAX_HIGHLIGHTS), ". ")


def _in_stock(site: str) -> Column:
    rules = PRODUCT[site]
    if "sizes" in rules:
        return text.in_stock_from_sizes(F.transform(PRODUCTS.all_of(*rules["sizes"]), lambda e: text_of(e)))
    if "stock" not in rules:
        return F.lit(True)
    notes = PRODUCTS.all_of(*rules["stock"])
    notes = F.slice(notes, 1, 1) if site == "amazon" else notes
    return F.forall(notes, lambda e: text.in_stock_from_text(text_of(e), F.lit(site)))


def _category(site: str) -> Column:
    if site == "myntra":
        return F.lit("clothing")
    return text.category_of(_first_text(PRODUCTS, PRODUCT[site].get("breadcrumb", [])))


def _brand(site: str) -> Column:
    found = _first_text(PRODUCTS, PRODUCT[site].get("brand", []))
    return text.brand_from_byline(found) if site == "amazon" else found


def extract_products(pages: DataFrame) -> DataFrame:
    """One product per page that names one."""
    wanted = sorted({*_selectors(PRODUCT), *PARTS})
    walked = html.with_found(pages.select("page_id", "site", "url", "html"), wanted, PARTS)
    named = walked.withColumn("name", _per_site(lambda s: _name(s, PRODUCTS))).filter(text.not_blank(F.col("name")))
    return named.select(
        "page_id", text.product_key(F.col("site"), F.col("url"), F.col("name")).alias("product_id"), "site", "name",
        _per_site(_category).alias("category"),
        _per_site(_brand).alias("brand"), "url",
        _per_site(_description).alias("description"),
        _per_site(_specifications).alias("specifications"),
        _per_site(_images).alias("images"),
        _per_site(_in_stock).alias("in_stock"),
    )


def _review(site: str, container: Column) -> Column:
    rules = REVIEW[site]
    rated = REVIEWS.first_of(*rules["rating"], within=container) if rules["rating"] else F.lit(None)
    if site == "amazon":
        rating = text.rating_from_class(attribute(rated, "class"))
        verified = F.size(REVIEWS.all_of(*rules["verified"], within=container)) > 0
    else:
        rating = text.rating_from_text(text_of(rated)) if rules["rating"] else F.lit(5.0)
        verified = (
            F.contains(F.lower(_first_text(REVIEWS, rules["verified"], container)), F.lit("certified buyer")) if site == "flipkart"
            else F.lit(site == "myntra")
        )
    return F.struct(
        _first_text(REVIEWS, rules["title"], container).alias("title"),
        _first_text(REVIEWS, rules["content"], container).alias("content"), rating.alias("rating"),
        _first_text(REVIEWS, rules["reviewer"], container).alias("reviewer_name"), verified.alias("verified_purchase"),
        _first_text(REVIEWS, rules["date"], container).alias("date_text"),
    )


def extract_reviews(pages: DataFrame, max_reviews: int | None = None) -> DataFrame:
    """Reviews of each page, without those that have no content.

    Reviews of the first site carry its item code as product_id, as the review pages name nothing else;
    `link_item_codes` gives them the product's own id.
    """
    wanted = sorted({*_selectors(REVIEW), *_selectors(PRODUCT, "name", "brand")})
    walked = html.with_found(pages.select("page_id", "site", "url", "html"), wanted, REVIEW_PARTS)

    def found(site: str) -> Column:
        reviews = F.transform(REVIEWS.first_nonempty(*REVIEW[site]["container"]), lambda c: _review(site, c))
        found = F.filter(reviews, lambda r: r["content"] != "")
        return found if max_reviews is None else F.slice(found, 1, max_reviews)

    item_code = text.present(F.regexp_extract("url", r"/(?:dp|product-reviews)/([A-Z0-9]{10})", 1))
    product = F.when(F.col("site") == "amazon", item_code).otherwise(
        F.when(F.col("name").isNotNull(), text.product_key(F.col("site"), F.col("url"), F.col("name")))
    )
    rows = (
        walked.withColumn("name", _per_site(lambda s: _name(s, REVIEWS))).withColumn("product_id", product)
        .filter("product_id is not null")
        .select("page_id", "product_id", "site", F.posexplode(_per_site(found)).alias("position", "r"))
    )
    content, reviewer = F.col("r.content"), F.col("r.reviewer_name")
    return rows.select(
        "page_id", "position", text.review_key(F.col("product_id"), content, reviewer).alias("review_id"),
        "product_id", "site", "r.title", "r.content", "r.rating", text.mask_name(reviewer).alias("reviewer_name"),
        "r.verified_purchase", text.review_date(F.col("r.date_text"), F.col("site")).alias("review_date"),
    )


def link_item_codes(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Replace item codes in reviews by the product_id of the product whose URL has the code."""
    codes = (
        products.select(text.listing_number(F.col("url")).alias("product_id"), F.col("product_id").alias("_own"))
        .filter("product_id is not null").groupBy("product_id").agg(F.min("_own").alias("_own"))
    )
    linked = reviews.join(codes, "product_id", "left")
    return linked.withColumn("product_id", F.coalesce("_own", "product_id")).drop("_own")


def extract_pricing(pages: DataFrame) -> DataFrame:
    """One price per page that shows one."""
    wanted = sorted({*_selectors(PRICE), *_selectors(PRODUCT, "name", "brand")})
    walked = html.with_found(pages.select("page_id", "site", "url", "fetched_at", "html"), wanted, [])
    found = html.Found([])

    def current(site: str) -> Column:
        return text.first_price(*[
            text.clean_price(_first_text(found, [s])) for s in PRICE[site]["current"]
        ])

    def offers(site: str) -> Column:
        selectors = PRICE[site]["offers"]
        spans = F.transform(found.all_of(*selectors), lambda e: text_of(e)) if selectors else F.array().cast("array<string>")
        pick = text.keyword_offers if site in ("amazon", "generic") else text.long_offers
        return pick(spans, MAX_OFFERS)

    read = walked.select(
        "page_id", "site", "url", "fetched_at",
        F.coalesce(_per_site(lambda s: _name(s, found)), F.lit("")).alias("name"),
        _per_site(current).alias("current_price"),
        _per_site(lambda s: text.clean_price(_first_text(found, PRICE[s]["original"]))).alias("original_price"),
        _per_site(lambda s: text.stated_percent(_first_text(found, PRICE[s]["discount"]))).alias("stated"),
        _per_site(offers).alias("offers"),
    ).filter("current_price is not null")
    price = (F.col("current_price"), F.col("original_price"))
    keyed = read.withColumn("product_id", text.product_key(F.col("site"), F.col("url"), F.col("name")))
    return keyed.select(
        "page_id", text.price_key(F.col("product_id"), F.col("fetched_at")).alias("price_id"), "product_id", "site",
        *price, text.discount_percentage(*price, F.col("stated")).alias("discount_percentage"),
        text.discount_amount(*price).alias("discount_amount"), "offers", F.col("fetched_at").alias("price_date"),
    )


def extract_listings(pages: DataFrame) -> DataFrame:
    """Search-result cards with a link and a title: (page_id, position, site, url, name, price, rating, image)."""
    walked = html.with_found(pages.select("page_id", "site", "url", "html"), _selectors(LISTING), LISTING_PARTS)
    bases = F.create_map(*[F.lit(v) for pair in schemas.SITE_BASE_URLS.items() for v in pair])
    base = F.coalesce(F.try_element_at(bases, F.col("site")), F.col("url"))

    def card(site: str, container: Column) -> Column:
        rules = LISTING[site]
        link, title = (LISTINGS.first_of(*rules[c], within=container) for c in ("link", "title"))
        name, titled = text_of(title), title.isNotNull()
        if "brand" in rules:
            brand = LISTINGS.first_of(*rules["brand"], within=container)
            name, titled = text.strip(F.concat_ws(" ", text_of(brand), name)), titled | brand.isNotNull()
        rated = _first_text(LISTINGS, rules["rating"], container)
        rating = text.first_number(rated) if rules["rating"] else F.lit(None).cast("double")
        return F.struct(
            F.when(link.isNotNull() & titled, attribute(link, "href")).alias("href"), name.alias("name"),
            text.clean_price(_first_text(LISTINGS, rules["price"], container)).alias("price"), rating.alias("rating"),
            attribute(LISTINGS.first_of(*rules["image"], within=container), "src").alias("image"),
        )

    def cards(site: str) -> Column:
        found = F.transform(LISTINGS.first_nonempty(*LISTING[site]["container"]), lambda c: card(site, c))
        return F.filter(found, lambda c: c["href"].isNotNull())

    rows = walked.select("page_id", "site", base.alias("base"), F.posexplode(_per_site(cards)).alias("position", "c"))
    return rows.select(
        "page_id", "position", "site", text.absolute_url(F.col("c.href"), F.col("base")).alias("url"), "c.name",
        "c.price", "c.rating", "c.image",
    )
