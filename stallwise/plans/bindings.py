"""Bindings of the test tables to the engine's tables: portable SQL, used as it is by Spark and by the oracle.

FIXTURES.md explains the first six. The others derive the inputs of the text functions and the shop pages from the
same tables, so that all of them grow with the data. `DEPENDS` lists the bindings a text reads from.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SQL: dict[str, str] = {}

SQL["products"] = """
select concat(cast(p_partkey as string), case when dup = 1 then '-copy' else '' end) as product_id,
  case p_partkey % 3 when 0 then 'amazon' when 1 then 'flipkart' else 'myntra' end as site,
  case when dup = 1 then concat('  ', upper(case when p_partkey % 4 = 0 then p_name else concat(p_brand, ' ', p_name) end))
       when p_partkey % 4 = 0 then p_name else concat(p_brand, ' ', p_name) end as name,
  case p_partkey % 5 when 0 then 'electronics' when 1 then 'clothing' when 2 then 'home-kitchen' when 3 then 'books' else 'sports' end as category,
  case when p_partkey % 10 = 7 then null else p_brand end as brand,
  concat(case when p_partkey % 13 = 5 then 'ftp://www.' else 'https://www.' end,
    case when p_partkey % 17 = 3 then 'example.org' when p_partkey % 3 = 0 then 'amazon.in' when p_partkey % 3 = 1 then 'flipkart.com' else 'myntra.com' end,
    case when p_partkey % 3 = 0 then '/dp/' when p_partkey % 3 = 1 then '/p/' else '/buy/' end, cast(p_partkey as string)) as url,
  case when p_partkey % 6 = 0 then null when p_partkey % 6 = 1 then 'short' else concat('A ', p_type, ' item: ', p_name) end as description,
  case when p_partkey % 8 = 0 then null else concat('{"size":"', cast(p_size as string), '","type":"', p_type, '"}') end as specifications,
  case when p_partkey % 9 = 0 then '[]' when p_partkey % 9 = 1 then '["https://img.example.com/a.jpg","bad"]' else '["https://img.example.com/a.jpg"]' end as images,
  p_size % 4 <> 0 as in_stock,
  make_timestamp(2024, 1, cast(1 + p_partkey % 30 as int), cast(p_partkey % 24 as int), 0, 0) as scraped_at,
  p_partkey + dup * 1000000000 as ingest_seq
from (select part.*, 0 as dup from part union all select part.*, 1 as dup from part where p_partkey % 20 = 4) t
"""
SQL["reviews"] = """
select md5(concat(product_id, '_', substring(content, 1, 100), '_', coalesce(reviewer_name, ''))) as review_id,
  product_id, site, title, content, rating, reviewer_name, verified_purchase, review_date, scraped_at, ingest_seq
from (select cast(d.n_chars % 97 as string) as product_id,
  case (d.n_chars % 97) % 3 when 0 then 'amazon' when 1 then 'flipkart' else 'myntra' end as site,
  case when d.doc_id % 5 = 0 then null else substring(d.text, 1, 40) end as title,
  case when d.doc_id % 50 = 11 then '   ' when d.doc_id % 25 = 3 then concat(d.text, ' Click HERE') else d.text end as content,
  case when d.doc_id % 41 = 7 then cast(6 as double) else cast(1 + (d.doc_id % 9) * 0.5 as double) end as rating,
  case when d.doc_id % 7 = 0 then null else concat('Customer#', cast(d.doc_id % 150 as string)) end as reviewer_name,
  coalesce(l.quality, 0) = 1 as verified_purchase,
  case when d.doc_id % 8 = 0 then null else make_timestamp(2024, 1, cast(1 + d.doc_id % 30 as int), 0, 0, 0) end as review_date,
  make_timestamp(2024, 1, cast(1 + d.doc_id % 30 as int), 12, 0, 0) as scraped_at,
  d.doc_id as ingest_seq
from documents d left join labels l on d.doc_id = l.doc_id) t
"""
SQL["pricing"] = """
select md5(concat(cast(l_partkey as string), '_', cast(l_orderkey as string), '_', cast(l_linenumber as string))) as price_id,
  cast(l_partkey as string) as product_id,
  case l_partkey % 3 when 0 then 'amazon' when 1 then 'flipkart' else 'myntra' end as site,
  floor(l_extendedprice / l_quantity * (1 - l_discount) * 100 + 0.5) / 100 as current_price,
  case when l_linenumber = 6 then null when l_orderkey % 40 = 1 then floor(l_extendedprice / l_quantity / 2 * 100 + 0.5) / 100 else floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 end as original_price,
  'INR' as currency,
  case when l_linenumber = 6 then null else l_discount * 100 end as discount_percentage,
  case when l_linenumber = 6 then null else floor(l_extendedprice / l_quantity * l_discount * 100 + 0.5) / 100 end as discount_amount,
  case when l_tax > 0.04 then '["Bank offer 5% off"]' else '[]' end as offers,
  l_shipdate as price_date, l_shipdate as scraped_at,
  l_orderkey * 10 + l_linenumber as ingest_seq
from lineitem
"""
SQL["jobs"] = """
select cast(o_orderkey as string) as job_id,
  case o_custkey % 3 when 0 then 'amazon' when 1 then 'flipkart' else 'myntra' end as site,
  case substring(o_orderpriority, 1, 1) when '1' then 'pricing_update' when '2' then 'review_collection' when '3' then 'comprehensive' else 'discovery' end as job_type,
  case when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then 'pending' when o_orderkey % 4 = 0 then 'failed' else 'running' end as status,
  o_orderdate as created_at,
  case when o_orderstatus = 'O' then null else o_orderdate end as started_at,
  case when o_orderstatus = 'F' then o_orderdate else null end as completed_at,
  cast(o_orderkey % 50 as bigint) as products_scraped, cast(o_orderkey % 20 as bigint) as reviews_scraped
from orders
"""
SQL["metrics"] = """
select ts, case event_type when 'view' then 'products_scraped_total' when 'click' then 'reviews_scraped_total' when 'signup' then 'data_quality_score' when 'error' then 'error_rate' else 'request_latency' end as name,
  case event_type when 'signup' then value / 50 else value end as value,
  case event_type when 'view' then 'counter' when 'click' then 'counter' when 'purchase' then 'timer' else 'gauge' end as type,
  case user_id % 3 when 0 then 'amazon' when 1 then 'flipkart' else 'myntra' end as site_label,
  event_id as seq
from events
"""
SQL["fetch_log"] = """
select ts, concat('d', cast(user_id % 3 as string), '.example.com') as domain, user_id, event_id as seq from events
"""
# Prices moved to the time of the products: the latest one becomes 2024-01-25.
SQL["pricing_2024"] = """
select price_id, product_id, site, current_price, original_price, currency, discount_percentage, discount_amount, offers,
  price_date + interval '8117' day as price_date, scraped_at + interval '8117' day as scraped_at, ingest_seq
from pricing
"""
# Prices of a week in which one shop gave none.
SQL["pricing_gap"] = """
select price_id, product_id, case when site = 'myntra' then 'amazon' else site end as site, current_price, original_price, currency,
  discount_percentage, discount_amount, offers, price_date, scraped_at, ingest_seq
from pricing_2024
"""
SQL["jobs_2024"] = """
select job_id, site, job_type, status, created_at + interval '8212' day as created_at, started_at, completed_at, products_scraped,
  reviews_scraped
from jobs
"""
SQL["price_texts"] = """
select l_orderkey * 10 + l_linenumber as row_id, l_linenumber as line,
  case l_linenumber % 6 when 0 then concat('₹', whole, '.50') when 1 then concat('Rs. ', whole) when 2 then 'n/a'
    when 3 then concat('MRP ', thousands, ',', rest, '.00 only') when 4 then concat(thousands, ' ', rest) else '' end as price_text
from (select l_orderkey, l_linenumber, cast(cast(floor(l_extendedprice) as bigint) as string) as whole,
  cast(cast(floor(l_extendedprice / 1000) as bigint) as string) as thousands,
  lpad(cast(cast(floor(l_extendedprice) as bigint) % 1000 as string), 3, '0') as rest from lineitem) t
"""
SQL["date_texts"] = """
select o_orderkey as row_id, site, case when o_orderkey % 11 = 0 then 'no date here' when site = 'amazon' then concat('Reviewed in India on ', d, ' ', m, ' ', y)
  when o_orderkey % 3 = 0 then concat(substring(m, 1, 3), ' ', d, ', ', y)
  when site = 'myntra' and o_orderkey % 3 = 1 then concat('Posted ', lpad(d, 2, '0'), '/', lpad(n, 2, '0'), '/', y) else concat(d, ' ', substring(m, 1, 3), ' ', y) end as date_text
from (select o_orderkey, case o_custkey % 3 when 0 then 'amazon' when 1 then 'flipkart' else 'myntra' end as site,
  cast(day(o_orderdate) as string) as d, cast(month(o_orderdate) as string) as n, cast(year(o_orderdate) as string) as y,
  case month(o_orderdate) when 1 then 'January' when 2 then 'February' when 3 then 'March' when 4 then 'April' when 5 then 'May' when 6 then 'June'
    when 7 then 'July' when 8 then 'August' when 9 then 'September' when 10 then 'October' when 11 then 'November' else 'December' end as m from orders) t
"""
SQL["breadcrumbs"] = """
select p_partkey as row_id, case p_partkey % 3 when 0 then 'amazon' when 1 then 'flipkart' else 'myntra' end as site,
  concat(case p_partkey % 6 when 0 then 'Home > ' when 1 then 'Sport > ' when 2 then 'Fashion > ' when 3 then 'Books > ' when 4 then 'Kitchen > ' else '' end, p_type, ' > ', p_name) as breadcrumb,
  case p_size % 5 when 0 then 'Currently unavailable.' when 1 then 'Out of Stock' when 2 then 'SOLD OUT' when 3 then 'In stock' else null end as stock_text
from part
"""
SQL["offer_texts"] = """
select p_partkey as row_id, concat('Bank OFFER on ', p_name) as a, case when p_partkey % 2 = 0 then 'Free delivery' else 'Save more' end as b,
  case when p_partkey % 3 = 0 then 'Deal of the day' else p_brand end as c, case when p_partkey % 5 = 0 then 'extra discount' else p_type end as d
from part
"""
SQL["links"] = """
select p_partkey as row_id, case p_partkey % 3 when 0 then 'amazon' when 1 then 'flipkart' else 'myntra' end as site,
  case p_partkey % 4 when 0 then '/dp/' when 1 then '/p/' when 2 then '/buy/' else '/about/' end as folder,
  concat(case p_partkey % 5 when 0 then 'https://www.shop.example.com' when 1 then '' when 2 then '//cdn.example.com' when 3 then 'http://user@shop.example.com:8080' else 'https://shop.example.com' end,
    case when p_partkey % 5 = 1 and p_partkey % 3 = 1 then case p_partkey % 8 when 0 then '?page=2' when 1 then '#part' when 2 then '../up' when 3 then './here'
        when 4 then 'a/../b' when 5 then '/x/../y/.' when 6 then 'mailto:a@b.c' else '../../../http-guide.html' end
      else concat(case p_partkey % 4 when 0 then '/dp/' when 1 then '/p/' when 2 then '/buy/' else '/about/' end, upper(substring(md5(p_name), 1, 10))) end,
    case when p_partkey % 5 = 1 and p_partkey % 3 = 1 then '' else case p_partkey % 7 when 0 then '?utm_source=x&id=1&ref=y#top' when 1 then '?ref=y' when 2 then '?id=1&tag=z&k=2' when 3 then '#top' else '' end end) as url
from part
"""
# Product pages of the three shops, one per product, with the product's own fields and its latest line of prices.
SQL["shop_pages"] = """
select ingest_seq as page_id, site, concat('https://www.', case site when 'amazon' then 'amazon.in/dp/' when 'flipkart' then 'flipkart.com/p/' else 'myntra.com/buy/' end, upper(substring(md5(product_id), 1, 10))) as url,
  scraped_at as fetched_at,
  case site when 'amazon' then concat('<html><body><div id="wayfinding-breadcrumbs_feature_div">Shop &gt; ', category, '</div><span id="productTitle"> ', title, ' </span><a id="bylineInfo">Visit the ', coalesce(brand, ''), ' Store</a>',
      '<span class="a-price"><span class="a-price-whole">', price, '</span></span><span class="a-text-strike">₹', mrp, '</span><div id="feature-bullets"><ul><li>', coalesce(description, ''), '</li></ul></div>',
      '<table id="productDetails_techSpec_section_1"><tr><td>Category</td><td>', category, '</td></tr><tr><td>Alone</td></tr></table><img class="a-dynamic-image" src="https://img.example.com/a.jpg"><img class="a-dynamic-image" src="https://img.example.com/a.jpg">',
      '<span class="a-size-base">Bank offer</span><span class="a-size-base">Other</span><div id="availability">', case when in_stock then 'In stock' else 'Currently unavailable' end, '</div></body></html>')
    when 'flipkart' then concat('<html><body><div class="_1MR4o5">Shop / ', category, '</div><h1 class="yhB1nd">', title, '</h1><span class="G6XhRU">', coalesce(brand, ''), '</span><div class="_30jeq3 _16Jk6d">₹', price, '</div><div class="_3I9_wc">₹', mrp, '</div><div class="_3Ay6Sb">10% off</div>',
      '<ul><li class="_21Ahn-">', coalesce(description, ''), '</li><li class="_21Ahn-">Sturdy</li></ul><table class="_14cfVK"><tr><td>Category</td><td>', category, '</td></tr></table><img class="_396cs4" src="https://img.example.com/a.jpg">',
      '<li class="_16_mp8">Bank offer 10% off</li><li class="_16_mp8">short</li><div class="_16FRp0">', case when in_stock then '' else 'Sold Out' end, '</div></body></html>')
    else concat('<html><body><h1 class="pdp-title">', coalesce(brand, ''), '</h1><h1 class="pdp-name">', title, '</h1><span class="pdp-price"><strong>Rs. ', price, '</strong></span><span class="pdp-mrp">MRP ', mrp, '</span><span class="pdp-discount">(0% OFF)</span>',
      '<div class="product-details">', coalesce(description, ''), '</div><div class="index-row"><div class="index-rowKey">Category</div><div class="index-rowValue">', category, '</div></div><div class="image-grid-image"><img src="https://img.example.com/w_200/a.jpg"></div>',
      '<div class="pdp-offers-content">Flat 100 off on first order</div><div class="size-buttons-size-button">', case when in_stock then 'M available' else 'M' end, '</div></body></html>') end as html,
  title, category, brand, description, in_stock, price_value, mrp_value
from (select p.*, replace(name, '  ', '') as title, 100 + cast(ingest_seq % 1000 as bigint) as price_value, 100 + cast(ingest_seq % 700 as bigint) as mrp_value,
  concat('1,', cast(100 + cast(ingest_seq % 1000 as bigint) as string)) as price, concat('1,', cast(100 + cast(ingest_seq % 700 as bigint) as string), '.50') as mrp from products p where product_id not like '%-copy') q
"""
# Result pages of the three shops: a whole card of a product, and a card without a link.
SQL["listing_pages"] = """
select page_id, site, url, concat('<html><body>', case site
  when 'amazon' then concat('<div data-component-type="s-search-result"><a class="a-link-normal" href="/dp/', code, '"><img class="s-image" src="https://img.example.com/', code, '.jpg"></a><span class="a-size-medium">', shown, '</span><span class="a-price-whole">', price, '</span><span class="a-icon-alt">', stars, ' out of 5 stars</span></div>',
    '<div data-component-type="s-search-result"><span class="a-size-medium">No link</span></div>')
  when 'flipkart' then concat('<div class="_13oc-S"><a class="_1fQZEK" href="p/', code, '"><img class="_396cs4" src="https://img.example.com/', code, '.jpg"><div class="_4rR01T">', shown, '</div></a><div class="_3LWZlK">', stars, '</div><div class="_30jeq3">₹', price, '</div></div>',
    '<div class="_13oc-S"><div class="_4rR01T">No link</div></div>')
  else concat('<ul><li class="product-base"><a href="/buy/', code, '"><img class="img-responsive" src="https://img.example.com/', code, '.jpg"><h3 class="product-brand">', coalesce(brand, ''), '</h3><h4 class="product-product">', shown, '</h4></a><span class="product-discountedPrice">Rs. ', price, '</span><span class="product-rating">', stars, '</span></li>',
    '<li class="product-base"><h4 class="product-product">No link</h4></li></ul>') end, '</body></html>') as html, code, title, brand, price_value, stars
from (select page_id, site, url, brand, title, price_value, concat('1,', cast(price_value as string)) as price, upper(substring(md5(title), 1, 10)) as code, replace(replace(title, '&', '&amp;'), '<', '&lt;') as shown,
  concat(cast(1 + page_id % 4 as string), '.', cast(page_id % 10 as string)) as stars from shop_pages) p
"""
# One review page per review, in the markup of its shop.
SQL["review_pages"] = """
select ingest_seq as page_id, site, concat('https://www.', case site when 'amazon' then 'amazon.in/product-reviews/' when 'flipkart' then 'flipkart.com/p/' else 'myntra.com/buy/' end, upper(substring(md5(product_id), 1, 10))) as url,
  case site when 'amazon' then concat('<div data-hook="review"><a data-hook="review-title">', shown_title, '</a><i data-hook="review-star-rating" class="a-icon a-star-', stars, '"></i><span class="a-profile-name">', reviewer, '</span>',
      case when verified_purchase then '<span data-hook="avp-badge">Verified Purchase</span>' else '' end, '<span data-hook="review-date">Reviewed in India on ', day, ' January 2024</span><span data-hook="review-body">', body, '</span></div>')
    when 'flipkart' then concat('<span class="B_NuCI">Item</span><div class="_27M-vq"><div class="_3LWZlK">', stars, '</div><p class="_2-N8zT">', shown_title, '</p><div class="t-ZTKy">', body, '</div><p class="_2sc7ZR">', reviewer, '</p>',
      '<span class="_2V5EHH">', case when verified_purchase then 'Certified Buyer' else 'Buyer' end, '</span><span class="_3PlgRk">', day, ' Jan 2024</span></div>')
    else concat('<h1 class="pdp-name">Item</h1><div class="user-review"><span class="review-rating">', stars, '</span><div class="user-review-reviewText">', body, '</div><div class="user-review-left">', reviewer, '</div><span class="review-date">', lpad(day, 2, '0'), '/01/2024</span></div>') end as html,
  product_id, content, reviewer, stars, day, verified_purchase
from (select r.*, cast(1 + ingest_seq % 5 as string) as stars, cast(1 + ingest_seq % 30 as string) as day, coalesce(reviewer_name, '') as reviewer,
  replace(replace(coalesce(title, ''), '&', '&amp;'), '<', '&lt;') as shown_title, replace(replace(content, '&', '&amp;'), '<', '&lt;') as body from reviews r) q
"""

DEPENDS = {
    "pricing_2024": ["pricing"], "pricing_gap": ["pricing_2024"], "jobs_2024": ["jobs"], "shop_pages": ["products"], "listing_pages": ["shop_pages"], "review_pages": ["reviews"],
}
# Pages made from table rows: a row of few bytes becomes a page that takes long to walk.
MADE_PAGES = {"shop_pages", "listing_pages", "review_pages"}
AS_OF = "2024-01-25 00:00:00"
PRICES_AS_OF = "2001-11-04 00:00:00"
METRICS_AS_OF = "2024-01-31 00:00:00"


def timestamp(value: str):
    return F.lit(value).cast("timestamp_ntz")


def zone_free(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema.fields if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Register the test tables that the named bindings (or tables) read, and give each as a frame."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    walked = set().union(*[tables_of(name) for name in MADE_PAGES.intersection(names)])
    for table in sorted(set().union(*[tables_of(name) for name in names])):
        read = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        (dealt(read) if table in walked else read).createOrReplaceTempView(table)
    return [bound(spark, name) for name in names]


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt out evenly to as many tasks as a shuffle has.

    A file of small rows is read by one task or a few, however many cores there are, and what is made of the rows would
    stay in these tasks. The rows are dealt out before pages are made of them, while they are small.
    """
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def tables_of(name: str) -> set[str]:
    if name not in SQL:
        return {name}
    read = {word for word in re.findall(r"(?:from|join) (\w+)", SQL[name]) if word in TABLES}
    return read.union(*[tables_of(needed) for needed in DEPENDS.get(name, [])])


def bound(spark: SparkSession, name: str) -> DataFrame:
    if name not in SQL:
        return spark.table(name)
    for needed in DEPENDS.get(name, []):
        bound(spark, needed)
    df = zone_free(spark.sql(SQL[name]))
    df.createOrReplaceTempView(name)
    return df
