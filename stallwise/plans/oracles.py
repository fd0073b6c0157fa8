"""The SQL each registered query is compared with, written for DuckDB over the same tables.

The texts state the results from the definitions, row by row where the Spark jobs pre-aggregate, slice or stream.
The WITH list of each comes from the bindings and helper queries it names.
"""

from __future__ import annotations

from stallwise.functions.text import URL_PATTERN
from stallwise.plans import bindings
from stallwise.plans.bindings import AS_OF, METRICS_AS_OF, PRICES_AS_OF

SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
VISIBLE = r"[^\s\x0B\x1C-\x1F\x85\p{Z}]"
NOW, PRICES_NOW, METRICS_NOW = (f"timestamp '{t}'" for t in (AS_OF, PRICES_AS_OF, METRICS_AS_OF))


def r4(x: str) -> str:
    return f"floor(({x}) * 10000 + 0.5) / 10000"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def points(condition: str) -> str:
    return f"case when {condition} then 1e0 else 0e0 end"


def held(x: str) -> str:
    return f"coalesce({x}, '') <> ''"


def visible(x: str) -> str:
    return f"regexp_matches(coalesce({x}, ''), '{VISIBLE}')"


def valid_url(x: str) -> str:
    return f"regexp_matches(coalesce({x}, ''), '{URL_PATTERN}')"


def exact(x: str, digits: int = 10) -> str:
    """The value if it can be summed; DuckDB turns doubles into decimals by multiplying, so no more digits than are exact."""
    return f"case when isfinite({x}) and abs({x}) < 1e20 then cast({x} as decimal(38, {digits})) end"


def plain_sum(x: str, where: str = "true") -> str:
    return f"cast(sum({exact(x)}) filter ({where}) as double)"


def mean(x: str, digits: int = 10) -> str:
    return f"cast(sum({exact(x, digits)}) as double) / count({exact(x, digits)})"


def joined(*issues: str) -> str:
    return "concat_ws('; ', " + ", ".join(issues) + ")"


def total(*parts: str) -> str:
    return "(" + " + ".join(parts) + ")"


DOMAIN = "case site when 'amazon' then 'amazon.in' when 'flipkart' then 'flipkart.com' when 'myntra' then 'myntra.com' end"


def product_scores(as_of: str, source: str = "products") -> str:
    required = ["product_id", "name", "site", "category", "url"]
    return f"""
    select *, (completeness_score + accuracy_score + consistency_score) / 3 as overall_score from (
    select product_id as record_id, 'product' as record_type, product_id, site, category, ingest_seq, date_trunc('day', scraped_at) + interval 26 hour as evaluated_at,
      {total(*[points(held(c)) for c in required], points(visible('brand')), points(visible('description')), points('len(imgs) > 0'), points('specifications is not null'))} / 9e0 as completeness_score,
      {total(points('length(name) between 3 and 500'), points(valid_url('url')),
             f"case when not ({held('brand')}) then 0.5e0 when {visible('brand')} then 1e0 else 0e0 end",
             f"case when not ({held('description')}) then 0.5e0 when length({strip('description')}) >= 10 then 1e0 else 0e0 end",
             "case when len(imgs) = 0 then 0.5e0 else good / len(imgs) end")} / 5e0 as accuracy_score,
      {total(points(f'contains(url, {DOMAIN})'),
             f"case when not ({held('brand')}) then 0.5e0 when contains(lower(name), lower(brand)) then 1e0 else 0e0 end",
             points(f'scraped_at <= {as_of}'))} / 3e0 as consistency_score,
      {joined(*[f"case when not ({held(c)}) then 'Missing required field: {c}' end" for c in required],
              "case when length(name) not between 3 and 500 then concat('Invalid name length: ', length(name)) end",
              f"case when not {valid_url('url')} then 'Invalid URL format' end",
              "case when good < len(imgs) then concat('Invalid image URLs: ', len(imgs) - good) end",
              f"case when not contains(url, {DOMAIN}) then concat('URL domain doesn''t match site: ', site) end",
              f"case when {held('brand')} and not contains(lower(name), lower(brand)) then 'Brand not found in product name' end",
              f"case when scraped_at > {as_of} then 'Invalid scraped timestamp' end")} as issues
    from (select *, len(list_filter(imgs, lambda x: {valid_url('x')})) as good from (select *, from_json(images, '["VARCHAR"]') as imgs from {source}) a) b) c
    """


LOWERED = "lower(content)"
SPAM = {
    "too_short": f"length({strip('content')}) < 10",
    "repetitive": "len(list_distinct(ws)) < len(ws) * 0.3e0",
    "repeated_character": f"len(list_filter(list_distinct(string_split({LOWERED}, '')), lambda c: c <> chr(10) and contains({LOWERED}, repeat(c, 11)))) > 0",
    "spam_phrase": f"(contains({LOWERED}, 'buy now') or contains({LOWERED}, 'click here') or contains({LOWERED}, 'visit') or contains({LOWERED}, 'website'))",
    "long_number": r"regexp_matches(content, '(?:^|[^\p{L}\p{N}_])\p{Nd}{10,}(?:$|[^\p{L}\p{N}_])')",
}
WORDED = f"(select *, list_filter(regexp_split_to_array({LOWERED}, '{SPACE}+'), lambda w: w <> '') as ws from reviews)"
FLAGGED = f"""(select *, not ({' or '.join(f for f in SPAM)}) as meaningful from (select *, {', '.join(f'{c} as {n}' for n, c in SPAM.items())} from {WORDED} w) f)"""


def review_scores(as_of: str) -> str:
    required = ["review_id", "product_id", "site", "content"]
    return f"""
    select *, (completeness_score + accuracy_score + consistency_score) / 3 as overall_score from (
    select review_id as record_id, 'review' as record_type, ingest_seq, date_trunc('day', scraped_at) + interval 26 hour as evaluated_at,
      {total(*[points(held(c)) for c in required], points('rating <> 0'), points(held('title')), points(held('reviewer_name')), points('review_date is not null'))} / 8e0 as completeness_score,
      {total(points('length(content) between 10 and 5000'), points('rating between 1 and 5'), points('meaningful'),
             f"case when not ({held('reviewer_name')}) then 0.5e0 when {visible('reviewer_name')} then 1e0 else 0e0 end")} / 4e0 as accuracy_score,
      {total(points(f'scraped_at <= {as_of}'), f"case when review_date is null then 0.5e0 when review_date <= {as_of} then 1e0 else 0e0 end")} / 2e0 as consistency_score,
      {joined(*[f"case when not ({held(c)}) then 'Missing required field: {c}' end" for c in required],
              "case when length(content) not between 10 and 5000 then concat('Invalid content length: ', length(content)) end",
              "case when rating not between 1 and 5 then concat('Invalid rating: ', rating) end",
              "case when not meaningful then 'Low quality or spam content detected' end",
              f"case when scraped_at > {as_of} then 'Invalid scraped timestamp' end",
              f"case when review_date > {as_of} then 'Invalid review date' end")} as issues
    from {FLAGGED} g) h
    """


def pricing_scores(as_of: str, source: str = "pricing") -> str:
    inside = "between 0.01 and 1000000"
    return f"""
    select *, (completeness_score + accuracy_score + consistency_score) / 3 as overall_score from (
    select *, price_id as record_id, 'pricing' as record_type, date_trunc('day', scraped_at) + interval 26 hour as evaluated_at,
      {total(*[points(f'{c} is not null') for c in ('price_id', 'product_id', 'site', 'current_price', 'original_price', 'discount_percentage')], points("offers <> '[]'"))} / 7e0 as completeness_score,
      {total(points(f'current_price {inside}'), f"case when original_price is null then 0.5e0 when original_price {inside} then 1e0 else 0e0 end",
             "case when discount_percentage is null then 0.5e0 when discount_percentage between 0 and 100 then 1e0 else 0e0 end")} / 3e0 as accuracy_score,
      {total('case when original_price is null then 0.5e0 when original_price >= current_price then 1e0 else 0e0 end', points(f'scraped_at <= {as_of}'))} / 2e0 as consistency_score,
      {joined(f"case when not current_price {inside} then concat('Invalid current price: ', current_price) end",
              f"case when not original_price {inside} then concat('Invalid original price: ', original_price) end",
              "case when discount_percentage not between 0 and 100 then concat('Invalid discount percentage: ', discount_percentage) end",
              "case when original_price < current_price then 'Original price less than current price' end",
              f"case when scraped_at > {as_of} then 'Invalid scraped timestamp' end")} as issues
    from {source}) c
    """


def all_scores(prices: str = "pricing_2024") -> str:
    columns = "record_id, record_type, completeness_score, accuracy_score, consistency_score, overall_score, issues, evaluated_at"
    return (
        f"select {columns} from ({product_scores(NOW)}) p union all select {columns} from ({review_scores(NOW)}) r "
        f"union all select {columns} from ({pricing_scores(NOW, prices)}) q"
    )


EXTRA = {
    "scores": (["products", "reviews", "pricing_2024"], all_scores()),
    "rules": ([], """select * from (values ('high_error_rate', 'error_rate', 10e0, '>', 'HIGH', 'Error rate is above threshold'),
      ('low_success_rate', 'scraping_success_rate', 90e0, '<', 'MEDIUM', 'Scraping success rate is low'),
      ('high_memory_usage', 'memory_usage_percentage', 80e0, '>', 'MEDIUM', 'Memory usage is high'),
      ('low_data_quality', 'data_quality_score', 0.7e0, '<', 'HIGH', 'Data quality score is below threshold'),
      ('busy', 'error_rate', 0e0, '!=', 'LOW', 'Errors')) v(rule_name, metric, threshold, operator, severity, message)"""),
    "gauges": (["metrics"], "select name as key, arg_max(value, (ts, seq)) as value from metrics where type = 'gauge' group by name"),
    "flags": (["metrics", "rules"], """select rule_name, metric, severity, ts, seq, value,
      case operator when '>' then value > threshold when '<' then value < threshold else value <> threshold end as breach
      from metrics join rules on name = metric where type = 'gauge' and rule_name <> 'busy'"""),
    "turns": (["flags"], """select * from (select *, coalesce(lag(breach) over (partition by rule_name order by ts, seq), false) as was from flags) t where breach <> was"""),
    "episodes": (["turns"], """select rule_name, metric, severity, value as current_value, ts as started_at, seq as started_seq, resolved_at
      from (select *, lead(ts) over (partition by rule_name order by ts, seq) as resolved_at from turns) t where breach"""),
    "timers": (["metrics"], """select name, site_label, count(*) as n, """ + mean("value") + """ as a, min(value) as lo, max(value) as hi, list_sort(list(value)) as vs
      from (select *, row_number() over (partition by name, site_label order by ts desc, seq desc) as rn from metrics where type = 'timer') t where rn <= 100 group by 1, 2"""),
    "plain_timers": (["metrics"], """select name, count(*) as n, """ + mean("value") + """ as a, max(value) as hi, list_sort(list(value)) as vs
      from (select *, row_number() over (partition by name order by ts desc, seq desc) as rn from metrics where type = 'timer') t where rn <= 100 group by 1"""),
    "signed": (["products", "reviews", "pricing_2024"], f"""select 'products' as tbl, concat_ws('|', site, {strip('lower(name)')}, url) as sig, site from products
      union all select 'reviews', concat_ws('|', product_id, md5({strip('lower(content)')})), site from reviews
      union all select 'pricing', concat_ws('|', product_id, cast(price_date as date)), site from pricing_2024"""),
    "completeness": (["products", "reviews", "pricing_2024"], " union all ".join(
        f"select '{t}' as tbl, ({' + '.join(f'count(*) filter ({c} is not null' + (f' and {c} <> {chr(39)}{chr(39)}' if s else '') + ')' for c, s in cols)}) / (count(*) * {len(cols)}) as rate, count(*) as n from {src}"
        for t, src, cols in (
            ("products", "products", [(c, True) for c in ("product_id", "site", "name", "category", "brand", "url", "description", "specifications", "images")] + [("in_stock", False), ("scraped_at", False), ("ingest_seq", False)]),
            ("reviews", "reviews", [(c, True) for c in ("review_id", "product_id", "site", "title", "content", "reviewer_name")] + [("rating", False), ("verified_purchase", False), ("review_date", False), ("scraped_at", False), ("ingest_seq", False)]),
            ("pricing", "pricing_2024", [(c, True) for c in ("price_id", "product_id", "site", "currency", "offers")] + [(c, False) for c in ("current_price", "original_price", "discount_percentage", "discount_amount", "price_date", "scraped_at", "ingest_seq")]),
        ))),
    "fresh": (["products", "reviews", "pricing_2024"], " union all ".join(
        f"select '{t}' as tbl, count(*) filter (scraped_at > {NOW} - interval 24 hour) as recent, count(*) as n from {src}"
        for t, src in (("products", "products"), ("reviews", "reviews"), ("pricing", "pricing_2024")))),
    "health": (["jobs_2024"], f"""select count(*) filter (status = 'completed') as done, count(*) filter (status = 'failed') as failed,
      count(*) filter (status = 'running') as active, count(*) filter (status = 'pending') as queued from jobs_2024 where created_at >= {NOW} - interval 7 day"""),
    "checks": (["scores", "completeness", "fresh", "signed", "health"], """
      select 'data_quality' as "check", case when low / n <= 0.3 then 'PASS' else 'FAIL' end as status, low / n as measure from (select count(*) as n, count(*) filter (overall_score < 0.7) as low from scores) q
      union all select 'completeness', case when min(rate) >= 0.8 then 'PASS' else 'FAIL' end, min(rate) from completeness
      union all select 'freshness', case when max(recent / n) > 0.5 then 'PASS' else 'STALE' end, max(recent / n) from fresh
      union all select 'duplicates', case when max(rate) > 0.1 then 'FAIL' else 'PASS' end, max(rate) from (select (count(*) - count(distinct sig)) / count(*) as rate from signed group by tbl) d
      union all select 'site_coverage', case when min(sites) = 3 then 'PASS' else 'PARTIAL' end, cast(count(*) filter (sites < 3) as double) from (select count(distinct site) as sites from signed group by tbl) s
      union all select 'processing_health', case when failed / (done + failed) > 0.2 then 'FAIL' else 'PASS' end, done / (done + failed) from health"""),
    "raised": (["checks"], """select 'LOW_DATA_QUALITY' as type, 'HIGH' as severity, concat('Low quality rate: ', floor(measure * 1000 + 0.5) / 10, '%') as message from checks where "check" = 'data_quality' and status = 'FAIL'
      union all select 'STALE_DATA', 'MEDIUM', 'Data appears to be stale' from checks where "check" = 'freshness' and status = 'STALE'
      union all select 'INCOMPLETE_SITE_COVERAGE', 'MEDIUM', 'Not all sites are being scraped' from checks where "check" = 'site_coverage' and status = 'PARTIAL'"""),
    # Two versions of every third product, and a ledger of the even first versions.
    "latest": (["products"], """select * from (select *, row_number() over (partition by product_id order by ingest_seq desc) as rn from (
      select product_id, site, scraped_at, in_stock, ingest_seq from products
      union all select product_id, site, scraped_at, not in_stock, ingest_seq + 10000000000 from products where ingest_seq % 3 = 0) v) w where rn = 1"""),
}
# The limits are the products of the doubles 0.95, 0.8 and 0.7.
GATE = {"products": repr(0.95 * 0.8) + "e0", "reviews": repr(0.95 * 0.7) + "e0", "pricing": repr(0.95 * 0.8) + "e0"}

KEYS = {
    "products": ("product_id", NOW, product_scores, f"site, {strip('lower(name)')}, url", "ingest_seq"),
    "reviews": ("review_id", NOW, review_scores, f"product_id, md5({strip('lower(content)')})", "ingest_seq"),
    "pricing": ("price_id", PRICES_NOW, pricing_scores, "product_id, cast(price_date as date)", "ingest_seq, price_id, current_price"),
}

SQL: dict[str, tuple[list[str], str]] = {}


def put(name: str, sql: str, *uses: str) -> None:
    SQL[name] = (list(uses), sql)


def _with(uses: list[str]) -> str:
    """The WITH list of the named bindings and helper queries, each after those it reads."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        needs, text = EXTRA[name] if name in EXTRA else (bindings.DEPENDS.get(name, []), bindings.SQL[name])
        for needed in needs:
            add(needed)
        done[name] = text

    for name in uses:
        add(name)
    return "with " + ",\n".join(f"{n} as ({t})" for n, t in done.items()) + "\n" if done else ""


def all_sql() -> dict[str, str]:
    return {name: _with(uses) + sql for name, (uses, sql) in SQL.items()}


# --- sources and sinks ---

put("raw_landing_roundtrip", "select product_id, site, name, brand, url, in_stock, scraped_at from products", "products")
put("raw_file_listing", """select 'products/20240125' as folder, count(*) as records, true as has_bytes from products
  union all select 'reviews/20240125', count(*), true from reviews""", "products", "reviews")
put("upsert_products", """select product_id, name, in_stock, ingest_seq from (select *, row_number() over (partition by product_id order by ingest_seq desc) as rn from (
  select product_id, name, in_stock, ingest_seq from products union all select product_id, name, not in_stock, ingest_seq + 10000000000 from products where ingest_seq % 3 = 0) v) w where rn = 1""", "products")
put("upsert_reviews", """select review_id, product_id, rating, ingest_seq from (select *, row_number() over (partition by review_id order by ingest_seq desc) as rn from (
  select review_id, product_id, rating, ingest_seq from reviews union all select review_id, product_id, 3e0, ingest_seq + 10000000000 from reviews where ingest_seq % 3 = 0) v) w where rn = 1""", "reviews")
put("upsert_pricing", f"""select price_id, {r4('current_price')} as current_price, ingest_seq from (select *, row_number() over (partition by price_id order by ingest_seq desc, product_id desc, current_price desc) as rn from (
  select price_id, product_id, current_price, ingest_seq from pricing union all select price_id, product_id, current_price + 1, ingest_seq + 10000000000 from pricing where ingest_seq % 3 = 0) v) w where rn = 1""", "pricing")
put("upsert_jobs", "select job_id, site, job_type, case when status = 'running' then 'completed' else status end as status, created_at from jobs", "jobs")
put("upsert_quality", f"""select record_id, {r4('consistency_score')} as consistency_score, {r4('overall_score')} as overall_score from (
  select * from ({product_scores("timestamp '2024-01-10 00:00:00'")}) a where ingest_seq % 2 <> 0 union all select * from ({product_scores(NOW)}) b where ingest_seq % 2 = 0) c""", "products")
put("unprocessed_scan", "select product_id, in_stock, ingest_seq from latest where not (ingest_seq % 2 = 0 and ingest_seq < 10000000000)", "latest")
put("mark_processed", 'select site, true as processed, count(*) as rows from latest group by site', "latest")
put("warehouse_partitioned_read", """select product_id, category, array_to_string(from_json(images, '["VARCHAR"]'), '|') as images, in_stock, cast(scraped_at as date) as dt from products
  where site = 'amazon' and scraped_at >= timestamp '2024-01-18'""", "products")
put("incremental_load", "select cast(scraped_at as date) as dt, site, count(*) as rows, count(distinct review_id) as reviews from reviews group by 1, 2", "reviews")
put("adhoc_sql", """select p.site, p.category, count(*) as prices, max(r.current_price) as top_price from products p join pricing r on p.product_id = r.product_id
  where r.price_date >= timestamp '2001-01-01' group by p.site, p.category""", "products", "pricing")
put("process_all_pending", """select 'products' as "table", count(distinct product_id) as first_round, (select count(*) from products where ingest_seq % 3 = 0) as second_round,
    count(distinct product_id) + (select count(*) from products where ingest_seq % 3 = 0) as target_rows from products
  union all select 'reviews', count(distinct review_id), 0, count(distinct review_id) from reviews
  union all select 'pricing', count(distinct price_id), 0, count(distinct price_id) from pricing""", "products", "reviews", "pricing")
put("current_after_loads", """select product_id, name, in_stock, array_to_string(from_json(images, '["VARCHAR"]'), '|') as images, ingest_seq, cast(scraped_at as date) as dt
  from (select *, row_number() over (partition by product_id order by ingest_seq desc) as rn from (select product_id, name, in_stock, images, ingest_seq, scraped_at from products
    union all select product_id, name, not in_stock, images, ingest_seq + 10000000000, scraped_at from products where ingest_seq % 3 = 0) v) w where rn = 1""", "products")
# The first two loads are merged to the base, entry 5 of the manifest; the third load, entry 8, holds the later of its versions of each key.
put("loaded_versions", """select 5 as load, product_id, in_stock, ingest_seq from (select *, row_number() over (partition by product_id order by ingest_seq desc) as rn from products) p where rn = 1
  union all select 8, product_id, in_stock, ingest_seq from (select *, row_number() over (partition by product_id order by ingest_seq desc) as rn from (
    select product_id, not in_stock as in_stock, ingest_seq + 10000000000 as ingest_seq from products where ingest_seq % 3 = 0
    union all select product_id, in_stock, ingest_seq - 1000000000 from products where ingest_seq % 5 = 0) v) w where rn = 1""", "products")
put("retention_cleanup", """select * from (select product_id, scraped_at, (ingest_seq % 2 = 0 and ingest_seq < 10000000000) as processed from latest) l
  where not (processed and scraped_at < timestamp '2024-01-11')""", "latest")
put("retention_counts", """select "table", count(*) filter (not old) as kept, count(*) filter (old) as dropped from (
  select 'products' as "table", ingest_seq % 2 = 0 and coalesce(scraped_at < timestamp '2024-01-11', false) as old from (select *, row_number() over (partition by product_id order by ingest_seq desc) as rn from products) p where rn = 1
  union all select 'reviews', ingest_seq % 2 = 0 and coalesce(scraped_at < timestamp '2024-01-11', false) from (select *, row_number() over (partition by review_id order by ingest_seq desc) as rn from reviews) r where rn = 1
  union all select 'pricing', ingest_seq % 2 = 0 and coalesce(scraped_at < timestamp '1998-05-02', false)
    from (select *, row_number() over (partition by price_id order by ingest_seq desc, product_id desc, current_price desc, original_price desc, discount_percentage desc) as rn from pricing) c where rn = 1) u group by 1""", "products", "reviews", "pricing")
put("metrics_export_json", f"select ts, name, {r4('value')} as value, type, site_label as site from metrics", "metrics")
put("recent_metrics", f"select ts, seq, name, {r4('value')} as value from metrics order by ts desc, seq desc limit 1000", "metrics")
put("storage_costs", " union all ".join(f"""select '{t}' as "table", count(*) as rows, true as measured, true as has_share, 1.75e0 as cost_per_gigabyte, true as charged from {t}""" for t in ("products", "reviews", "pricing")), "products", "reviews", "pricing")
put("metrics_export", """select strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp, name as metric, value, type, concat('{"site":"', site_label, '"}') as labels from metrics""", "metrics")

# --- projections, filters, routing ---

_RULES = {
    "products": [("product_id is blank", f"not {visible('product_id')}"), ("name is blank", f"not {visible('name')}"), ("url is null", "url is null"),
                 ("category is unknown", "category not in ('electronics', 'clothing', 'home-kitchen', 'books', 'sports')")],
    "reviews": [("content is blank", f"not {visible('content')}"), ("rating is out of range", "rating not between 1 and 5"), ("product_id is null", "product_id is null")],
    "pricing": [("current_price is negative", "current_price < 0"), ("original_price is negative", "original_price < 0"),
                ("discount_percentage is out of range", "discount_percentage not between 0 and 100"), ("discount_amount is negative", "discount_amount < 0"),
                ("original_price is below current_price", "original_price < current_price")],
}
put("constraint_violations", " union all ".join(
    f"select '{t}' as entity, '{n}' as violation, count(*) as rows from {t} where {c} having count(*) > 0" for t, rules in _RULES.items() for n, c in rules
), "products", "reviews", "pricing")
put("quarantine_counts", " union all ".join(
    f"select '{t}' as entity, count(*) filter (not bad) as valid, count(*) filter (bad) as quarantined from (select coalesce({' or '.join(f'coalesce({c}, false)' for _, c in rules)}, false) as bad from {t}) {t}_b"
    for t, rules in _RULES.items()
), "products", "reviews", "pricing")


def _unique(entity: str) -> str:
    key, as_of, scores, signature, order = KEYS[entity]
    return f"(select * from (select *, row_number() over (partition by {signature} order by {order}) as rn from {entity}) u where rn = 1)"


def _counts(entity: str, where: str = "true") -> tuple[str, str]:
    """Scores of the first copies, and the number of all rows."""
    key, as_of, scores, signature, order = KEYS[entity]
    first = f"(select * from (select *, row_number() over (partition by {signature} order by {order}) as rn from {entity} where {where}) u where rn = 1)"
    if entity == "reviews":
        scored = review_scores(as_of).replace("from reviews)", f"from {first} reviews)")
    else:
        scored = scores(as_of, first + " k")
    return scored, f"(select count(*) from {entity} where {where})"


for _entity, (_key, _as_of, _scores, _signature, _order) in KEYS.items():
    put(f"gate_{_entity}", f"select record_id as {_key}, ingest_seq, {r4('overall_score')} as overall_score from ({_scores(_as_of)}) s where overall_score >= {GATE[_entity]}", _entity)
    put(f"dedup_{_entity}", f"select {_key}, site, ingest_seq from {_unique(_entity)} d", _entity)
    put(f"score_{_entity}", f"""select record_id, record_type, {', '.join(f"{r4(c)} as {c}" for c in ('completeness_score', 'accuracy_score', 'consistency_score', 'overall_score'))}, issues from ({_scores(_as_of)}) s""", _entity)
    _scored, _all = _counts(_entity)
    put(f"ingest_{_entity}", f"""select 'processed' as status, count(*) filter (overall_score >= {GATE[_entity]}) as n from ({_scored}) a
      union all select 'failed', count(*) filter (overall_score < {GATE[_entity]}) from ({_scored}) b
      union all select 'duplicate', {_all} - count(*) from {_unique(_entity)} c""", _entity)

put("clean_products", f"""select product_id, case when ingest_seq % 5 = 0 then null else scraped_at end as scraped_at,
    case when ingest_seq % 7 = 0 then null else json_extract_string(specifications, '$.size') end as size,
    case when ingest_seq % 7 = 0 or specifications is null then 0 else 2 end as n_specifications,
    case when ingest_seq % 11 = 0 then '' else array_to_string(from_json(images, '["VARCHAR"]'), '|') end as images from products""", "products")
put("clean_pricing", """select price_id, price_date, case when ingest_seq % 9 = 0 then null else scraped_at end as scraped_at,
    array_to_string(from_json(offers, '["VARCHAR"]'), '|') as offers from pricing""", "pricing")
put("clean_reviews", "select review_id, review_date, scraped_at, rating from reviews", "reviews")


def _stats(entity: str) -> str:
    halves = [_counts(entity, f"ingest_seq % 2 = {p}") for p in (0, 1)]
    kept = " + ".join(f"(select count(*) filter (overall_score >= {GATE[entity]}) from ({s}) x)" for s, _ in halves)
    unique = " + ".join(f"(select count(*) from ({s}) x)" for s, _ in halves)
    rows = " + ".join(n for _, n in halves)
    return f"select '{entity}' as entity, {kept} as processed, {rows} - ({unique}) as duplicates_filtered, {unique} - ({kept}) as validation_failures, timestamp '2024-01-26' as last_processed"


put("ingest_rows", f"select record_id as product_id, case when overall_score >= {GATE['products']} then 'processed' else 'failed' end as status, {r4('overall_score')} as overall_score from ({_counts('products')[0]}) s", "products")
put("processing_stats", " union all ".join(_stats(e) for e in KEYS), "products", "reviews", "pricing")
put("categorize_products", """select row_id, case when regexp_matches(lower(breadcrumb), 'clothing|fashion') then 'clothing' when regexp_matches(lower(breadcrumb), 'home|kitchen') then 'home-kitchen'
  when contains(lower(breadcrumb), 'book') then 'books' when contains(lower(breadcrumb), 'sport') then 'sports' else 'electronics' end as category from breadcrumbs""", "breadcrumbs")
put("stock_status", """select row_id, not (contains(t, 'out of stock') or case when site = 'amazon' then contains(t, 'unavailable') else contains(t, 'sold out') end) as by_text,
  row_id % 2 = 0 or contains(t, 'available') or row_id % 3 = 0 as by_sizes from (select *, lower(coalesce(stock_text, '')) as t from breadcrumbs) b""", "breadcrumbs")
put("product_url_filter", r"""select row_id, site, url from links where case site when 'amazon' then regexp_matches(url, '/dp/|/gp/product/') when 'flipkart' then regexp_matches(url, '/p/|/product/')
  else regexp_matches(url, '/buy|/product/') end""", "links")
_TERMS = "(values ('electronics', 1, 1, 'red'), ('electronics', 1, 2, 'gear'), ('electronics', 1, 3, 'bolt'), ('clothing', 2, 1, 'blue'), ('clothing', 2, 2, 'ring'), ('clothing', 2, 3, 'gizmo'), ('home-kitchen', 3, 1, 'small'), ('home-kitchen', 3, 2, 'widget'), ('books', 4, 1, 'hot'), ('books', 4, 2, 'cold'), ('books', 4, 3, 'big'), ('sports', 5, 1, 'large'), ('sports', 5, 2, 'ring'), ('sports', 5, 3, 'bolt')) t(category, c, k, term)"
put("search_term_coverage", f"""select s.site, t.category, t.term, count(p.product_id) as products, d.schedule from {_TERMS} cross join (values ('amazon'), ('flipkart'), ('myntra')) s(site)
  cross join (values ('daily'), ('weekly')) d(schedule) left join products p on p.site = s.site and p.category = t.category and contains(lower(p.name), t.term)
  where (d.schedule = 'daily' and t.k <= 2) or (d.schedule = 'weekly' and t.c <= 2) group by all""", "products")
put("stale_price_products", f"""select p.product_id, p.site, l.latest_price from products p left join (select product_id, max(price_date) as latest_price from pricing group by 1) l using (product_id)
  where l.latest_price is null or l.latest_price < {PRICES_NOW} - interval 6 hour""", "products", "pricing")
put("few_review_products", "select p.product_id, p.site, count(r.review_id) as reviews from products p left join reviews r using (product_id) group by 1, 2 having count(r.review_id) < 3", "products", "reviews")

# --- views and aggregates ---

put("product_price_trends", f"""select product_id, name, brand, category, site, price_id, current_price, original_price, {r4('discount_percentage')} as discount_percentage, price_date, previous_price,
    {r4('current_price - previous_price')} as price_change from (select p.product_id, p.name, p.brand, p.category, p.site, pr.price_id, pr.current_price, pr.original_price, pr.discount_percentage, pr.price_date,
    lag(pr.current_price) over (partition by p.product_id order by pr.price_date, pr.ingest_seq, pr.price_id, pr.current_price) as previous_price
  from products p join pricing pr on p.product_id = pr.product_id where pr.price_date >= {PRICES_NOW} - interval 30 day) t""", "products", "pricing")
put("product_review_summary", f"""select p.product_id, p.name, p.brand, p.category, p.site, count(r.review_id) as total_reviews, {r4(mean('r.rating'))} as avg_rating,
    count(*) filter (r.verified_purchase) as verified_reviews, count(*) filter (r.rating >= 4) as positive_reviews, count(*) filter (r.rating <= 2) as negative_reviews, max(r.review_date) as latest_review_date
  from products p left join reviews r on p.product_id = r.product_id group by 1, 2, 3, 4, 5""", "products", "reviews")
put("daily_scraping_summary", f"""select cast(scraped_at as date) as scrape_date, site, count(distinct product_id) as products_scraped, count(distinct case when in_stock then product_id end) as in_stock_products,
    {r4('avg(case when specifications is not null then 1 else 0 end)')} as spec_completeness, {r4('avg(case when length(description) > 10 then 1 else 0 end)')} as desc_completeness
  from products where scraped_at >= {NOW} - interval 7 day group by 1, 2""", "products")
_MEANS = f"""{r4(mean('overall_score', 12))} as avg_overall_score, {r4(mean('completeness_score', 12))} as avg_completeness, {r4(mean('accuracy_score', 12))} as avg_accuracy, {r4(mean('consistency_score', 12))} as avg_consistency"""
put("quality_summary", f"""select record_type, cast(evaluated_at as date) as evaluation_date, count(*) as total_records, {_MEANS},
    count(*) filter (overall_score >= 0.8) as high_quality_records, count(*) filter (overall_score < 0.5) as low_quality_records
  from scores where evaluated_at >= {NOW} - interval 30 day group by 1, 2""", "scores")
put("site_comparison", f"""select p.site, p.category, count(distinct p.product_id) as total_products, {r4(mean('pr.current_price'))} as avg_current_price, {r4(mean('pr.discount_percentage'))} as avg_discount,
    count(distinct r.review_id) as total_reviews, {r4(mean('r.rating'))} as avg_rating
  from products p left join pricing_2024 pr on p.product_id = pr.product_id left join reviews r on p.product_id = r.product_id
  where p.scraped_at >= {NOW} - interval 7 day and (pr.price_date is null or pr.price_date >= {NOW} - interval 7 day) group by 1, 2""", "products", "pricing_2024", "reviews")
put("site_comparison_preagg", f"""select site, category, count(distinct k.product_id) as total_products, any_value(avg_current_price) as avg_current_price, any_value(avg_discount) as avg_discount,
    coalesce(any_value(total_reviews), 0) as total_reviews, any_value(avg_rating) as avg_rating from kept k
  left join (select site, category, {r4(mean('current_price'))} as avg_current_price, {r4(mean('discount_percentage'))} as avg_discount from kept join (select product_id, current_price, discount_percentage, price_date from pricing_2024) pr using (product_id)
    where price_date >= {NOW} - interval 7 day group by 1, 2) a using (site, category)
  left join (select site, category, count(distinct review_id) as total_reviews, {r4(mean('rating'))} as avg_rating from kept join (select product_id, review_id, rating from reviews) r using (product_id) group by 1, 2) b using (site, category)
  group by 1, 2""", "products", "pricing_2024", "reviews", "kept")
EXTRA["kept"] = (["products", "pricing_2024"], f"""select product_id, site, category from products p where scraped_at >= {NOW} - interval 7 day
  and (not exists (select 1 from pricing_2024 q where q.product_id = p.product_id) or exists (select 1 from pricing_2024 q where q.product_id = p.product_id and q.price_date >= {NOW} - interval 7 day))""")
for _view, _name in (("product_price_trends", "stored_price_trends"), ("daily_scraping_summary", "stored_daily_summary"), ("quality_summary", "stored_quality_summary"), ("site_comparison", "stored_site_comparison")):
    SQL[_name] = SQL[_view]
put("offer_keyword_hits", """select row_id, array_to_string(list_filter([a, b, c, d], lambda x: regexp_matches(lower(x), 'offer|discount|save|deal'))[1:3], '|') as by_keyword,
  array_to_string(list_filter([a, b, c, d], lambda x: length(x) > 10)[1:3], '|') as by_length from offer_texts""", "offer_texts")
put("check_data_quality", f"""select case when low / n <= 0.3 then 'PASS' else 'FAIL' end as status, n as total_records, n - low as high_quality_records, low as low_quality_records, {r4('low / n')} as low_quality_rate,
    o as avg_overall_score, c as avg_completeness_score, a as avg_accuracy_score, s as avg_consistency_score from (select count(*) as n, count(*) filter (overall_score < 0.7) as low,
    {r4(mean('overall_score', 12))} as o, {r4(mean('completeness_score', 12))} as c, {r4(mean('accuracy_score', 12))} as a, {r4(mean('consistency_score', 12))} as s from scores) q""", "scores")
put("check_completeness", f"""select tbl as "table", {r4('rate')} as avg_completeness, n as records_checked, case when rate >= 0.8 then 'PASS' else 'FAIL' end as status from completeness""", "completeness")
put("check_freshness", f"""select tbl as "table", {r4('recent / n')} as freshness_rate, recent as recent_records, n as total_checked, case when recent / n > 0.5 then 'PASS' else 'STALE' end as status from fresh""", "fresh")
put("check_duplicate_rate", f"""select tbl as "table", n as records, d as duplicates, {r4('d / n')} as duplicate_rate, case when d / n > 0.1 then 'FAIL' else 'PASS' end as status, d / n <= 0.05 as within_target
  from (select tbl, count(*) as n, count(*) - count(distinct sig) as d from signed group by tbl) s""", "signed")
put("check_site_coverage", """select tbl as "table", count(*) as records, concat_ws(',', case when not bool_or(site = 'amazon') then 'amazon' end, case when not bool_or(site = 'flipkart') then 'flipkart' end,
    case when not bool_or(site = 'myntra') then 'myntra' end) as missing_sites, case when count(distinct site) < 3 then 'PARTIAL' else 'PASS' end as status
  from (select 'products' as tbl, site from products union all select 'reviews', site from reviews union all select 'pricing', site from pricing_gap) t group by tbl""", "products", "reviews", "pricing_gap")
put("missing_sites", "select s.site from (values ('amazon'), ('flipkart'), ('myntra')) s(site) where s.site not in (select site from pricing_gap)", "pricing_gap")
put("check_processing_health", f"""select case when failed / (done + failed) > 0.2 then 'FAIL' else 'PASS' end as status, {r4('done / (done + failed)')} as job_success_rate, active as active_jobs, queued as queue_size from health""", "health")
put("job_status_counts", "select site, status, count(*) as jobs from jobs group by 1, 2", "jobs")
put("health_metrics", f"""select {r4("avg(case status when 'PASS' then 1.0 when 'FAIL' then 0.5 when 'STALE' then 0.5 when 'PARTIAL' then 0.5 else 0 end)")} as overall_health_score, count(*) as checks,
  (select {r4(mean('overall_score', 12))} from scores) as avg_quality_score from checks""", "checks")
put("quality_alerts", "select * from raised", "raised")
put("overall_status", """select case when count(*) = 0 then 'PASS' when count(*) filter (severity = 'HIGH') > 0 then 'ALERT' else 'WARNING' end as overall_status, count(*) as alerts from raised""", "raised")
put("quality_report_rows", f"""select "check" as check_type, status, cast({r4('measure')} as varchar) as details from checks
  union all select concat('ALERT_', type), severity, message from raised""", "raised")

# --- metrics and alerts ---

_LABELLED = "concat(name, '{site=', site_label, '}')"
_COUNTERS = f"select {_LABELLED} as key, {r4(plain_sum('value'))} as value from metrics where type = 'counter' group by 1"
_GAUGES = f"select {_LABELLED} as key, {r4('arg_max(value, (ts, seq))')} as value from metrics where type = 'gauge' group by 1"
_P95 = "case when n > 20 then vs[cast(floor(n * 0.95) as int) + 1] else hi end"
put("metric_counters", _COUNTERS, "metrics")
put("metric_gauges", _GAUGES, "metrics")
put("metric_timer_stats", f"select {_LABELLED} as key, n as count, {r4('a')} as avg, {r4('lo')} as min, {r4('hi')} as max, {r4(_P95)} as p95 from timers", "timers")
put("metrics_summary", f"""select 'counter' as kind, key, 'value' as stat, value from ({_COUNTERS}) c union all select 'gauge', key, 'value', value from ({_GAUGES}) g
  union all select 'timer', {_LABELLED}, stat, {r4('v')} from timers cross join lateral (values ('count', cast(n as double)), ('avg', a), ('min', lo), ('max', hi), ('p95', {_P95})) s(stat, v)""", "timers")
put("quality_gauges", f"""select 'data_quality_score' as name, {r4(mean('overall_score', 12))} as value from scores
  union all select 'validation_failure_rate', {r4('count(*) filter (overall_score < 0.7) / count(*) * 100')} from scores""", "scores")
put("alerts_active", f"""select rule_name, metric, {r4('v')} as current_value, threshold, severity, message, has_data from (select r.*, coalesce(g.value, 0) as v, g.value is not null as has_data
  from rules r left join gauges g on r.metric = g.key) a where case operator when '>' then v > threshold when '<' then v < threshold else v <> threshold end""", "rules", "gauges")
_EPISODE = f"select rule_name, metric, severity, {r4('current_value')} as current_value, started_at, started_seq, resolved_at from episodes"
put("alert_history", _EPISODE, "episodes")
put("recent_alerts", _EPISODE + " order by episodes.started_at desc, episodes.started_seq desc, rule_name limit 100", "episodes")
put("alert_summary", "select cast(started_at as date) as day, severity, count(*) as alerts, count(resolved_at) as resolved from episodes group by 1, 2", "episodes")

# --- reports ---

_DAY = "date '2024-01-20'"


def _figures(section: str, source: str, **figures: str) -> str:
    return " union all ".join(f"select '{section}' as section, '{m}' as metric, cast({x} as double) as value from {source}" for m, x in figures.items())


_SUCCESS = "count(*) filter (status = 'completed') / nullif(count(*) filter (status in ('completed', 'failed')), 0) * 100"
_OPEN = "started_at < timestamp '2024-01-21' and (resolved_at is null or resolved_at >= timestamp '2024-01-21')"
EXTRA["day_latency"] = (["metrics"], f"""select count(*) as n, {mean('value')} as a, max(value) as hi, list_sort(list(value)) as vs from (select * from metrics where type = 'timer' and name = 'request_latency' and cast(ts as date) = {_DAY} order by ts desc, seq desc limit 100) t""")
EXTRA["daily"] = (["products", "reviews", "pricing_2024", "jobs_2024", "scores", "day_latency", "episodes"], " union all ".join([
    _figures("Scraping", f"products where cast(scraped_at as date) = {_DAY}", total_products_scraped="count(*)", sites_scraped="count(distinct site)", categories_covered="count(distinct category)"),
    _figures("Scraping", f"reviews where cast(scraped_at as date) = {_DAY}", total_reviews_scraped="count(*)"),
    _figures("Scraping", f"pricing_2024 where cast(scraped_at as date) = {_DAY}", total_pricing_updates="count(*)"),
    _figures("Scraping", f"jobs_2024 where cast(created_at as date) = {_DAY}", jobs_completed="count(*) filter (status = 'completed')", jobs_failed="count(*) filter (status = 'failed')", success_rate_percentage=_SUCCESS),
    _figures("Quality", f"scores where cast(evaluated_at as date) = {_DAY}", avg_quality_score=mean("overall_score", 12), validation_failure_rate="count(*) filter (overall_score < 0.7) / count(*) * 100", high_quality_records="count(*) filter (overall_score >= 0.8)",
             medium_quality_records="count(*) filter (overall_score >= 0.5 and overall_score < 0.8)", low_quality_records="count(*) filter (overall_score < 0.5)"),
    _figures("Quality", f"(select count(*) as n, count(distinct concat_ws('|', site, {strip('lower(name)')}, url)) as u from products where cast(scraped_at as date) = {_DAY}) d", duplicate_rate_percentage="(n - u) / n * 100"),
    _figures("Performance", "day_latency", avg_request_latency_seconds="coalesce(a, 0)", p95_request_latency=f"coalesce({_P95}, 0)", total_requests="n",
             avg_processing_time_seconds="0", memory_usage_mb="0", cpu_usage_percentage="0"),
    _figures("Costs", "(select (select count(*) from pricing_2024 where date_trunc('month', price_date) = date '2024-01-01') as p, (select count(*) from jobs_2024 where date_trunc('month', created_at) = date '2024-01-01') as j) c",
             daily_storage_cost="p * 0.25e0 / 30", daily_query_cost="p * 0.5e0 / 30", daily_compute_cost="j * 1.5e0 / 30", daily_total_cost="(p * 0.25e0 + p * 0.5e0 + j * 1.5e0) / 30"),
    _figures("Alerts", "episodes", active_alerts_count=f"count(*) filter ({_OPEN})", total_alerts_today=f"count(*) filter (cast(started_at as date) = {_DAY})",
             high_severity_alerts=f"count(*) filter (cast(started_at as date) = {_DAY} and severity = 'HIGH')", medium_severity_alerts=f"count(*) filter (cast(started_at as date) = {_DAY} and severity = 'MEDIUM')",
             resolved_alerts=f"count(*) filter (cast(started_at as date) = {_DAY} and resolved_at is not null)"),
]))
put("daily_report", f"select section, metric, {r4('value')} as value from daily", "daily")
put("report_csv_rows", f"select metric, {r4('value')} as value, section as category from daily", "daily")
_TABLES = (("products", "products", "scraped_at"), ("reviews", "reviews", "scraped_at"), ("pricing", "pricing_2024", "price_date"))
_WEEK = f"{{c}} >= {{end}} - interval 7 day and {{c}} < {{end}}"
_BEFORE = f"{{c}} >= {{end}} - interval 14 day and {{c}} < {{end}} - interval 7 day"


def _during(phrase: str, c: str, end: str = NOW) -> str:
    return phrase.format(c=c, end=end)


put("weekly_summary", "select metric, " + r4("value") + " as value from (" + " union all ".join(
    [_figures("", f"{src} where {_during(_WEEK, c)}", **{f"total_{t}": "count(*)"}) for t, src, c in _TABLES]
    + [_figures("", f"scores where {_during(_WEEK, 'evaluated_at')}", avg_quality_score=mean("overall_score", 12)),
       _figures("", f"jobs_2024 where {_during(_WEEK, 'created_at')}", uptime_percentage=_SUCCESS)]
) + ") f", "products", "reviews", "pricing_2024", "jobs_2024", "scores")
put("weekly_growth", " union all ".join(
    f"""select '{t}' as "table", cur as current_rows, prev as previous_rows, {r4('(cur - prev) / nullif(prev, 0) * 100')} as growth_percentage
    from (select count(*) filter ({_during(_WEEK, c)}) as cur, count(*) filter ({_during(_BEFORE, c)}) as prev from {src}) {t}_w""" for t, src, c in _TABLES
), "products", "reviews", "pricing_2024")


def _compared(metric: str, source: str, figure: str, c: str, end: str = NOW) -> str:
    return (f"select '{metric}' as metric, (select cast({figure} as double) from {source} and {_during(_WEEK, c, end)}) as cur, "
            f"(select cast({figure} as double) from {source} and {_during(_BEFORE, c, end)}) as prev")


put("weekly_trends", f"""select metric, {r4('cur')} as current_value, {r4('prev')} as previous_value, case when (cur - prev) / nullif(prev, 0) * 100 > 1 then case when metric like '%quality' then 'improving' else 'increasing' end
    when (cur - prev) / nullif(prev, 0) * 100 < -1 then 'decreasing' else 'stable' end as trend from (""" + " union all ".join([
    _compared("scraping_volume", "pricing_2024 where true", "count(*)", "price_date"),
    *[_compared(f"{p}_quality", "scores where true", mean(f"{p}_score", 12), "evaluated_at") for p in ("overall", "completeness", "accuracy", "consistency")],
    _compared("latency", "metrics where type = 'timer'", mean("value"), "ts", METRICS_NOW),
    _compared("error_rate", "jobs_2024 where status in ('completed', 'failed')", "count(*) filter (status = 'failed') / nullif(count(*), 0) * 100", "created_at"),
]) + ") c", "pricing_2024", "scores", "metrics", "jobs_2024")
put("top_performing_sites", f"""select site, total_products, {r4('success')} as success_rate, {r4('quality')} as avg_quality_score, rank() over (order by success desc, quality desc, total_products desc, site) as rank
  from (select site, count(distinct product_id) as total_products, {mean('overall_score', 12)} as quality from ({product_scores(NOW)}) s group by site) q join (select site, {_SUCCESS} as success from jobs group by site) j using (site)""", "products", "jobs")
put("recommendations", """select 'Consider implementing additional data validation rules' as recommendation where coalesce((select value from gauges where key = 'data_quality_score'), 0) < 0.8
  union all select 'Monitor memory usage - consider optimizing batch sizes' where coalesce((select value from gauges where key = 'memory_usage_percentage'), 0) > 80""", "gauges")
put("cost_report", f"""select month, n * 0.25e0 as storage_cost, n * 0.5e0 as query_cost, j * 1.5e0 as compute_cost, n * 0.25e0 + n * 0.5e0 + j * 1.5e0 as total_cost, 1515e0 - (n * 0.25e0 + n * 0.5e0 + j * 1.5e0) as remaining_budget,
  {r4('(n * 0.25e0 + n * 0.5e0 + j * 1.5e0) / 1515e0 * 100')} as utilization_percentage from (select month, cast(sum(n) as double) as n, cast(sum(j) as double) as j from (
  select cast(date_trunc('month', price_date) as date) as month, 1 as n, 0 as j from pricing union all select cast(date_trunc('month', created_at) as date), 0, 1 from jobs) u group by month) m""", "pricing", "jobs")
put("dashboard_rows", f"""select section, metric, {r4('value')} as value from (
  select 'current_metrics' as section, name as metric, {plain_sum("value")} as value from metrics where type = 'counter' group by name
  union all select 'current_metrics', key, value from gauges union all select 'performance_indicators', concat('avg_', name), a from plain_timers
  union all {_figures('job_status', 'jobs_2024', running_jobs="count(*) filter (status = 'running')", queued_jobs="count(*) filter (status = 'pending')",
                      completed_today=f"count(*) filter (status = 'completed' and cast(created_at as date) = {_DAY})", failed_today=f"count(*) filter (status = 'failed' and cast(created_at as date) = {_DAY})")}
  union all {_figures('quality_indicators', 'scores', data_quality_score=mean('overall_score', 12), validation_failure_rate='count(*) filter (overall_score < 0.7) / count(*) * 100')}
  union all {_figures('recent_alerts', '(select * from episodes order by started_at desc, started_seq desc, rule_name limit 10) e', recent_alerts='count(*)', recent_unresolved='count(*) filter (resolved_at is null)')}
  ) d""", "metrics", "gauges", "plain_timers", "jobs_2024", "scores", "episodes")

# --- windows, top-k, batches, duplicates ---

put("top_reviews_per_product", """select product_id, rank, review_id, rating from (select *, row_number() over (partition by product_id order by rating desc, scraped_at desc, ingest_seq) as rank from reviews) t where rank <= 20""", "reviews")
put("array_topk", """select row_id, concat_ws('|', a, case when c <> a then c end, case when d <> a and d <> c then d end, case when b not in (a, c, d) then b end) as top_five,
  concat_ws('|', a, case when c <> a then c end) as top_three from offer_texts""", "offer_texts")
put("batch_assign", """select site, batch, count(*) as rows, min(ingest_seq) as first_seq, max(ingest_seq) as last_seq
  from (select site, ingest_seq, (row_number() over (partition by site order by ingest_seq) - 1) // 100 as batch from products) t group by 1, 2""", "products")
put("dedup_across_batches", """select price_id, ingest_seq from (select *, row_number() over (partition by product_id, cast(price_date as date) order by ingest_seq, price_id, current_price) as rn from pricing where ingest_seq % 2 = 1) t
  where rn = 1 and not exists (select 1 from pricing e where e.ingest_seq % 2 = 0 and e.product_id = t.product_id and cast(e.price_date as date) = cast(t.price_date as date))""", "pricing")

# --- text, URLs, prices, dates ---

put("url_validity", f"""select product_id, u as url, {valid_url('u')} as valid from (select product_id, case ingest_seq % 9 when 0 then 'http://localhost:8080/x' when 1 then 'https://10.0.0.1' when 2 then 'https://nodots/path'
  when 3 then '' when 4 then 'https://a.example.com/with space' else url end as u from products) p""", "products")
put("spam_flags", f"select ingest_seq, {', '.join(SPAM)}, meaningful from {FLAGGED} f", "reviews")
put("issue_counts", """select record_type, issue, count(*) as rows from (select record_type, unnest(string_split(issues, '; ')) as issue from scores where issues <> '') i group by 1, 2""", "scores")
_NUMBER = r"'[0-9]+\.?[0-9]*'"
put("parse_prices", f"""select row_id, line, try_cast(regexp_extract(replace(price_text, ',', ''), {_NUMBER}) as double) as price,
  try_cast(regexp_extract(regexp_replace(price_text, '₹|,|{SPACE}', '', 'g'), {_NUMBER}) as double) as loose_price from price_texts""", "price_texts")
put("first_price", """select ingest_seq, price from (select ingest_seq, case when ingest_seq % 2 = 0 and current_price <> 0 then current_price when original_price <> 0 then original_price end as price from pricing) p where price is not null""", "pricing")
_STATED = "case ingest_seq % 3 when 0 then 0e0 when 1 then discount_percentage end"
put("discounts", f"""select ingest_seq, {r4('amount')} as amount, {r4('case when amount is not null then coalesce(nullif(stated, 0), amount / original_price * 100) else stated end')} as percentage from (
  select *, case when original_price > current_price and original_price <> 0 then original_price - current_price end as amount, {_STATED} as stated from pricing) p""", "pricing")
put("record_ids", """select 'product' as kind, ingest_seq, md5(concat(site, '_', url, '_', name)) as key from products
  union all select 'review', ingest_seq, md5(concat(product_id, '_', substring(content, 1, 100), '_', coalesce(reviewer_name, ''))) from reviews
  union all select 'price', ingest_seq, md5(concat(product_id, '_', cast(epoch(scraped_at) as bigint))) from pricing""", "products", "reviews", "pricing")
put("anonymize_reviewers", """select ingest_seq, case when length(n) > 2 then concat(substring(n, 1, 1), repeat('*', length(n) - 2), right(n, 1)) else n end as reviewer
  from (select ingest_seq, case when ingest_seq % 10 = 1 then 'Al' else reviewer_name end as n from reviews) r""", "reviews")
_CLEANED = f"""regexp_replace(regexp_replace({strip('text')}, '{SPACE}+', ' ', 'g'), '[^\\p{{L}}\\p{{N}}_\\s\\-.,!?()''"]', '', 'g')"""
put("clean_text", f"select doc_id, length(t) as length, md5(t) as digest from (select doc_id, coalesce({_CLEANED}, '') as t from documents) d")
put("normalize_urls", r"""select row_id, concat(regexp_extract(u, '^[^?#]*'), case when kept <> '' then concat('?', kept) else '' end, regexp_extract(u, '#.*$')) as url from (
  select row_id, u, array_to_string(list_filter(string_split(regexp_extract(u, '\?([^#]*)', 1), '&'), lambda p: not regexp_matches(p, '^(utm_source|utm_medium|utm_campaign|ref|tag)(=|$)')), '&') as kept from (
  select row_id, case when regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*:') then url when starts_with(url, '//') then concat('https:', url)
    when url = '' or starts_with(url, '#') or starts_with(url, '?') then concat('https://www.shop.example.com/list/page.html', url)
    else concat('https://www.shop.example.com/', array_to_string(list_reduce(list_transform(list_filter(string_split(concat(case when starts_with(path, '/') then '' else '/list/' end, path,
      case when regexp_matches(path, '(^|/)[.]{1,2}$') then '/' else '' end), '/')[2:], lambda s: s <> '.'), lambda s: [s]), lambda x, y: case when y[1] = '..' then x[:-2] else list_concat(x, y) end, cast([] as varchar[])), '/'), rest) end as u
  from (select row_id, url, regexp_extract(url, '^[^?#]*') as path, regexp_extract(url, '[?#].*$') as rest from links) l) a) b""", "links")
put("pages_by_domain", r"select regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1) as domain, count(*) as pages from pages group by 1")
put("parse_review_dates", r"""select row_id, site, case when site = 'amazon' then try_strptime(nullif(regexp_extract(date_text, 'on ([0-9]{1,2} \w+ [0-9]{4})', 1), ''), '%d %B %Y')
  else coalesce(try_strptime(nullif(regexp_extract(date_text, '[0-9]{1,2} \w+ [0-9]{4}'), ''), '%d %b %Y'), try_strptime(nullif(regexp_extract(date_text, '\w+ [0-9]{1,2}, [0-9]{4}'), ''), '%b %d, %Y'),
    case when site = 'myntra' then try_strptime(nullif(regexp_extract(date_text, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}'), ''), '%d/%m/%Y') end) end as review_date from date_texts""", "date_texts")
put("parse_ratings", """select ingest_seq, case when ingest_seq % 6 = 0 then 5e0 else rating end as by_text, case when ingest_seq % 4 = 0 then 5e0 else cast(ingest_seq % 5 + 1 as double) end as by_class from reviews""", "reviews")
put("url_keys", """select row_id, nullif(regexp_extract(url, '/dp/([A-Z0-9]{10})', 1), '') as item_code, site as brand, concat('https://img.example.com/w_500/', row_id) as image from links""", "links")
put("label_keys", "select seq, case when seq % 4 = 0 then name else concat(name, '{site=', site_label, ',type=', type, '}') end as key from metrics", "metrics")

# --- pages ---

put("html_element_counts", """select tag, count(*) as elements, count(distinct page_id) as pages from (select page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) as tag from pages) t group by 1""")
_TITLED = "case site when 'myntra' then trim(concat(coalesce(brand, ''), ' ', title)) else trim(title) end"
put("extract_products", f"""select page_id, md5(concat(site, '_', url, '_', n)) as product_id, site, n as name, case when site = 'myntra' then 'clothing' else category end as category, coalesce(brand, '') as brand, url,
    case when site = 'flipkart' then concat(case when coalesce(description, '') <> '' then concat(description, '. ') else '' end, 'Sturdy') else coalesce(description, '') end as description, category as specifications,
    case when site = 'myntra' then 'https://img.example.com/w_500/a.jpg' else 'https://img.example.com/a.jpg' end as images, in_stock from (select *, {_TITLED} as n from shop_pages) s
  union all select page_id + 2000000000, md5(concat('generic_', url, '_', n)), 'generic', n, 'electronics', '', url, null, '', '', true
    from (select *, {strip("replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&amp;', '&')")} as n from pages) g""", "shop_pages")
put("extract_reviews", f"""select page_id, 0 as position, md5(concat(pid, '_', substring(body, 1, 100), '_', reviewer)) as review_id, pid as product_id, site, md5(body) as content_digest, cast(stars as double) as rating,
    case when length(reviewer) > 2 then concat(substring(reviewer, 1, 1), repeat('*', length(reviewer) - 2), right(reviewer, 1)) else reviewer end as reviewer_name,
    site = 'myntra' or verified_purchase as verified_purchase, make_timestamp(2024, 1, cast(day as bigint), 0, 0, 0) as review_date
  from (select *, case when site = 'amazon' then upper(substring(md5(product_id), 1, 10)) else md5(concat(site, '_', url, '_Item')) end as pid, {strip('content')} as body from review_pages) r where body <> ''""", "review_pages")
put("linked_reviews", f"""select md5(concat(p.site, '_', p.url, '_', p.n)) as product_id, p.n as name, count(*) as reviews, sum(cast(stars as double)) as rating_sum
  from (select * from review_pages where site = 'amazon' and {strip('content')} <> '') r
  join (select min(product_id) as own, site, url, min(n) as n from (select s.*, {_TITLED} as n, (select min(q.product_id) from products q where q.ingest_seq = s.page_id) as product_id from shop_pages s where site = 'amazon') t group by site, url) p
    on p.url = concat('https://www.amazon.in/dp/', upper(substring(md5(r.product_id), 1, 10))) group by 1, 2
  union all select upper(substring(md5(product_id), 1, 10)), null, count(*), sum(cast(stars as double)) from review_pages where site = 'amazon' and {strip('content')} <> ''
    and concat('https://www.amazon.in/dp/', upper(substring(md5(product_id), 1, 10))) not in (select url from shop_pages) group by 1""", "review_pages", "shop_pages")
put("shop_listings", """select page_id, 0 as position, site, concat(case site when 'amazon' then 'https://www.amazon.in/dp/' when 'flipkart' then 'https://www.flipkart.com/p/' else 'https://www.myntra.com/buy/' end, code) as url,
  case when site = 'myntra' then trim(concat(coalesce(brand, ''), ' ', title)) else trim(title) end as name, cast(concat('1', price_value) as double) as price, cast(stars as double) as rating,
  concat('https://img.example.com/', code, '.jpg') as image from listing_pages""", "listing_pages")
put("extract_pricing", f"""select page_id, md5(concat(pid, '_', cast(epoch(fetched_at) as bigint))) as price_id, pid as product_id, site, cur as current_price, mrp as original_price,
    {r4("case when site = 'flipkart' then 10 when mrp > cur then (mrp - cur) / mrp * 100 when site = 'myntra' then 0 end")} as discount_percentage, {r4('case when mrp > cur then mrp - cur end')} as discount_amount,
    case site when 'amazon' then 'Bank offer' when 'flipkart' then 'Bank offer 10% off' else 'Flat 100 off on first order' end as offers, fetched_at as price_date
  from (select *, md5(concat(site, '_', url, '_', {_TITLED})) as pid, cast(concat('1', price_value) as double) as cur, cast(concat('1', mrp_value, '.50') as double) as mrp from shop_pages) s""", "shop_pages")
put("extract_listings", f"""select page_id, cast(i - 1 as int) as position, concat(regexp_extract(url, '^[A-Za-z]+://[^/?#]*'), regexp_extract(li, '<a href="([^"]*)"', 1)) as url,
    {strip("replace(regexp_extract(li, '>([^<]*)</a>', 1), '&amp;', '&')")} as name
  from (select page_id, url, unnest(items) as li, generate_subscripts(items, 1) as i from (select page_id, url, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a>') as items from pages) p) l""")

# --- streams and activity ---

EXTRA["gaps"] = (["fetch_log"], "select *, lag(ts) over (partition by user_id order by ts, seq) as before from fetch_log")
put("stale_gaps", f"""select user_id, before as gap_start, ts as gap_end from gaps where ts - before > interval 24 hour
  union all select user_id, max(ts), null from fetch_log group by user_id having {METRICS_NOW} - max(ts) > interval 24 hour""", "gaps")
put("politeness_audit", """select domain, count(*) as requests, count(*) filter (gap < 2000000) as too_soon, min(gap) / 1000000 as smallest_gap
  from (select domain, epoch_us(ts) - epoch_us(lag(ts) over (partition by domain order by ts, seq)) as gap from fetch_log) g group by domain""", "fetch_log")
put("stream_ingest", f"""select price_id, product_id, {r4('current_price')} as current_price, ingest_seq from (select *, row_number() over (partition by price_id order by ingest_seq desc, product_id desc, current_price desc) as v
  from ({_counts('pricing')[0]}) s where overall_score >= {GATE['pricing']}) w where v = 1""", "pricing")
put("stream_dedup", "select user_id, ts, seq from (select *, row_number() over (partition by user_id order by ts, seq) as rn from fetch_log) f where rn = 1", "fetch_log")
put("stream_metric_windows", f"""select * from (select date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval 1 hour as window_end, name, count(*) as samples,
    {r4(plain_sum("value", "type = 'counter'"))} as counter_sum, {r4("arg_max(value, (ts, seq)) filter (type = 'gauge')")} as gauge_last,
    {r4("min(value) filter (type = 'timer')")} as timer_min, {r4("max(value) filter (type = 'timer')")} as timer_max from metrics group by 1, 2, 3) w
  where window_end <= (select date_trunc('millisecond', max(ts)) from metrics) - interval 1 hour""", "metrics")
put("stream_silence_alerts", """select user_id, min(ts) as first_seen, max(ts) as last_seen, count(*) as rows, max(ts) + interval 24 hour as alert_at
  from (select user_id, ts, sum(case when before is null or ts - before > interval 24 hour then 1 else 0 end) over (partition by user_id order by ts, seq) as spell from gaps) s
  group by user_id, spell having max(ts) + interval 24 hour < (select date_trunc('millisecond', max(ts)) from fetch_log) - interval 1 hour""", "gaps")
put("stream_ingest_counts", f"""select 'pricing' as entity, (select count(*) from pricing) as rows, count(*) filter (overall_score >= {GATE['pricing']}) as processed,
    (select count(*) from pricing) - count(*) as duplicates, count(*) filter (not coalesce(overall_score >= {GATE['pricing']}, false)) as failures from ({_counts('pricing')[0]}) s""", "pricing")
put("stream_stale_users", """select user_id, min(ts) as first_seen, max(ts) as last_seen, count(*) as rows from (select user_id, ts, sum(case when before is null or ts - before >= interval 24 hour then 1 else 0 end)
    over (partition by user_id order by ts, seq) as spell from gaps) s group by user_id, spell having max(ts) + interval 24 hour <= (select date_trunc('millisecond', max(ts)) from fetch_log) - interval 1 hour""", "gaps")
put("stream_timer_windows", f"""select window_start, window_start + interval 1 hour as window_end, name, count(*) as count, {r4(mean('value'))} as avg, {r4('min(value)')} as min, {r4('max(value)')} as max,
    {r4("case when count(*) > 20 then list_sort(list(value))[1 + cast(floor(count(*) * 0.95e0) as int)] else max(value) end")} as p95
  from (select *, date_trunc('hour', ts) as window_start, row_number() over (partition by date_trunc('hour', ts), name order by ts desc, seq desc) as rn from metrics where type = 'timer') t
  where rn <= 100 and window_start + interval 1 hour <= (select date_trunc('millisecond', max(ts)) from metrics where type = 'timer') - interval 1 hour group by 1, 3""", "metrics")
