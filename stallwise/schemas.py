"""Entity schemas and the fixed values every job shares."""

from __future__ import annotations

from pyspark.sql import types as T

# Timestamps are zone-free wall-clock UTC throughout; streams cast to TimestampType where they need a watermark.
_S, _D, _L, _B, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampNTZType()
_TEXTS = T.ArrayType(_S)


def _schema(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


PRODUCTS = _schema(
    ("product_id", _S, False), ("site", _S, False), ("name", _S, False), ("category", _S, False), ("brand", _S),
    ("url", _S, False), ("description", _S), ("specifications", T.MapType(_S, _S)), ("images", _TEXTS),
    ("in_stock", _B), ("stock_quantity", _L), ("scraped_at", _TS), ("last_updated", _TS),
)
REVIEWS = _schema(
    ("review_id", _S, False), ("product_id", _S, False), ("site", _S, False), ("title", _S), ("content", _S, False),
    ("rating", _D, False), ("reviewer_name", _S), ("verified_purchase", _B), ("review_date", _TS), ("scraped_at", _TS),
)
PRICING = _schema(
    ("price_id", _S, False), ("product_id", _S, False), ("site", _S, False), ("current_price", _D, False),
    ("original_price", _D), ("currency", _S), ("discount_percentage", _D), ("discount_amount", _D), ("offers", _TEXTS),
    ("deal_type", _S), ("price_date", _TS), ("scraped_at", _TS),
)
QUALITY_SCORES = _schema(
    ("record_id", _S, False), ("record_type", _S, False), ("completeness_score", _D, False),
    ("accuracy_score", _D, False), ("consistency_score", _D, False), ("overall_score", _D, False),
    ("issues", _TEXTS), ("evaluated_at", _TS),
)
JOBS = _schema(
    ("job_id", _S, False), ("site", _S, False), ("job_type", _S, False), ("category", _S), ("search_terms", _TEXTS),
    ("max_pages", _L), ("status", _S), ("started_at", _TS), ("completed_at", _TS), ("products_scraped", _L),
    ("reviews_scraped", _L), ("errors", _TEXTS), ("created_at", _TS),
)
METRICS = _schema(("ts", _TS), ("name", _S), ("value", _D), ("type", _S), ("labels", T.MapType(_S, _S)))

# Primary key and partition day of each table.
PRIMARY_KEY = {
    "products": "product_id", "reviews": "review_id", "pricing": "price_id",
    "jobs": "job_id", "quality_scores": "record_id",
}
DAY_COLUMN = {
    "products": "scraped_at", "reviews": "scraped_at", "pricing": "price_date",
    "jobs": "created_at", "quality_scores": "evaluated_at",
}
CLUSTER_COLUMNS = {
    "products": ["site", "category"], "reviews": ["site", "product_id"], "pricing": ["site", "product_id"],
    "jobs": ["site", "status"], "quality_scores": ["record_type"],
}

# Sites, categories and their domains and product-page paths.
SITES = ["amazon", "flipkart", "myntra"]
CATEGORIES = ["electronics", "clothing", "home-kitchen", "books", "sports"]
SITE_DOMAINS = {"amazon": "amazon.in", "flipkart": "flipkart.com", "myntra": "myntra.com"}
SITE_BASE_URLS = {
    "amazon": "https://www.amazon.in", "flipkart": "https://www.flipkart.com", "myntra": "https://www.myntra.com",
}
PRODUCT_URL_PATHS = {
    "amazon": ["/dp/", "/gp/product/"], "flipkart": ["/p/", "/product/"], "myntra": ["/buy", "/product/"],
}
# Search terms per category.
SEARCH_TERMS = {
    "electronics": ["smartphone", "laptop", "headphones", "tablet", "camera"],
    "clothing": ["shirt", "jeans", "dress", "shoes", "jacket"],
    "home-kitchen": ["cookware", "bedding", "furniture", "appliances", "decor"],
    "books": ["fiction", "textbook", "biography", "thriller", "romance"],
    "sports": ["fitness", "cricket", "football", "running", "gym"],
}
# Quality limits and thresholds.
NAME_LENGTH = (3, 500)
CONTENT_LENGTH = (10, 5000)
PRICE_RANGE = (0.01, 1_000_000.0)
MIN_COMPLETENESS = 0.95
GATE = {"products": MIN_COMPLETENESS * 0.8, "reviews": MIN_COMPLETENESS * 0.7, "pricing": MIN_COMPLETENESS * 0.8}
MIN_OVERALL_SCORE = 0.7
MIN_TABLE_COMPLETENESS = 0.8
LOW_QUALITY_RATE_LIMIT = 0.3
DUPLICATE_RATE_LIMIT = 0.1
DUPLICATE_RATE_TARGET = 0.05
JOB_FAILURE_LIMIT = 0.2
STALE_HOURS = 24
MAX_REQUESTS_PER_SECOND = 0.5
# Default alert rules (rule_name, metric, threshold, operator, severity, message).
ALERT_RULES = [
    ("high_error_rate", "error_rate", 10.0, ">", "HIGH", "Error rate is above threshold"),
    ("low_success_rate", "scraping_success_rate", 90.0, "<", "MEDIUM", "Scraping success rate is low"),
    ("high_memory_usage", "memory_usage_percentage", 80.0, ">", "MEDIUM", "Memory usage is high"),
    ("low_data_quality", "data_quality_score", 0.7, "<", "HIGH", "Data quality score is below threshold"),
]
