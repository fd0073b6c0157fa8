"""Which products to visit next, URL and keyword filters, batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.operators import ordered


def product_urls(df: DataFrame, site: str = "site", url: str = "url") -> DataFrame:
    """Rows whose URL is a product page of their site. The patterns are fixed, so this is a plain row filter."""
    def matches(name: str) -> Column:
        paths = [F.col(url).contains(p) for p in schemas.PRODUCT_URL_PATHS[name]]
        return (F.lower(site) == name) & reduce(lambda a, b: a | b, paths)

    return df.filter(reduce(lambda a, b: a | b, [matches(s) for s in schemas.PRODUCT_URL_PATHS]))


def term_coverage(
    products: DataFrame, terms: dict[str, list[str]], first_terms: int | None = 2, first_categories: int | None = None
) -> DataFrame:
    """Products per (site, category, term) whose name contains the term; combinations without any stay with 0.

    One pass over the products: each row is exploded over the few terms of its own category that it contains, and
    the counts are joined to the fixed list of combinations.
    """
    chosen = {c: t[:first_terms] for c, t in list(terms.items())[:first_categories]}
    pairs = F.create_map(*[v for c, t in chosen.items() for v in (F.lit(c), F.array(*[F.lit(x) for x in t]))])
    name = F.lower("name")
    hits = F.filter(F.try_element_at(pairs, F.col("category")), lambda t: name.contains(t))
    found = (
        products.select("site", "category", F.explode(hits).alias("term"))
        .groupBy("site", "category", "term").agg(F.count("*").alias("products"))
    )
    rows = [(s, c, t) for s in schemas.SITES for c, ts in chosen.items() for t in ts]
    frontier = products.sparkSession.createDataFrame(rows, "site string, category string, term string")
    return frontier.join(found, ["site", "category", "term"], "left").fillna(0, ["products"])


def stale_prices(products: DataFrame, pricing: DataFrame, as_of: Column, hours: int = 6) -> DataFrame:
    """Products without a price newer than `hours` before `as_of`."""
    latest = pricing.groupBy("product_id").agg(F.max("price_date").alias("latest_price"))
    cutoff = as_of - F.make_dt_interval(hours=F.lit(hours))
    return (
        products.select("product_id", "site").join(latest, "product_id", "left")
        .filter(F.col("latest_price").isNull() | (F.col("latest_price") < cutoff))
    )


def few_reviews(products: DataFrame, reviews: DataFrame, wanted: int = 3) -> DataFrame:
    counts = reviews.groupBy("product_id").agg(F.count("*").alias("reviews"))
    return (
        products.select("product_id", "site").join(counts, "product_id", "left").fillna(0, ["reviews"])
        .filter(F.col("reviews") < wanted)
    )


def assign_batches(df: DataFrame, key: str, at: str = "ingest_seq", size: int = 100, partitions: int | None = None) -> DataFrame:
    """Number each key's rows in groups of `size` along `at`."""
    numbered = ordered.row_numbers(df, [key], [at], "_position", partitions)
    return numbered.withColumn("batch", F.floor((F.col("_position") - 1) / size)).drop("_position")
