"""The analytic views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.operators import ordered


def summable(c: str | Column) -> Column:
    """A number with 18 decimals; NULL for NaN, infinite values and amounts of 10^20 or more."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("decimal(38,18)")


def exact_sum(c: str | Column) -> Column:
    """Sum over decimals: the same on every run, whatever the order of the tasks.

    Only where that sum itself passes 10^20 the plain sum of the same values takes its place.
    """
    return F.coalesce(F.try_sum(summable(c)).cast("double"), F.sum(summable(c).cast("double")))


def exact_avg(c: str | Column) -> Column:
    """Average of the values that can be summed; the others are in neither sum nor divisor."""
    return exact_sum(c) / F.count(summable(c))


def unsummable(c: str | Column) -> Column:
    """How many values are left out of sums."""
    c = F.col(c) if isinstance(c, str) else c
    return F.count_if(c.isNotNull() & summable(c).isNull())


def stored_by_day_of(df: DataFrame, c: str) -> bool:
    """Whether the table is written by the day of this time column, and not of another that it has too."""
    day_of = next((name for name in ("price_date", "evaluated_at", "created_at", "scraped_at") if name in df.columns), None)
    return "dt" in df.columns and day_of == c


def since(df: DataFrame, c: str, start: Column) -> Column:
    """Rows from `start` on; in a table written by day also on the day, so that only those partitions are read."""
    inside = F.col(c) >= start
    return inside & (F.col("dt") >= F.to_date(start)) if stored_by_day_of(df, c) else inside


def within(df: DataFrame, c: str, start: Column, end: Column) -> Column:
    """Rows from `start` on and before `end`, by the same rule."""
    inside = since(df, c, start) & (F.col(c) < end)
    return inside & (F.col("dt") <= F.to_date(end)) if stored_by_day_of(df, c) else inside


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def product_price_trends(
    products: DataFrame, pricing: DataFrame, as_of: Column, days: int = 30, partitions: int | None = None
) -> DataFrame:
    """Each price of the last `days` with the product's price before it and the change.

    The look back runs on the prices alone, over ranges of (product, time), before the product's columns are joined on:
    products are keyed by product_id, so a price has the same row before it on either side of the join, and the join has
    no order to keep, so adaptive execution may split a product with very many prices.
    """
    recent = pricing.filter(since(pricing, "price_date", days_before(as_of, days))).select(
        "price_id", "product_id", "current_price", "original_price", "discount_percentage", "price_date", "ingest_seq"
    )
    order = ["price_date", "ingest_seq", "price_id", "current_price"]
    trends = ordered.previous_values(recent, ["product_id"], order, {"current_price": "previous_price"}, partitions)
    return products.select("product_id", "name", "brand", "category", "site").join(trends, "product_id").select(
        "product_id", "name", "brand", "category", "site", "price_id", "current_price", "original_price",
        "discount_percentage", "price_date", "previous_price",
        (F.col("current_price") - F.col("previous_price")).alias("price_change"),
    )


def part_sums(c: str, name: str, where: Column | None = None) -> list[Column]:
    """Of one group: the exact sum, the plain one for where that overflows, and the number of values that can be summed."""
    value = summable(c) if where is None else F.when(where, summable(c))
    return [F.try_sum(value).alias(f"{name}_exact"), F.sum(value.cast("double")).alias(f"{name}_plain"), F.count(value).alias(f"{name}_n")]


def average_of_parts(name: str, weight: Column | None = None) -> Column:
    """The average over the groups of `part_sums`, each group counting `weight` times; NULL where nothing can be summed."""
    exact, plain, n = F.col(f"{name}_exact"), F.col(f"{name}_plain"), F.col(f"{name}_n")
    if weight is not None:
        # Wide enough for the product; what isn't leaves the exact sum.
        exact, plain, n = exact.try_cast("decimal(27,10)") * weight.try_cast("decimal(10,0)"), plain * weight, n * weight
    whole = F.count_if((n > 0) & exact.isNull()) == 0
    return F.coalesce(F.when(whole, F.try_sum(exact).cast("double")), F.sum(plain)) / F.nullif(F.sum(n), F.lit(0))


def product_review_summary(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review figures per product; products without reviews stay.

    Reviews are reduced to one row per product before the join, so a product with very many reviews costs no more.
    """
    rating = F.col("rating")
    per_product = reviews.groupBy("product_id").agg(
        F.count("review_id").alias("n"), *part_sums("rating", "rating"), F.count_if("verified_purchase").alias("verified"),
        F.count_if(rating >= 4.0).alias("positive"), F.count_if(rating <= 2.0).alias("negative"),
        F.max("review_date").alias("latest"),
    )
    keys = ["product_id", "name", "brand", "category", "site"]
    joined = products.select(*keys).join(per_product, "product_id", "left")

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return joined.groupBy(*keys).agg(
        total("n").alias("total_reviews"), average_of_parts("rating").alias("avg_rating"),
        total("verified").alias("verified_reviews"), total("positive").alias("positive_reviews"),
        total("negative").alias("negative_reviews"), F.max("latest").alias("latest_review_date"),
    )


def daily_scraping_summary(products: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    described = F.coalesce(F.length("description") > 10, F.lit(False))
    return (
        products.filter(since(products, "scraped_at", days_before(as_of, days)))
        .groupBy(F.to_date("scraped_at").alias("scrape_date"), "site")
        .agg(
            F.countDistinct("product_id").alias("products_scraped"),
            F.countDistinct(F.when(F.col("in_stock"), F.col("product_id"))).alias("in_stock_products"),
            (F.count("specifications") / F.count("*")).alias("spec_completeness"),
            (F.count_if(described) / F.count("*")).alias("desc_completeness"),
        )
        .orderBy(F.desc("scrape_date"), "site")
    )


def quality_summary(scores: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return (
        scores.filter(since(scores, "evaluated_at", days_before(as_of, days)))
        .groupBy("record_type", F.to_date("evaluated_at").alias("evaluation_date"))
        .agg(
            F.count("*").alias("total_records"),
            exact_avg("overall_score").alias("avg_overall_score"),
            exact_avg("completeness_score").alias("avg_completeness"),
            exact_avg("accuracy_score").alias("avg_accuracy"),
            exact_avg("consistency_score").alias("avg_consistency"),
            F.count_if(F.col("overall_score") >= 0.8).alias("high_quality_records"),
            F.count_if(F.col("overall_score") < 0.5).alias("low_quality_records"),
        )
        .orderBy(F.desc("evaluation_date"), "record_type")
    )


def _compared_products(products: DataFrame, pricing: DataFrame, reviews: DataFrame, as_of: Column, days: int):
    """Recent products with one row of price figures and one of review figures each, and their matched review ids.

    Prices and reviews are reduced to the recent products' before anything is aggregated, and of prices older than the
    look-back only the product ids are read: whether a product has any price at all.
    """
    start = days_before(as_of, days)
    recent = products.filter(since(products, "scraped_at", start)).select("product_id", "site", "category")
    keys = recent.select("product_id").distinct()
    inside = F.col("price_date").isNull() | (F.col("price_date") >= start)
    if stored_by_day_of(pricing, "price_date"):
        inside &= F.col("dt").isNull() | (F.col("dt") >= F.to_date(start))
    prices = pricing.filter(inside).join(keys, "product_id", "left_semi").groupBy("product_id").agg(
        F.count("*").alias("prices"), *part_sums("current_price", "price"), *part_sums("discount_percentage", "discount"),
    )
    priced = pricing.select("product_id").join(keys, "product_id", "left_semi").distinct().withColumn("priced", F.lit(True))
    own = reviews.join(keys, "product_id", "left_semi")
    rated = own.groupBy("product_id").agg(F.count("*").alias("reviews"), *part_sums("rating", "rating"))
    # A product whose prices are all older than the look-back drops out; one without any price stays.
    kept = (
        recent.join(prices, "product_id", "left").join(priced, "product_id", "left")
        .filter(F.col("prices").isNotNull() | F.col("priced").isNull()).join(rated, "product_id", "left")
    )
    owners = kept.select("product_id", "site", "category").distinct()
    # Pairs first, so that a product with very many copies of a review joins once per review.
    pairs = own.select("product_id", "review_id").distinct()
    ids = (
        pairs.join(owners, "product_id").groupBy("site", "category")
        .agg(F.countDistinct("review_id").alias("total_reviews"))
    )
    return kept, ids


def site_comparison(
    products: DataFrame, pricing: DataFrame, reviews: DataFrame, as_of: Column, days: int = 7, fan_out: bool = True
) -> DataFrame:
    """Sites and categories side by side.

    With `fan_out` the averages weigh each price by the product's number of reviews and each rating by its number of
    prices, as the three-way outer join of the rows does. The weights are multiplied in, so the joined rows, whose
    number is the product of both sides, never exist. Without it every price and every rating counts once.
    """
    kept, ids = _compared_products(products, pricing, reviews, as_of, days)
    one = F.lit(1)
    by_reviews = F.greatest(F.coalesce("reviews", F.lit(0)), one) if fan_out else one
    by_prices = F.greatest(F.coalesce("prices", F.lit(0)), one) if fan_out else one

    figures = kept.groupBy("site", "category").agg(
        F.countDistinct("product_id").alias("total_products"),
        average_of_parts("price", by_reviews).alias("avg_current_price"),
        average_of_parts("discount", by_reviews).alias("avg_discount"),
        average_of_parts("rating", by_prices).alias("avg_rating"),
    )
    return (
        figures.join(ids, ["site", "category"], "left").fillna(0, ["total_reviews"])
        .select(
            "site", "category", "total_products", "avg_current_price", "avg_discount", "total_reviews", "avg_rating"
        )
        .orderBy("site", "category")
    )


def register_views(spark, views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
