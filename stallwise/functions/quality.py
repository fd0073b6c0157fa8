"""Quality scores and constraints of products, reviews and prices as Column expressions.

Every rule is a `Rule`: the points a row earns, and the issue text it gets when it fails. A score is the mean of its
rules' points; the issues are the failed rules' texts in rule order. "Missing" is NULL or '' for texts and an empty
array or map; a blank text is present but earns no point.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.functions import text


class Rule(NamedTuple):
    points: Column
    issue: Column | None = None


def _points(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def _failed(condition: Column, message: str, value: Column | None = None) -> Column:
    shown = F.lit(message) if value is None else F.concat(F.lit(message + ": "), value.cast("string"))
    return F.when(~F.coalesce(condition, F.lit(False)), shown)


def _checked(condition: Column, message: str, value: Column | None = None) -> Rule:
    return Rule(_points(condition), _failed(condition, message, value))


def _checked_if_present(present: Column, condition: Column, message: str, value: Column | None = None) -> Rule:
    """Half a point when the value is missing, which is no issue."""
    return Rule(
        F.when(~present, 0.5).otherwise(_points(condition)), F.when(present, _failed(condition, message, value))
    )


def _required(name: str, held: Column) -> Rule:
    return _checked(held, f"Missing required field: {name}")


def _has_text(name: str) -> Column:
    return F.coalesce(F.col(name) != "", F.lit(False))


def _has_entries(name: str) -> Column:
    return F.coalesce(F.size(name) > 0, F.lit(False))


def _not_later(name: str, as_of: Column, message: str) -> Rule:
    return _checked(F.col(name) <= as_of, message)


def product_rules(as_of: Column) -> dict[str, list[Rule]]:
    name, brand, url = F.col("name"), F.col("brand"), F.col("url")
    images = F.coalesce(F.col("images"), F.array().cast("array<string>"))
    n_images = F.size(images)
    n_valid = F.size(F.filter(images, text.is_valid_url))
    domains = F.create_map(*[F.lit(v) for pair in schemas.SITE_DOMAINS.items() for v in pair])
    has_brand, has_description = _has_text("brand"), _has_text("description")
    name_length = F.length(name)
    return {
        "completeness": [_required(c, _has_text(c)) for c in ("product_id", "name", "site", "category", "url")]
        + [Rule(_points(text.not_blank(F.col(c)))) for c in ("brand", "description")]
        + [Rule(_points(_has_entries(c))) for c in ("images", "specifications")],
        "accuracy": [
            _checked(name_length.between(*schemas.NAME_LENGTH), "Invalid name length", name_length),
            _checked(text.is_valid_url(url), "Invalid URL format"),
            Rule(F.when(~has_brand, 0.5).otherwise(_points(text.not_blank(brand)))),
            Rule(
                F.when(~has_description, 0.5).otherwise(_points(F.length(text.strip(F.col("description"))) >= 10))
            ),
            Rule(
                F.when(n_images == 0, 0.5).otherwise(n_valid / n_images),
                F.when(n_valid < n_images, F.concat(F.lit("Invalid image URLs: "), (n_images - n_valid).cast("string"))),
            ),
        ],
        "consistency": [
            Rule(
                _points(url.contains(F.try_element_at(domains, F.col("site")))),
                F.when(
                    ~F.coalesce(url.contains(F.try_element_at(domains, F.col("site"))), F.lit(False)),
                    F.concat(F.lit("URL domain doesn't match site: "), F.col("site")),
                ),
            ),
            _checked_if_present(has_brand, F.lower(name).contains(F.lower(brand)), "Brand not found in product name"),
            _not_later("scraped_at", as_of, "Invalid scraped timestamp"),
        ],
    }


def review_rules(as_of: Column) -> dict[str, list[Rule]]:
    content, rating, reviewer = F.col("content"), F.col("rating"), F.col("reviewer_name")
    length = F.length(content)
    return {
        "completeness": [_required(c, _has_text(c)) for c in ("review_id", "product_id", "site", "content")]
        + [_required("rating", F.coalesce(rating != 0, F.lit(False)))]
        + [Rule(_points(_has_text(c))) for c in ("title", "reviewer_name")]
        + [Rule(_points(F.col("review_date").isNotNull()))],
        "accuracy": [
            _checked(length.between(*schemas.CONTENT_LENGTH), "Invalid content length", length),
            _checked(rating.between(1.0, 5.0), "Invalid rating", rating),
            _checked(F.col("meaningful"), "Low quality or spam content detected"),
            Rule(F.when(~_has_text("reviewer_name"), 0.5).otherwise(_points(text.not_blank(reviewer)))),
        ],
        "consistency": [
            _not_later("scraped_at", as_of, "Invalid scraped timestamp"),
            _checked_if_present(
                F.col("review_date").isNotNull(), F.col("review_date") <= as_of, "Invalid review date"
            ),
        ],
    }


def pricing_rules(as_of: Column) -> dict[str, list[Rule]]:
    current, original, percent = F.col("current_price"), F.col("original_price"), F.col("discount_percentage")
    return {
        "completeness": [
            _required(c, F.col(c).isNotNull()) for c in ("price_id", "product_id", "site", "current_price")
        ]
        + [Rule(_points(F.col(c).isNotNull())) for c in ("original_price", "discount_percentage")]
        + [Rule(_points(_has_entries("offers")))],
        "accuracy": [
            _checked(current.between(*schemas.PRICE_RANGE), "Invalid current price", current),
            _checked_if_present(
                original.isNotNull(), original.between(*schemas.PRICE_RANGE), "Invalid original price", original
            ),
            _checked_if_present(percent.isNotNull(), percent.between(0, 100), "Invalid discount percentage", percent),
        ],
        "consistency": [
            _checked_if_present(
                original.isNotNull(), original >= current, "Original price less than current price"
            ),
            _not_later("scraped_at", as_of, "Invalid scraped timestamp"),
        ],
    }


RULES = {"products": product_rules, "reviews": review_rules, "pricing": pricing_rules}
RECORD_TYPE = {"products": "product", "reviews": "review", "pricing": "pricing"}


def with_scores(df: DataFrame, entity: str, as_of: Column) -> DataFrame:
    """Add the three part scores, their mean and the issues to each row; no shuffle, no Python."""
    columns = df.columns
    if entity == "reviews":
        df = text.with_spam_checks(df, "content")
    rules = RULES[entity](as_of)
    parts = {
        f"{part}_score": reduce(lambda a, b: a + b, [r.points for r in group]) / len(group)
        for part, group in rules.items()
    }
    issues = [r.issue for group in rules.values() for r in group if r.issue is not None]
    overall = (F.col("completeness_score") + F.col("accuracy_score") + F.col("consistency_score")) / 3
    scored = df.withColumns({**parts, "issues": F.array_compact(F.array(*issues))}).withColumn("overall_score", overall)
    return scored.select(*columns, *parts, "issues", "overall_score")


def score_rows(df: DataFrame, entity: str, as_of: Column, evaluated_at: Column | None = None) -> DataFrame:
    """Quality records of one entity's rows. `evaluated_at` is the time of the run that scored them, `as_of` if not given."""
    return with_scores(df, entity, as_of).select(
        F.col(schemas.PRIMARY_KEY[entity]).alias("record_id"),
        F.lit(RECORD_TYPE[entity]).alias("record_type"),
        "completeness_score", "accuracy_score", "consistency_score", "overall_score", "issues",
        (as_of if evaluated_at is None else evaluated_at).alias("evaluated_at"),
    )


def _violation(broken: Column, rule: str) -> Column:
    return F.when(F.coalesce(broken, F.lit(False)), F.lit(rule))


def violations(entity: str) -> Column:
    """Names of the model constraints a row breaks, in a fixed order."""
    def blank(c: str) -> Column:
        return _violation(~text.not_blank(F.col(c)), f"{c} is blank")

    def absent(c: str) -> Column:
        return _violation(F.col(c).isNull(), f"{c} is null")

    def negative(c: str) -> Column:
        return _violation(F.col(c) < 0, f"{c} is negative")

    site = _violation(~F.coalesce(F.col("site").isin(schemas.SITES), F.lit(False)), "site is unknown")
    if entity == "products":
        checks = [
            blank("product_id"), site, blank("name"),
            _violation(~F.coalesce(F.col("category").isin(schemas.CATEGORIES), F.lit(False)), "category is unknown"),
            absent("url"),
        ]
    elif entity == "reviews":
        checks = [
            absent("review_id"), absent("product_id"), site, blank("content"), absent("rating"),
            _violation(~F.col("rating").between(1.0, 5.0), "rating is out of range"),
        ]
    else:
        checks = [
            absent("price_id"), absent("product_id"), site, absent("current_price"), negative("current_price"),
            negative("original_price"),
            _violation(~F.col("discount_percentage").between(0, 100), "discount_percentage is out of range"),
            negative("discount_amount"),
            _violation(F.col("original_price") < F.col("current_price"), "original_price is below current_price"),
        ]
    return F.array_compact(F.array(*checks))
