"""Text, URL, price, date and identifier functions. All are Column expressions that stay in generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What Unicode calls white space; the \s of Java is ASCII only.
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
# Tracking parameters, keywords and phrases, in the order in which they are looked for.
TRACKING_PARAMETERS = ["utm_source", "utm_medium", "utm_campaign", "ref", "tag"]
OFFER_KEYWORDS = ["offer", "discount", "save", "deal"]
SPAM_PHRASES = ["buy now", "click here", "visit", "website"]
# Category keywords in order of precedence; the first that occurs in the breadcrumb wins.
BREADCRUMB_CATEGORIES = [
    ("clothing", ["clothing", "fashion"]), ("home-kitchen", ["home", "kitchen"]), ("books", ["book"]),
    ("sports", ["sport"]),
]
# Fixed value: what counts as a valid URL.
URL_PATTERN = (
    r"(?i)^https?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost"
    r"|[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})(?::[0-9]+)?(?:/?|[/?]\S+)$"
)


VISIBLE = SPACE.replace("[", "[^", 1)


def strip(c: Column) -> Column:
    """From the first visible character to the last: one search from the front, one step back from the end."""
    return F.regexp_extract(c, f"(?s){VISIBLE}(?:.*{VISIBLE})?", 0)


def present(c: Column) -> Column:
    """NULL for a missing text, where missing means NULL or empty; a blank text is kept."""
    return F.nullif(c, F.lit(""))


def not_blank(c: Column) -> Column:
    """True when a text has anything but white space; one look for a visible character, no copy of the text."""
    return F.coalesce(c.rlike(VISIBLE), F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def is_valid_url(c: Column) -> Column:
    return F.coalesce(c.rlike(URL_PATTERN), F.lit(False))


def words_of_lowered(c: Column) -> Column:
    return F.array_remove(F.split(c, f"{SPACE}+"), "")


WORD_CHARACTER = r"[\p{L}\p{N}_]"
SPAM_CHECKS = ["too_short", "repetitive", "repeated_character", "spam_phrase", "long_number"]


def with_spam_checks(df: DataFrame, content: str) -> DataFrame:
    """Add the separate reasons for which a text counts as not meaningful, and `meaningful`; a NULL text is not.

    The lower-case text and its words are columns of their own, so that each is made once per row. The first number
    pattern is cheap and keeps the bounded one away from nearly all rows.
    """
    c = F.col(content)
    lowered, ws = F.col("_lowered"), F.col("_words")
    digits = rf"(?<!{WORD_CHARACTER})\p{{Nd}}{{10,}}(?!{WORD_CHARACTER})"
    checks = {
        # Ten characters from the first visible one to the last, without a stripped copy of the text.
        "too_short": ~c.rlike(f"(?s){VISIBLE}.{{8,}}?{VISIBLE}"),
        "repetitive": F.size(F.array_distinct(ws)) < F.size(ws) * F.lit(0.3),
        "repeated_character": lowered.rlike(r"([^\n])\1{10}"),
        "spam_phrase": any_of([lowered.contains(p) for p in SPAM_PHRASES]),
        "long_number": c.rlike(r"\p{Nd}{10}") & c.rlike(digits),
    }
    named = {n: F.coalesce(check, F.lit(False)) for n, check in checks.items()}
    return (
        df.withColumn("_lowered", F.lower(c)).withColumn("_words", words_of_lowered(lowered)).withColumns(named)
        .withColumn("meaningful", c.isNotNull() & ~any_of([F.col(n) for n in SPAM_CHECKS]))
        .drop("_lowered", "_words")
    )


def first_number(c: Column) -> Column:
    """The first number in a text, NULL without one."""
    return F.regexp_extract(c, r"[0-9]+\.?[0-9]*", 0).try_cast("double")


def clean_price(c: Column) -> Column:
    return first_number(F.replace(c, F.lit(","), F.lit("")))


def price_from_text(c: Column) -> Column:
    return first_number(F.regexp_replace(c, f"₹|,|{SPACE}", ""))


def first_price(*candidates: Column) -> Column:
    """The first candidate that is neither missing nor zero."""
    return F.coalesce(*[F.nullif(c, F.lit(0.0)) for c in candidates])


def stated_percent(c: Column) -> Column:
    return F.regexp_extract(c, r"([0-9]+)%", 1).try_cast("double")


def discount_amount(current: Column, original: Column) -> Column:
    return F.when((original > current) & (original != 0), original - current)


def discount_percentage(current: Column, original: Column, stated: Column) -> Column:
    computed = (original - current) / F.nullif(original, F.lit(0.0)) * 100
    return F.when((original > current) & (original != 0), F.coalesce(F.nullif(stated, F.lit(0.0)), computed)).otherwise(
        stated
    )


def _joined(*parts: Column) -> Column:
    return F.md5(F.concat_ws("_", *[F.coalesce(p, F.lit("")) for p in parts]))


def product_key(site: Column, url: Column, name: Column) -> Column:
    return _joined(site, url, name)


def review_key(product_id: Column, content: Column, reviewer: Column) -> Column:
    return _joined(product_id, F.substring(content, 1, 100), reviewer)


def price_key(product_id: Column, fetched_at: Column) -> Column:
    return _joined(product_id, F.unix_timestamp(fetched_at.cast("timestamp")).cast("string"))


def mask_name(c: Column) -> Column:
    return F.when(
        F.length(c) > 2,
        F.concat(F.left(c, F.lit(1)), F.repeat(F.lit("*"), F.length(c) - 2), F.right(c, F.lit(1))),
    ).otherwise(c)


def clean_text(c: Column) -> Column:
    collapsed = F.trim(F.regexp_replace(c, f"{SPACE}+", " "))
    return F.coalesce(F.regexp_replace(collapsed, r"""[^a-zA-Z \p{L}\p{N}_\-.,!?()'"]+""", ""), F.lit(""))


def domain(c: Column) -> Column:
    """Network location, with user and port; empty when the text has none."""
    return F.coalesce(F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1), F.lit(""))


def _without_dots(path: Column) -> Column:
    """A path, given without its leading slash, with its dot segments worked off; what climbs above the root stays there."""
    open_end = F.when(path.rlike(r"(^|/)\.{1,2}$"), F.concat(path, F.lit("/"))).otherwise(path)
    steps = F.filter(F.split(open_end, "/"), lambda s: s != ".")
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(s))),
    )
    return F.array_join(kept, "/")


def absolute_url(c: Column, base: Column) -> Column:
    """A link as seen from a page: other schemes stay, queries and fragments keep the page's path, dots are worked off."""
    origin = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*/)?", 1)
    path, rest = F.regexp_extract(c, r"^[^?#]*", 0), F.regexp_extract(c, r"[?#].*$", 0)
    full = F.when(path.startswith("/"), F.substring(path, 2, 2**31 - 1)).otherwise(F.concat(folder, path))
    return (
        F.when(F.coalesce(c, F.lit("")) == "", base)
        .when(c.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), c)
        .when(c.startswith("//"), F.concat(F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*:", 0), c))
        .when(c.startswith("?"), F.concat(F.regexp_extract(base, r"^[^?#]*", 0), c))
        .when(c.startswith("#"), F.concat(F.regexp_extract(base, r"^[^#]*", 0), c))
        .otherwise(F.concat(origin, F.lit("/"), _without_dots(full), rest))
    )


def strip_tracking(c: Column) -> Column:
    """Drop the tracking parameters from a URL's query and keep everything else in place."""
    query = F.regexp_extract(c, r"\?([^#]*)", 1)
    drop = "^(?:" + "|".join(TRACKING_PARAMETERS) + ")(?:=|$)"
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(drop)), "&")
    head = F.regexp_extract(c, r"^[^?#]*", 0)
    fragment = F.regexp_extract(c, r"#.*$", 0)
    return F.concat(head, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")), fragment)


_MONTH_FIRST = r"([\p{L}\p{N}_]+ [0-9]{1,2}, [0-9]{4})"
_DAY_FIRST = r"([0-9]{1,2} [\p{L}\p{N}_]+ [0-9]{4})"
_SLASHED = r"([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"


def _parsed(c: Column, pattern: str, fmt: str) -> Column:
    found = F.initcap(F.regexp_extract(c, pattern, 1))
    return F.try_to_timestamp(found, F.lit(fmt)).cast("timestamp_ntz")


def review_date(c: Column, site: Column) -> Column:
    """Review date of a page text; each site has its own set of formats, and any other text gives NULL."""
    long_form = _parsed(c, "on " + _DAY_FIRST, "d MMMM yyyy")
    # The first shape that occurs decides; a date of that shape that does not parse is not tried again.
    short_form = (
        F.when(c.rlike(_DAY_FIRST), _parsed(c, _DAY_FIRST, "d MMM yyyy"))
        .when(c.rlike(_MONTH_FIRST), _parsed(c, _MONTH_FIRST, "MMM d, yyyy"))
    )
    with_slashes = F.when(
        ~c.rlike(_DAY_FIRST) & ~c.rlike(_MONTH_FIRST), _parsed(c, _SLASHED, "d/M/yyyy")
    )
    return (
        F.when(site == "amazon", long_form)
        .when(site == "flipkart", short_form)
        .otherwise(F.coalesce(short_form, with_slashes))
    )


def rating_from_text(c: Column) -> Column:
    return F.coalesce(first_number(c), F.lit(5.0))


def rating_from_class(c: Column) -> Column:
    return F.coalesce(F.regexp_extract(c, r"a-star-([0-9])", 1).try_cast("double"), F.lit(5.0))


def listing_number(url: Column) -> Column:
    """Ten-character item code of a product URL, NULL without one."""
    return F.nullif(F.regexp_extract(url, r"/dp/([A-Z0-9]{10})", 1), F.lit(""))


def brand_from_byline(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("Visit the "), F.lit("")), F.lit(" Store"), F.lit(""))


def larger_image(c: Column) -> Column:
    return F.replace(c, F.lit("w_200"), F.lit("w_500"))


def array_top(values: Column, k: int) -> Column:
    """The first k entries without repeats: the cut comes before the repeats are dropped."""
    return F.array_distinct(F.filter(F.slice(values, 1, k), lambda v: F.coalesce(v, F.lit("")) != ""))


def keyword_offers(spans: Column, k: int = 3) -> Column:
    return F.slice(F.filter(spans, lambda s: any_of([F.lower(s).contains(w) for w in OFFER_KEYWORDS])), 1, k)


def long_offers(spans: Column, k: int = 3) -> Column:
    return F.slice(F.filter(spans, lambda s: F.length(s) > 10), 1, k)


def category_of(breadcrumb: Column) -> Column:
    lowered = F.lower(breadcrumb)
    chosen = None
    for category, keywords in BREADCRUMB_CATEGORIES:
        hit = any_of([lowered.contains(k) for k in keywords])
        chosen = F.when(hit, category) if chosen is None else chosen.when(hit, category)
    return chosen.otherwise("electronics")


def in_stock_from_text(c: Column, site: Column) -> Column:
    lowered = F.lower(F.coalesce(c, F.lit("")))
    gone = lowered.contains("out of stock") | F.when(site == "amazon", lowered.contains("unavailable")).otherwise(
        lowered.contains("sold out")
    )
    return ~gone


def in_stock_from_sizes(sizes: Column) -> Column:
    """False when sizes are listed and none of them is available."""
    available = F.exists(sizes, lambda s: F.lower(s).contains("available"))
    return (F.size(sizes) == 0) | available


def label_key(name: Column, labels: Column) -> Column:
    """Metric name with its sorted labels, `name{k=v,k=v}`; the bare name without labels."""
    entries = F.array_sort(F.map_entries(labels))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return F.when(F.coalesce(text, F.lit("")) == "", name).otherwise(F.concat(name, F.lit("{"), text, F.lit("}")))
