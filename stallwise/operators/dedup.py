"""Keep-first duplicates removal and latest-row upserts.

Both are `row_number() = 1` filters: Spark keeps only one row per key in each map task before the shuffle
(WindowGroupLimit), so a signature that a third of all rows share still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallwise.functions import text
from stallwise.sources import scratch

# Above so many keys with several versions, all rows are dealt out by key.
FEW_KEYS = 500_000
ORDER = {
    "products": ["ingest_seq"], "reviews": ["ingest_seq"], "pricing": ["ingest_seq", "price_id", "current_price"],
}


def signature(entity: str, as_of: Column | None = None) -> list[Column]:
    """What makes two records of an entity the same."""
    if entity == "products":
        return [F.col("site"), text.strip(F.lower("name")), F.col("url")]
    if entity == "reviews":
        return [F.col("product_id"), F.md5(text.strip(F.lower("content")))]
    day = F.col("price_date") if as_of is None else F.coalesce("price_date", as_of)
    return [F.col("product_id"), F.to_date(day)]


def signature_hash(entity: str, as_of: Column | None = None) -> Column:
    """One fixed-length value per signature, for stored signatures and streams."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in signature(entity, as_of)]
    return F.md5(F.concat_ws("\x1f", *parts))


def stored_signature(entity: str, as_of: Column | None = None) -> dict[str, Column]:
    """The signature as short columns by name, for rows that carry it: a name is a row's own column or one to be added."""
    parts = signature(entity, as_of)
    if entity == "pricing":
        return dict(zip(("product_id", "_day"), parts))
    if entity == "reviews":
        return {"product_id": parts[0], "_content": F.unhex(parts[1])}
    return {"_signature": F.unhex(signature_hash(entity, as_of))}


def first_rows(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def top_rows(df: DataFrame, keys: list[Column | str], order: list[Column | str], k: int) -> DataFrame:
    """First k rows of each key with their rank."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def drop_duplicates(df: DataFrame, entity: str, as_of: Column | None = None) -> DataFrame:
    return first_rows(df, signature(entity, as_of), ORDER[entity])


def drop_seen(batch: DataFrame, seen: DataFrame, entity: str, as_of: Column | None = None) -> DataFrame:
    """Rows of a batch whose signature neither an earlier row of the batch nor an earlier batch had.

    `seen` holds the `signature` column of earlier batches. The batch is made unique first, so the join has no hot key.
    """
    fresh = drop_duplicates(batch, entity, as_of).withColumn("signature", signature_hash(entity, as_of))
    return fresh.join(seen.select("signature"), "signature", "left_anti")


def upsert(current: DataFrame, incoming: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Latest version of each key over both sides; the last write wins."""
    return latest_rows(current.unionByName(incoming, allowMissingColumns=True), key, order)


def latest_rows(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    return first_rows(df, [key], [F.col(c).desc() for c in order or ["ingest_seq"]])


def latest_of_few(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """`latest_rows` for a stored table, most keys of which have one version.

    Digests of the keys are counted first; only rows of keys that may have several versions are compared, all others
    pass as they are. Where there are many such keys, all rows are compared.
    """
    digest = F.xxhash64(key).alias("_digest")
    several = scratch.cut(df.groupBy(digest).agg(F.count("*").alias("_n")).filter("_n > 1").select("_digest"))
    if several.count() > FEW_KEYS:
        return latest_rows(df, key, order)
    several = F.broadcast(several.withColumn("_several", F.lit(True)))
    marked = df.withColumn("_digest", digest).join(several, "_digest", "left").drop("_digest")
    once, more = marked.filter("_several is null"), latest_rows(marked.filter("_several"), key, order)
    return once.unionByName(more).drop("_several")
