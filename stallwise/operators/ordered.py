"""Previous row, next row and row number per key, whatever share of all rows a key holds.

A plain window sends each key to one task. Here the rows are range-partitioned along (keys, order) instead, so tasks get
equal shares: a key with ten times the rows lies in ten times the tasks, and even rows of one key and moment are parted
by the rest of the order. The window then runs per (partition, key). What crosses a boundary is the end of the partition
before: one small row per partition, carried along all of them. The frame is read twice, once to choose the ranges and
once to deal the rows out; the dealt rows are cut, so that both the window and the boundaries see the same partitions,
also after an executor was lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallwise.sources import scratch

PART = "_part"


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def lined_up(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """Rows dealt to `partitions` ranges (None: as the session shuffles) of (keys, order), numbered in `_part`."""
    along = [*keys, *order]
    dealt = df.repartitionByRange(partitions, *along) if partitions else df.repartitionByRange(*along)
    return scratch.cut(dealt.withColumn(PART, F.spark_partition_id()))


def _ends(rows: DataFrame, keys: list[str], order: list[str], kept: list[str], first: bool = False) -> DataFrame:
    """(_part, _end): keys and `kept` columns of each partition's last row, or its first."""
    pick = F.min_by if first else F.max_by
    own = F.struct(*[F.col(c).alias(f"key_{i}") for i, c in enumerate(keys)], *kept)
    return rows.groupBy(PART).agg(pick(own, F.struct(*keys, *order)).alias("_end"))


def _same_key(keys: list[str], end: str = "_carried") -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{end}.key_{i}")) for i, c in enumerate(keys)])


def _shifted(df: DataFrame, keys, order, values: dict[str, str], ahead: bool, partitions) -> DataFrame:
    rows = lined_up(df, keys, order, partitions)
    # One row per partition, so a single task can look along them and every task can hold them.
    along = W.orderBy(F.col(PART).desc() if ahead else F.col(PART).asc())
    carried = _ends(rows, keys, order, list(values), ahead).select(PART, F.lag("_end").over(along).alias("_carried"))
    window = W.partitionBy(PART, *keys).orderBy(*[F.col(c).desc() if ahead else F.col(c).asc() for c in order])
    moved = rows.withColumns({alias: F.lag(c).over(window) for c, alias in values.items()} | {"_first": F.row_number().over(window) == 1})
    crossing = {alias: F.when(F.col("_first"), F.when(_same_key(keys), F.col("_carried")[c])).otherwise(F.col(alias)) for c, alias in values.items()}
    return moved.join(F.broadcast(carried), PART, "left").withColumns(crossing).drop(PART, "_first", "_carried")


def previous_values(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Add, for each `column: alias`, the column's value in the previous row of the same key along `order`.

    Rows with equal keys and order stand in any order among themselves: end `order` with a tie-break.
    """
    return _shifted(df, keys, order, values, False, partitions)


def next_values(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Like `previous_values`, looking at the next row."""
    return _shifted(df, keys, order, values, True, partitions)


def row_numbers(df: DataFrame, keys: list[str], order: list[str], alias: str = "row_number", partitions: int | None = None) -> DataFrame:
    """Number each key's rows from 1 along `order`: the number within the partition plus the key's rows in those before."""
    rows = lined_up(df, keys, order, partitions)
    ends = F.broadcast(_ends(rows, keys, order, []))
    # Of each partition only its last key can go on in the next.
    tails = rows.join(ends, PART).where(_same_key(keys, "_end")).groupBy(PART, "_end").agg(F.count(F.lit(1)).alias("_rows"))
    so_far = F.sum("_rows").over(W.partitionBy("_end").orderBy(PART))
    carried = tails.select(PART, F.struct("_end.*", so_far.alias("rows")).alias("_end"))
    carried = carried.select(PART, F.lag("_end").over(W.orderBy(PART)).alias("_carried"))
    numbered = rows.withColumn(alias, F.row_number().over(W.partitionBy(PART, *keys).orderBy(*order)))
    before = F.when(_same_key(keys), F.col("_carried.rows")).otherwise(0)
    return numbered.join(F.broadcast(carried), PART, "left").withColumn(alias, F.col(alias) + F.coalesce(before, F.lit(0))).drop(PART, "_carried")
