"""Figures that a job takes of the rows it passes on, without reading them again."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Passing:
    """Counts of the rows of `frame` that an action has read: all of them, and those for which named conditions hold."""

    def __init__(self, df: DataFrame, **conditions) -> None:
        self.taken = Observation()
        self.names = ["rows", *conditions]
        self.frame = df.observe(self.taken, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])

    def counts(self) -> dict[str, int]:
        """To be called after the action. Where Spark found that there are no rows at all, nothing was taken: zeros."""
        try:
            return {n: self.taken.get[n] for n in self.names}
        except Py4JJavaError:
            return dict.fromkeys(self.names, 0)
