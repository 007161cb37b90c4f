"""A bounded, reproducible sample of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def least_hashed(rows: DataFrame, total: int, n: int) -> list[Row]:
    """The ``n`` rows of the least hashed ``k``, ties by the other columns; ``total`` is about how many rows there are.

    Only rows below a hash under which three times as many are expected are gathered, so the driver gets a number
    of rows that doesn't grow with the table or its partitions. Fewer come if most rows were filtered before.
    """
    h = F.xxhash64("k")
    if total > 3 * n:
        rows = rows.where(h <= F.lit(int(-(2**63) + 2**64 * (3 * n / total))))
    return rows.withColumn("h", h).orderBy("h", *rows.columns).limit(n).collect()
