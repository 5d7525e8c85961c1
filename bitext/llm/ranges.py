"""Dealing a table to ascending ranges of a key, sorted within each range."""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled keys per range; Spark's own range partitioner uses about as many.
SAMPLE_PER_RANGE = 60


def range_limits(table: DataFrame, key: str, ranges: int) -> list:
    """First keys of the ranges 1, 2, ...; at most ``ranges - 1`` of them, all
    present in the table. Only the balance of the ranges depends on the sample."""
    keys = table.select(key).where(F.col(key).isNotNull())
    total = keys.count()
    share = min(1.0, SAMPLE_PER_RANGE * ranges / total) if total else 1.0
    found = sorted(r[0] for r in (keys.sample(share, seed=11) if share < 1 else keys).collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)} - {found[0]}) if found else []


def bucket_of(limits: list, key: str) -> Column:
    """Number of limits not above the key; a NULL key is in range 0."""
    if not limits:
        return F.lit(0)

    def number(keys):
        import pandas as pd

        return pd.Series([bisect.bisect_right(limits, k) for k in keys], dtype="int32")

    found = F.pandas_udf(number, "int")(F.coalesce(F.col(key), F.lit(limits[0])))
    return F.when(F.col(key).isNull(), 0).otherwise(found)


def by_ranges(table: DataFrame, key: str, limits: list) -> DataFrame:
    """``table`` with ``_bucket`` (range number), one partition per range, rows
    sorted by key (NULL first), ties by the other columns."""
    rest = [c for c in table.columns if c != key]
    return table.withColumn("_bucket", bucket_of(limits, key)).repartitionById(
        len(limits) + 1, F.col("_bucket")).sortWithinPartitions("_bucket", key, *rest)


def by_ranges_with_next(table: DataFrame, key: str, limits: list) -> DataFrame:
    """As ``by_ranges``, and each range ends with copies (``_halo`` true) of the
    rows with the first key of the next range, the last range with those of the
    first, so that a reader finds every row's successor in its own range."""
    rest = [c for c in table.columns if c != key]
    lowest, nulls = table.agg(F.min(key), F.max(F.col(key).isNull())).first()
    first = F.col(key).isNull() if nulls else F.col(key).eqNullSafe(F.lit(lowest))
    # Every limit is a key of the table, so it is its range's first key.
    starts = F.col(key).isin(limits) if limits else F.lit(False)
    own = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("h"))
    copy = F.when(first, F.struct(F.lit(len(limits)).alias("b"), F.lit(True).alias("h"))).when(
        starts, F.struct((F.col("_bucket") - 1).alias("b"), F.lit(True).alias("h")))
    placed = table.withColumn("_bucket", bucket_of(limits, key)).withColumn(
        "_to", F.explode(F.array_compact(F.array(own, copy)))).withColumns(
        {"_bucket": F.col("_to.b"), "_halo": F.col("_to.h")}).drop("_to")
    return placed.repartitionById(len(limits) + 1, F.col("_bucket")).sortWithinPartitions(
        "_bucket", "_halo", key, *rest)
