"""Input layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-distribute an input that arrives in fewer partitions than cores.

    A small file with one row group is scanned by one task; the CPU-heavy
    text steps that follow would then run on one core. When the scan already
    has at least ``defaultParallelism`` partitions (any large input) this is
    a no-op and adds no shuffle.
    """
    try:
        n = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= n:
            return df
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session): leave as is
        return df
    cols = [F.col(k) for k in keys] or [F.col(df.columns[0])]
    return df.repartition(n, *cols)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-distribute an input whose rows take long, whatever its files look like: a task
    reads a whole row group, and files may have few. One shuffle of the columns used."""
    return df.repartition(F.xxhash64(*keys))
