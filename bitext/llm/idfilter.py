"""Narrowing a wide table to listed ids before it is shuffled."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of the filter; its size does not depend on the data.
SLOTS = 1 << 20


def only_ids(table: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``table`` whose ``key`` is in the one-column ``ids``.

    Ids are hashed to a fixed number of slots; the used slots (at most
    ``SLOTS``, whatever the data) are broadcast and drop most other rows in
    the scan, and an exact semi-join decides the rest. Past some millions of
    ids the filter lets more rows through and the join alone does the work.
    """
    ids = ids.toDF(key).where(F.col(key).isNotNull()).distinct()
    return split_by_ids(table, ids, key)[0].where(F.col(key).isNotNull()).join(ids, key, "left_semi")


def split_by_ids(table: DataFrame, ids: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``table`` in two: rows that may be in ``ids`` and rows that surely are not
    (NULL keys among them)."""
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")
    used = np.zeros(SLOTS, bool)
    slots = ids.toDF(key).where(F.col(key).isNotNull()).select(slot.alias("slot")).distinct()
    used[[r[0] for r in slots.collect()]] = True
    shared = table.sparkSession.sparkContext.broadcast(np.packbits(used))
    marked = table.withColumn("_slot", F.when(F.col(key).isNotNull(), slot).otherwise(-1))
    return tuple(marked.mapInArrow(_keep(shared, table.columns, wanted), table.schema) for wanted in (True, False))


def _keep(shared, columns: list[str], wanted: bool):
    def run(batches):
        import pyarrow as pa

        seen = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            slots = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            mask = ((slots >= 0) & seen[slots]) == wanted
            if mask.any():
                yield batch.select(columns).filter(pa.array(mask))

    return run
