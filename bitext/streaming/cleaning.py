"""Streaming variant of pair cleaning.

The reference has no streaming. Cleaning and validity (P1-P6, F1) and the
length filter (F2) are row-wise, so the same column expressions run on a
Structured Streaming DataFrame unchanged (the GBK repair is an Arrow-batched
Python step, supported in micro-batches). Exact de-duplication of an
unbounded stream would need unbounded state, so it is only offered within an
event-time watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_space
from ..operators.clean import clean_columns
from ..operators.split import keep_pair
from ..session import ensure_checkpoint_dir


def clean_pairs_stream(stream: DataFrame, source: str = "source", target: str = "target",
                       length_filter: bool = True, event_time: str | None = None,
                       watermark: str = "1 hour") -> DataFrame:
    """Cleaned, valid (and length-filtered) pairs of a streaming DataFrame.

    With ``event_time``, identical pairs arriving within ``watermark`` of
    each other are dropped (bounded state); without it no cross-batch
    de-duplication is done.
    """
    out = clean_columns(stream, source, target).drop("modified")
    ok = F.col("valid")
    if length_filter:
        out = out.withColumns({source: normalize_space(source), target: normalize_space(target)})
        ok = ok & (F.col(source) != "") & (F.col(target) != "") & keep_pair(source, target, normalized=True)
    # Keep rows through an outer generator instead of a plain filter: a filter
    # on the cleaned columns would be pushed back through the cleaning
    # projections (re-running them, and the Python step, in the predicate),
    # while a filter on a generator's output stays above it.
    cols = [c for c in out.columns if c != "valid"]
    out = out.withColumn("_ok", ok)
    row = F.array(F.struct(*[F.col(c) for c in cols]))
    out = (out.select(F.inline_outer(F.when(F.col("_ok"), row)))
              .filter(F.col(source).isNotNull()))  # cleaned text is never NULL
    if event_time is not None:
        out = out.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([source, target])
    return out


def start_parquet_sink(df: DataFrame, path: str, name: str = "bitext_clean",
                       available_now: bool = True, checkpoint: str | None = None):
    """Append the stream to Parquet; progress is kept in a folder under the
    shared checkpoint directory, so a restarted query resumes exactly once."""
    base = ensure_checkpoint_dir(df.sparkSession)
    ckpt = checkpoint or f"{base.rstrip('/')}/streams/{name}"
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt)
    writer = writer.queryName(name).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
