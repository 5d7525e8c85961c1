"""Sinks (K1-K7). Outputs go to new paths; inputs are never overwritten in place."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._util import explode_rows
from ..operators.rank import running_total


def snapshot_path(base: str, ts: str | None = None) -> str:
    """Versioned output folder ``<base>/snapshot=<UTC timestamp>`` (K7).

    Replaces "back up the input, then overwrite it": each run writes a new
    snapshot and the previous one stays readable.
    """
    ts = ts or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    return f"{base.rstrip('/')}/snapshot={ts}"


def _csv_writer(df: DataFrame, mode: str):
    return (df.write.mode(mode).option("header", True).option("quote", '"')
              .option("escape", '"').option("encoding", "UTF-8")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_pairs(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """``source,target`` pairs (K1); CSV with header or Parquet."""
    out = df.select("source", "target")
    if fmt == "csv":
        _csv_writer(out, mode).csv(path)
    else:
        out.write.mode(mode).parquet(path)


def write_splits(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Split-labelled pairs partitioned by ``split`` (K2), Parquet.

    Each split folder holds rows range-partitioned and sorted by
    ``split_key``, i.e. in split-file line order.
    """
    (df.repartitionByRange("split", "split_key").sortWithinPartitions("split", "split_key")
       .write.mode(mode).partitionBy("split").parquet(path))


def write_split_text(df: DataFrame, path: str, side: str, mode: str = "errorifexists") -> None:
    """One side of every split as plain lines (``split=<name>/part-*``) in
    ``split_key`` order (K2). Written per side; concatenating the part files of
    a split in name order gives the line-aligned file."""
    (df.select("split", "split_key", F.col(side).alias("value"))
       .repartitionByRange("split", "split_key").sortWithinPartitions("split", "split_key")
       .drop("split_key").write.mode(mode).partitionBy("split").text(path))


def write_vocab(vocab: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``token<TAB>count`` lines in rank order (K3): a distributed range sort,
    part files in order."""
    (vocab.repartitionByRange("rank").sortWithinPartitions("rank")
          .select(F.concat_ws("\t", "token", F.col("count").cast("string")).alias("value"))
          .write.mode(mode).text(path))


#: Folders per memory snapshot.
MEMORY_BUCKETS = 32


def write_memory(entries: DataFrame, base: str, ts: str | None = None, buckets: int = MEMORY_BUCKETS) -> str:
    """Persist memory entries as a new snapshot below ``base`` (K4); returns its folder.

    A snapshot may hold the whole memory or only a run's new entries: readers take
    each key's newest value (``sources.readers.read_memory``). Rows are dealt by a hash
    of the source to ``bucket`` folders, so one bucket can be read or merged alone.
    """
    target = snapshot_path(base, ts)
    bucket = F.pmod(F.xxhash64("source"), F.lit(int(buckets))).cast("int")
    (entries.select("source", "translation", bucket.alias("bucket")).repartition("bucket")
            .write.mode("errorifexists").partitionBy("bucket").parquet(target))
    return target


def write_translations(docs: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """One row per document ``(doc_id, translation)`` with its newline-joined translation (K5).

    As text: ``<path>/lines`` holds the lines of all documents in ``doc_id`` order, in as
    many files as the range sort has tasks, and ``<path>/manifest`` one row per document
    ``(doc_id, first_line, lines)``, empty documents with no lines. The line numbers count
    over all files in name order. ``doc_id`` must be unique.
    """
    if fmt != "text":
        docs.write.mode(mode).parquet(path)
        return
    base = path.rstrip("/")
    text = F.col("translation")
    lines = F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))
    sizes = docs.select("doc_id", F.size(lines).alias("lines"))
    manifest = running_total(sizes, "lines", "doc_id", total_col="first_line")
    manifest.select("doc_id", "first_line", "lines").write.mode(mode).parquet(f"{base}/manifest")
    rows = explode_rows(docs, ["doc_id"], lines, ("pos", "value"), True)
    (rows.repartitionByRange("doc_id", "pos").sortWithinPartitions("doc_id", "pos").select("value")
         .write.mode(mode).option("lineSep", "\n").text(f"{base}/lines"))


def write_metrics(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Run-metrics or report table as CSV with header (K6)."""
    _csv_writer(df, mode).csv(path)
