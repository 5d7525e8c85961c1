"""Vocabulary with reserved specials and a global frequency rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .._util import explode_rows, require_columns
from ..functions.text import tokens
from .rank import global_rank

# --- fixed values: reserved entries written first, each with this count -----
SPECIALS = ("<blank>", "<s>", "</s>", "<unk>")
SPECIAL_COUNT = 1_000_000
# ---------------------------------------------------------------------------

#: A position in a line is below this (a value holds less than 2**31 characters).
_POSITIONS = 1 << 31


def token_counts(df: DataFrame, text_col: str, order_col: str = "line_no",
                 specials=SPECIALS) -> DataFrame:
    """``(token, count, first_seen)`` over whitespace tokens.

    One explode and one hash aggregate. ``first_seen`` is line and position packed
    into one number, ``line * 2**31 + position`` as a 38-digit decimal: comparable,
    of fixed width (so the aggregate stays a hash aggregate with map-side combine)
    and unique to the token. Lines are whole numbers below 2**95.
    """
    require_columns(df, text_col, order_col)
    line = F.col(order_col).cast("decimal(38,0)") * F.lit(_POSITIONS).cast("decimal(10,0)")
    rows = explode_rows(df, [line.cast("decimal(38,0)").alias("_line")], tokens(text_col), ("_pos", "token"), True)
    return (rows.filter(~F.col("token").isin(*specials))
                .groupBy("token").agg(F.count(F.lit(1)).alias("count"),
                                      F.min((F.col("_line") + F.col("_pos")).cast("decimal(38,0)")).alias("first_seen")))


def build_vocab(df: DataFrame, text_col: str, order_col: str = "line_no",
                specials=SPECIALS, max_size: int | None = None) -> DataFrame:
    """``(token, count, rank)``: specials first (count 1,000,000), then tokens by
    descending count, ties in first-seen order; specials found in the data are
    not counted again. ``max_size`` keeps the first ``max_size`` non-special
    entries (a top-k by rank, no extra sort). The vocabulary is sorted by ranges and
    written once (``global_rank``), so this is eager.
    """
    spark: SparkSession = df.sparkSession
    ranked = global_rank(token_counts(df, text_col, order_col, specials), F.desc("count"), "first_seen",
                         offset=len(specials))
    if max_size is not None:
        ranked = ranked.filter(F.col("rank") <= len(specials) + int(max_size))
    head = spark.createDataFrame(
        [(tok, SPECIAL_COUNT, i + 1) for i, tok in enumerate(specials)],
        "token string, count long, rank long")
    return head.unionByName(ranked.select("token", "count", "rank"))
