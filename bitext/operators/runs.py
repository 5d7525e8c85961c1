"""Experiment-run reports: throughput, best runs, comparisons, metrics table
(P11, P12, P14, F4, J6, A6-A12, D3, D4).

A run table has the columns of ``RUNS_SCHEMA`` plus ``row_no`` (file order,
used for "first row wins"). Winners are numbers that pack a metric and the row
number, so all reports come from hash aggregates with map-side combine over one
read of the runs; none collects a mode's rows into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._util import explode_rows, require_columns
from ..functions.text import format_metric, pct_change, safe_float

RUNS_SCHEMA = ("mode string, model_type string, batch_size int, beam_size int, "
               "glossary_enabled boolean, cache_enabled boolean, elapsed_time double, "
               "num_sentences int, sent_per_sec double, cache_hits int")
RUN_FIELDS = ("mode", "model_type", "batch_size", "beam_size", "glossary_enabled",
              "cache_enabled", "elapsed_time", "num_sentences", "sent_per_sec", "cache_hits")


def throughput(runs: DataFrame, elapsed_col: str = "elapsed_raw", n_col: str = "num_sentences") -> DataFrame:
    """``elapsed_time`` rounded to 6 digits, ``sent_per_sec = n / elapsed``
    rounded to 4, and 0 when elapsed <= 0 (A6)."""
    require_columns(runs, elapsed_col, n_col)
    e = F.col(elapsed_col)
    sps = F.when(e > 0, F.round(F.col(n_col) / e, 4)).otherwise(F.lit(0.0))
    return runs.withColumns({"elapsed_time": F.round(e, 6), "sent_per_sec": sps})


def runs_for_mode(runs: DataFrame, mode: str) -> DataFrame:
    """Rows of one benchmark mode."""
    return runs.filter(F.col("mode") == mode)


def repeat_rows(df: DataFrame, k: int, copy_col: str = "copy") -> DataFrame:
    """Every row ``k`` times, numbered 0..k-1 (D3). A generator, not a join."""
    if k < 0:
        raise ValueError("k must be >= 0")
    return explode_rows(df, ["*"], F.array_repeat(F.lit(True), int(k)),
                        (copy_col, "_copy_flag"), True).drop("_copy_flag")


def concat_runs(*frames: DataFrame) -> DataFrame:
    """Append the result rows of several experiment cases."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _number(col) -> Column:
    """A metric as a double, blank as 0 (text through ``safe_float``)."""
    return F.coalesce(safe_float(col), F.lit(0.0))


def sortable_bits(x: Column) -> Column:
    """The IEEE 754 bits of a double as a long in the order of the doubles (negative
    numbers give negative longs; NaN is the largest), by arithmetic that is exact."""
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("int")
    # log2 may round across a power of two: set right by comparing.
    power = guess + F.when(size >= F.pow(F.lit(2.0), guess) * 2, 1).when(size < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    fraction = (size / F.pow(F.lit(2.0), power) - 1) * F.lit(float(1 << 52))
    normal = (power + 1023).cast("long") * F.lit(1 << 52) + fraction.cast("long")
    # Below the normal numbers the bits count steps of 2^-1074.
    small = (size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    bits = F.when(size < F.lit(2.0 ** -1022), small).when(size == F.lit(float("inf")), F.lit(0x7FF << 52)).otherwise(normal)
    return F.when(F.isnan(x), F.lit(0x7FF8 << 48)).when(x < 0, -bits).otherwise(bits)


def packed_rank(metric: Column, row_no: Column) -> Column:
    """One 38-digit number that orders rows by metric, then by smaller ``row_no``.

    Fixed width, so that the winner of a group is a plain ``max`` and its other
    fixed-width columns ``max_by`` in one hash aggregate.
    """
    last = F.lit(str((1 << 63) - 1)).cast("decimal(19,0)") - row_no.cast("decimal(19,0)")
    return (sortable_bits(metric).cast("decimal(19,0)") * F.lit(str(1 << 63)).cast("decimal(19,0)")
            + last).cast("decimal(38,0)")


def best_rows(runs: DataFrame, metric: str, higher_is_better: bool = True) -> DataFrame:
    """Per mode, the row with the best ``metric`` (blank -> 0); first row wins ties.

    Text columns group the first hash aggregate together with the mode, the others
    come from the packed winner; of its rows (one per mode and text values) the
    best of each mode stays. The runs are read once, no aggregate sorts.
    """
    require_columns(runs, "mode", "row_no", metric)
    m = _number(F.col(metric))
    texts = ["mode"] + [c for c, t in runs.dtypes if t == "string" and c != "mode"]
    rest = [c for c in runs.columns if c not in texts]
    ranked = runs.withColumn("_rank", packed_rank(m if higher_is_better else -m, F.col("row_no")))
    some = ranked.groupBy(*texts).agg(F.max("_rank").alias("_rank"), *[F.max_by(c, "_rank").alias(c) for c in rest])
    best = some.groupBy("mode").agg(F.max("_rank").alias("_rank"))
    return some.join(best.withColumnRenamed("mode", "_mode"), (F.col("mode").eqNullSafe(F.col("_mode")))
                     & (some["_rank"] == best["_rank"])).select(*runs.columns)


def compare_runs(runs: DataFrame, mode: str, key: str, a, b,
                 metrics=("sent_per_sec", "elapsed_time")) -> DataFrame:
    """First run with ``key = a`` against the first with ``key = b`` in one
    mode (J6): ``a_<m>``, ``b_<m>`` and ``<m>_change_pct`` (b vs a) per metric;
    empty when either run is missing. One hash aggregate, no self-join."""
    require_columns(runs, "mode", "row_no", key, *metrics)
    sides = {s: F.when(F.col(key) == F.lit(v), F.col("row_no")) for s, v in (("a", a), ("b", b))}
    p = runs_for_mode(runs, mode).agg(
        *[F.min(at).alias(f"_{s}") for s, at in sides.items()],
        *[F.min_by(m, at).alias(f"{s}_{m}") for m in metrics for s, at in sides.items()])
    cols = []
    for m in metrics:
        cols += [f"a_{m}", f"b_{m}", pct_change(f"b_{m}", f"a_{m}").alias(f"{m}_change_pct")]
    return p.filter("_a IS NOT NULL AND _b IS NOT NULL").select(*cols)


# --- fixed values: the report's modes, model types and labels -----------------
MODEL_MODE, BATCH_MODE, BEAM_MODE, CACHE_MODE = "model_compare", "batch_compare", "beam_compare", "cache_compare"
BASELINE, FINETUNED = "baseline", "finetuned"
# -----------------------------------------------------------------------------


def mode_facts(runs: DataFrame) -> DataFrame:
    """One row per mode of the reports with all that they tell of it.

    ``runs`` is read once: a hash aggregate per (mode, model type) over fixed-width
    values (packed winners, first rows), then one per mode. First rows are those of
    the smallest ``row_no``: of either model type, and with the cache off and on.
    """
    require_columns(runs, "row_no", *RUN_FIELDS)
    r = runs.filter(F.col("mode").isin(MODEL_MODE, BATCH_MODE, BEAM_MODE, CACHE_MODE))
    row = F.col("row_no")
    r = r.withColumns({"_speed": packed_rank(_number(F.col("sent_per_sec")), row),
                       "_hits": packed_rank(_number(F.col("cache_hits")), row),
                       "_off": F.when(~F.col("cache_enabled"), row), "_on": F.when(F.col("cache_enabled"), row)})
    firsts = {"first": "row_no", "off": "_off", "on": "_on"}
    values = ("sent_per_sec", "elapsed_time", "cache_hits")
    some = r.groupBy("mode", "model_type").agg(
        F.max("_speed").alias("speed"), F.max("_hits").alias("hits"),
        *[F.max_by(c, "_speed").alias(f"speed_{c}") for c in ("batch_size", "beam_size", "sent_per_sec")],
        *[F.max_by(c, "_hits").alias(f"hits_{c}") for c in ("cache_enabled", "cache_hits")],
        *[F.min(at).alias(s) for s, at in firsts.items()],
        *[F.min_by(v, at).alias(f"{s}_{v}") for s, at in firsts.items() for v in values])
    kind = lambda name, col: F.max(F.when(F.col("model_type") == name, F.col(col)))
    facts = some.groupBy("mode").agg(
        F.max("speed").alias("speed"),
        *[F.max_by(c, "speed").alias(c) for c in ("speed_batch_size", "speed_beam_size", "speed_sent_per_sec")],
        *[F.max_by(c, "hits").alias(c) for c in ("hits_cache_enabled", "hits_cache_hits")],
        *[F.min(s).alias(s) for s in ("off", "on")],
        *[F.min_by(f"{s}_{v}", s).alias(f"{s}_{v}") for s in ("off", "on") for v in values],
        *[kind(name, c).alias(f"{name}_{v}") for name in (BASELINE, FINETUNED)
          for v, c in (("row", "first"), ("sent_per_sec", "first_sent_per_sec"), ("elapsed_time", "first_elapsed_time"))])
    names = some.select(F.col("mode").alias("_mode"), F.col("speed").alias("_speed"),
                        F.col("model_type").alias("speed_model_type"))
    return facts.join(names, (F.col("mode") == F.col("_mode")) & (F.col("speed") == F.col("_speed"))).drop("_mode", "_speed")


def _both_models() -> Column:
    return F.col(f"{BASELINE}_row").isNotNull() & F.col(f"{FINETUNED}_row").isNotNull() & (F.col("mode") == MODEL_MODE)


def _both_caches() -> Column:
    return F.col("off").isNotNull() & F.col("on").isNotNull() & (F.col("mode") == CACHE_MODE)


def _speed_change() -> Column:
    return pct_change(f"{FINETUNED}_sent_per_sec", f"{BASELINE}_sent_per_sec")


def _latency_change() -> Column:
    return pct_change(f"{FINETUNED}_elapsed_time", f"{BASELINE}_elapsed_time")


def _cache_speedup() -> Column:
    return pct_change("on_sent_per_sec", "off_sent_per_sec")


def _latency_reduction() -> Column:
    """The documented (off - on) / off * 100 (the reference's code computes
    -on/off*100 under that label)."""
    off, on = F.col("off_elapsed_time"), F.col("on_elapsed_time")
    return F.when(off == 0, F.lit(0.0)).otherwise((off - on) / off * F.lit(100.0))


def model_compare(runs: DataFrame) -> DataFrame:
    """First baseline vs first finetuned ``model_compare`` run (A8, J6); empty when
    either side is missing."""
    return mode_facts(runs).filter(_both_models()).select(
        F.col(f"{BASELINE}_sent_per_sec").alias("baseline_sent_per_sec"),
        F.col(f"{FINETUNED}_sent_per_sec").alias("finetuned_sent_per_sec"),
        _speed_change().alias("speed_change_pct"),
        F.col(f"{BASELINE}_elapsed_time").alias("baseline_elapsed_time"),
        F.col(f"{FINETUNED}_elapsed_time").alias("finetuned_elapsed_time"),
        _latency_change().alias("latency_change_pct"))


def cache_compare(runs: DataFrame) -> DataFrame:
    """First cache-off vs first cache-on ``cache_compare`` run."""
    return mode_facts(runs).filter(_both_caches()).select(
        F.col("off_sent_per_sec").alias("cache_off_sent_per_sec"),
        F.col("on_sent_per_sec").alias("cache_on_sent_per_sec"),
        _cache_speedup().alias("cache_speedup_pct"),
        F.col("off_elapsed_time").alias("cache_off_elapsed_time"),
        F.col("on_elapsed_time").alias("cache_on_elapsed_time"),
        _latency_reduction().alias("cache_latency_reduction_pct"),
        F.col("on_cache_hits").cast("double").alias("cache_hits"))


def _report_row(category: str, metric: str, value: Column, digits: int, notes: str, shown: Column) -> Column:
    row = F.struct(F.lit(category).alias("category"), F.lit(metric).alias("metric"),
                   F.round(value, digits).alias("value"), F.lit(notes).alias("notes"))
    return F.when(shown, row)


def metrics_rows(bleu_pair: DataFrame, runs: DataFrame) -> DataFrame:
    """Long table ``(category, metric, value, notes)`` (A10).

    ``bleu_pair`` is one row ``(baseline_bleu, finetuned_bleu)``. Three BLEU
    rows always; two model rows and three cache rows when those runs exist.
    Values are rounded as the report prints them (4, 2, 2, 0 digits).
    """
    always = F.lit(True)
    bleu = F.array(
        _report_row("bleu", "baseline_bleu", F.col("baseline_bleu"), 4, "test set", always),
        _report_row("bleu", "finetuned_bleu", F.col("finetuned_bleu"), 4, "test set", always),
        _report_row("bleu", "bleu_improvement_pct", pct_change("finetuned_bleu", "baseline_bleu"), 2,
                    "(finetuned-baseline)/baseline*100", always))
    models, caches = _both_models(), _both_caches()
    of_runs = F.array_compact(F.array(
        _report_row("throughput", "model_compare_speed_change_pct", _speed_change(), 2,
                    "finetuned vs baseline sent_per_sec", models),
        _report_row("latency", "model_compare_latency_change_pct", _latency_change(), 2,
                    "finetuned vs baseline elapsed_time", models),
        _report_row("cache", "cache_speedup_pct", _cache_speedup(), 2, "cache_on vs cache_off sent_per_sec", caches),
        _report_row("cache", "cache_latency_reduction_pct", _latency_reduction(), 2, "(off-on)/off*100", caches),
        _report_row("cache", "cache_hits", F.col("on_cache_hits").cast("double"), 0,
                    "cache_compare, cache_enabled=True", caches)))
    return bleu_pair.select(F.inline(bleu)).unionByName(mode_facts(runs).select(F.inline(of_runs)))


def report_text(metrics: DataFrame) -> DataFrame:
    """``(category, metric, text)`` of ``metrics_rows``: values as the report prints
    them (P14), BLEU with four digits, hits with none, all others with two."""
    value = F.col("value")
    text = F.when(F.col("metric").isin("baseline_bleu", "finetuned_bleu"), format_metric(value, 4)).when(
        F.col("metric") == "cache_hits", format_metric(value, 0)).otherwise(format_metric(value, 2))
    return metrics.select("category", "metric", text.alias("text"))


def run_series(runs: DataFrame, mode: str, x: str) -> DataFrame:
    """``(model_type, x, elapsed_time, row_no)`` of one mode, ordered by the
    integer x within each model type (A11, W5). A distributed sort, not a
    per-model collect."""
    r = runs_for_mode(runs, mode)
    return (r.select("model_type", F.col(x).cast("int").alias("x"), "elapsed_time", "row_no")
             .orderBy("model_type", "x", "row_no"))


def highlights(runs: DataFrame) -> DataFrame:
    """Labelled best runs ``(label, key, key_value, value)`` (A12): fastest model,
    best batch size, fastest beam, highest cache hits, plus the throughput and
    cache speed-up changes. One row of facts per mode, one read of the runs."""
    def best(mode, key, source, value, label):
        return F.when(F.col("mode") == mode, F.struct(
            F.lit(label).alias("label"), F.lit(key).alias("key"), F.col(source).cast("string").alias("key_value"),
            F.col(value).cast("double").alias("value")))

    def change(shown, label, key, key_value, value):
        return F.when(shown, F.struct(F.lit(label).alias("label"), F.lit(key).alias("key"),
                                      F.lit(key_value).alias("key_value"), value.alias("value")))

    speed = "speed_sent_per_sec"
    rows = F.array_compact(F.array(
        best(MODEL_MODE, "model_type", "speed_model_type", speed, "fastest_model"),
        best(BATCH_MODE, "batch_size", "speed_batch_size", speed, "best_batch_throughput"),
        best(BEAM_MODE, "beam_size", "speed_beam_size", speed, "fastest_beam"),
        best(CACHE_MODE, "cache_enabled", "hits_cache_enabled", "hits_cache_hits", "highest_cache_hits"),
        change(_both_models(), "throughput_change_pct", MODEL_MODE, "finetuned_vs_baseline", _speed_change()),
        change(_both_caches(), "cache_speedup_pct", CACHE_MODE, "on_vs_off", _cache_speedup())))
    return mode_facts(runs).select(F.inline(rows))
