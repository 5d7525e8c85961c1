"""BLEU against a brute-force implementation; run reports; repeat rows."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bitext.operators.bleu import align_lines, corpus_bleu, evaluate_systems
from bitext.operators.runs import (best_rows, cache_compare, compare_runs, concat_runs, metrics_rows,
                                   model_compare,
                                   repeat_rows, run_series, throughput)

_R = [(re.compile(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])"), r" \1 "), (re.compile(r"([^0-9])([\.,])"), r"\1 \2 "),
      (re.compile(r"([\.,])([^0-9])"), r" \1 \2"), (re.compile(r"([0-9])(-)"), r"\1 \2 ")]


def tok(line):
    line = line.rstrip().replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    for a, b in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        line = line.replace(a, b)
    line = f" {line} "
    for r, s in _R:
        line = r.sub(s, line)
    return line.split()


def brute_bleu(hyps, refs):
    correct, total = [0] * 4, [0] * 4
    sl = rl = 0
    for h, r in zip(hyps, refs):
        h, r = tok(h), tok(r)
        sl, rl = sl + len(h), rl + len(r)
        for n in range(1, 5):
            hc = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
            rc = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
            correct[n - 1] += sum(min(c, rc[g]) for g, c in hc.items())
            total[n - 1] += max(0, len(h) - n + 1)
    if not any(correct):
        return correct, total, sl, rl, 0.0  # smoothing is for some orders without a match
    prec, smooth = [0.0] * 4, 1.0
    for n in range(4):
        if total[n] == 0:
            break
        if correct[n] == 0:
            smooth *= 2
            prec[n] = 100.0 / (smooth * total[n])
        else:
            prec[n] = 100.0 * correct[n] / total[n]
    bp = 1.0 if sl >= rl else (math.exp(1 - rl / sl) if sl > 0 else 0.0)
    score = bp * math.exp(sum(math.log(p) if p > 0 else -9999999999 for p in prec) / 4)
    return correct, total, sl, rl, score


CASES = [
    (["the cat sat on the mat .", "a b c d", "hello, world!", "1-2 3.5 x.y", "&amp; fish &lt;3"],
     ["the cat sat on a mat.", "a b c e", "Hello, world!", "1-2 3.5 x. y", "& fish <3"]),
    (["the the the the", "x y"], ["the cat the", "x y"]),
    (["short"], ["a much longer reference sentence here"]),
    (["well-\nknown fact-\n", "trailing space  \t"], ["well-known fact-", "trailing space"]),
    (["a a a b b a a a", "a b a b a b a b a", "", "x y z"], ["a a b b b a a", "b a b a b a a a b", "y", "p q r"]),
    (["x"], ["y"]),
]


def test_bleu_of_random_repeats(spark):
    import random
    rng = random.Random(3)
    rows = [(k, i, " ".join(rng.choice("abc") for _ in range(rng.randrange(14))),
             " ".join(rng.choice("abc") for _ in range(rng.randrange(14)))) for k in ("p", "q") for i in range(60)]
    rows += rows[:5]  # equal rows are sentences of their own
    df = spark.createDataFrame(rows, "system string, line_no long, hypothesis string, reference string").repartition(6)
    for row in evaluate_systems(df).collect():
        some = [r for r in rows if r[0] == row.system]
        c, t, sl, rl, score = brute_bleu([r[2] for r in some], [r[3] for r in some])
        assert [row[f"correct_{n}"] for n in range(1, 5)] == c and [row[f"total_{n}"] for n in range(1, 5)] == t
        assert (row.sys_len, row.ref_len) == (sl, rl) and row.bleu == pytest.approx(score, rel=1e-9)


def test_bleu_of_no_rows(spark):
    row = corpus_bleu(spark.createDataFrame([], "hypothesis string, reference string")).first()
    assert (row.sys_len, row.total_1, row.bleu) == (0, 0, 0.0)


@pytest.mark.parametrize("hyps,refs", CASES)
def test_bleu_matches_brute_force(spark, hyps, refs):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(zip(hyps, refs))],
                               "line_no long, hypothesis string, reference string")
    row = corpus_bleu(df).first()
    c, t, sl, rl, score = brute_bleu(hyps, refs)
    assert [row[f"correct_{n}"] for n in range(1, 5)] == c
    assert [row[f"total_{n}"] for n in range(1, 5)] == t
    assert (row.sys_len, row.ref_len) == (sl, rl)
    assert row.bleu == pytest.approx(score, rel=1e-9, abs=1e-12)


def test_two_token_hypothesis_has_no_higher_orders(spark):
    df = spark.createDataFrame([(0, "a b", "a b c")], "line_no long, hypothesis string, reference string")
    row = corpus_bleu(df).first()
    assert (row.total_3, row.total_4, row.bleu) == (0, 0, 0.0)


def test_systems_and_alignment(spark):
    ref = spark.createDataFrame([(0, "a b c d"), (1, "e f g h")], "line_no long, reference string")
    hyp = spark.createDataFrame([(0, "a b c d"), (1, "e f x h")], "line_no long, hypothesis string")
    al = align_lines(hyp, ref)
    stacked = al.withColumn("system", F.lit("s1")).unionByName(
        al.withColumn("hypothesis", F.col("reference")).withColumn("system", F.lit("s2")))
    got = {r.system: r.bleu for r in evaluate_systems(stacked).collect()}
    assert got["s2"] == pytest.approx(100.0)
    assert got["s1"] < 100.0
    short = hyp.filter("line_no = 0")
    with pytest.raises(Exception):
        align_lines(short, ref).collect()


# Run rows of a published experiment table, so that the report's figures
# (0.47 and -0.47 %, 55449681.41 %, 0.29 %) can be compared.
RUN_ROWS = [
    ("model_compare", "baseline", 4, 5, True, False, 2.107196, 3, 1.4237, 0),
    ("model_compare", "finetuned", 4, 5, True, False, 2.097289, 3, 1.4304, 0),
    ("batch_compare", "finetuned", 1, 5, True, False, 2.136247, 3, 1.4043, 0),
    ("batch_compare", "finetuned", 4, 5, True, False, 2.178663, 3, 1.377, 0),
    ("batch_compare", "finetuned", 8, 5, True, False, 2.134059, 3, 1.4058, 0),
    ("cache_compare", "finetuned", 4, 5, True, False, 2.606132, 18, 6.9068, 0),
    ("cache_compare", "finetuned", 4, 5, True, True, 5e-06, 18, 3829805.5027, 18),
]


def runs_df(spark):
    from bitext.operators.runs import RUNS_SCHEMA
    rows = [r + (i,) for i, r in enumerate(RUN_ROWS)]
    return spark.createDataFrame(rows, RUNS_SCHEMA + ", row_no long")


def test_reports(spark):
    runs = runs_df(spark)
    m = model_compare(runs).first()
    assert round(m.speed_change_pct, 2) == 0.47 and round(m.latency_change_pct, 2) == -0.47
    c = cache_compare(runs).first()
    assert round(c.cache_speedup_pct, 2) == 55449681.41
    assert c.cache_latency_reduction_pct == pytest.approx((2.606132 - 5e-06) / 2.606132 * 100)
    g = compare_runs(runs, "model_compare", "model_type", "baseline", "finetuned").first()
    assert (g.a_sent_per_sec, g.b_sent_per_sec) == (1.4237, 1.4304)
    assert g.sent_per_sec_change_pct == m.speed_change_pct
    assert compare_runs(runs, "cache_compare", "cache_enabled", False, True).first().b_sent_per_sec == 3829805.5027
    assert compare_runs(runs, "beam_compare", "model_type", "baseline", "finetuned").count() == 0
    best = {r.mode: r.batch_size for r in best_rows(runs, "sent_per_sec").collect()}
    assert best["batch_compare"] == 8
    bp = spark.createDataFrame([(20.97, 21.03)], "baseline_bleu double, finetuned_bleu double")
    mr = {r.metric: r.value for r in metrics_rows(bp, runs).collect()}
    assert mr["bleu_improvement_pct"] == 0.29 and mr["cache_hits"] == 18.0 and len(mr) == 8
    xs = [(r.model_type, r.x) for r in run_series(runs, "batch_compare", "batch_size").collect()]
    assert xs == [("finetuned", 1), ("finetuned", 4), ("finetuned", 8)]


def test_sortable_bits_order_all_doubles(spark):
    import random
    import struct
    from bitext.operators.runs import sortable_bits
    rng = random.Random(4)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values += [float(2.0 ** e) * f for e in range(-1074, 1023) for f in (1, 1 + 2.0 ** -52, 1 - 2.0 ** -53)]
    values += [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, float("inf"), float("-inf"), 3829805.5027]
    values = [v for v in values if v == v]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    for r in df.select("x", sortable_bits(F.col("x")).alias("b")).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.b == (-bits if r.x < 0 else bits), r.x


def test_best_rows_ties_and_text(spark):
    from bitext.operators.runs import RUNS_SCHEMA, report_text
    rows = [("m", kind, i, 1, True, False, 1.0, 3, speed, None, i) for i, (kind, speed) in enumerate(
        [("b", 1.0), ("a", 2.5), ("b", 2.5), (None, -1.0), ("c", None)])] + [(None, "x", 9, 1, True, True, 1.0, 1, 7.0, 1, 99)]
    runs = spark.createDataFrame(rows, RUNS_SCHEMA + ", row_no long")
    best = {r.mode: (r.row_no, r.model_type, r.batch_size) for r in best_rows(runs, "sent_per_sec").collect()}
    assert best == {"m": (1, "a", 1), None: (99, "x", 9)}
    low = {r.mode: r.row_no for r in best_rows(runs, "sent_per_sec", higher_is_better=False).collect()}
    assert low == {"m": 3, None: 99}
    table = spark.createDataFrame([("bleu", "baseline_bleu", 20.97, ""), ("cache", "cache_hits", 18.0, ""),
                                   ("latency", "x_pct", -0.5, "")], "category string, metric string, value double, notes string")
    assert [r.text for r in report_text(table).collect()] == ["20.9700", "18", "-0.50"]


def test_reports_missing_modes(spark):
    runs = runs_df(spark).filter("mode = 'batch_compare'")
    bp = spark.createDataFrame([(0.0, 0.0)], "baseline_bleu double, finetuned_bleu double")
    assert metrics_rows(bp, runs).count() == 3


def test_throughput_and_repeat(spark):
    df = spark.createDataFrame([(3, 2.0), (3, 0.0)], "num_sentences int, elapsed_raw double")
    got = [r.sent_per_sec for r in throughput(df).collect()]
    assert got == [1.5, 0.0]
    assert repeat_rows(df, 6).count() == 12 and repeat_rows(df, 0).count() == 0
    assert concat_runs(df, df).count() == 4
