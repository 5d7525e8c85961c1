"""Cleaning, validity, de-duplication, audits and the reproducible split."""

import pytest
from pyspark.sql import functions as F

from bitext.operators.clean import clean_audit, clean_pairs, valid_pair
from bitext.operators.split import check_ratios, keep_pair, split_pairs
from bitext.plans.corpus import prepare_corpus


def pairs(spark, rows):
    return spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)],
                                 "line_no long, source string, target string")


def test_validity(spark):
    rows = [("translator-credits", "x y"), ("N/A", "nada"), ("a", "bb"), ("OK", "OK"),
            ("Open", "Abrir"), ("abcd", "abcd")]
    got = [r[0] for r in pairs(spark, rows).select(valid_pair()).collect()]
    assert got == [False, False, False, False, True, True]


def test_keep_pair(spark):
    rows = [("a b", "c d e f g h"), ("a b", "c d e f g h i"), ("a", "b"), (" ".join(["w"] * 81), "x y")]
    got = [r[0] for r in pairs(spark, rows).select(keep_pair()).collect()]
    assert got == [True, False, False, False]


def test_clean_dedup_and_audit(spark):
    rows = [("_File", "_Archivo"), ("File", "Archivo"), ("a\nb  c", "x"), ("OK", "OK"),
            ("EspaÃ±a", "Spain"), ("España", "Spain"), (None, "x")]
    df = pairs(spark, rows)
    out = sorted((r.line_no, r.source, r.target) for r in clean_pairs(df).collect())
    assert out == [(0, "File", "Archivo"), (4, "España", "Spain")]
    a = clean_audit(df).first().asDict()
    assert a == {"input_rows": 7, "output_rows": 2, "modified_rows": 4,
                 "dropped_invalid": 3, "dropped_dup": 2}


def test_clean_is_idempotent(spark):
    rows = [("Hello  world", "Hola mundo"), ("Save as", "Guardar como"), ("x\ty", "z w")]
    once = clean_pairs(pairs(spark, rows))
    again = clean_audit(once)
    a = again.first()
    assert a.modified_rows == 0 and a.dropped_invalid == 0 and a.dropped_dup == 0


def test_ratio_checks():
    with pytest.raises(ValueError):
        check_ratios(1.0, 0.1)
    with pytest.raises(ValueError):
        check_ratios(0.7, 0.3)


@pytest.mark.parametrize("n", [808, 10, 1019, 4097])
def test_exact_split_sizes(spark, n):
    df = spark.range(n).select(F.col("id").alias("line_no"),
                               F.concat(F.lit("src "), F.col("id").cast("string")).alias("source"),
                               F.concat(F.lit("tgt "), F.col("id").cast("string")).alias("target"))
    out = split_pairs(df)
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    te = max(1, int(n * 0.7))
    ve = max(te + 1, int(n * (0.7 + 0.15)))
    assert counts == {"train": te, "valid": ve - te, "test": n - ve}
    # exact membership: the first te keys in (split_key, line_no) order are train
    rows = sorted(out.collect(), key=lambda r: (r.split_key, r.line_no))
    assert [r.split for r in rows] == ["train"] * te + ["valid"] * (ve - te) + ["test"] * (n - ve)


def test_split_too_small(spark):
    df = pairs(spark, [("a b", "c d")] * 3)
    with pytest.raises(Exception):
        split_pairs(df).collect()


def test_hash_split_keeps_copies_together(spark):
    rows = [("same pair", "misma frase")] * 50 + [(f"p {i}", f"q {i}") for i in range(200)]
    out = split_pairs(pairs(spark, rows), mode="hash")
    assert out.filter(F.col("source") == "same pair").select("split").distinct().count() == 1
    assert out.count() == 250


def test_prepare_corpus_end_to_end(spark):
    rows = [(f"_word{i} and more", f"palabra{i} y mas") for i in range(40)] + [("x", "y")] * 5
    out = prepare_corpus(pairs(spark, rows))
    got = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert got == {"train": 28, "valid": 6, "test": 6}
    assert out.filter(F.col("source").contains("_")).count() == 0


def test_prepare_corpus_with_audit(spark):
    from bitext.plans.corpus import prepare_corpus_with_audit
    rows = ([(f"_word{i} and more", f"palabra{i} y mas") for i in range(40)] + [("x", "y")] * 5
            + [("one", "uno dos tres cuatro cinco seis siete ocho nueve diez")] * 2)
    split, audit = prepare_corpus_with_audit(pairs(spark, rows))
    a = audit.first().asDict()
    assert a == {"input_rows": 47, "output_rows": 41, "modified_rows": 40, "dropped_invalid": 5,
                 "dropped_dup": 1, "loaded": 41, "dropped_by_filter": 1}
    assert split.count() == 40
