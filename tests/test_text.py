"""Scalar text functions: literal rows from the fixture notes."""

from pyspark.sql import functions as F

from bitext.functions import text as T


def one(spark, col, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {dtype}")
    return [r[0] for r in df.select(col).collect()]


def test_accelerator(spark):
    assert one(spark, T.clean_text("s"), ["_Help", "Ay_uda", "_ foo"]) == ["Help", "Ayuda", " foo"]


def test_control_chars(spark):
    assert one(spark, T.remove_control_chars("s"), ["a\nb", "a\tb", "a\x7fb"]) == ["ab", "a\tb", "a\x7fb"]


def test_whitespace_classes(spark):
    seps = [" ", "\u0085", " ", "　", "\u001c", "\t", " "]
    got = one(spark, T.normalize_space("s"), [f" a{c}{c}b " for c in seps] + [None])
    assert got == ["a b"] * len(seps) + [""]
    # control removal first: U+001C vanishes instead of becoming a space
    assert one(spark, T.clean_text("s"), ["a\u001cb"]) == ["ab"]


def test_whitespace_matches_python_on_all_code_points(spark):
    chars = [chr(i) for i in range(0x3001) if chr(i).isspace() or i in (0x180E, 0x200B, 0xFEFF)]
    got = one(spark, T.normalize_space("s"), [f"x{c}y" for c in chars])
    assert got == [" ".join(f"x{c}y".split()) for c in chars]


def test_mojibake(spark):
    assert one(spark, T.fix_mojibake("s"), ["EspaÃ±a", "naïve", "日本 Ã", "F谩brica", "日本語", None]) == \
        ["España", "naïve", "日本 Ã", "Fábrica", "日本語", None]


def test_tokens_and_counts(spark):
    assert one(spark, T.token_count("s"), ["a  b c", "", None]) == [3, 0, 0]


def test_sentences(spark):
    got = one(spark, T.split_sentences("s"), ["A b.  C? d\r\n\ne.f g! h", "  ", "x. \n y"])
    assert got == [["A b.", "C?", "d", "e.f g!", "h"], [], ["x.", "y"]]


def test_sentences_match_python_regex(spark):
    import re
    pat = re.compile(r"(?<=[.!?])\s+|\r?\n+")
    texts = ["a. b\n\n c!d ?  e", " . x", "one. two? three\r\nfour\n", "q!\n\n  r.", "a\t. b"]
    expect = [[p.strip() for p in pat.split(t.strip()) if p.strip()] for t in texts]
    assert one(spark, T.split_sentences("s"), texts) == expect


def test_safe_float(spark):
    assert one(spark, T.safe_float("s"), ["3.5", "BLEU = 3.5", "x", None]) == [3.5, 3.5, 0.0, 0.0]


def test_pct_change(spark):
    df = spark.createDataFrame([(5.0, 0.0), (3.0, 2.0)], "new double, old double")
    assert [r[0] for r in df.select(T.pct_change("new", "old")).collect()] == [0.0, 50.0]


def test_format_metric(spark):
    df = spark.createDataFrame([(1234.5678,)], "v double")
    assert df.select(T.format_metric("v", 2)).first()[0] == "1234.57"
