"""The two encoding repairs against the codecs themselves."""

import random

from bitext.functions import text as T
from bitext.operators.clean import clean_columns

LETTERS = "abc ?%+é á ñ ü ß漢字锟斤拷€⊕♁谩脿铆�😀"


def cjk(text):
    return sum("一" <= ch <= "鿿" for ch in text)


def by_codec(text):
    """The rule in words: with CJK in it, the text's GBK bytes read as UTF-8, if both
    codecs agree to that and fewer CJK characters come of it."""
    if not cjk(text):
        return text
    try:
        other = str(text.encode("gbk"), "utf-8")
    except UnicodeError:
        return text
    return other if cjk(other) < cjk(text) else text


def test_gbk_repair_equals_the_codec(spark):
    rng = random.Random(8)
    texts = ["F谩brica", "日本語", "锟斤拷", "€ 漢", "⊕漢", "♁漢", "漢 ?", "%3F漢", "a+b漢", "漢", ""]
    for _ in range(1500):
        plain = "".join(rng.choice(LETTERS) for _ in range(rng.randrange(12)))
        texts += [plain, plain.encode().decode("gbk", "ignore")]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(T.fix_mojibake_gbk("s")).collect()]
    assert got == [by_codec(t) for t in texts]
    assert sum(a != b for a, b in zip(got, texts)) > 200


def test_both_repairs_in_a_table_with_nulls(spark):
    rows = [(1, "EspaÃ±a", "F谩brica"), (2, None, "plain"), (3, "日本", None)]
    df = spark.createDataFrame(rows, "line_no long, source string, target string")
    got = sorted((r.line_no, r.source, r.target) for r in clean_columns(df).collect())
    assert got == [(1, "España", "Fábrica"), (2, "", "plain"), (3, "日本", "")]
