"""Hot keys: one pair / one sentence holding a third of all rows."""

from pyspark.sql import functions as F

from bitext.operators.clean import clean_audit
from bitext.operators.split import split_pairs
from bitext.operators.translate import ReverseWordsPredictor
from bitext.operators.vocab import build_vocab
from bitext.plans.corpus import prepare_corpus
from bitext.plans.documents import translate_documents


def skewed_pairs(spark, n=3000):
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.col("id").alias("line_no"),
        F.when(hot, F.lit("the same source line")).otherwise(F.concat(F.lit("source line "), F.col("id").cast("string"))).alias("source"),
        F.when(hot, F.lit("la misma linea")).otherwise(F.concat(F.lit("linea numero "), F.col("id").cast("string"))).alias("target"))


def test_hot_pair_dedup_and_split(spark):
    df = skewed_pairs(spark)
    a = clean_audit(df).first()
    assert (a.input_rows, a.output_rows, a.dropped_dup) == (3000, 2001, 999)
    out = prepare_corpus(df)
    assert out.count() == 2001
    # exact split over the raw (un-deduplicated) rows: the hot pair's copies get
    # distinct keys, so sizes are exact and no bucket is hot
    s = {r.split: r["count"] for r in split_pairs(df).groupBy("split").count().collect()}
    assert s == {"train": 2100, "valid": 450, "test": 450}
    top = split_pairs(df).groupBy(F.substring("split_key", 1, 4)).count().agg(F.max("count")).first()[0]
    assert top < 30


def test_hot_sentence_translation(spark):
    rows = [(i // 10, i % 10, "Hot sentence here." if i % 3 == 0 else f"Sentence {i} here.") for i in range(900)]
    sent = spark.createDataFrame(rows, "doc_id long, pos int, sentence string")
    res = translate_documents(sent, ReverseWordsPredictor())
    tr = res.translations
    assert tr.count() == 900 and tr.filter(F.col("translation").isNull()).count() == 0
    assert tr.filter(F.col("sentence") == "Hot sentence here.").select("translation").distinct().first()[0] == \
        "here. sentence Hot"
    s = res.stats.first()
    assert (s.positions, s.pending, s.hits) == (900, 601, 299)


def test_hot_token_vocab(spark):
    rows = [(i, "the " * 5 + f"w{i % 50}") for i in range(600)]
    v = build_vocab(spark.createDataFrame(rows, "line_no long, text string"), "text").orderBy("rank").collect()
    assert (v[4].token, v[4]["count"]) == ("the", 3000) and len(v) == 4 + 1 + 50
