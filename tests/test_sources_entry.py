"""Sources, sinks and the driver entry points."""

import json
import os

import pytest

from bitext.operators.glossary import glossary_terms
from bitext.operators.vocab import build_vocab
from bitext.sources.readers import (read_bitext, read_documents, read_glossary, read_memory_json,
                                    read_pairs_csv, read_runs_csv)
from bitext.sources.writers import snapshot_path, write_memory, write_pairs, write_vocab
from tests.conftest import SF_SMALL


def test_pairs_csv(spark, tmp_path):
    p = tmp_path / "pairs.csv"
    p.write_text('﻿source,target,extra\n"Open ""file""",Abrir\n"two\nlines",dos\nshort\n', encoding="utf-8")
    rows = sorted((r.line_no, r.source, r.target) for r in read_pairs_csv(spark, str(p), multi_line=True).collect())
    assert [(s, t) for _, s, t in rows] == [('Open "file"', "Abrir"), ("two\nlines", "dos"), ("short", None)]
    norm = read_pairs_csv(spark, str(p), normalize=True, multi_line=True).collect()
    assert sorted(r.source for r in norm) == ['Open "file"', "two lines"]
    with pytest.raises(ValueError):
        read_pairs_csv(spark, str(p), source_col="en")


def test_bitext_alignment(spark, tmp_path):
    a, b = tmp_path / "a.en", tmp_path / "b.es"
    a.write_text("﻿one\ntwo\n\nfour\n", encoding="utf-8")
    b.write_text("uno\r\ndos\r\n\r\ncuatro\r\n", encoding="utf-8")
    rows = sorted((r.line_no, r.source, r.target) for r in read_bitext(spark, str(a), str(b)).collect())
    assert rows == [(0, "one", "uno"), (1, "two", "dos"), (2, "", ""), (3, "four", "cuatro")]
    c = tmp_path / "c.es"
    c.write_text("uno\n", encoding="utf-8")
    with pytest.raises(Exception):
        read_bitext(spark, str(a), str(c)).collect()


def test_documents_glossary_memory_runs(spark, tmp_path):
    d = tmp_path / "doc.txt"
    d.write_text("﻿  Hello. World  \n", encoding="utf-8")
    assert read_documents(spark, str(d)).first().text == "Hello. World"
    g = tmp_path / "g.csv"
    g.write_text("source,target\nmachine translation,traduccion\nBLEU,puntuacion\nBLEU,otra\n , x\n",
                 encoding="utf-8")
    terms = glossary_terms(read_glossary(spark, str(g))).orderBy("position").collect()
    assert [r[1:] for r in terms] == [("machine translation", "traduccion"), ("BLEU", "otra")]
    m = tmp_path / "m.json"
    m.write_text(json.dumps({"a": "", "b": "B"}), encoding="utf-8")
    assert sorted((r.source, r.translation) for r in read_memory_json(spark, str(m)).collect()) == \
        [("a", ""), ("b", "B")]
    bad = tmp_path / "bad.json"
    bad.write_text("{not json", encoding="utf-8")
    assert read_memory_json(spark, str(bad)).count() == 0
    assert read_memory_json(spark, str(tmp_path / "missing.json")).count() == 0
    assert read_runs_csv(spark, str(tmp_path / "missing.csv")).count() == 0
    r = tmp_path / "runs.csv"
    r.write_text("mode,model_type,batch_size,beam_size,glossary_enabled,cache_enabled,elapsed_time,"
                 "num_sentences,sent_per_sec,cache_hits\nmodel_compare,baseline,4,5,True,False,2.1,3,1.42,0\n")
    row = read_runs_csv(spark, str(r)).first()
    assert row.glossary_enabled is True and row.cache_enabled is False and row.batch_size == 4


def test_writers(spark, tmp_path):
    lines = spark.createDataFrame([(0, "b a a")], "line_no long, text string")
    out = str(tmp_path / "vocab")
    write_vocab(build_vocab(lines, "text"), out)
    text = "".join(open(os.path.join(out, f), encoding="utf-8").read()
                   for f in sorted(os.listdir(out)) if f.startswith("part-"))
    assert text.splitlines()[4:] == ["a\t2", "b\t1"]
    mem = spark.createDataFrame([("x", "X")], "source string, translation string")
    path = write_memory(mem, str(tmp_path / "memory"), ts="20260101_000000")
    assert path.endswith("snapshot=20260101_000000") and spark.read.parquet(path).count() == 1
    assert snapshot_path("/a/b/", "t") == "/a/b/snapshot=t"
    write_pairs(spark.createDataFrame([("a", "b")], "source string, target string"), str(tmp_path / "p"), fmt="csv")


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert set(df.columns) == {"split", "pairs", "src_tokens", "tgt_tokens"}
    assert df.count() == 3
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 30


def test_split_writers(spark, tmp_path):
    from pyspark.sql import functions as F

    from bitext.operators.split import split_pairs
    from bitext.sources.writers import write_split_text, write_splits
    df = spark.range(200).select(F.col("id").alias("line_no"),
                                 F.concat(F.lit("s"), F.col("id").cast("string")).alias("source"),
                                 F.concat(F.lit("t"), F.col("id").cast("string")).alias("target"))
    sp = split_pairs(df)
    write_splits(sp, str(tmp_path / "parq"))
    back = spark.read.parquet(str(tmp_path / "parq"))
    assert {r.split: r["count"] for r in back.groupBy("split").count().collect()} == \
        {"train": 140, "valid": 30, "test": 30}
    for side in ("source", "target"):
        write_split_text(sp, str(tmp_path / side), side)

    def lines(side, split):
        d = tmp_path / side / f"split={split}"
        return [ln for f in sorted(os.listdir(d)) if f.startswith("part-")
                for ln in open(d / f, encoding="utf-8").read().splitlines()]
    src, tgt = lines("source", "test"), lines("target", "test")
    assert len(src) == 30 and [s[1:] for s in src] == [t[1:] for t in tgt]
    expect = [r.source for r in sorted(sp.filter("split = 'test'").collect(), key=lambda r: r.split_key)]
    assert src == expect
