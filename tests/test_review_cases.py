"""Literal cases of earlier wrong answers: folders, checks that vanish, repeated keys, blanks."""
import pytest
from pyspark.sql import functions as F

from bitext.operators.bleu import align_lines, corpus_bleu
from bitext.operators.glossary import glossary_terms
from bitext.operators.memory import memory_keys, memory_lookup, memory_upsert
from bitext.operators.split import split_pairs
from bitext.plans.fixtures import pairs_from_conversations, pairs_from_documents
from bitext.operators.vocab import build_vocab
from bitext.sources.readers import read_bitext, read_memory, read_memory_json, read_pairs_csv, read_translations
from bitext.sources.writers import write_memory, write_pairs, write_split_text, write_translations


def folder(path, *parts):
    path.mkdir()
    for i, lines in enumerate(parts):
        (path / f"part-{i:05d}.txt").write_text("".join(f"{x}\n" for x in lines), encoding="utf-8")
    return str(path)


def test_bitext_of_folders(spark, tmp_path):
    src = folder(tmp_path / "src", ["a0", "a1", "a2"], ["a3"], ["a4", "a5"])
    tgt = folder(tmp_path / "tgt", ["b0"], ["b1", "b2", "b3", "b4", "b5"])
    rows = sorted(tuple(r) for r in read_bitext(spark, src, tgt).collect())
    assert rows == [(i, f"a{i}", f"b{i}") for i in range(6)]


def test_unequal_lengths_fail_for_any_columns(spark, tmp_path):
    src, tgt = folder(tmp_path / "s", ["a", "b", "c"]), folder(tmp_path / "t", ["x", "y"])
    hyp = spark.createDataFrame([(0, "h")], "line_no long, hypothesis string")
    ref = spark.createDataFrame([(0, "r"), (1, "r")], "line_no long, reference string")
    for table in (read_bitext(spark, src, tgt), align_lines(hyp, ref)):
        for action in (lambda t: t.count(), lambda t: t.select(t.columns[-1]).collect(),
                       lambda t: t.select("line_no").collect()):
            with pytest.raises(Exception, match="no partner for line"):
                action(table)


def test_written_splits_read_back(spark, tmp_path):
    pairs = spark.range(200).select(F.col("id").alias("line_no"), F.concat(F.lit("s"), "id").alias("source"),
                                    F.concat(F.lit("t"), "id").alias("target"))
    split = split_pairs(pairs).cache()
    for side in ("source", "target"):
        write_split_text(split, str(tmp_path / side), side)
    for name in ("train", "valid", "test"):
        back = read_bitext(spark, str(tmp_path / "source" / f"split={name}"), str(tmp_path / "target" / f"split={name}"))
        got = [(r.source, r.target) for r in back.orderBy("line_no").collect()]
        assert got == [(r.source, r.target) for r in split.where(F.col("split") == name).orderBy("split_key").collect()]


def test_order_of_csv_files_follows_names(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    (d / "a.csv").write_text("source,target\n1,x\n2,x\n")
    (d / "b.csv").write_text("source,target\n" + "".join(f"{i},y\n" for i in range(3, 3000)))
    for packing in ("134217728", "4096"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", packing)
        try:
            rows = read_pairs_csv(spark, str(d)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted((r.line_no, int(r.source)) for r in rows) == [(i, i + 1) for i in range(2999)]


def test_no_match_scores_zero(spark):
    rows = spark.createDataFrame([(0, "a b c d e", "v w x y z")], "line_no long, hypothesis string, reference string")
    assert corpus_bleu(rows).first().bleu == 0.0


@pytest.mark.parametrize("mode", ["exact", "hash"])
def test_too_few_pairs(spark, mode):
    few = spark.createDataFrame([(0, "a", "b")], "line_no long, source string, target string")
    for table in (few, few.limit(0)):
        with pytest.raises(ValueError):
            split_pairs(table, mode=mode)
    assert split_pairs(few, mode=mode, min_pairs=1).count() == 1


def test_split_does_not_depend_on_partitions(spark):
    pairs = spark.range(500).select(F.col("id").alias("line_no"), F.lit("same").alias("source"), F.lit("t").alias("target"))
    label = lambda df: sorted((r.line_no, r.split) for r in split_pairs(df).collect())
    assert label(pairs.repartition(1)) == label(pairs.repartition(9))


def test_blanks_survive_csv(spark, tmp_path):
    rows = [(" lead", "trail "), ("\ttab", "  ")]
    write_pairs(spark.createDataFrame(rows, "source string, target string"), str(tmp_path / "p"), fmt="csv")
    assert sorted((r.source, r.target) for r in read_pairs_csv(spark, str(tmp_path / "p")).collect()) == sorted(rows)


def test_memory_keys_and_repeats(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('{"a": "1", "b": "x", "a": "2", "c": "3", "c": null}')
    memory = read_memory_json(spark, str(path))
    assert sorted(map(tuple, memory.collect()), key=str) == [("a", "2"), ("b", "x"), ("c", None)]
    doubled = spark.createDataFrame([("a", "1"), ("a", "2")], "source string, translation string")
    sentences = spark.createDataFrame([("a",), ("z",)], "sentence string")
    assert sorted((r.sentence, r.hit) for r in memory_lookup(sentences, doubled).collect()) == [("a", True), ("z", False)]
    new = spark.createDataFrame([("a", None), ("n", "5")], "source string, translation string")
    assert sorted(map(tuple, memory_upsert(memory, new).collect()), key=str) == [
        ("a", None), ("b", "x"), ("c", None), ("n", "5")]
    keyed = memory_keys(sentences.withColumn("beam", F.lit(5)), "beam")
    assert {r.sentence for r in keyed.collect()} == {"a\u001f5", "z\u001f5"}
    assert memory_keys(sentences).collect() == sentences.collect()


def test_glossary_trims_all_blanks(spark):
    rows = spark.createDataFrame([(0, "\tterm\u00a0", "\u3000ziel ")], "ord long, source_term string, target_term string")
    assert [tuple(r) for r in glossary_terms(rows).collect()] == [(0, "term", "ziel")]


def test_every_line_and_turn_takes_part(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "one"), (3, None)], "doc_id long, text string")
    got = sorted((r.line_no % 2**31, r.source, r.target) for r in pairs_from_documents(docs).collect())
    assert got == [(1, "a", "b"), (1, "one", ""), (2, "b", "c"), (3, "c", "")]
    turns = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 3, "user", "v")],
                                  "conv_id long, turn int, role string, text string")
    assert sorted((r.source, r.target) for r in pairs_from_conversations(turns).collect()) == [
        ("s", "u"), ("u", ""), ("v", "")]


def test_text_translations_keep_their_document(spark, tmp_path):
    rows = [("d1", "x\ny"), ("d2", ""), ("d3", "z"), ("d0", "\n"), ("d4", None)]
    rows += [(f"e{i:03d}", "\n".join(f"{i}-{j}\r" for j in range(i % 7))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, translation string").repartition(5)
    write_translations(docs, str(tmp_path / "out"), fmt="text")
    assert not [p for p in (tmp_path / "out").rglob("*doc_id*")]
    got = {}
    for r in read_translations(spark, str(tmp_path / "out")).orderBy("doc_id", "pos").collect():
        assert r.pos == len(got.setdefault(r.doc_id, []))
        got[r.doc_id].append(r.translation)
    assert got == {d: t.split("\n") for d, t in rows if t}
    manifest = spark.read.parquet(str(tmp_path / "out" / "manifest"))
    assert manifest.count() == len(rows) and manifest.where("lines = 0").count() == 2 + 9


def test_memory_snapshots(spark, tmp_path):
    schema, base = "source string, translation string", str(tmp_path / "memory")
    assert read_memory(spark, base).collect() == []
    write_memory(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], schema), base, "20240101_000000")
    write_memory(spark.createDataFrame([("b", "3"), ("d", ""), ("a", None), ("d", "x")], schema), base, "20240102_000000")
    got = {r.source: r.translation for r in read_memory(spark, base).collect()}
    assert got == {"a": None, "b": "3", "c": None, "d": "x"}


def test_json_layouts(spark, tmp_path):
    import json
    big = {f"key {i}": f"value, {i}," for i in range(4000)} | {"q\"uote": "br{ace}", "nul": None, "t": True}
    cases = {"a.json": (json.dumps(big, indent=2, ensure_ascii=False), big),
             "b.json": (json.dumps({"one": "cell"}), {"one": "cell"}),
             "c.json": ('{\n  "x": "1",\n  "y": "2"\n', {}), "d.json": ('{\n  "x": "1"\n  "y": "2"\n}', {}),
             "e.json": ('{\n  "x": "1",\n  "y": "2",\n}', {}), "f.json": ("[1, 2]", {}), "g.json": ("{}", {}),
             "h.json": ('\ufeff{\r\n  "crlf": "yes"\r\n}', {"crlf": "yes"}), "i.json": ("", {})}
    for name, (text, want) in cases.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
        want = {k: "true" if v is True else v for k, v in want.items()}
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        try:
            got = {r.source: r.translation for r in read_memory_json(spark, str(tmp_path / name)).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == want, name


def test_any_document_id(spark):
    docs = spark.createDataFrame([(2**62, "a b c\nd e f"), (-2**63, "g h i\nj k l")], "doc_id long, text string")
    pairs = pairs_from_documents(docs)
    assert sorted(int(r.line_no) for r in pairs.collect()) == [
        -2**94 + 1, -2**94 + 2, 2**93 + 1, 2**93 + 2]
    assert build_vocab(pairs, "source").count() == 16
    assert split_pairs(pairs, min_pairs=1).count() == 4
