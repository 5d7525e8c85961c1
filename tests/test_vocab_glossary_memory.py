"""Vocabulary, glossary protection, translation memory and the translation flow."""

import pytest
from pyspark.sql import functions as F

from bitext.operators.glossary import glossary_terms, mapping_text, protect_terms, restore_terms
from bitext.operators.memory import cache_hits, memory_lookup, memory_upsert, pending_sentences
from bitext.operators.translate import PhraseTablePredictor, ReverseWordsPredictor, translate_batch
from bitext.operators.vocab import build_vocab
from bitext.plans.documents import reassemble, segment_documents, translate_documents


def test_vocab_order_and_specials(spark):
    lines = spark.createDataFrame([(0, "b a <s> a"), (1, "c b d"), (2, "d e")], "line_no long, text string")
    v = [(r.token, r["count"], r.rank) for r in build_vocab(lines, "text").orderBy("rank").collect()]
    assert v[:4] == [("<blank>", 1000000, 1), ("<s>", 1000000, 2), ("</s>", 1000000, 3), ("<unk>", 1000000, 4)]
    # counts desc; ties by first occurrence (line, then position)
    assert v[4:] == [("b", 2, 5), ("a", 2, 6), ("d", 2, 7), ("c", 1, 8), ("e", 1, 9)]
    capped = build_vocab(lines, "text", max_size=2).collect()
    assert len(capped) == 6


def test_vocab_rank_matches_sort(spark):
    import random
    random.seed(7)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(random.choice(words[: 5 + i % 50]) for _ in range(8))) for i in range(300)]
    df = spark.createDataFrame(rows, "line_no long, text string")
    got = [(r.token, r["count"]) for r in build_vocab(df, "text").orderBy("rank").collect()][4:]
    counts, first = {}, {}
    for ln, t in rows:
        for p, w in enumerate(t.split()):
            counts[w] = counts.get(w, 0) + 1
            first.setdefault(w, (ln, p))
    expect = sorted(counts, key=lambda w: (-counts[w], first[w]))
    assert [w for w, _ in got] == expect


def test_protect_restore(spark):
    df = spark.createDataFrame([("Machine Translation and bleu",), ("nothing here",)], "s string")
    g = [("machine translation", "traduccion automatica"), ("BLEU", "puntuacion BLEU")]
    out = protect_terms(df, "s", g).select("protected", mapping_text("term_map").alias("m"),
                                            restore_terms("protected", "term_map").alias("r")).collect()
    assert out[0].protected == "__TERM_0__ and __TERM_1__"
    assert out[0].m == "__TERM_0__=traduccion automatica|__TERM_1__=puntuacion BLEU"
    assert out[0].r == "traduccion automatica and puntuacion BLEU"
    assert out[1].protected == "nothing here" and out[1].m == ""


def ordered_terms(spark, glossary):
    rows = glossary_terms(glossary, spark).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(len(rows)))
    return [(r.source_term, r.target_term) for r in rows]


def test_glossary_rules(spark):
    assert ordered_terms(spark, [("a", "1"), ("bbb", "2"), ("cc", "3"), ("a", "4"), (" ", "x")]) == \
        [("bbb", "2"), ("cc", "3"), ("a", "4")]
    gdf = spark.createDataFrame([(1, " term ", "t1"), (2, "longer term", "t2"), (3, "term", "t3")],
                                "ord int, source_term string, target_term string")
    assert ordered_terms(spark, gdf) == [("longer term", "t2"), ("term", "t3")]
    assert ordered_terms(spark, []) == []


def sequential(text, terms):
    """The definition: every term over the text as the terms before it left it."""
    import re
    found = []
    for i, (term, target) in enumerate(terms):
        pattern = re.compile(re.escape(term), re.IGNORECASE)
        if pattern.search(text):
            text = pattern.sub(f"__TERM_{i}__", text)
            found.append(f"__TERM_{i}__={target}")
    return text, "|".join(found)


def test_protect_equals_sequential_definition(spark):
    import random
    rng = random.Random(5)
    terms = ["the", "and the", "cat", "term", "er", "m", "_", "__", "0__", "_x", "x_", "7", "__TERM_1__", "t", "ab_", "a",
             "bleu score", "score.", "EÑE", "erm", "1__ ", " __t", "zz"]
    words = ["The", "and", "THE", "cat", "term", "x", "7", "bleu", "score.", "eñe", "_", "ab_cat", "zebra", "m", "a"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) for _ in range(120)] + ["", None, "nothing"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1000, texts[0])], "i int, s string")
    for some in (terms, terms[:3], ["m", "er"], ["zz"], []):
        glossary = [(t, f"<{k}>") for k, t in enumerate(some)]
        ordered = ordered_terms(spark, glossary)
        out = protect_terms(df, "s", glossary).select("i", "s", "protected", mapping_text("term_map").alias("m")).collect()
        assert len(out) == len(texts) + 1
        for r in out:
            assert (r.protected, r.m) == sequential(r.s or "", ordered), (r.s, ordered)


def test_many_terms_and_case_folding(spark):
    terms = [(f"word{i:04d}", f"w{i}") for i in range(3000)] + [("STRAßE", "calle"), ("kelvin", "K"), ("istanbul", "I")]
    rows = [("WORD0007 and word2999x", "__TERM"), ("straße", ""), ("\u212aelvin", ""), ("\u0130STANBUL", ""), ("none", "")]
    df = spark.createDataFrame(rows, "s string, protected_before string")
    got = {r.s: r.m for r in protect_terms(df, "s", terms).select("s", mapping_text("term_map").alias("m")).collect()}
    assert got["WORD0007 and word2999x"].endswith("=w7|__TERM_2999__=w2999") or "=w2999" in got["WORD0007 and word2999x"]
    assert got["straße"].endswith("=calle") and got["\u212aelvin"].endswith("=K") and got["\u0130STANBUL"].endswith("=I")
    assert got["none"] == ""


def test_protect_regex_metacharacters(spark):
    df = spark.createDataFrame([("cost is $5 (approx.) \\E end",)], "s string")
    out = protect_terms(df, "s", [("$5 (approx.)", "5 USD"), ("\\E", "E")]).first()
    assert out.protected == "cost is __TERM_0__ __TERM_1__ end"


def test_memory_presence_is_hit(spark):
    sent = spark.createDataFrame([(0, 0, "x"), (0, 1, "z"), (0, 2, "z")], "doc_id long, pos int, sentence string")
    mem = spark.createDataFrame([("x", "")], "source string, translation string")
    hits = sorted((r.pos, r.hit) for r in memory_lookup(sent, mem).collect())
    assert hits == [(0, True), (1, False), (2, False)]
    c = cache_hits(sent, mem).first()
    assert (c.positions, c.hits, c.pending) == (3, 2, 1)
    assert [r.sentence for r in pending_sentences(sent, mem).collect()] == ["z"]
    up = {r.source: r.translation for r in memory_upsert(mem, spark.createDataFrame(
        [("x", "X"), ("z", "Z")], "source string, translation string")).collect()}
    assert up == {"x": "X", "z": "Z"}


def test_translate_flow(spark):
    docs = spark.createDataFrame([(1, "Hello there. Hello there. The glossary works!"), (2, "")],
                                 "doc_id long, text string")
    sent = segment_documents(docs)
    mem = spark.createDataFrame([("The glossary works!", "")], "source string, translation string")
    res = translate_documents(sent, ReverseWordsPredictor(), glossary=[("glossary", "glosario")], memory=mem)
    rows = sorted((r.pos, r.translation, r.hit) for r in res.translations.collect())
    # ``hit`` = served from memory; the repeat at pos 1 still counts in ``hits``
    assert rows == [(0, "there. Hello", False), (1, "there. Hello", False), (2, "", True)]
    s = res.stats.first()
    assert (s.positions, s.hits, s.pending) == (3, 2, 1)
    docs_out = reassemble(res.translations).first()
    assert docs_out.translation == "there. Hello\nthere. Hello\n"
    off = translate_documents(sent, PhraseTablePredictor({"Hello": "Hola"}), memory=mem, cache_enabled=False)
    assert off.stats.first().hits == 0
    assert sorted(r.translation for r in off.translations.collect())[0] == "Hola there."


def test_translate_glossary_placeholders(spark):
    sent = spark.createDataFrame([(0, 0, "use the glossary now")], "doc_id long, pos int, sentence string")
    res = translate_documents(sent, ReverseWordsPredictor(), glossary=[("the glossary", "el glosario")])
    assert res.translations.first().translation == "now el glosario use"


def test_predictor_count_mismatch(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    with pytest.raises(Exception):
        translate_batch(df, "s", lambda batch: []).collect()


def test_model_and_options_reach_the_predictor(spark, tmp_path):
    class CountingModel:
        """Writes a file per load, and answers with its options."""

        def __init__(self, folder):
            self.folder = folder

        def load(self, model):
            import os
            import uuid
            self.model = model
            open(os.path.join(self.folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()

        def __call__(self, batch, beam_size=1):
            lengths = [len(t) for t in batch]
            assert max(lengths) - min(lengths) <= 2  # texts of like length share a batch
            return [f"{self.model}:{beam_size}:{t}" for t in batch]

    rows = [(i, "x" * (1 + i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, s string").repartition(8)
    model = CountingModel(str(tmp_path))
    out = translate_batch(df, "s", model, batch_size=4, model="finetuned", options={"beam_size": 5}).collect()
    assert {r.i: r.translation for r in out} == {i: f"finetuned:5:{t}" for i, t in rows}
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads))  # once per worker process, not per task


def test_statistics_do_not_run_the_model(spark):
    def fails(batch):
        raise AssertionError("the model ran")

    sent = spark.createDataFrame([(0, 0, "a b"), (0, 1, "a b"), (1, 0, "c")], "doc_id long, pos int, sentence string")
    result = translate_documents(sent, fails)
    s = result.stats.first()
    assert (s.positions, s.hits, s.pending) == (3, 1, 2)
    with pytest.raises(Exception):
        result.translations.collect()


def test_repeated_memory_keys_count_once(spark):
    sent = spark.createDataFrame([(0, 0, "a b"), (0, 1, "c d")], "doc_id long, pos int, sentence string")
    mem = spark.createDataFrame([("a b", "1"), ("a b", "2"), ("z", "3"), ("z", None)], "source string, translation string")
    res = translate_documents(sent, ReverseWordsPredictor(), memory=mem)
    assert sorted((r.pos, r.translation) for r in res.translations.collect()) == [(0, "2"), (1, "d c")]
    s = res.stats.first()
    assert (s.positions, s.hits, s.pending) == (2, 1, 1)
    assert sorted(tuple(r) for r in res.memory.collect()) == [("a b", "2"), ("c d", "d c"), ("z", "3")]
    assert [tuple(r) for r in res.new_entries.collect()] == [("c d", "d c")]
    new = spark.createDataFrame([("z", "4"), ("z", "5"), ("q", "6")], "source string, translation string")
    assert sorted(tuple(r) for r in memory_upsert(mem, new).collect()) == [("a b", "2"), ("q", "6"), ("z", "5")]


def test_documents_without_sentences_stay(spark):
    docs = spark.createDataFrame([(1, "One here. Two."), (2, ""), (3, None)], "doc_id long, text string")
    done = segment_documents(docs).select("doc_id", "pos", F.col("sentence").alias("translation"))
    got = {r.doc_id: r.translation for r in reassemble(done, documents=docs).collect()}
    assert got == {1: "One here.\nTwo.", 2: "", 3: ""}
