"""Steps that must be computed once per row or text, read from the optimized plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bitext._util import computed
from bitext.operators.split import keep_pair, normalize_pairs
from bitext.plans import fixtures as fx


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sides_are_normalized_once_below_the_filters(spark):
    pairs = spark.createDataFrame([(1, " a  b ", "c d"), (2, "a b", " "), (3, None, "c"), (4, "a", "b c d e")],
                                  "line_no long, source string, target string")
    kept = normalize_pairs(pairs).filter(keep_pair(normalized=True))
    assert [tuple(r) for r in kept.collect()] == [(1, "a b", "c d")]
    plan = optimized(kept)
    assert plan.count("regexp_replace(") == 2  # one per side, however many conditions
    assert plan.count("split(") == 2  # tokens are counted once per side


def test_computed_replaces_in_place_and_appends(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "b")], "`a.b` int, x string, y string")
    out = computed(df, x=F.concat("x", F.lit("!")), z=F.coalesce("y", F.lit("-")))
    assert out.columns == ["a.b", "x", "y", "z"]
    assert sorted(map(tuple, out.collect())) == [(1, "a!", None, "-"), (2, None, "b", "b")]


def test_a_text_is_split_once_for_all_its_lines(spark):
    docs = spark.createDataFrame([(1, "a\nb\n\nc"), (7, ""), (10, "x\ny"), (3, None)], "doc_id long, text string")
    pairs = fx.pairs_from_documents(docs)
    assert optimized(pairs).count("split(") == 1
    rows = sorted((int(r.line_no) >> 31, int(r.line_no) % (1 << 31), r.source, r.target) for r in pairs.collect())
    assert rows == [(1, 1, "a", "b"), (1, 2, "b", ""), (1, 3, "", "c"), (1, 4, "c", ""), (7, 1, "_", ""),
                    (10, 1, "x", "y\r"), (10, 2, "y", "\r")]


def test_lines_of_translations_are_not_broadcast(spark, tmp_path):
    from bitext.sources.readers import read_translations
    from bitext.sources.writers import write_translations
    docs = spark.createDataFrame([(1, "a\nb"), (2, ""), (3, "c")], "doc_id long, translation string")
    write_translations(docs, str(tmp_path / "t"), fmt="text")
    back = read_translations(spark, str(tmp_path / "t"))
    assert "BroadcastHashJoin [line_no" not in back._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, back.collect())) == [(1, 0, "a"), (1, 1, "b"), (3, 0, "c")]


def test_fan_out_is_the_only_join_after_the_model(spark):
    from bitext.operators.translate import ReverseWordsPredictor
    from bitext.plans.documents import translate_documents
    rows = [(1, 0, "a b"), (1, 1, "c d"), (2, 0, "a b"), (2, 1, ""), (2, 2, None)]
    sentences = spark.createDataFrame(rows, "doc_id long, pos int, sentence string")
    memory = spark.createDataFrame([("c d", None)], "source string, translation string")
    done = translate_documents(sentences, ReverseWordsPredictor(), memory=memory).translations
    assert optimized(done).count("Join") == 1
    assert {(r.doc_id, r.pos): (r.translation, r.hit) for r in done.collect()} == {
        (1, 0): ("b a", False), (1, 1): (None, True), (2, 0): ("b a", False), (2, 1): ("", False),
        (2, 2): (None, None)}


def test_cleaned_sides_are_normalized_as_any_text(spark):
    from bitext.functions.text import clean_text, normalize_cleaned, normalize_space
    texts = ["_ a", "a _ b", "a _", "a__b", "\u00a0a \u2003 _\u3000b\x85", "a\tb", "a\x1cb", "", None, "_", " _ _ ", "a  b_"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(clean_text("t").alias("t"))
    rows = df.select(normalize_space("t"), normalize_cleaned("t")).collect()
    assert all(a == b for a, b in rows) and ("a b", "a b") in [tuple(r) for r in rows]


def test_the_latin1_guard_looks_for_all_markers_at_once(spark):
    from bitext.functions.text import MOJIBAKE_MARKERS, latin1_candidate
    texts = [m + "\u00a9" for m in MOJIBAKE_MARKERS] + ["Espa\u00c3\u00b1a", "plain", "\u00e9", "\u00c3\u00b1\u4e00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plan = optimized(df.select(latin1_candidate("t")))
    assert "instr(" not in plan
    found = {r.t: r.c for r in df.select("t", latin1_candidate("t").alias("c")).collect()}
    assert found["Espa\u00c3\u00b1a"] == "Espa\u00f1a" and found["\u00c3\u00a9"] == "\u00e9"
    assert found["plain"] is found["\u00e9"] is found["\u00c3\u00b1\u4e00"] is found[None] is None


def test_bleu_lines_are_matched_where_they_are_read(spark):
    from bitext.operators.bleu import bleu_stats
    rows = [("en", "a b a b a.", "a b a b, a"), ("en", None, "x"), ("de", "a &amp; b", "a & b"), ("de", "c", None)]
    df = spark.createDataFrame(rows, "lang string, h string, r string")
    stats = bleu_stats(df, group_cols=("lang",), ref_col="r", systems={"s": "h"})
    assert stats._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # of the sums
    assert {r.lang: tuple(r)[2:] for r in stats.collect()} == {
        "en": (5, 3, 2, 1, 6, 5, 4, 3, 6, 7), "de": (3, 2, 1, 0, 4, 2, 1, 0, 4, 3)}


def test_tokens_of_pieces_are_those_of_the_line(spark):
    from bitext.functions.bleu_tokenize import Tokens13a, tokenize_13a
    texts = ["a. .b ,.c", "1.5 2,x .5 x.5 5. 5, a,", "it's 3-4 -5 5- a-b-\nc", "(x) &lt;&amp;amp; ..., 1..2 ,,", "é.ñ, ②. ², 三.",
             "a\u00a0. \u3000,b\x1c.\x85c", "<skipped>a <skip", " x-\n", ". ", "", "a_b.c/d{e}", "x" * 70 + ".5-"]
    tokens = Tokens13a()
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tokenize_13a("t").alias("words"))
    for row in df.collect() * 2:
        assert tokens.of(row.t) == row.words, row.t


def test_a_held_glossary_gives_what_the_joined_one_gives(spark, monkeypatch):
    from bitext.operators import glossary as g
    terms = [("and the", "y el"), ("the", "el"), ("er", "1"), ("te", "2"), ("M_", "3"), ("7", "4"), ("__", "5"), ("aß", "6"),
             ("\u0130", "7"), ("k", "8"), ("ñandú", "9"), ("\u03c3", "s"), ("x" * 9, "x"), ("\ud801\udc28".encode("utf-16", "surrogatepass").decode("utf-16"), "d")]
    texts = ["And THE end", "term 7_", "STRASSE Aß aẞ ß", "\u0130i\u0131I \u212a", "ÑANDÚ ñandu", "Σσς", "X" * 20, "\U00010400b", "", None,
             "nothing"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    answer = lambda: sorted(map(tuple, g.protect_terms(df, "s", terms).select(
        "s", "protected", g.mapping_text("term_map")).collect()), key=repr)
    held = g.protect_terms(df, "s", terms)
    assert "Join" not in optimized(held) and "Exchange" not in held._jdf.queryExecution().executedPlan().toString()
    first = answer()
    monkeypatch.setattr(g, "HELD_TERMS", 3)
    assert "Join" in optimized(g.protect_terms(df, "s", terms))
    assert answer() == first
    monkeypatch.undo()
    assert "Join" in optimized(g.protect_terms(df, "s", [("ß", "ss")]))  # finds no capital one


def test_letters_fold_as_the_pattern_compares_them(spark):
    from pyspark.sql import functions as F
    from bitext.operators.glossary import CaseFolds
    folds = CaseFolds()
    pairs = [(c, d) for c in map(chr, [*range(0x20, 0xd800), *range(0xf900, 0x10000)])
             for d in {folds[ord(c)], c.lower()[0], c.upper()[0]} if d != c]
    pairs = [p for p in pairs if p[1] != "ß"] + [(f"-{c}", f"-{d}") for c, d in pairs]
    df = spark.createDataFrame(pairs, "c string, d string")
    same = F.regexp_like("c", F.concat(F.lit("(?iu)\\Q"), "d", F.lit("\\E")))
    wrong = [(r.c, r.d) for r in df.select("c", "d", same.alias("same")).collect()
             if r.same != (r.c.translate(folds) == r.d.translate(folds))]
    assert wrong == []


GLOSSARIES = {
    "words": ["the", "then", "hen", "and the", "en", "he", "nth", "x" * 20, "x" * 17, "xx", "ñandú", "The", "İs", "日本", "本"],
    "inside placeholders": ["the", "term", "te", "er", "TE", "m", "7", "1", "12", "hen", "and", "a_b", "e"],
    "at their borders": ["the", "er", "_", "__", "m_", "x_", "_t", "and", "7__", "hen", "__TERM_1__"],
    "none": [],
}


def random_texts(count, seed=3):
    import random
    rng = random.Random(seed)
    words = ["The", "then", "and", "THEN", "hen", "x" * 17, "X" * 39, "x", "term", "7", "12", "a_b", "_t", "m_", "Ñandú", "日本本",
             "İstanbul", "nth", "__TERM_1__", "ththe", "enenen", "", "\x00", "🙂he"]
    return ["", "nothing to do", "x" * 64] + [
        rng.choice([" ", "", "-"]).join(rng.choice(words) for _ in range(rng.randrange(1, 12))) for _ in range(count)]


@pytest.mark.parametrize("kind", GLOSSARIES)
def test_texts_protected_together_equal_the_definition(kind, monkeypatch):
    import pyarrow as pa
    from bitext.operators import glossary as g
    order = sorted(GLOSSARIES[kind], key=lambda t: -len(t))
    terms = [(i, t, f"<{t}>") for i, t in enumerate(order)]
    texts = random_texts(400)
    for cells, depth, size in ((g.TRIE_CELLS, g.TRIE_DEPTH, g.SLICE_BYTES), (1, 2, 30)):
        for name, value in (("TRIE_CELLS", cells), ("TRIE_DEPTH", depth), ("SLICE_BYTES", size)):
            monkeypatch.setattr(g, name, value)
        held = g.HeldGlossary(terms)
        first = pa.array(["not in the slice", *texts]).slice(1)
        parts = [held.protect(part) for part in g.byte_slices(first)]
        assert size > 30 and len(parts) == 1 or len(parts) > 100
        got = [(t, [x["placeholder"] for x in m]) for a, b in parts for t, m in zip(a.to_pylist(), b.to_pylist())]
        assert len(got) == len(texts)
        for text, (protected, marks) in zip(texts, got):
            want, used = held.applied(text, range(len(terms)))
            assert (protected, marks) == (want, [held.marks[i] for i in used]), text
    assert [len(held.protect(part)[0]) for part in g.byte_slices(pa.array([], pa.string()))] == [0]


def test_terms_are_not_applied_text_by_text(monkeypatch):
    import pyarrow as pa
    from bitext.operators import glossary as g
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in ("ai", "er", "o") for c in ("nt", "s", "tion")]
    held = g.HeldGlossary([(i, w, w[::-1]) for i, w in enumerate(sorted([*words, "er", "te"], key=lambda w: -len(w)))])
    calls, applied = [], g.HeldGlossary.applied
    monkeypatch.setattr(g.HeldGlossary, "applied", lambda self, *a: calls.append(a) or applied(self, *a))
    texts = [f"{a} {b}{c}." for a in words for b in words for c in ("", "te", "x")]
    protected, maps = held.protect(pa.array(texts))
    assert len(calls) <= len(words) + 2 < len(texts) / 100  # what later terms do to each placeholder
    assert protected.null_count == 0 and min(map(len, maps.to_pylist())) > 1


def test_only_placeholders_in_the_text_are_replaced(spark):
    from pyspark.sql import functions as F
    from bitext.operators.glossary import restore_terms
    kind = "s string, m array<struct<placeholder:string,target:string>>"
    mark = "__TERM_{}__".format
    rows = [("a " + mark(1) + mark(2), [(mark(2), "zwei"), (mark(3), "drei"), (mark(1), "eins")]),
            ("__TERM_1__TERM_2__ __TERM_2__", [(mark(2), "b"), (mark(1), "a")]),  # shared underscores
            ("__TERM_1__TERM_2__", [(mark(1), "a"), (mark(2), "b")]),
            ("__TERM____TERM_1____", [(mark(1), "_7"), (mark(7), "c")]),  # a target that forms another
            ("__TERM_1____TERM_2____TERM_3__", [(mark(2), "7"), (mark(1), ""), (mark(3), "x|y")]),
            ("__TE" + mark(5) + "RM_4__", [(mark(5), "é"), (mark(4), "d")]),
            ("__TE" + mark(5) + "RM_4__", [(mark(9), ""), (mark(5), ""), (mark(4), "d")]),  # an empty one does
            ("<1> " + mark(1), [("<1>", "one"), (mark(1), "a"), (mark(1), "b")]),
            (mark(1), [(None, "a")]), (mark(1), [(mark(2), None)]), (mark(1), [(mark(1), None)]),
            (mark(1), []), (None, [(mark(1), "a")]), (mark(1), None), ("", []), ("__TERM_12__", [(mark(1), "a"), (mark(12), "$1\\")])]
    df = spark.createDataFrame(rows, kind)
    in_turn = F.aggregate("m", F.coalesce("s", F.lit("")), lambda acc, z: F.replace(acc, z["placeholder"], z["target"]))
    for r in df.select("s", "m", restore_terms("s", "m").alias("got"), in_turn.alias("want")).collect():
        assert r.got == r.want, r
    assert "array_contains" in optimized(df.select(restore_terms("s", "m")))


def test_restored_terms_equal_the_definition_on_random_maps(spark):
    import random
    from pyspark.sql import functions as F
    from bitext.operators.glossary import restore_terms
    rng = random.Random(11)
    parts = ["__TERM_1__", "__TERM_2__", "__TERM_12__", "__T", "TERM", "_1", "_", "__", "1", "2", "E", "RM_", "word", " "]
    targets = ["", "T", "ERM", "1", "2", "_", "__", "TERM_1", "M_2", "word", "é x"]
    some = lambda values, n: [rng.choice(values) for _ in range(rng.randrange(n))]
    rows = [("".join(some(parts[:1 + rng.randrange(len(parts))], 9)),
             [(f"__TERM_{n}__", rng.choice(targets[rng.choice([0, 1, 9]):])) for n in rng.sample([1, 2, 12, 21], rng.randrange(5))])
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "s string, m array<struct<placeholder:string,target:string>>")
    in_turn = F.aggregate("m", F.col("s"), lambda acc, z: F.replace(acc, z["placeholder"], z["target"]))
    got = df.select("s", "m", restore_terms("s", "m").alias("got"), in_turn.alias("want")).collect()
    assert [r for r in got if r.got != r.want] == []
