"""Held-out accuracy, defined edge cases and the parts of op3, op9 and op10."""
import zlib
from collections import Counter

import numpy as np
import pytest

from bitext.llm import lang_id, quality, toxicity
from bitext.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def held_out(spark, name, label, modulus, rest):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    return [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]


def test_quality_held_out(spark):
    pairs = held_out(spark, "op3_quality", "quality", 3, 1)
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.95


def test_toxicity_held_out(spark):
    pairs = held_out(spark, "op10_toxicity", "toxic", 5, 0)
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.9
    assert sum(b for a, b in pairs if not a) <= 0.05 * len(pairs)


def test_language_held_out(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op9_language_id"](spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) / len(rows) > 0.98


ROWS = [(i, t, lang) for i, (t, lang) in enumerate([
    ("the cat sat on the mat and the dog", "en"), ("the rain in the hills was long", "en"),
    ("der hund und die katze schlafen nicht", "de"), ("das haus und der garten sind schön", "de")] * 12)]
EDGES = [(1000, None, "en"), (1001, "", None), (1002, " 12 ?! ", "de"), (1003, "the " * 40_000, None),
         (None, "der hund und die", "de"), (1004, "the dog", None), (1004, "the dog", None), (1005, "日本", None)]
DOCS = "doc_id long, text string, lang string, score string"


def docs(spark, rows=None):
    return spark.createDataFrame([(*r, "x") for r in (rows if rows is not None else ROWS + EDGES)], DOCS)


def test_language_edges(spark):
    got = lang_id.identify_languages(docs(spark)).collect()
    assert len(got) == len(ROWS + EDGES)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1000].score == 0
    assert by[1003].lang_pred == by[1004].lang_pred == "en" and by[None].lang_pred == "de" and not by[None].held_out
    assert by[1005].lang_pred in ("de", "en")
    assert lang_id.identify_languages(docs(spark).limit(0)).count() == 0
    nothing = lang_id.identify_languages(docs(spark, EDGES[:3])).collect()
    assert {r.lang_pred for r in nothing} <= {"und", "de"}


def test_kernel_is_the_share_of_common_grams():
    a, b = lang_id.grams("abc déf"), lang_id.grams("abc dxf")
    model = lang_id.KernelModel([], np.union1d(a, b), np.isin(np.union1d(a, b), b)[:, None] / np.sqrt(len(b)), None)
    expected = len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b))
    assert model.kernel([a])[0, 0] == pytest.approx(expected, rel=1e-6)


def test_long_text_grams_equal_short_path():
    assert set(lang_id.grams("hello wörld " * 3000)) == set(lang_id.grams("hello wörld " * 3))


def test_scripts_stay_apart(spark):
    assert not np.intersect1d(lang_id.grams("абвгд"), lang_id.grams("აბგდე")).tolist()[1:]  # but for the separator
    plain = [*"аб", " а", "аб", "б ", " аб", "аб ", " "]
    assert len(lang_id.grams("аб")) == len(plain)
    samples = {"ru": "собака и кошка спят дома", "ka": "ძაღლი და კატა სახლში სძინავთ", "zh": "狗和猫在家里睡觉",
               "ja": "犬と猫は家で寝ています"}
    rows = [(10 * k + i, text + " " + text[i % 5:], lang) for k, (lang, text) in enumerate(samples.items()) for i in range(10)]
    asked = [(5000, "кошка дома", None), (5001, "კატა სახლში", None), (5002, "猫在家里", None), (5003, "猫は家で", None)]
    got = {r.doc_id: r.lang_pred for r in lang_id.identify_languages(docs(spark, rows + asked)).collect()}
    assert [got[i] for i in (5000, 5001, 5002, 5003)] == ["ru", "ka", "zh", "ja"]


def test_predictions_equal_a_dense_kernel_ridge():
    """Every training text a landmark: Nyström's solution is that of the whole kernel matrix."""
    words = {"en": "the cat sat on a mat and dog".split(), "de": "der hund und die katze auf einem".split(),
             "fr": "le chat est sur la table avec".split()}
    rng = np.random.default_rng(3)
    texts = [(lang, " ".join(rng.choice(words[lang], 4, replace=False))) for lang in ("de", "en", "fr") for _ in range(8)]

    def sets(text):  # from the definition, with strings
        s = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        return {s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}

    def kernel(a, b):
        return len(sets(a) & sets(b)) / np.sqrt(len(sets(a)) * len(sets(b)))

    k = np.array([[kernel(a, b) for _, b in texts] for _, a in texts])
    y = np.array([[1.0 if lang == name else -1.0 for name in ("de", "en", "fr")] for lang, _ in texts])
    alpha = np.linalg.solve(k @ k / 8 + lang_id.RIDGE * k + 1e-12 * np.eye(len(k)), k @ y / 8)
    model = lang_id.fit([(lang, lang_id.grams(t)) for lang, t in texts], landmarks=len(texts))
    asked = ["the dog and cat", "die katze und hund", "la table est", "cat sur mat"]
    expected = np.array([[kernel(a, b) for _, b in texts] for a in asked]) @ alpha
    for text, (lang, score), row in zip(asked, model.predict(asked), expected):
        assert lang == ("de", "en", "fr")[row.argmax()]
        assert score == pytest.approx(np.clip((row.max() + 1) / 2, 0, 1), abs=2e-3)


def labels(spark, marks):
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int, text string")


MARKS = [(i, i % 4 // 2, i % 4 // 2, "clash") for i in range(48)] + [(3, None, None, "n"), (None, 1, 1, ""), (999, 1, 1, "")]


@pytest.mark.parametrize("score, label", [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_score_edges(spark, score, label):
    got = score(docs(spark), labels(spark, MARKS)).collect()
    assert len(got) == len(ROWS + EDGES) and all(0 <= r.score <= 1 for r in got)
    assert score(docs(spark).limit(0), labels(spark, MARKS)).count() == 0
    none = score(docs(spark), labels(spark, MARKS).limit(0)).collect()
    assert len({r.score for r in none}) == 1
    one = score(docs(spark), labels(spark, [(i, 1, 1, "") for i in range(48)])).collect()
    assert all(r.predicted == 1 for r in one)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    assert ((model.scores(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.85
    z = (x[:, 2] > 0.3).astype(float)
    assert ((quality.fit(x[:2000], z[:2000]).scores(x[2000:]) >= 0.5) == z[2000:]).mean() > 0.97


def test_letter_model_sums_to_one():
    words = ["idiot", "idea", "item", "tide", "edit"]
    model = toxicity.SharedLetters({r for w in words for r in toxicity.letter_runs(w)})
    letters = {c for w in words for c in w} | {" "}
    for context in ("    ", "   i", "  id", "zzzz"):
        total = sum(np.exp(model.letter(context + c)) for c in letters)
        assert 0.5 < total <= 1.0 + 1e-9


def test_toxic_words_have_evidence():
    counts = Counter({"good": 0, "vile": 60})
    table, other = toxicity.evidence_table([("good", 5, 500), ("vile", counts["vile"], 0)],
                                           [(1000, 300, 200, 50), (9000, 900, 500, 150)], ["good ", "vile "])
    assert table["vile"] > 3 > 0 > table["good"] and abs(other) < 2


def test_letter_runs_of_all_words_count(spark):
    counts = {"vile": (7, 1, 9), "evil": (0, 6, 6), "live": (1, 0, 1), "zebra": (0, 1, 4), "été": (2, 2, 5), "only": (0, 0, 1)}
    totals = [tuple(f(c[k] for c in counts.values()) for f in (
        sum, lambda x: sum(v > 0 for v in x), lambda x: sum(v == 1 for v in x), lambda x: sum(v == 2 for v in x)))
        for k in (0, 1)]
    words = spark.createDataFrame([(w, *c) for w, c in counts.items()], "word string, toxic long, ordinary long, whole long")
    runs = {r for w in counts for r in toxicity.letter_runs(w)}  # also those of one word only
    letters = toxicity.SharedLetters(runs)
    grams = {r.gram: r.p for r in toxicity.letter_grams(words).collect()}
    assert grams == pytest.approx({r[1:]: np.exp(letters.letter(r)) for r in runs})
    expected, other = toxicity.evidence_table([(w, *c[:2]) for w, c in counts.items() if any(c[:2])], totals, runs)
    got = {r.word: r.value for r in toxicity.word_evidence(words, totals).collect()}
    assert got == pytest.approx(expected) and toxicity.other_evidence(totals) == pytest.approx(other)


def test_held_letter_grams_are_not_joined(spark, monkeypatch):
    rows = [("vile", 7, 1, 9), ("evil", 0, 6, 6), ("live", 1, 0, 1), ("lililili", 0, 1, 4), ("été", 2, 2, 5)]
    words = spark.createDataFrame(rows, "word string, toxic long, ordinary long, whole long")
    totals, joined, write = [(10, 3, 1, 1), (10, 4, 2, 1)], [], toxicity.written_table
    monkeypatch.setattr(toxicity, "written_table", lambda df, name: joined.append(write(df, name)) or joined[-1])
    got = [{r.word: r.value for r in toxicity.word_evidence(words, totals, hot_grams=n).collect()}
           for n in (0, 5, toxicity.HOT_GRAMS)]
    rest = [sum(len(r.open) for r in df.collect()) for df in joined]
    assert rest[0] == sum(len(r[0]) + 1 for r in rows) and rest[0] > rest[1] > rest[2] == 0
    assert set(got[0]) == {r[0] for r in rows}
    assert got[1] == pytest.approx(got[0]) and got[2] == pytest.approx(got[0])


def test_rare_words_have_their_own_evidence(spark):
    texts = [(i, f"all of us said w{chr(97 + i % 26)}x{chr(97 + i // 26)}q " * 2 + "vile" * (i % 2), "en") for i in range(200)]
    marks = [(i, 0, i % 2, "") for i in range(200)]
    counted = [i for i in range(200) if i % 2 and zlib.crc32(str(i).encode()) % 5]
    texts += [(500 + i, texts[i][1].split()[4], "en") for i in counted] + [(900, "unseen", "en"), (901, "the-wax-vile of-x", "en")]
    frames = [toxicity.score_toxicity(docs(spark, texts), labels(spark, marks), hot_words=n) for n in (10**6, 30, 0)]
    whole, some, none = [{r.doc_id: r for r in f.collect()} for f in frames]
    # Each of these words is in one training document at most; four fifths of those documents give counts.
    own = [whole[500 + i].evidence - whole[900].evidence for i in counted]
    assert sum(d > 0.1 for d in own) > 0.6 * len(own)
    assert len(whole) == len(texts)
    for i, r in whole.items():  # what is broadcast and what is joined does not matter
        for other in (some[i], none[i]):
            assert (other.evidence, other.peak_evidence, other.score) == pytest.approx(
                (r.evidence, r.peak_evidence, r.score), abs=1e-9)


def test_held_words_are_looked_up_without_a_memo():
    from bitext.llm.toxicity import Evidence, words_of
    held = Evidence({"ab": 1.0, "c": -0.5})
    n, total, strongest, rest = held.text("Ab ab ab-c x x-ab")
    assert (n, total, strongest) == (5, 2.5, [1.0, 0.5])
    assert rest == [{"known": 0.0, "times": 1, "words": ["x"]}, {"known": 1.0, "times": 1, "words": ["x"]}]
    assert set(held.memo) == {"ab-c", "x-ab"}  # only pieces that had to be cut
    assert [words_of(p) for p in ("é²", "a1b", "ab", "_")] == [["é²"], ["a", "b"], ["ab"], []]
