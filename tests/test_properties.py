"""Property tests: JVM text semantics equal Python's on generated Unicode text.

Each example is a whole batch of strings checked in one Spark job.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bitext.functions import text as T
from bitext.operators.clean import clean_audit, clean_pairs
from bitext.operators.glossary import protect_terms, restore_terms

WS = [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0",
      "\u1680", "\u2000", "\u2007", "\u200a", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000",
      # not whitespace for Python: zero-width space, Mongolian vowel separator, BOM
      "\u200b", "\u180e", "\ufeff"]
ALPHABET = st.sampled_from(list("abcAB.!?,;_-") + WS + ["é", "ß", "日", "\x00", "\x07"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=40)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, values, col):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(col).collect()]


@SETTINGS
@given(TEXTS)
def test_normalize_space_equals_python(spark, texts):
    expect = [" ".join("".join(" " if ch.isspace() else ch for ch in t).split(" ")).split() for t in texts]
    assert [x.split(" ") if x else [] for x in column(spark, texts, T.normalize_space("s"))] == expect


@SETTINGS
@given(TEXTS)
def test_control_chars_equal_python(spark, texts):
    gone = dict.fromkeys([*range(0, 9), *range(10, 32)])
    assert column(spark, texts, T.remove_control_chars("s")) == [t.translate(gone) for t in texts]


def scan_sentences(text):
    """Sentences by one scan: a line feed (with a carriage return before it) ends one, and
    so does white space after a full stop, an exclamation or a question mark."""
    parts, now, i = [], "", 0
    text = text.strip()
    while i < len(text):
        rest = text[i:]
        if rest.startswith("\n") or rest.startswith("\r\n"):
            parts, now = parts + [now], ""
            i += 2 if rest[0] == "\r" else 1
        elif rest[0].isspace() and i and text[i - 1] in ".!?":
            parts, now = parts + [now], ""
            while i < len(text) and text[i].isspace():
                i += 1
        else:
            now += rest[0]
            i += 1
    return [p for p in (x.strip() for x in parts + [now]) if p]


@SETTINGS
@given(TEXTS)
def test_sentences_equal_a_scan(spark, texts):
    assert column(spark, texts, T.split_sentences("s")) == [scan_sentences(t) for t in texts]


@SETTINGS
@given(TEXTS)
def test_token_count_equals_python(spark, texts):
    assert column(spark, texts, T.token_count("s")) == [len(t.split()) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.text(alphabet=st.sampled_from(list("ab cd.")), max_size=12),
                          st.text(alphabet=st.sampled_from(list("xy z.")), max_size=12)),
                min_size=1, max_size=30))
def test_clean_is_idempotent(spark, rows):
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)],
                               "line_no long, source string, target string")
    once = clean_pairs(df)
    a = clean_audit(once).first()
    assert (a.modified_rows, a.dropped_invalid, a.dropped_dup) == (0, 0, 0)


@SETTINGS
@given(st.lists(st.text(alphabet=st.sampled_from(list("the cat and dog ")), max_size=40), min_size=1, max_size=20))
def test_protect_restore_round_trip(spark, texts):
    # every target equals its term in the casing found in the text -> identity
    g = [("the cat", "the cat"), ("and", "and"), ("dog", "dog")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    out = protect_terms(df, "s", g).orderBy("i").select(restore_terms("protected", "term_map")).collect()
    assert [r[0] for r in out] == texts
