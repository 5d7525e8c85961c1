"""Grouping of spelling variants by asymmetric q-chunks.

Words are counted over all documents. Two words are near if one inserted,
deleted or replaced code point makes them equal. The shorter word of a pair (the
smaller one at equal length) contributes two disjoint chunks of half its length, its
beginning and its end; the other contributes positional grams of that length.
One edit cannot touch both chunks, so one of them is a gram of the other word, shifted
by no more than one place: the beginning stays where it is, the end moves with the
difference of the lengths. Only grams at these places are made. Chunks and grams are
joined on (gram, length, end), a pair found by both chunks is kept for the first only,
and the edit distance decides.

A chunk that more than ``HOT_KEY`` words share is not joined as it is: its words
meet by what is left after one deletion (with the place, where lengths are equal),
so that no group is larger than the alphabet times the word, and no pair is lost.

A word's form is its near word with the largest count (ties: smallest in code-point
order) if that is at least ``factor`` times its own. Counts grow along forms, so forms
cannot run in circles; the last form (root) is found by pointer doubling.

Defined results
* NULL, empty and letterless texts add no words; an empty table gives no rows.
* Repeated rows count as often as they are there; a NULL doc_id is the empty text.
* Extra columns do not matter; only ``doc_id`` and ``text`` are read.

Scale: built-in functions only. Words are counted before they are shuffled; all that
follows is of the vocabulary's size. Nothing is collected, joins split skewed keys.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitext._util import explode_rows
from bitext.session import reliable_checkpoint

from ._common import load_table

MIN_LENGTH, MIN_COUNT, FACTOR = 5, 3, 2
#: Words (of both kinds) that may share a chunk and still be compared with each other.
HOT_KEY = 400
RUNS = "[A-Za-zÀ-ÿ]+"
#: Every so many (document, word) pairs one is misspelt by the contract's rule.
DELETION_EVERY = 97
KEY = ["chunk", "size", "end"]


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.lower(c) == c, c).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def with_deletions(doc_id: Column, word: Column) -> Column:
    """``word`` without its code point number h % length where ``DELETION_EVERY``
    divides h, the crc32 of ``<doc_id>:<word>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    shorter = F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.length(word)))
    return F.when(h % DELETION_EVERY == 0, shorter).otherwise(word)


def count_words(documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                change=None) -> DataFrame:
    """``word, n`` of the lower-cased letter runs of all texts; ``change(doc_id, run)``
    may alter a run before it is counted."""
    runs = explode_rows(documents, ["doc_id"], F.regexp_extract_all("text", F.lit(RUNS), F.lit(0)), ("run",))
    runs = runs.select("doc_id", lower_ascii(F.col("run")).alias("run"))
    word = F.col("run") if change is None else change(F.col("doc_id"), F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def chunks(words: DataFrame) -> DataFrame:
    """``chunk, size, end, word, n``: both chunks of every word (end 0 and 1)."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    both = F.array(F.struct(F.col("word").substr(F.lit(1), half).alias("chunk"), size.alias("size"),
                            F.lit(0).alias("end")),
                   F.struct(F.col("word").substr(size - half + 1, half).alias("chunk"), size.alias("size"),
                            F.lit(1).alias("end")))
    return words.select(F.inline(both), "word", "n")


def grams(words: DataFrame) -> DataFrame:
    """``chunk, size, end, word, n``: the grams of every word where a word of
    ``size`` code points (as many, or one fewer) would have its chunks."""
    found = []
    for fewer in (0, 1):
        size = F.length("word") - fewer
        half = F.floor(size / 2).cast("int")
        last = size - half + fewer + 1  # 1-based place of the end chunk, shifted by the longer length
        for end, place in ((0, F.lit(1)), (1, last)):
            found.append(F.struct(F.col("word").substr(place, half).alias("chunk"), size.alias("size"),
                                  F.lit(end).alias("end")))
    return words.select(F.inline(F.array(*found)), "word", "n").where(F.col("size") > 0)


def near_pairs(words: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """``a, a_n, b, b_n``: every unordered pair of near words once.

    ``words`` has distinct ``word`` and a count ``n``, and is read several times.
    """
    left = chunks(words).withColumnsRenamed({"word": "a", "n": "a_n"})
    right = grams(words).withColumnsRenamed({"word": "b", "n": "b_n"})
    shared = left.select(*KEY).unionAll(right.select(*KEY)).groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
    hot = reliable_checkpoint(shared.where(F.col("_n") > hot_key).select(*KEY))
    usual = left.join(hot, KEY, "left_anti").join(right.join(hot, KEY, "left_anti"), KEY).where(
        _ordered()).where(F.levenshtein("a", "b", 2) == 1).drop("chunk")
    crowded = _by_deletion(left.join(hot, KEY, "left_semi"), right.join(hot, KEY, "left_semi"))
    return usual.unionByName(crowded).where(_first_chunk()).select("a", "a_n", "b", "b_n")


def _ordered() -> Column:
    return (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))


def _first_chunk() -> Column:
    """False for a pair found by its ends whose beginnings agree too."""
    half = F.floor(F.col("size") / 2).cast("int")
    start = F.lit(1)
    return (F.col("end") == 0) | (F.col("a").substr(start, half) != F.col("b").substr(start, half))


def _by_deletion(left: DataFrame, right: DataFrame) -> DataFrame:
    """Near pairs within the same key, joined by what one deletion leaves. Key, place
    and rest travel as one number; what it brings together is compared again."""
    at = F.col("_at")

    def with_rest(rows, word, place, without):
        rest = F.col(word) if not without else F.concat(
            F.col(word).substr(F.lit(1), at - 1), F.col(word).substr(at + 1, F.length(word)))
        return rows.withColumn("_rest", F.xxhash64(*KEY, place, rest)).drop("_at", "chunk")

    places = lambda word: F.explode(F.sequence(F.lit(1), F.length(word))).alias("_at")
    # One code point replaced: the same place is left out of both words.
    replaced_a = with_rest(left.select("*", places("a")), "a", at, True)
    replaced_b = with_rest(right.where(F.length("b") == F.col("size")).select("*", places("b")), "b", at, True)
    # One code point more: the longer word without some place is the shorter word.
    added_a = with_rest(left, "a", F.lit(0), False)
    added_b = with_rest(right.where(F.length("b") > F.col("size")).select("*", places("b")), "b", F.lit(0), True)
    joined = replaced_a.unionByName(added_a).join(
        replaced_b.unionByName(added_b.distinct()), ["size", "end", "_rest"]).drop("_rest")
    half = F.floor(F.col("size") / 2).cast("int")
    chunk = lambda word: F.when(F.col("end") == 0, F.col(word).substr(F.lit(1), half)).otherwise(
        F.col(word).substr(F.length(word) - half + 1, half))
    return joined.where(_ordered()).where((chunk("a") == chunk("b")) & (F.levenshtein("a", "b", 2) == 1))


def spelling_forms(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, n, form, form_n, n_near`` of every row of ``words(word, n)``."""
    pairs = near_pairs(words)
    near = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form"))).alias("_best"))
    form_n = -F.col("_best.minus")
    taken = form_n >= factor * F.col("n")
    return words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.when(taken, F.col("_best.form")).alias("form"), F.when(taken, form_n).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form: the end of its chain. Every
    round doubles the length of the steps, so chains of k forms take log2(k) rounds."""
    steps = reliable_checkpoint(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        moved = steps.join(ahead, "root", "left")
        steps = reliable_checkpoint(moved.select(
            "word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved")))
        if steps.where("_moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def spelling_groups(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, n, form, form_n, root, n_near`` of every row of ``words(word, n)``."""
    words = reliable_checkpoint(words.select("word", F.col("n").cast("long").alias("n")))
    forms = reliable_checkpoint(spelling_forms(words, factor))
    roots = last_forms(forms)
    return forms.join(roots, "word", "left").select(
        "word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near")


def op11_spelling_variants(spark, sf_dir) -> DataFrame:
    documents = load_table(spark, sf_dir, "documents")
    return spelling_groups(count_words(documents, change=with_deletions))


#: DuckDB's edit distance counts bytes: the 64 two-byte letters become one-byte signs for it.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = "".join(c for c in map(chr, range(0x20, 0x7F)) if not c.islower() and c not in "'\"{}")[:64]

#: The words' crc32 is a fold over their UTF-8 bytes (letters up to U+00FF have one or
#: two); near words are found by comparing all words of like length.
ORACLE = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                           '[a-zÀ-ÿ]+')) AS run
  FROM documents
),
per_document AS (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(list_reduce(list_concat([4294967295], flatten(list_transform(
                       string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                       lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                                      ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
                     lambda s, b: xor(t[(xor(s, b) & 255) + 1], s >> 8)), 4294967295) AS h
  FROM per_document, crc_table
),
counted AS (
  SELECT CASE WHEN h % {DELETION_EVERY} = 0
              THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k
  FROM hashed
),
words AS (SELECT word, sum(k)::BIGINT AS n FROM counted WHERE length(word) >= {MIN_LENGTH}
          GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
plain AS (SELECT word, n, translate(word, '{_WIDE}', '{_NARROW}') AS w FROM words),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM plain a JOIN plain b ON length(b.w) BETWEEN length(a.w) - 1 AND length(a.w) + 1 AND levenshtein(a.w, b.w) = 1
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place,
                  count(*) OVER (PARTITION BY word) AS n_near FROM near),
forms AS (
  SELECT w.word, w.n, CASE WHEN r.other_n >= {FACTOR} * w.n THEN r.other END AS form,
         CASE WHEN r.other_n >= {FACTOR} * w.n THEN r.other_n END AS form_n, coalesce(r.n_near, 0)::BIGINT AS n_near
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
),
chains AS (
  SELECT word, word AS root FROM forms
  UNION
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.form, f.form_n, c.root, f.n_near
FROM forms f JOIN chains c USING (word) JOIN forms last ON last.word = c.root WHERE last.form IS NULL
"""
