"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of all test items (13 consecutive normalised words; a shorter item
is one window) form one automaton over normalised text. Each document is
normalised the same way and scanned once; matches come back as word indexes
and as character offsets in the original text.

Normalisation: A-Z become a-z, words are runs of a-z, 0-9 and non-ASCII
characters. It works on UTF-8 bytes, read as latin-1 text by the automaton, so
one code unit is one byte.

Defined results
* NULL or empty text, or text without words: no words, no hits, not contaminated.
* NULL, empty or wordless items match nothing. Repeated items (same id or same
  text) are reported once per distinct id; a NULL item id is ignored.
* Repeated document rows each get their own result row.
* Extra columns of either table are not read, whatever their names.

Scale: documents are never shuffled. The automaton is broadcast; its size is
checked: item text is measured first and split into blocks of about
``block_chars`` characters. Each block is one automaton and one pass, and the
passes' hits are merged per document, so what a worker holds stays bounded
however large the benchmark grows.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import load_table, map_rows, worker_cache

WINDOW = 13
BLOCK_CHARS = 4_000_000
#: n_hit * CONTAMINATED_SHARE >= n_words marks a document as contaminated.
CONTAMINATED_SHARE = 20

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
               for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_HITS = "word_ranges array<struct<first:int,last:int>>, item_ids array<string>"

def normal_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def item_windows(text: str | None, window: int = WINDOW) -> list[tuple[str, int]]:
    """``(pattern, number of words)`` of an item's windows."""
    words = [w.decode("latin-1") for w in normal_words(text)]
    size = min(window, len(words))
    return [(f" {' '.join(words[i:i + size])} ", size) for i in range(len(words) - size + 1)] if words else []


def build_automaton(items: list[tuple[str, str]], window: int = WINDOW):
    """Automaton over the windows of ``(item_id, text)``; None without windows."""
    import ahocorasick

    owners: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        for pattern, size in item_windows(text, window):
            owners.setdefault(pattern, (size, set()))[1].add(item_id)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for pattern, value in owners.items():
        automaton.add_word(pattern, value)
    automaton.make_automaton()
    return automaton


def scan(automaton, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged hit word ranges (inclusive) and item ids."""
    words = normal_words(text)
    if not words or automaton is None:
        return len(words), [], set()
    normal = f" {b' '.join(words).decode('latin-1')} "
    ranges: list[tuple[int, int]] = []
    items: set = set()
    seen = at = 0
    for end, (size, ids) in automaton.iter(normal):
        seen += normal.count(" ", at, end)  # words that start before this match's end
        at = end
        first, last = seen - size, seen - 1
        items |= ids
        while ranges and ranges[-1][1] >= first - 1:
            lo, hi = ranges.pop()
            first, last = min(first, lo), max(last, hi)
        ranges.append((first, last))
    return len(words), ranges, items


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in ``text`` of word ranges."""
    if not ranges:
        return []
    lowered = text.translate(_LOWER)
    spans = [m.span() for m in _WORD.finditer(lowered)]
    return [(spans[a][0], spans[b][1]) for a, b in ranges]


_LOWER = {c: c + 32 for c in range(65, 91)}


def _block(spark, items, window):
    shared, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex
    return lambda: worker_automaton(key, shared, window)


def worker_automaton(key: str, shared, window: int):
    """The worker's automaton of a block; built once, one at a time."""
    held = worker_cache().setdefault("automaton", {})
    if key not in held:
        held.clear()
        held[key] = build_automaton(shared.value, window)
    return held[key]


def _hits(documents: DataFrame, automaton, keep_all: bool, columns=()) -> DataFrame:
    """Rows with hits, or all of them. ``text_key`` tells rows of one doc_id apart."""
    fields = documents.select("doc_id", *columns).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def make():
        a = automaton()

        def work(texts, doc_ids, *rest):
            rows = [(i, t, *scan(a, t)) for i, t in zip(doc_ids, texts)]
            rows = rows if keep_all else [r for r in rows if r[3]]
            yield dict(zip(columns, rest)) | {
                   "doc_id": [r[0] for r in rows],
                   "text_key": [hashlib.md5((r[1] or "").encode()).digest() for r in rows],
                   "n_words": [r[2] for r in rows],
                   "word_ranges": [[{"first": x, "last": y} for x, y in r[3]] for r in rows],
                   "spans": [[{"start": x, "end": y} for x, y in original_spans(r[1], r[3])] if r[3] else []
                             for r in rows],
                   "item_ids": [sorted(r[4]) for r in rows]}

        return work

    return map_rows(documents, [F.col("text").alias("_text"), "doc_id", *columns],
                    f"{ddl}, text_key binary, n_words long, {_HITS}, "
                    "spans array<struct<start:int,end:int>>", make)


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_chars: int = BLOCK_CHARS, columns: list[str] = ()) -> DataFrame:
    """Per document: ``doc_id, <columns>, n_words, word_ranges, spans, item_ids,
    n_hit, contaminated``. ``spans`` are character offsets in the original text."""
    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(
        "item_id IS NOT NULL AND text IS NOT NULL AND text <> ''").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    if blocks == 1:
        hits = _hits(documents, _block(spark, [tuple(r) for r in items.collect()], window), True, columns).drop(
            "text_key")
    else:
        found = None
        for b in range(blocks):
            own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
            # the first block's rows include documents without hits
            keyed = _hits(documents, _block(spark, [tuple(r) for r in own.collect()], window), b == 0)
            found = keyed if found is None else found.unionByName(keyed)
        hits = _merge(documents, found, columns)
    n_hit = F.aggregate("word_ranges", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    return hits.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * CONTAMINATED_SHARE >= F.col("n_words")))


def _merge(documents: DataFrame, found: DataFrame, columns) -> DataFrame:
    """Union of the blocks' hits, joined to each row of the documents."""
    merged = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n_words").agg(
        F.flatten(F.collect_list("word_ranges")).alias("_r"), F.flatten(F.collect_list("spans")).alias("_s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))

    def join_ranges(c, lo, hi, gap):
        return F.aggregate(
            F.array_sort(c), F.expr(f"cast(array() as array<struct<{lo}:int,{hi}:int>>)"),
            lambda acc, r: F.when(
                (F.size(acc) > 0) & (F.element_at(acc, -1)[hi] >= r[lo] - gap),
                F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                    F.element_at(acc, -1)[lo].alias(lo),
                    F.greatest(F.element_at(acc, -1)[hi], r[hi]).alias(hi))))).otherwise(
                F.concat(acc, F.array(r))))

    merged = merged.select("_id", "_key", "n_words", join_ranges("_r", "first", "last", 1).alias("word_ranges"),
                           join_ranges("_s", "start", "end", 0).alias("spans"), "item_ids")
    key = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("_text_key")
    return documents.select("doc_id", *columns, key).join(
        merged, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))).drop(
        "_id", "_key", "_text_key")


def op6_decontaminate(spark, sf_dir):
    hits = decontaminate(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS k
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(0, len(w) - least(13, len(w)) + 1)) AS i
        FROM item WHERE len(w) > 0)),
dwin AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1:i + n], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i
        FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dwin.n, item_id FROM dwin JOIN win USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
