"""Removing repeated passages with compressed FM-indexes.

A window is 50 consecutive words of one document. Every word is removed that a
window covers whose word sequence also starts in a document with a smaller
doc_id; windows are judged on the input.

Method
1. Each window picks the smallest hash among its runs of ``ANCHOR_WORDS`` words
   (the leftmost on ties): its anchor. Equal windows pick equal anchors, so
   only windows of an anchor that occurs in two documents can be repeats. The
   consecutive windows of one anchor occurrence form a slice of words.
2. Equal slices are aggregated to one row with the smallest doc_id (combined
   before the shuffle), so a passage in a third of all documents is one slice.
3. Slices are dealt to shards by anchor; an anchor with very many different
   slices is dealt window by window, by the window's words. Equal windows always
   share a shard.
4. Each shard builds a compressed FM-index of its slices: a wavelet matrix of
   bit vectors over the Burrows-Wheeler transform, and marks where neighbouring
   suffixes differ within 50 words. All slices then stream through it: backward
   search reads each from its end, and at every word the matching statistics
   are kept at the threshold: once a match has 50 words its interval is
   reported and widened to the interval of its first 50 words before the next
   step. The smallest doc_id in the interval owns the window.
5. Intervals of windows owned by a smaller doc_id go back to the documents.

Defined results
* NULL, empty or wordless text: no words, nothing removed, kept text ''.
* Fewer than 50 words: nothing removed.
* Repeats inside one document, and between rows that share a doc_id, stay.
* NULL doc_id: neither a source nor a copy.
* Extra columns are not read.

Scale: documents' text moves only for documents that own or lose a passage. A
shard holds about ``SHARD_WORDS`` words; there are as many shards as the
repeated text needs.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.session import reliable_checkpoint

from ._common import (gram_hashes, load_table, map_rows, mix64, power_table, record_batch, to_arrow_schema,
                      word_hashes)
from .idfilter import only_ids, split_by_ids

WINDOW = 50
ANCHOR_WORDS = 12
SHARD_WORDS = 200_000
#: An anchor with more different slices than this is dealt window by window.
HOT_SLICES = 3_000
#: Rows of slices that a task gives out at a time.
OUT_ROWS = 2_000


# --- slices -------------------------------------------------------------------
def slices_of(words: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR_WORDS):
    """Anchor hashes, first windows and window counts of the slices of a document."""
    n_windows = len(words) - window + 1
    if n_windows <= 0:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty
    grams = gram_hashes(words, anchor)
    low_bits = np.uint64(max(24, int(len(grams)).bit_length()))
    at = np.arange(len(grams), dtype=np.uint64)
    ranked = (grams >> low_bits << low_bits) | at  # ties go to the left
    span = window - anchor + 1
    lowest, width = ranked, 1
    while 2 * width <= span:
        lowest = np.minimum(lowest[:-width], lowest[width:])
        width *= 2
    if span > width:
        lowest = np.minimum(lowest[:len(lowest) - (span - width)], lowest[span - width:])
    chosen = (lowest & ((np.uint64(1) << low_bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    return grams[chosen[first]], first, np.diff(np.r_[first, n_windows])


def range_digests(words: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Digests of ``words[first:first + count]``."""
    up, down = power_table(len(words) + 1)
    total = np.empty(len(words) + 1, np.uint64)
    total[0] = 0
    np.cumsum(words * up[:len(words)], out=total[1:])
    return mix64((total[first + count] - total[first]) * down[first] + count.astype(np.uint64))


def _occurrences(documents: DataFrame, window: int, kind: str) -> DataFrame:
    def make():
        def work(doc_ids, texts):
            out = {"anchor": [], "digest": [], "doc": [], "first": [], "windows": []}
            for doc, text in zip(doc_ids, texts):
                words = word_hashes(text.encode("utf-8", "surrogatepass"))[2]
                anchors, first, count = slices_of(words, window)
                if len(first):
                    out["anchor"].append(anchors.view(np.int64))
                    out["digest"].append(range_digests(words, first, count + window - 1).view(np.int64))
                    out["doc"] += [doc] * len(first)
                    out["first"].append(first.astype(np.int32))
                    out["windows"].append(count.astype(np.int32))
            if out["doc"]:
                yield {k: v if k == "doc" else np.concatenate(v) for k, v in out.items()}

        return work

    return map_rows(documents.where("doc_id IS NOT NULL AND text IS NOT NULL"), ["doc_id", "text"],
                    f"anchor long, digest long, doc {kind}, first int, windows int", make)


def _contents(documents: DataFrame, slices: DataFrame, shards: int, window: int, kind: str) -> DataFrame:
    """Words of each slice, read from a document that has it, with its shard."""
    asked = slices.groupBy(F.col("owner").alias("doc_id")).agg(F.collect_list(F.struct(
        "anchor", "digest", "first", "windows", "last_doc", "hot")).alias("asked"))
    texts = only_ids(documents.select("doc_id", "text").where("text IS NOT NULL"), slices.select("owner"))

    def make():
        def work(doc_ids, texts, asked):
            names = ("shard", "anchor", "digest", "part", "owner", "last_doc", "words")
            out = {k: [] for k in names}

            def give(shard, a, part, owner, words):
                for k, v in (("shard", shard), ("anchor", a["anchor"]), ("digest", a["digest"]), ("part", part),
                             ("owner", owner), ("last_doc", a["last_doc"]), ("words", words)):
                    out[k].append(v)

            for doc, text, wanted in zip(doc_ids, texts, asked):
                data = text.encode("utf-8", "surrogatepass")
                starts, ends, words = word_hashes(data)
                for a in wanted:
                    lo, n = a["first"], a["windows"] + window - 1
                    if lo + n > len(words) or int(range_digests(words[lo:lo + n], np.zeros(1, np.int64), np.array(
                            [n]))[0].view(np.int64)) != a["digest"]:
                        continue  # another row of this doc_id
                    if not a["hot"]:
                        give(a["anchor"] % shards, a, 0, doc, data[starts[lo]:ends[lo + n - 1]])
                        continue
                    each = np.arange(a["windows"])
                    keys = range_digests(words[lo:lo + n], each, np.full(len(each), window))
                    for j, key in zip(each.tolist(), (keys % np.uint64(shards)).tolist()):
                        give(key, a, j, doc, data[starts[lo + j]:ends[lo + j + window - 1]])
                if len(out["shard"]) >= OUT_ROWS:
                    yield out
                    out = {k: [] for k in names}
            yield out

        return work

    return map_rows(texts.join(asked, "doc_id"), ["doc_id", "text", "asked"],
                    f"shard long, anchor long, digest long, part int, owner {kind}, last_doc {kind}, words binary",
                    make)


# --- FM-index -------------------------------------------------------------------
class BitVector:
    """Packed bits with a running count per 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        part = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(part)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector per bit of the alphabet."""

    def __init__(self, sequence: np.ndarray, largest: int):
        self.levels = []
        for bit in reversed(range(max(1, int(largest).bit_length()))):
            ones = (sequence >> bit & 1).astype(bool)
            zeros = len(ones) - int(ones.sum())
            self.levels.append((bit, BitVector(ones), zeros))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at`` (arrays of one length)."""
        lo = np.zeros_like(at)
        for bit, vector, zeros in self.levels:
            both = vector.ones(np.concatenate([lo, at]))
            one_lo, one_at = both[:len(at)], both[len(at):]
            one = (symbol >> bit & 1).astype(bool)
            lo = np.where(one, zeros + one_lo, lo - one_lo)
            at = np.where(one, zeros + one_at, at - one_at)
        return at - lo


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling, and for each rank but the first whether
    it shares its first ``depth`` symbols with the rank before."""
    n = len(text)

    def later(rank, by):
        return np.concatenate([rank[by:] + 1, np.zeros(min(by, n), np.int64)])

    key, have, shared = text, 1, None
    if depth >= 3 and int(text.max()) < 1 << 20:  # three symbols fit one number
        key, have = (text + 1 << 42) + (later(text, 1) << 21) + later(text, 2), 3
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        done = rank[order[-1]] == n - 1
        if shared is None and (done or 2 * have >= depth):
            # equal on `depth` symbols: equal on `have` at both ends of them
            shared = rank, later(rank, max(0, depth - have))
        if done:
            break
        key = rank * (n + 1) + later(rank, have)
        have *= 2
    a, b = shared
    same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    return order, same


class FmIndex:
    """FM-index of word sequences with, per suffix, the sequence's owner."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, depth: int):
        self.depth = depth
        self.lengths = np.array([len(s) for s in sequences])
        n = int(self.lengths.sum()) + len(sequences)
        ends = np.cumsum(self.lengths + 1) - 1  # the separators' places
        inner = np.ones(n, bool)
        inner[ends] = False
        words, codes = np.unique(np.concatenate(sequences), return_inverse=True)
        m = len(sequences)
        text = np.empty(n, np.int64)
        text[inner], text[ends] = codes + m, np.arange(m)  # separators all differ
        order, same = suffix_order(text, depth)
        symbols = np.zeros(n, np.int64)  # in the index all separators are symbol 0
        symbols[inner] = codes + 1
        self.symbols, self.starts = symbols, ends - self.lengths
        self.wavelet = WaveletMatrix(symbols[order - 1], len(words))
        self.below = np.r_[0, np.cumsum(np.bincount(symbols, minlength=len(words) + 1))]
        self.group_lo = np.flatnonzero(np.r_[True, ~same])
        self.group_hi = np.r_[self.group_lo[1:], n]
        self.group = np.cumsum(np.r_[0, ~same])
        of = np.repeat(owners, self.lengths + 1)
        self.group_owner = np.minimum.reduceat(of[order], self.group_lo)

    def window_owners(self) -> list[np.ndarray]:
        """Smallest owner of each ``depth``-word window of each sequence, by
        streaming all sequences through backward search, one word a step."""
        order = np.argsort(-self.lengths, kind="stable")
        lengths, starts = self.lengths[order], self.starts[order]
        out = [np.empty(0, np.int64)] * len(order)
        answers = [np.empty(max(0, n - self.depth + 1), np.int64) for n in lengths]
        flat = np.concatenate(answers) if answers else np.empty(0, np.int64)
        base = np.r_[0, np.cumsum([len(a) for a in answers])]
        lo = np.zeros(len(order), np.int64)
        hi = np.full(len(order), len(self.symbols), np.int64)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -step, side="left"))  # sequences longer than step
            symbol = self.symbols[starts[:live] + lengths[:live] - 1 - step]
            below = self.below[symbol]
            ranks = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([lo[:live], hi[:live]]))
            lo[:live], hi[:live] = below + ranks[:live], below + ranks[live:]
            if step + 1 >= self.depth:  # a full match: report it, keep its first words only
                group = self.group[lo[:live]]
                flat[base[:live] + lengths[:live] - 1 - step] = self.group_owner[group]
                lo[:live], hi[:live] = self.group_lo[group], self.group_hi[group]
        for k, i in enumerate(order):
            out[i] = flat[base[k]:base[k + 1]]
        return out


def _search(contents: DataFrame, window: int, kind: str) -> DataFrame:
    """Runs of windows ``(anchor, digest, from_window, n_windows, owner)`` of each
    slice whose owner comes before the slice's last document."""
    schema = f"anchor long, digest long, from_window int, n_windows int, owner {kind}"
    out = to_arrow_schema(schema)

    def shard(table):
        import pyarrow as pa

        rows = table.to_pydict()
        ids, codes = np.unique(np.array(rows["owner"], object if kind == "string" else None), return_inverse=True)
        sequences = [word_hashes(w)[2] for w in rows["words"]]
        found = FmIndex(sequences, codes, window).window_owners()
        cols = {f.name: [] for f in out}
        for i, owners in enumerate(found):
            first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            for a, n in zip(first.tolist(), np.diff(np.r_[first, len(owners)]).tolist()):
                owner = ids[owners[a]]
                owner = owner.item() if hasattr(owner, "item") else owner
                if owner < rows["last_doc"][i]:
                    for k, v in (("anchor", rows["anchor"][i]), ("digest", rows["digest"][i]),
                                 ("from_window", rows["part"][i] + a), ("n_windows", n), ("owner", owner)):
                        cols[k].append(v)
        return pa.Table.from_batches([record_batch(cols, out)], schema=out)

    return contents.groupBy("shard").applyInArrow(shard, schema)


# --- operator -------------------------------------------------------------------
def repeated_ranges(documents: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                    hot_slices: int = HOT_SLICES) -> DataFrame:
    """``doc_id, ranges``: per document that loses words, the word ranges
    ``(first, count, digest, slice_first, slice_words)`` that repeat; the digest
    is that of the slice's words."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    found = reliable_checkpoint(_occurrences(documents, window, kind))
    twice = found.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where(
        "lo < hi").select("anchor")
    found = reliable_checkpoint(found.join(twice, "anchor", "left_semi"))
    slices = found.groupBy("anchor", "digest", "windows").agg(
        F.min("doc").alias("owner"), F.min_by("first", "doc").alias("first"), F.max("doc").alias("last_doc"))
    slices = reliable_checkpoint(slices)
    total = slices.agg(F.sum(F.col("windows") + window - 1)).first()[0] or 0
    hot = slices.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_slices).select(
        "anchor", F.lit(True).alias("hot"))
    slices = slices.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    contents = _contents(documents, slices, max(1, -(-total // shard_words)), window, kind)
    runs = reliable_checkpoint(_search(contents, window, kind))
    copies = found.join(runs, ["anchor", "digest"]).where("owner < doc").select(
        F.col("doc").alias("doc_id"), F.struct(
            (F.col("first") + F.col("from_window")).alias("first"),
            (F.col("n_windows") + window - 1).alias("count"), "digest",
            F.col("first").alias("slice_first"), (F.col("windows") + window - 1).alias("slice_words")).alias("range"))
    return copies.groupBy("doc_id").agg(F.collect_list("range").alias("ranges"))


def _kept(text: str | None, ranges) -> tuple[int, int, bytes]:
    """Words, removed words and the kept words joined by one space (UTF-8).
    Blanks of bytes.split() are exactly those that end a word here."""
    data = (text or "").encode("utf-8", "surrogatepass")
    found = data.split()
    if not ranges or not found:
        return len(found), 0, b" ".join(found)
    words = word_hashes(data)[2]
    lo = np.array([r["slice_first"] for r in ranges])
    n = np.array([r["slice_words"] for r in ranges])
    inside = lo + n <= len(words)  # else it is a range of another row of this doc_id
    digests = range_digests(words, np.where(inside, lo, 0), np.where(inside, n, 0)).view(np.int64)
    gone = np.zeros(len(found) + 1, np.int64)
    for r, own in zip(ranges, (inside & (digests == [r["digest"] for r in ranges])).tolist()):
        if own:
            gone[r["first"]] += 1
            gone[r["first"] + r["count"]] -= 1
    removed = np.cumsum(gone)[:-1] > 0
    return len(found), int(removed.sum()), b" ".join(itertools.compress(found, (~removed).tolist()))


def remove_repeats(documents: DataFrame, window: int = WINDOW, columns: list[str] = (), make_row=None,
                   schema: str = "kept string", **sizes) -> DataFrame:
    """Per document ``doc_id, <columns>, n_words, n_removed`` and the columns that
    ``make_row(text, n_removed, kept)`` derives, ``kept`` as UTF-8 (default: the
    kept text)."""
    make_row = make_row or (lambda text, n_removed, kept: (kept.decode("utf-8", "surrogatepass"),))
    ranges = reliable_checkpoint(repeated_ranges(documents, window, **sizes))
    maybe, other = split_by_ids(documents.select("doc_id", "text", *columns), ranges.select("doc_id"))
    fields = documents.select("doc_id", *columns).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    names = [f.strip().split()[0] for f in schema.split(",")]

    def make():
        def work(doc_ids, texts, *rest):
            marks, extra = rest[-1], rest[:-1]
            rows = [_kept(t, r) for t, r in zip(texts, marks)]
            made = [make_row(t, r[1], r[2]) for t, r in zip(texts, rows)]
            yield {"doc_id": doc_ids, "n_words": [r[0] for r in rows], "n_removed": [r[1] for r in rows]} | dict(
                zip(columns, extra)) | {k: [m[i] for m in made] for i, k in enumerate(names)}

        return work

    def finish(table):
        return map_rows(table, ["doc_id", "text", *columns, "ranges"],
                        f"{ddl}, n_words long, n_removed long, {schema}", make)

    none = F.lit(None).cast(ranges.schema["ranges"].dataType)
    return finish(maybe.join(ranges, "doc_id", "left")).unionByName(finish(other.withColumn("ranges", none)))


def op7_substring_dedup(spark, sf_dir):
    return remove_repeats(
        load_table(spark, sf_dir, "documents"), schema="kept_sha256 string",
        make_row=lambda text, n_removed, kept: (hashlib.sha256(kept).hexdigest(),))


ORACLE = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 50], ' ')) AS k
        FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM doc WHERE len(w) >= 50)),
own AS (SELECT k, min(doc_id) AS owner FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN own USING (k) WHERE owner < doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM doc),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
