"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Every text, with a blank before it, is cut by a byte-level BPE (A) and by a piece
model (B). The work on token lists is Arrow's, a slice of documents at a time: the
lists are flattened with their parent indices; byte ends are cumulative sums of
token lengths, segmented by document; an Acero full outer hash join of both sides on
(document, end) gives the union of all ends. Between two ends of that union lies
exactly one token of each side, so every row of the union is one link, and the rows where
both sides end close a group. ``Table.group_by`` counts, per slice and then per
task, the documents that link an id pair; Spark adds the partial counts.

Tokens, the kind of every end, digests and partial counts are written as Parquet below
``spark.checkpoint.dir`` in one pass over the texts, and read from there afterwards.
The corpus-wide counts come back to the links in two ways: the most frequent
pairs, ``HOT_PAIRS`` at most, are broadcast, and the links of all others are joined
with the whole table of counts.

Defined results
* NULL and empty texts, and texts whose joined A or B bytes differ from blank + text (the
  piece model rewrites U+2581), have no tokens: zeros and an empty digest column.
* Special tokens' strings inside a text are plain text.
* Rows are told apart by a number of their own: repeated, equal and NULL doc_ids each
  give their own row. An empty table gives no rows. Extra columns are not read.
* Very long texts are one slice each; a slice otherwise has ``SLICE_CHARS`` characters at most.

Scale: texts are not shuffled. A task holds one slice and at most ``FLUSH_PAIRS``
partial counts. The largest count per A id is broadcast (at most one row per id).
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitext.session import ensure_checkpoint_dir, reliable_checkpoint

from ._common import load_table, to_arrow_schema, worker_cache

RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Characters (or links) of a slice.
SLICE_CHARS = 100_000
#: Rows of an Arrow batch: some thousand documents with all their tokens are too many.
BATCH_ROWS = 1_000
#: Partial counts that a task gathers before it hands them on.
FLUSH_PAIRS = 250_000
#: Id pairs whose counts are broadcast: at most this many rows of 17 bytes.
HOT_PAIRS = 1 << 20
LIST_PAIRS = 16_384
SHIFT = 32
SCHEMA = ("row long, doc_id {doc_id}, a array<int>, b array<int>, steps binary, n_a long, n_b long, n_groups long, "
          "n_links long, groups_sha256 string, pairs array<long>, counts array<long>")


class TokenPair:
    """Both tokenizers, their tokens' bytes and the text forms of their ids.

    A's ids come from the rank table of the same vocabulary as the JSON file's:
    ordinary encoding, in which special strings are plain text.
    """

    def __init__(self, ranks_path: str, pieces_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                   special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        by_id = {rank: token for token, rank in ranks.items()}
        self.bytes_a = pa.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], pa.binary())
        self.bytes_b = pa.array([piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())],
                                pa.binary())
        self.sizes_a, self.sizes_b = (pc.cast(pc.binary_length(x), pa.int64()) for x in (self.bytes_a, self.bytes_b))
        # "id," and "id|" of every A id, then "id," and "id;" of every B id.
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        self.words = pa.array([f"{i},".encode() for i in range(n_a)] + [f"{i}|".encode() for i in range(n_a)]
                              + [f"{i},".encode() for i in range(n_b)] + [f"{i};".encode() for i in range(n_b)])

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Token ids of both sides; both lists are empty where the text has no tokens."""
        kept = [t for t in texts if t]
        raw = [(" " + t).encode("utf-8") for t in kept]
        a = [self.a.encode_ordinary(" " + t) for t in kept]
        b = self.b.encode(kept, num_threads=1) if kept else []
        good = [x and y for x, y in zip(same_bytes(a, self.bytes_a, raw), same_bytes(b, self.bytes_b, raw))]
        found = iter(zip(a, b, good))
        lists_a, lists_b = [], []
        for t in texts:
            x, y, fits = next(found) if t else ([], [], False)
            lists_a.append(x if fits else [])
            lists_b.append(y if fits else [])
        kind = pa.list_(pa.int32())
        return pa.array(lists_a, kind), pa.array(lists_b, kind)


def piece_bytes(piece: str) -> bytes:
    """Bytes of a piece: U+2581 is a blank, ``<0xHH>`` the byte HH."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode("utf-8")


def same_bytes(ids: list[list[int]], token_bytes: pa.Array, raw: list[bytes]) -> list[bool]:
    """Whether the tokens' bytes, joined, are the raw bytes; per list of ids."""
    lists = pa.array(ids, pa.list_(pa.int32()))
    joined = pc.cast(pc.take(token_bytes, pc.list_flatten(lists)), pa.large_binary())
    ends = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
    at = ends[lists.offsets.to_numpy()]
    data = memoryview(joined.buffers()[2]).cast("B") if len(joined) else memoryview(b"")
    return [data[at[i]:at[i + 1]] == raw[i] for i in range(len(raw))]


def token_ends(lists: pa.ListArray, sizes: pa.Array, name: str) -> pa.Table:
    """``doc, end, <name>``: every token's byte end in its document; ``name`` is true."""
    ids, doc = pc.list_flatten(lists), pc.cast(pc.list_parent_indices(lists), pa.int64())
    total = pc.cumulative_sum(pc.take(sizes, ids))
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), total]), lists.offsets[:-1])
    return pa.table({"doc": doc, "end": pc.subtract(total, pc.take(before, doc)),
                     name: pa.repeat(True, len(ids))})


def align(a: pa.ListArray, b: pa.ListArray, sizes_a: pa.Array, sizes_b: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``doc, steps``: one row per link in text order. A step is 1 where only A's token
    ends, 2 where only B's does, 3 where both do and a group closes."""
    ends = token_ends(a, sizes_a, "in_a").join(token_ends(b, sizes_b, "in_b"), ["doc", "end"],
                                               join_type="full outer", use_threads=False)
    ends = ends.sort_by([("doc", "ascending"), ("end", "ascending")])
    in_a, in_b = (ends[c].is_valid().to_numpy().astype(np.uint8) for c in ("in_a", "in_b"))
    return ends["doc"].to_numpy(), in_a + 2 * in_b


def link_ids(a: pa.ListArray, b: pa.ListArray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the A and the B token of every link."""
    sides = []
    for lists, bit in ((a, 1), (b, 2)):
        ended = ((steps & bit) > 0).astype(np.int64)
        sides.append(pc.list_flatten(lists).to_numpy(zero_copy_only=False)[np.cumsum(ended) - ended])
    return sides[0], sides[1]


def group_digests(a, b, steps: np.ndarray, codec: TokenPair) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per document ('' without tokens)."""
    flat_a, flat_b = (pc.list_flatten(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b))
    closed = steps == 3
    group = np.cumsum(closed) - closed                       # group of every link
    a_ends, b_ends = (steps & 1) > 0, (steps & 2) > 0
    group_a, group_b = group[a_ends], group[b_ends]          # group of every token
    before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=int(closed.sum())))])
    upto_a = np.cumsum(np.bincount(group_a, minlength=int(closed.sum())))
    n_a, n_b = len(codec.bytes_a), len(codec.bytes_b)
    codes = np.empty(len(flat_a) + len(flat_b), np.int64)
    codes[np.arange(len(flat_a)) + before_b[group_a]] = flat_a + n_a * closed[a_ends]
    codes[np.arange(len(flat_b)) + upto_a[group_b]] = 2 * n_a + flat_b + n_b * closed[b_ends]
    text = pc.cast(pc.take(codec.words, pa.array(codes)), pa.large_binary())
    if not len(codes):
        return [""] * len(a)
    ends = np.frombuffer(text.buffers()[1], np.int64, len(codes) + 1)
    at = ends[(a.offsets.to_numpy() - a.offsets[0].as_py()) + (b.offsets.to_numpy() - b.offsets[0].as_py())]
    data = memoryview(text.buffers()[2]).cast("B")
    return [hashlib.sha256(data[at[i]:at[i + 1] - 1]).hexdigest() if at[i + 1] > at[i] else ""
            for i in range(len(a))]


def pair_counts(doc: np.ndarray, pairs: np.ndarray) -> pa.Table:
    """``pair, n``: the number of documents of a slice that hold each pair."""
    once = pa.table({"doc": doc, "pair": pairs}).group_by(["doc", "pair"], use_threads=False).aggregate([])
    return once.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])


def added(parts: list[pa.Table]) -> pa.Table:
    merged = pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")])
    return merged.rename_columns(["pair", "n"])


def slices(lengths: np.ndarray, limit: int):
    """Ranges of rows with at most ``limit`` in sum, one row at least."""
    lo, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(lengths):
        yield lo, len(lengths)


def codec_of(paths: tuple[str, str]) -> TokenPair:
    cache = worker_cache()
    if ("token pair", paths) not in cache:
        cache["token pair", paths] = TokenPair(*paths)
    return cache["token pair", paths]


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return str(public_tokenizers.path(RANKS)), str(public_tokenizers.path(PIECES))


def aligned_documents(documents: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """One pass over the texts. Rows with ``row`` hold a document's tokens, steps, numbers
    and digest; rows without hold partial ``counts`` of ``pairs`` (A id * 2^32 + B id)."""
    paths = paths or vocabulary_paths()
    schema = SCHEMA.format(doc_id=documents.schema["doc_id"].dataType.simpleString())
    table = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    out = to_arrow_schema(schema)
    return table.mapInArrow(lambda batches: _align_batches(batches, codec_of(paths), out), schema)


def _align_batches(batches, codec: TokenPair, schema: pa.Schema):
    parts: list[pa.Table] = []
    held = 0
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
        for lo, hi in slices(lengths, SLICE_CHARS):
            rows = batch.slice(lo, hi - lo)
            a, b = codec.encode(rows.column(2).to_pylist())
            doc, steps = align(a, b, codec.sizes_a, codec.sizes_b)
            ids_a, ids_b = link_ids(a, b, steps)
            part = pair_counts(doc, (ids_a.astype(np.int64) << SHIFT) + ids_b)
            parts.append(part)
            held += part.num_rows
            if held > FLUSH_PAIRS:
                parts = [added(parts)]
                held = parts[0].num_rows
                if held > FLUSH_PAIRS // 2:
                    yield from _count_rows(parts[0], schema)
                    parts, held = [], 0
            n = np.bincount(doc, minlength=len(a))
            at = np.concatenate([[0], np.cumsum(n)])
            raw = steps.tobytes()
            yield _rows(schema, hi - lo, {
                "row": rows.column(0), "doc_id": rows.column(1), "a": a, "b": b,
                "steps": [raw[at[i]:at[i + 1]] for i in range(len(a))],
                "n_a": pc.list_value_length(a), "n_b": pc.list_value_length(b),
                "n_groups": np.bincount(doc[steps == 3], minlength=len(a)), "n_links": n,
                "groups_sha256": group_digests(a, b, steps, codec)})
        pa.default_memory_pool().release_unused()
    if parts:
        yield from _count_rows(added(parts), schema)


def _count_rows(counts: pa.Table, schema: pa.Schema):
    for lo in range(0, counts.num_rows, LIST_PAIRS):
        some = counts.slice(lo, LIST_PAIRS)
        one = {k: pa.ListArray.from_arrays([0, some.num_rows], some[c].combine_chunks())
               for k, c in (("pairs", "pair"), ("counts", "n"))}
        yield _rows(schema, 1, one)


def _rows(schema: pa.Schema, n: int, columns: dict) -> pa.RecordBatch:
    filled = []
    for f in schema:
        value = columns.get(f.name)
        if value is None:
            value = pa.nulls(n, f.type)
        elif not isinstance(value, pa.Array):
            value = pa.array(value, f.type)
        filled.append(value if value.type == f.type else value.cast(f.type))
    return pa.RecordBatch.from_arrays(filled, schema=schema)


def corpus_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that link the pair; whether no pair of the same
    A id has more."""
    partial = aligned.where("pairs IS NOT NULL").select(F.inline(F.arrays_zip("pairs", "counts")))
    counts = reliable_checkpoint(partial.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n")))
    of_a = F.shiftright("pair", SHIFT).alias("a")
    most = counts.groupBy(of_a).agg(F.max("n").alias("most"))  # one row per A id at most
    return counts.withColumn("a", of_a).join(F.broadcast(most), "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def hot_counts(counts: DataFrame, limit: int = HOT_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (ascending), counts and best marks of the most frequent pairs, ``limit`` at
    most: all whose count lies in the highest quarter-octaves that fit."""
    octave = F.floor(F.log2("n") * 4).cast("int").alias("octave")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(octave).count().collect()), reverse=True)
    lowest, room = None, limit
    for number, size in sizes:
        room -= size
        if room < 0:
            break
        lowest = number
    if lowest is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    table = counts.where(octave >= lowest).toArrow().combine_chunks()
    pairs, n, best = (table[c].to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pairs)
    return pairs[order], n[order], best[order]


def _scored(aligned: DataFrame, hot) -> DataFrame:
    """Documents with the sums over links of hot pairs, and the other links' pairs."""
    kept = aligned.where("row IS NOT NULL").select(
        "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "steps")
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.select(*names).schema)
    schema = f"{fields}, n_best long, count_sum long, rest array<struct<pair: long, links: long>>"

    out = to_arrow_schema(schema)

    def run(batches):
        worker_cache().clear()  # the tokenizers of the first pass are not needed any more
        pairs, counts, best = hot.value
        for batch in batches:
            lengths = pc.binary_length(batch.column(9)).to_numpy(zero_copy_only=False)
            for lo, hi in slices(lengths, SLICE_CHARS):
                yield _score_slice(batch.slice(lo, hi - lo), names, pairs, counts, best, out)
            pa.default_memory_pool().release_unused()

    return kept.mapInArrow(run, schema)


def _score_slice(rows: pa.RecordBatch, names, hot_pairs, hot_n, hot_best, schema) -> pa.RecordBatch:
    a, b = rows.column(7), rows.column(8)
    n = pc.binary_length(rows.column(9)).to_numpy(zero_copy_only=False)
    steps = np.frombuffer(b"".join(rows.column(9).to_pylist()), np.uint8)
    ids_a, ids_b = link_ids(a, b, steps)
    coded = pc.dictionary_encode(pa.array((ids_a.astype(np.int64) << SHIFT) + ids_b))
    kinds, kind = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    if len(hot_pairs):
        place = np.minimum(np.searchsorted(hot_pairs, kinds), len(hot_pairs) - 1)
        known = hot_pairs[place] == kinds
        n_of, best_of = np.where(known, hot_n[place], 0), known & hot_best[place]
    else:
        known = best_of = np.zeros(len(kinds), bool)
        n_of = np.zeros(len(kinds), np.int64)
    at = np.concatenate([[0], np.cumsum(n)])

    def per_document(values):
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[at[1:]] - total[at[:-1]]

    rest = [[] for _ in range(len(n))]
    cold = np.flatnonzero(~known[kind])
    if len(cold):
        doc = np.searchsorted(at, cold, "right") - 1
        found = pa.table({"doc": doc, "pair": kinds[kind[cold]]}).group_by(["doc", "pair"], use_threads=False).aggregate(
            [([], "count_all")]).to_pydict()
        for d, pair, links in zip(*found.values()):
            rest[d].append({"pair": pair, "links": links})
    columns = {c: rows.column(i) for i, c in enumerate(names)}
    return _rows(schema, len(n), columns | {"n_best": per_document(best_of[kind]), "count_sum": per_document(n_of[kind]),
                                            "rest": rest})


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Arrow batches of ``rows`` rows for the jobs run inside (the session's size after)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def alignment_statistics(documents: DataFrame, paths: tuple[str, str] | None = None,
                         hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row."""
    spark: SparkSession = documents.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/alignment-{uuid.uuid4().hex}"
    with small_batches(spark):
        aligned_documents(documents, paths).write.option("compression", "zstd").parquet(f"{folder}/aligned")
    aligned = spark.read.parquet(f"{folder}/aligned")
    counts = reliable_checkpoint(corpus_counts(aligned))
    hot = spark.sparkContext.broadcast(hot_counts(counts, hot_pairs))
    with small_batches(spark):
        _scored(aligned, hot).write.parquet(f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored")
    rest = scored.where(F.size("rest") > 0).select("row", F.inline("rest")).join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("_best"),
        F.sum(F.col("links") * F.col("n")).alias("_sum"))
    return scored.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def op12_token_alignment(spark, sf_dir) -> DataFrame:
    return alignment_statistics(load_table(spark, sf_dir, "documents"))
