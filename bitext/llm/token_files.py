"""Token-ID files packed by a static range asymmetric numeral system (rANS).

Documents are encoded with a tokenizer, an end id follows each, and the ids are
written in ascending doc_id order as segments. A segment is one self-contained
binary image:

    header     magic 'tANS', version, precision, lanes, tokens per block, counts
    table      the segment's distinct ids and their scaled frequencies, shared
               by all its blocks
    documents  number of ids of each document
    directory  per block: ids, words, CRC-32 of its ids, and the state of every
               lane to start decoding from (the block's checkpoint)
    words      the blocks' 32-bit words

Blocks are independent: the directory alone says where one starts and how, so
any block can be decoded without the others. Within a block id i goes to lane
i mod ``LANES`` (interleaved states sharing one word stream). All lanes of all
blocks of a segment are stepped together with numpy. Decoding checks that every
lane returns to its starting state and each block's checksum.

Segments are rows of a Parquet folder (``bucket, segment, first_token, doc_ids,
n_tokens, image``), so writing, committing and parallel reading are Spark's, on any
file system that Spark reaches.

Defined results
* NULL and empty text: the end id alone.
* Ties and repeated doc_ids: each row is its own document, ordered by text ids.
  NULL doc_ids come first.
* An empty table gives an empty folder and no rows.
* Extra columns are not read.

Scale: text is encoded where it is read; only 16-bit ids are shuffled, once, to
ranges of doc_id. A task streams a range and holds one segment. Range offsets
(one number per range) are the only thing that goes through the driver.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitext.session import ensure_checkpoint_dir

from ._common import load_table, map_rows, record_batch, shuffle_partitions, to_arrow_schema, worker_cache
from .bpe import byte_alphabet, vocabulary_path
from .ranges import by_ranges, range_limits

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SEGMENT_TOKENS = 1 << 20
BLOCK_TOKENS = 1 << 16
LANES = 64
MEMO_ENTRIES = 800_000

_HEADER = "<4sBBHIIQII"
_LOW = np.uint64(1 << 31)
_MAGIC = b"tANS"


# --- encoding with the tokenizer ---------------------------------------------
class WordEncoder:
    """``Tokenizer.encode(text, add_special_tokens=False).ids`` through a bounded
    memo of blank-separated pieces (this tokenizer never joins across blanks).

    A memo has two generations: a full one becomes the old one, and what is looked up
    in the old one moves to the new one, so frequent pieces stay."""

    #: Letters whose lower case and composed form are themselves or one letter.
    _SIMPLE = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
    _PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
    #: Marks that are a part of their own after letters.
    _ENDS = ".,;:!?"
    #: Separators to str.split but not to the tokenizer.
    _ODD = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.merge = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = dict(enumerate(byte_alphabet()))
        self.memo_entries = memo_entries
        self.pieces = Memo(memo_entries)  # a part is a piece of one part
        self.type = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        width = int(self.type[-1])
        self.raw = [i.to_bytes(width, "little") for i in range(self.library.get_vocab_size())]

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special) or any(c in text for c in self._ODD):
            return self._library(text)
        pieces = text.split()
        ids = list(map(self.pieces.young.get, pieces))
        if None in ids:
            ids = [self._piece(p) if x is None else x for p, x in zip(pieces, ids)]
        return b"".join(ids)

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.find(piece)
        if ids is None:
            word = piece.lower() if piece.isascii() else ""
            if word.isalpha():
                ids = self._part(word)
                if word == piece:
                    return ids
            elif word[-1:] in self._ENDS and word[:-1].isalpha():
                ids = self._part(word[:-1]) + self._part(word[-1])
            elif self._SIMPLE.fullmatch(piece):
                ids = b"".join(map(self._part, self._PARTS.findall(piece.lower())))
            else:
                ids = self._library(piece)
            self.pieces.keep(piece, ids)
        return ids

    def _part(self, part: str) -> bytes:
        ids = self.pieces.find(part)
        if ids is None:
            # Visible ASCII stands for itself.
            symbols = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([self.raw[t.id] for t in self.merge.tokenize(symbols)])
            self.pieces.keep(part, ids)
        return ids


class Memo:
    """Two generations of at most half of ``entries`` short keys each."""

    def __init__(self, entries: int):
        self.half = max(1, entries // 2)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.keep(key, found)
        return found

    def keep(self, key: str, value: bytes) -> None:
        if len(key) <= 64:
            if len(self.young) >= self.half:
                self.old, self.young = self.young, {}
            self.young[key] = value


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file; kept between tasks."""
    cache = worker_cache()
    if ("encoder", path) not in cache:
        cache["encoder", path] = WordEncoder(path)
    return cache["encoder", path]


# --- segment images -------------------------------------------------------------
def scaled_frequencies(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies of at least 1 that sum to ``2 ** bits``."""
    total = 1 << bits
    f = np.maximum(1, counts * total // counts.sum()).astype(np.int64)
    over = int(f.sum()) - total
    if over < 0:
        f[np.argmax(f)] -= over
    while over > 0:
        i = int(np.argmax(f))
        cut = min(over, int(f[i]) // 2)
        f[i] -= cut
        over -= cut
    return f


def pack_segment(ids: np.ndarray, doc_lengths: np.ndarray, block_tokens: int = BLOCK_TOKENS,
                 lanes: int = LANES) -> bytes:
    """Image of a segment of at least one id."""
    n = len(ids)
    if ids.itemsize == 2:  # counted in a table of all ids, no sort
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        counts, place = counts[symbols], np.zeros(len(counts), np.int64)
        place[symbols] = np.arange(len(symbols))
        codes = place[ids]
    else:
        symbols, codes, counts = np.unique(ids, return_inverse=True, return_counts=True)
    bits = min(22, max(12, int(len(symbols) - 1).bit_length() + 3))
    freq = scaled_frequencies(counts, bits)
    start = np.r_[0, np.cumsum(freq)[:-1]]
    blocks = -(-n // block_tokens)
    steps = -(-min(n, block_tokens) // lanes)
    grid = np.full(blocks * steps * lanes, -1, np.int64)
    if blocks > 1:
        grid = np.full(blocks * (block_tokens // lanes) * lanes, -1, np.int64)
        steps = block_tokens // lanes
    grid[:n] = codes
    grid = np.ascontiguousarray(grid.reshape(blocks, steps, lanes).transpose(1, 0, 2)).reshape(steps, -1)
    f64, s64 = freq.astype(np.uint64), start.astype(np.uint64)
    shift, word = np.uint64(bits), np.uint64(32)
    state = np.full(blocks * lanes, _LOW, np.uint64)
    given = np.zeros(grid.shape, bool)
    words = np.zeros(grid.shape, np.uint32)
    for t in range(steps - 1, -1, -1):
        code = grid[t]
        live = code >= 0
        whole = live.all()
        f, c = f64[code], s64[code]
        full = state >= f << np.uint64(63 - bits)
        if not whole:
            full &= live
        given[t] = full
        words[t] = state  # low 32 bits; only the given ones count
        x = np.where(full, state >> word, state)
        q = x // f
        x = (q << shift) + (x - q * f) + c
        state = x if whole else np.where(live, x, state)
    parts, directory = [], []
    for b in range(blocks):
        own = slice(b * lanes, (b + 1) * lanes)
        out = words[:, own][given[:, own]]
        raw = ids[b * block_tokens:(b + 1) * block_tokens].astype("<u4")
        directory.append(struct.pack("<III", len(raw), len(out), zlib.crc32(raw.tobytes()))
                         + state[own].astype("<u8").tobytes())
        parts.append(out.astype("<u4").tobytes())
    header = struct.pack(_HEADER, _MAGIC, 1, bits, lanes, block_tokens, len(doc_lengths), n, blocks, len(symbols))
    return b"".join([header, symbols.astype("<u4").tobytes(), freq.astype("<u4").tobytes(),
                     np.asarray(doc_lengths, "<u4").tobytes(), *directory, *parts])


class Segment:
    """Reader of a segment image; decodes all or chosen blocks."""

    def __init__(self, image: bytes):
        (magic, version, self.bits, self.lanes, self.block_tokens, docs, self.n_tokens, self.blocks,
         n_symbols) = struct.unpack_from(_HEADER, image)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a token segment of a known version")
        at = struct.calcsize(_HEADER)

        def take(kind, count):
            nonlocal at
            found = np.frombuffer(image, kind, count, at)
            at += found.nbytes
            return found

        self.symbols = take("<u4", n_symbols)
        self.freq = take("<u4", n_symbols).astype(np.int64)
        self.doc_lengths = take("<u4", docs)
        self.sizes, self.checks, self.states, word_counts = [], [], [], []
        for _ in range(self.blocks):
            size, n_words, check = take("<u4", 3).tolist()
            self.sizes.append(size)
            word_counts.append(n_words)
            self.checks.append(check)
            self.states.append(take("<u8", self.lanes))
        self.word_at = np.r_[0, np.cumsum(word_counts)].astype(np.int64)
        self.words = take("<u4", int(self.word_at[-1]))

    def decode(self, blocks: list[int] | None = None) -> np.ndarray:
        """Ids of the blocks (default all), checked, in order."""
        chosen = list(range(self.blocks)) if blocks is None else blocks
        if not chosen:
            return np.empty(0, np.uint32)
        sizes = np.array([self.sizes[b] for b in chosen])
        steps = int(-(-sizes.max() // self.lanes))
        start = np.r_[0, np.cumsum(self.freq)[:-1]]
        slot_code = np.repeat(np.arange(len(self.symbols)), self.freq)
        f64, s64 = self.freq.astype(np.uint64), start.astype(np.uint64)
        state = np.stack([self.states[b] for b in chosen]).astype(np.uint64)
        at = self.word_at[chosen].copy()
        mask, shift, word = np.uint64((1 << self.bits) - 1), np.uint64(self.bits), np.uint64(32)
        lane = np.arange(self.lanes)
        words = np.r_[self.words, np.uint32(0)].astype(np.uint64)
        out = np.empty((steps, len(chosen), self.lanes), np.int64)
        whole = int(sizes.min()) // self.lanes
        for t in range(steps):
            slot = state & mask
            code = slot_code[slot.astype(np.int64)]
            out[t] = code
            x = f64[code] * (state >> shift) + slot - s64[code]
            short = x < _LOW
            live = None
            if t >= whole:
                live = t * self.lanes + lane < sizes[:, None]
                short &= live
            seen = np.cumsum(short, axis=1)
            place = np.where(short, at[:, None] + seen - 1, len(self.words))
            x = np.where(short, (x << word) | words[place], x)
            at += seen[:, -1]
            state = x if live is None else np.where(live, x, state)
        if (state != _LOW).any():
            raise ValueError("a lane did not return to its first state")
        ids = self.symbols[out.transpose(1, 0, 2).reshape(len(chosen), -1)
                           [np.arange(steps * self.lanes) < sizes[:, None]]]
        for b, part in zip(chosen, np.split(ids, np.cumsum(sizes)[:-1])):
            if zlib.crc32(part.astype("<u4").tobytes()) != self.checks[b]:
                raise ValueError(f"block {b}: wrong checksum")
        return ids


# --- jobs --------------------------------------------------------------------------
def token_ids(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, ids``: little-endian ids (16-bit if the vocabulary allows) with the end id."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def make():
        e = encoder(tokenizer)
        end = np.array([end_id], e.type).tobytes()

        def work(doc_ids, texts):
            yield {"doc_id": doc_ids, "ids": [e.encode(t) + end if t else end for t in texts]}

        return work

    return map_rows(documents, ["doc_id", "text"], f"doc_id {kind}, ids binary", make)


def write_token_files(documents: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                      segment_tokens: int = SEGMENT_TOKENS, block_tokens: int = BLOCK_TOKENS,
                      lanes: int = LANES) -> None:
    """Write the documents' ids as segments under ``path`` (a new folder)."""
    tokenizer = tokenizer or vocabulary_path(VOCABULARY)
    if block_tokens % lanes:
        raise ValueError("block_tokens must be a multiple of lanes")
    kind = documents.schema["doc_id"].dataType.simpleString()
    limits = range_limits(documents, "doc_id", shuffle_partitions(documents.sparkSession))
    schema = f"bucket int, segment int, first_token long, doc_ids array<{kind}>, n_tokens long, image binary"
    out = to_arrow_schema(schema)
    width = WordEncoder(tokenizer).type

    def run(batches):
        bucket, docs, parts, held, segment, first = None, [], [], 0, 0, 0

        def flush():
            nonlocal docs, parts, held, segment, first
            ids = np.frombuffer(b"".join(parts), width)
            lengths = np.array([len(p) for p in parts]) // ids.itemsize
            row = {"bucket": [bucket], "segment": [segment], "first_token": [first], "doc_ids": [docs],
                   "n_tokens": [len(ids)], "image": [pack_segment(ids, lengths, block_tokens, lanes)]}
            docs, parts, held, segment, first = [], [], 0, segment + 1, first + len(ids)
            return record_batch(row, out)

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                for own, doc, ids in zip(*[c.to_pylist() for c in batch.slice(lo, 512).columns]):
                    if own != bucket:
                        if parts:
                            yield flush()
                        bucket, segment, first = own, 0, 0
                    docs.append(doc)
                    parts.append(ids)
                    held += len(ids)
                    if held >= segment_tokens * np.dtype(width).itemsize:
                        yield flush()
        if parts:
            yield flush()

    ranged = by_ranges(token_ids(documents, tokenizer, end_id), "doc_id", limits)
    ranged.select("_bucket", "doc_id", "ids").mapInArrow(run, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``, 32-bit little-endian)."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    offsets, total = {}, 0
    for bucket, n in sorted(tuple(r) for r in files.groupBy("bucket").agg(F.sum("n_tokens")).collect()):
        offsets[bucket], total = total, total + n
    schema = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                bucket, first, docs, image = [c[k].as_py() for c in batch.columns]
                segment = Segment(image)
                ids = segment.decode().astype("<u4")
                ends = np.cumsum(segment.doc_lengths.astype(np.int64))
                if len(docs) != len(ends) or int(ends[-1]) != len(ids):
                    raise ValueError("document lengths and ids disagree")
                starts = ends - segment.doc_lengths
                raw = [ids[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
                cols = {"doc_id": docs, "start": (starts + offsets[bucket] + first).tolist(),
                        "n_tokens": (ends - starts).tolist(), "ids_crc32": [zlib.crc32(r) for r in raw], "ids": raw}
                yield record_batch(cols, out)

    return files.select("bucket", "first_token", "doc_ids", "image").mapInArrow(run, schema)


def op2_token_files(spark, sf_dir):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_token_files(load_table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path, with_ids=False)
