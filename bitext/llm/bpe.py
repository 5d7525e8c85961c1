"""Byte-level BPE encoding and decoding by tree concatenation.

Text is cut where the tokenizer always cuts it (at a blank between two characters
that are not white space), and each piece is encoded once per worker through a
bounded memo; a run of mixed white space stays whole, with its neighbours. A
piece that stays long without a cut (a run of letters, signs or blanks) is
encoded as a tree: its halves are encoded down to short leaves, all leaves of a
batch in one parallel library call, and joined level by level. A join
re-encodes a window of tokens around the seam and doubles it until the window's
first token equals the left side's and its last token the right side's. Then
every adjacent token pair of the result is one that the merge rules leave
standing, which makes the whole sequence the encoding of the whole run.

Defined results
* NULL and empty text: no tokens, decoded text ''.
* The tokenizer's special strings inside a text become their ids, as in the
  library's ``encode``.
* Rows are independent: repeated rows, ties and extra columns do not matter.

Scale: no shuffle. A worker holds the vocabulary, a memo of at most
``MEMO_ENTRIES`` pieces, and one slice of rows.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import load_table, map_rows, worker_cache

VOCABULARY = "byte_bpe_50k.json"
MEMO_ENTRIES = 100_000
#: Unsplit runs of more bytes than this are encoded as a tree.
LEAF_BYTES = 256
FIRST_WINDOW = 4
#: The pre-tokenizer cuts before every such blank: its white space is a part of Python's.
CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> list[str]:
    """The byte-level alphabet: visible latin-1 characters stand for themselves,
    the other bytes for the code points from 256 on, in byte order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class TreeBpe:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES, leaf_bytes: int = LEAF_BYTES):
        import regex
        from tokenizers import Tokenizer, models
        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.model = Tokenizer.from_str(json.dumps(spec | {
            "added_tokens": [], "normalizer": None, "pre_tokenizer": None, "post_processor": None}))
        self.merge = self.model.model
        self.pretoken = regex.compile(public_tokenizers.PATTERN)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        alphabet = byte_alphabet()
        self.letters = {b: c for b, c in enumerate(alphabet)}
        back = {c: b for b, c in enumerate(alphabet)}
        self.token_bytes = {i: bytes(back[c] for c in t) for t, i in model["vocab"].items()
                            if t not in self.special}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.memo: dict[str, bytes] = {}
        self.memo_entries, self.leaf_bytes = memo_entries, leaf_bytes
        self.joins = 0

    # -- encoding ---------------------------------------------------------
    def encode(self, text: str) -> bytes:
        """Token ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.special_at is None or not any(s in text for s in self.special):
            return self._encode_plain(text)
        out, at = [], 0
        for m in self.special_at.finditer(text):
            out += [self._encode_plain(text[at:m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._encode_plain(text[at:])])

    def _encode_plain(self, text: str) -> bytes:
        if not text:
            return b""
        head, *rest = CUT.split(text)
        ids = list(map(self.memo.get, rest))
        if None in ids:
            ids = [self._spaced(p) if x is None else x for p, x in zip(rest, ids)]
        return self._piece(head) + b"".join(ids)

    def _spaced(self, piece: str) -> bytes:
        """Ids of a blank and ``piece``, remembered by the piece."""
        ids = self.memo.get(piece)
        if ids is None:
            ids = self._piece(" " + piece)
            if len(piece) <= self.leaf_bytes:
                if len(self.memo) >= self.memo_entries:
                    self.memo.clear()
                self.memo[piece] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that starts and ends at cuts of the pre-tokenizer."""
        return b"".join(map(self._run, self.pretoken.findall(piece)))

    def _run(self, run: str) -> bytes:
        symbols = run.encode("utf-8").decode("latin-1").translate(self.letters)
        if len(symbols) <= self.leaf_bytes:
            ids = [t.id for t in self.merge.tokenize(symbols)]
        else:
            ids = self._tree(symbols)
        return np.array(ids, "<u4").tobytes()

    def _tree(self, symbols: str) -> list[int]:
        """Leaves in one library call, then joins, level by level."""
        step = self.leaf_bytes
        level = [(lo, min(lo + step, len(symbols))) for lo in range(0, len(symbols), step)]
        sides = self._library([symbols[a:b] for a, b in level])
        while len(sides) > 1:
            pairs = [self._join(sides[i], sides[i + 1]) for i in range(0, len(sides) - 1, 2)]
            sides = pairs + ([sides[-1]] if len(sides) % 2 else [])
        return sides[0]

    def _library(self, strings: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(strings, add_special_tokens=False)]

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the two sides' concatenation."""
        size = FIRST_WINDOW
        while True:
            self.joins += 1
            a, b = max(0, len(left) - size), min(len(right), size)
            raw = b"".join(map(self.token_bytes.__getitem__, left[a:] + right[:b]))
            window = self._library([raw.decode("latin-1").translate(self.letters)])[0]
            if (a == 0 or window[0] == left[a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[:a] + window + right[b:]
            size *= 2

    # -- decoding ---------------------------------------------------------
    def decode(self, ids: bytes) -> str:
        """Text of little-endian 32-bit ids; unknown ids are skipped, and broken
        UTF-8 becomes U+FFFD."""
        known = self.token_bytes
        return b"".join([known.get(i, b"") for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def codec(path: str) -> TreeBpe:
    """The worker's codec of a vocabulary file; kept between tasks."""
    cache = worker_cache()
    if ("bpe", path) not in cache:
        cache["bpe", path] = TreeBpe(path)
    return cache["bpe", path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encode_documents(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids`` (binary, little-endian unsigned 32-bit) ``, decoded``."""
    return _run(documents, vocabulary, (), lambda ids, decoded: {"ids": ids, "decoded": decoded},
                "ids binary, decoded string")


def _run(documents, vocabulary, columns, make_columns, schema):
    fields = documents.select("doc_id", *columns).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def make():
        c = codec(vocabulary or vocabulary_path())

        def work(texts, doc_ids, *rest):
            ids = [c.encode(t or "") for t in texts]
            yield {"doc_id": doc_ids} | dict(zip(columns, rest)) | make_columns(ids, [c.decode(x) for x in ids])

        return work

    return map_rows(documents, [F.col("text").alias("_text"), "doc_id", *columns], f"{ddl}, {schema}", make)


def bpe_round_trip(documents: DataFrame, vocabulary: str | None = None, columns: list[str] = ()) -> DataFrame:
    """Per document ``doc_id, <columns>``, the token count and the digests of ids
    and decoded text."""
    return _run(
        documents, vocabulary, columns,
        lambda ids, decoded: {"n_tokens": [len(x) // 4 for x in ids],
                              "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                              "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in decoded]},
        "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark, sf_dir):
    return bpe_round_trip(load_table(spark, sf_dir, "documents"))
