"""Document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of a text (64 bytes of memory: a byte's
influence is shifted out). A chunk ends where the hash's masked bits are zero,
with normalised chunking: a strict mask before the target size, a lenient one
after it, and hard bounds ``MIN_CHUNK`` and ``MAX_CHUNK``. An insertion moves
only the boundaries near it, so the digests of all other chunks stay.

A fingerprint is the list of a text's chunk digests (48 bits of SHA-256) with the
chunk lengths, each digest once. Containment weighs shared digests by length:
``contained(a, b)`` is the share of a's distinct chunk bytes found in b, and
``likeness`` the shared bytes over the bytes of either (0 to 1).

Defined results
* NULL and empty text: empty fingerprint ''. Two empty fingerprints are alike
  (1.0); an empty and a filled one are not (0.0).
* Equal texts have equal fingerprints.
* The next document of the last is the first; a single row is its own next.
* Rows are ordered by doc_id, NULL first, ties by text; repeated rows follow
  each other.
* Extra columns are not read.

Scale: rows are dealt to ranges of doc_id, so text is shuffled once; each range
also gets the first row of the next range. Range limits come from a sample of
ids (they only balance the ranges). A task streams its sorted rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from ._common import load_table, shuffle_partitions
from .ranges import by_ranges_with_next, range_limits

MIN_CHUNK, TARGET_CHUNK, MAX_CHUNK = 16, 48, 192
STRICT_BITS, LENIENT_BITS = 7, 4
DIGEST_HEX = 12

# One random 64-bit number for each byte value.
_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64 - 1, 256, dtype=np.uint64)
_STRICT = np.uint64(((1 << STRICT_BITS) - 1) << (64 - STRICT_BITS))
_LENIENT = np.uint64(((1 << LENIENT_BITS) - 1) << (64 - LENIENT_BITS))


def gear_hashes(data: bytes) -> np.ndarray:
    """Rolling hash after each byte: ``sum(gear[byte[i - j]] << j)``, by doubling."""
    h = _GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < 64:
        if width < len(h):
            longer = h.copy()
            longer[width:] += h[:-width] << np.uint64(width)
            h = longer
        width *= 2
    return h


def boundaries(data: bytes) -> list[int]:
    """End offsets of the chunks of ``data``."""
    size = len(data)
    if not size:
        return []
    h = gear_hashes(data)
    lenient = np.flatnonzero((h & _LENIENT) == 0)
    strict = (h[lenient] & _STRICT) == 0
    ends = (lenient + 1).tolist()
    strict = strict.tolist()
    out, start, k, n = [], 0, 0, len(ends)
    while start < size:
        cut = min(start + MAX_CHUNK, size)
        while k < n and ends[k] < start + MIN_CHUNK:
            k += 1
        while k < n and ends[k] < cut:
            if strict[k] or ends[k] >= start + TARGET_CHUNK:
                cut = ends[k]
                break
            k += 1
        out.append(cut)
        start = cut
    return out


def chunk_digests(text: str | None) -> dict[str, int]:
    """Digest -> length in bytes of the distinct chunks, in order of appearance."""
    data = (text or "").encode("utf-8", "surrogatepass")
    out, start = {}, 0
    for end in boundaries(data):
        piece = data[start:end]
        out[hashlib.sha256(piece).hexdigest()[:DIGEST_HEX]] = len(piece)
        start = end
    return out


def to_text(chunks: dict[str, int]) -> str:
    """Fingerprint text: digest and two hexadecimal digits of length per chunk."""
    return "".join(f"{d}{n:02x}" for d, n in chunks.items())


def from_text(fingerprint: str) -> dict[str, int]:
    step = DIGEST_HEX + 2
    return {fingerprint[i:i + DIGEST_HEX]: int(fingerprint[i + DIGEST_HEX:i + step], 16)
            for i in range(0, len(fingerprint), step)}


def contained(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of a's chunk bytes that are in b."""
    total = sum(a.values())
    return sum(n for d, n in a.items() if d in b) / total if total else float(not b)


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    """Shared chunk bytes over the chunk bytes of either."""
    shared = sum(n for d, n in a.items() if d in b)
    either = sum(a.values()) + sum(b.values()) - shared
    return shared / either if either else 1.0


def edited_text(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as much of the next text's start."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, contained_in_edited, contained_in_next``."""
    import pyarrow as pa

    from ._common import record_batch, to_arrow_schema

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, contained_in_edited double, contained_in_next double")
    out = to_arrow_schema(schema)

    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                yield from zip(*[c.to_pylist() for c in batch.slice(lo, 512).columns])

    def result(doc, text, own, following, other):
        edited = edited_text(text, following)
        new = chunk_digests(edited) if edited != text else own
        return (doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(own),
                to_text(new), likeness(own, new), likeness(own, other), contained(own, new), contained(own, other))

    def give(made):
        return record_batch(dict(zip(out.names, [pa.array(c, f.type) for f, c in zip(out, zip(*made))])), out)

    def run(batches):
        held, made, bucket = None, [], None
        for own_bucket, halo, doc, text in rows(batches):
            if bucket != own_bucket:
                held, bucket = None, own_bucket
            text = text or ""
            chunks = chunk_digests(text)
            if held is not None:
                made.append(result(*held, text, chunks))
            # the first extra row is the next document of the range's last row
            held = None if halo else (doc, text, chunks)
            if len(made) >= 512:
                yield give(made)
                made = []
        if made:
            yield give(made)

    limits = range_limits(documents, "doc_id", shuffle_partitions(documents.sparkSession))
    dealt = by_ranges_with_next(documents.select("doc_id", "text"), "doc_id", limits)
    return dealt.select("_bucket", "_halo", "doc_id", "text").mapInArrow(run, schema)


def op1_fingerprints(spark, sf_dir):
    return fingerprint_documents(load_table(spark, sf_dir, "documents"))
