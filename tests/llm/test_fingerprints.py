"""Chunking, fingerprints and the order of documents, against plain Python."""
import hashlib
import random

from bitext.llm import fingerprints as fp


def text(seed, n):
    rnd = random.Random(seed)
    return "".join(rnd.choice("abcdefgh é日 \n") for _ in range(n))


def brute_gear(data):
    out, h = [], 0
    for b in data:
        h = ((h << 1) + int(fp._GEAR[b])) % 2**64
        out.append(h)
    return out


def test_gear_hash_rolls():
    data = text(1, 500).encode()
    assert fp.gear_hashes(data).tolist() == brute_gear(data)
    assert fp.gear_hashes(b"").tolist() == [] and fp.gear_hashes(b"x").tolist() == brute_gear(b"x")


def test_chunks_cover_and_shift():
    t = text(2, 6000)
    ends = fp.boundaries(t.encode())
    sizes = [b - a for a, b in zip([0] + ends, ends)]
    assert ends[-1] == len(t.encode()) and max(sizes) <= fp.MAX_CHUNK and min(sizes[:-1]) >= fp.MIN_CHUNK
    a, b = fp.chunk_digests(t), fp.chunk_digests("some words before " + t)
    assert fp.contained(a, b) > 0.95 and fp.likeness(a, b) > 0.9
    assert fp.likeness(a, fp.chunk_digests(text(3, 6000))) < 0.05
    assert fp.from_text(fp.to_text(a)) == a
    assert fp.likeness({}, {}) == 1.0 and fp.likeness(a, {}) == 0.0 and fp.contained({}, a) == 0.0


def test_documents(spark):
    rows = [(i * 3, text(i, i * 7 % 400)) for i in range(60)]
    rows += [(500, None), (501, ""), (502, text(9, 90_000)), (503, "same"), (503, "same"), (None, "null id")]
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fingerprint string")
    got = fp.fingerprint_documents(table.repartition(7)).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = []
    for k, (i, t) in enumerate(ordered):
        edited = fp.edited_text(t, ordered[(k + 1) % len(ordered)][1])
        own, new = fp.chunk_digests(t), fp.chunk_digests(edited)
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fp.to_text(own), fp.to_text(new),
                         fp.likeness(own, new), fp.likeness(own, fp.chunk_digests(ordered[(k + 1) % len(ordered)][1]))))
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(expected, key=str)


def test_empty_and_single(spark):
    table = spark.createDataFrame([(7, "only one document here")], "doc_id long, text string")
    assert fp.fingerprint_documents(table.limit(0)).count() == 0
    row = fp.fingerprint_documents(table).first()
    assert row.near_next == 1.0 and row.doc_id == 7
