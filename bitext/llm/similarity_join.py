"""Exact shingle-Jaccard join and its components, by parity sketches.

A document is the set of its distinct 5-word shingles. Two documents link when
``100 * |A & B| >= 80 * |A | B|``, so their symmetric difference is at most
``(|A| + |B|) / 9``.

Method
1. Documents with equal sets are one node from here on (class = its smallest id).
2. XOR-hashing puts a set into a parity sketch: shingle -> bit position, a bit
   is the parity of the shingles on it. One shingle more or less flips one bit,
   so the Hamming distance of two sketches never exceeds the sets' symmetric
   difference. The sketch is cut into segments; its length depends only on the
   size band (sizes within a factor of ``BAND_GROWTH``).
3. Pigeonhole: ``t`` differing shingles spoil at most ``t`` segments. So of the
   filled segments, in one global order, the first ``t + 1`` of each side must
   share one (the prefix principle). Those are the join keys. Shared shingles, and
   common ones, have segments of their own, last in that order, so a passage of
   several documents becomes a key only where a text has little else.
4. A document with no more than ``t`` filled segments also gives keys of a
   finer sketch, and so on; two documents meet on the finest level that both
   have, where at least one of them has enough segments. No link is lost.
5. Keys are sorted by value. Every member of a key is paired with the key's first
   member; a pair whose sizes or whole sketches are too far apart is out, the
   others are compared exactly, and the links' components are found. Where a key
   still joins different components, each of a few other members (other ones each
   round) meets the members outside its component, so a family of near copies
   grows together at the cost of its size.
6. What then still joins different components is compared in full across them:
   sketch against sketch in blocks of ``BLOCK_SETS`` members, inside tasks; only
   pairs whose sketches allow a link become rows and are compared exactly.

Defined results
* NULL, empty or wordless text: empty set, linked with nothing.
* Fewer than five words: the whole word sequence is the one shingle.
* Rows sharing a doc_id are one document whose links are those of all its rows.
* NULL doc_id: its size is reported, component NULL, and it links with nothing.
* Extra columns are not read.

Scale: text is never shuffled except that of documents in candidate pairs. Which
shingles are shared is counted over all documents, from sorted and packed 32-bit
hashes, and kept in two Bloom filters of ``FILTER_BITS`` bits; neither they nor
the slot filter of candidate ids grow with the data. A shingle wrongly taken for
a shared one only moves to the end of the order: that costs time, never a link.
(Past some 2 ** 32 shingles chance makes most hashes shared and the order fades.)
Steps hand their rows on as Parquet: a small table is then read by few tasks, however
many partitions made it, which keeps the number of shuffle files down.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.session import reliable_checkpoint, written_table

from ._common import gram_hashes, load_table, map_rows, mix64, word_hashes
from .graph import connected_components
from .idfilter import only_ids

SHINGLE_WORDS = 5
BAND_GROWTH = 3
#: Places of a segment; it is only ever held as a digest, so that many cost nothing.
SEGMENT_BITS = 1 << 32
#: A shingle is shared from two documents on, common above this many.
COMMON_DOCUMENTS = 8
#: Bits of each of the two fixed-size filters of shared and of common shingles.
FILTER_BITS = 1 << 26
#: Shingles that a task counts together, and documents per part of the slots.
COUNT_BLOCK = 2_000_000
DOCUMENTS_PER_PART = 4_096
#: Rounds of pairing with single members before the full comparison, members that
#: a key offers in a round, and block size of the full comparison.
STAR_ROUNDS, STAR_LEADERS = 2, 6
BLOCK_SETS = 2_048
#: Sets a task remembers so as to give the keys of a repeated set once.
GIVEN_SETS = 1_000_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    if not text:
        return np.empty(0, np.uint64)
    words = word_hashes(text.encode("utf-8", "surrogatepass").translate(_LOWER))[2]
    if len(words) >= SHINGLE_WORDS:
        return np.unique(gram_hashes(words, SHINGLE_WORDS))
    if not len(words):
        return words
    return mix64(gram_hashes(words, len(words)) + np.uint64(len(words)))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    common = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * common >= 80 * (len(a) + len(b) - common)


def _bands(largest: int) -> list[tuple[int, int, int]]:
    """``(smallest, largest, cap)``: band of the smaller set; partners go up to the cap."""
    out, lo = [], 1
    while lo <= largest:
        up = max(lo + 1, int(lo * BAND_GROWTH))
        out.append((lo, up - 1, 5 * (up - 1) // 4))
        lo = up
    return out


_ALL_BANDS = _bands(2**40)


def join_keys(shingles: np.ndarray, common: tuple) -> np.ndarray:
    """64-bit join keys of a set; ``common`` holds the two filters (``shared_filters``)."""
    n = len(shingles)
    differ = (n + 5 * n // 4) // 9
    if not differ:  # only an equal set can be linked
        return np.empty(0, np.uint64)
    frequent = frequency_class(shingles, common)
    out = []
    for band, (lo, hi, cap) in enumerate(_ALL_BANDS):
        if lo > n:
            break
        if n > cap:
            continue
        segments = -(-115 * (hi // 4 + 1) // 100) + 4
        for level in range(64):
            count = segments << (2 * level)
            salt = band * 64 + level + 1
            spread = np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
            place = mix64(shingles + spread) % np.uint64(count * SEGMENT_BITS)
            segment = place // np.uint64(SEGMENT_BITS) + frequent * np.uint64(count)
            order = np.argsort(segment, kind="stable")
            segment = segment[order]
            first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            # Digest of a segment's parity bits: equal places cancel, as their bit does.
            digest = np.bitwise_xor.reduceat(mix64(place + np.uint64(1))[order], first)
            segment, digest = segment[first][digest != 0], digest[digest != 0]
            key = mix64(digest ^ mix64(segment * np.uint64(4096) + np.uint64(salt)))
            out.append(key[np.lexsort((key, segment // np.uint64(count)))][:differ + 1])
            if len(key) > differ:
                break
    return np.concatenate(out)


def parity_sketch(shingles: np.ndarray) -> bytes:
    """Parity bits of the whole set; a power of two, four to eight times the shingles."""
    size = 4 * max(64, 1 << max(0, len(shingles) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    place, count = np.unique(mix64(shingles + np.uint64(11)) % np.uint64(size), return_counts=True)
    bits[place.astype(np.int64)] = count & 1
    return np.packbits(bits, bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Hamming distance; the longer sketch is folded to the shorter one's length.
    Never more than the sets' symmetric difference."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    return int(np.bitwise_count(np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0) ^ x).sum())


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit digests of a set."""
    if not len(shingles):
        return 0, 0
    return (int(mix64(shingles).sum(dtype=np.uint64).view(np.int64)),
            int(np.bitwise_xor.reduce(mix64(shingles + np.uint64(7))).view(np.int64)))


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned 32-bit numbers as gaps, in byte planes so that they compress."""
    gaps = np.diff(values, prepend=values.dtype.type(0)).astype("<u4")
    return gaps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _summaries(documents: DataFrame, parts: int) -> DataFrame:
    """One pass: a row per document (size, set digest, sketch) and, marked by
    ``kind = 1``, the hashes of a block of shingles per part ``n`` of the slots."""
    def make():
        held: list[np.ndarray] = []
        size = 0

        def packed():
            nonlocal held, size
            hashes = np.sort((np.concatenate(held) >> np.uint64(32)).astype(np.uint32)) if held else np.empty(
                0, np.uint32)
            held, size = [], 0
            width = (1 << 32) // parts
            cuts = np.searchsorted(hashes, np.arange(1, parts, dtype=np.int64) * width)
            found = [(i, p) for i, p in enumerate(np.split(hashes, cuts)) if len(p)]
            k = len(found)
            return {"kind": [1] * k, "doc_id": [None] * k, "n": [i for i, _ in found], "d1": [0] * k, "d2": [0] * k,
                    "sketch": [pack_sorted(p - np.uint32(i * width)) for i, p in found]}

        def work(doc_ids, texts):
            nonlocal size
            sets = [shingle_set(t) for t in texts]
            digests = [_digest(s) for s in sets]
            yield {"kind": [0] * len(sets), "doc_id": doc_ids, "n": [len(s) for s in sets],
                   "d1": [d[0] for d in digests], "d2": [d[1] for d in digests],
                   "sketch": [parity_sketch(s) if len(s) > 3 else None for s in sets]}
            held.extend(sets)
            size += sum(map(len, sets))
            if size >= COUNT_BLOCK:
                yield packed()

        work.flush = lambda: [packed()]
        return work

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_rows(documents, ["doc_id", "text"], f"kind int, doc_id {kind}, n long, d1 long, d2 long, sketch binary",
                    make)


def _places(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The two filter bits of 32-bit hashes; both are in the hash's part."""
    part_bits = FILTER_BITS // parts
    first = hashes.astype(np.uint64) >> np.uint64(6)
    other = mix64(hashes.astype(np.uint64) + np.uint64(1)) & np.uint64(part_bits - 1)
    return first.astype(np.int64), ((first & ~np.uint64(part_bits - 1)) | other).astype(np.int64)


def frequency_class(shingles: np.ndarray, filters: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    """0 for a shingle of one document, 1 for a shared one, 2 for a common one."""
    parts, *bitmaps = filters
    places = _places((shingles >> np.uint64(32)).astype(np.uint32), parts)
    return sum(np.logical_and(*[(bits[p >> 3] >> (p & 7).astype(np.uint8) & 1) > 0 for p in places]).astype(np.uint64)
               for bits in bitmaps)


def shared_filters(packed: DataFrame, parts: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of parts, and the filters of shared and of common shingles."""
    part_bits = FILTER_BITS // parts

    def count(key, table):
        import pyarrow as pa

        part = key[0].as_py()
        hashes = np.sort(np.concatenate([unpack_sorted(x.as_py()) for x in table.column("sketch")]))
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        times = np.diff(np.r_[first, len(hashes)])
        bits = []
        for least in (2, COMMON_DOCUMENTS + 1):
            own = np.zeros(part_bits, bool)
            found = hashes[first[times >= least]] + np.uint32(part * ((1 << 32) // parts))
            for place in _places(found, parts):
                own[place - part * part_bits] = True
            bits.append(np.packbits(own, bitorder="little").tobytes())
        return pa.table({"n": pa.array([part], pa.int64()), "shared": pa.array(bits[:1], pa.binary()),
                         "common": pa.array(bits[1:], pa.binary())})

    out = [np.zeros(FILTER_BITS // 8, np.uint8) for _ in range(2)]
    counted = packed.select("n", "sketch").groupBy("n").applyInArrow(count, "n long, shared binary, common binary")
    for n, *bits in counted.toLocalIterator():
        for whole, part in zip(out, bits):
            whole[n * part_bits // 8:(n + 1) * part_bits // 8] = np.frombuffer(part, np.uint8)
    return parts, *out


def _candidate_groups(documents: DataFrame, common: tuple) -> DataFrame:
    """``(key, d1, leader)``: sets (by digest) that share a join key, and the
    key's smallest digest; keys with one set are left out."""
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def make():
        given: set[int] = set()  # sets this task has given keys of

        def work(texts):
            keys, digests = [], []
            for text in texts:
                shingles = shingle_set(text)
                d1 = _digest(shingles)[0]
                if d1 not in given:
                    if len(given) >= GIVEN_SETS:
                        given.clear()
                    given.add(d1)
                    own = join_keys(shingles, shared.value)
                    keys.append(own)
                    digests.append(np.full(len(own), d1))
            if keys:
                yield {"key": np.concatenate(keys).view(np.int64), "d1": np.concatenate(digests)}

        return work

    keyed = map_rows(documents.where("doc_id IS NOT NULL AND text IS NOT NULL"), ["text"], "key long, d1 long", make)
    return _runs(keyed.repartition("key").sortWithinPartitions("key", "d1"))


def _runs(ordered: DataFrame) -> DataFrame:
    """Runs of equal keys with two sets or more, each set once, with the first.
    Streams over the sorted rows; only the last row's state is carried."""
    import pyarrow as pa

    from ._common import record_batch, to_arrow_schema

    schema = "key long, d1 long, leader long"
    out = to_arrow_schema(schema)

    def run(batches):
        carry = None  # key, leader, last set, whether the leader's row was given out
        for batch in batches:
            key, d1 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(key):
                continue
            fresh = np.r_[carry is None or carry[0] != key[0] or carry[2] != d1[0],
                          (key[1:] != key[:-1]) | (d1[1:] != d1[:-1])]
            last = key[-1], d1[-1]
            key, d1 = key[fresh], d1[fresh]
            if not len(key):
                continue
            told = False
            if carry is not None and carry[0] == key[0]:
                key, d1, told = np.r_[carry[0], key], np.r_[carry[1], d1], carry[3]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            leader = np.repeat(d1[first], size)
            keep = np.repeat(size >= 2, size)
            carry = (last[0], leader[-1], last[1], bool(size[-1] >= 2))
            if told:
                keep[0] = False
            if keep.any():
                yield record_batch({"key": pa.array(key[keep]), "d1": pa.array(d1[keep]),
                                    "leader": pa.array(leader[keep])}, out)

    return ordered.mapInArrow(run, schema)


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``(a, b)`` node ids of the set pairs ``(x, y)`` whose sizes and sketches
    allow a link."""
    kind = classes.schema["node"].dataType.simpleString()
    side = [classes.select(F.col("d1").alias(d), F.col("node").alias(n), F.col("n_shingles").alias(f"n_{n}"),
                           F.col("sketch").alias(f"s_{n}")) for d, n in (("x", "a"), ("y", "b"))]
    both = pairs.join(side[0], "x").join(side[1], "y").where(
        "least(n_a, n_b) * 100 >= greatest(n_a, n_b) * 80 AND s_a IS NOT NULL AND s_b IS NOT NULL")

    def make():
        def work(a, b, n_a, n_b, s_a, s_b):
            kept = [i for i in range(len(a)) if 9 * sketch_distance(s_a[i], s_b[i]) <= n_a[i] + n_b[i]]
            yield {"a": [a[i] for i in kept], "b": [b[i] for i in kept]}

        return work

    return map_rows(both, ["a", "b", "n_a", "n_b", "s_a", "s_b"], f"a {kind}, b {kind}", make)


def verify_pairs(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """The linked ones of ``pairs(a, b)``."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = only_ids(documents.select("doc_id", "text"), pairs.select("a").union(pairs.select("b")))
    both = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"))

    def make():
        recent: dict = {}

        def sets(text):
            found = recent.get(text)
            if found is None:
                if len(recent) >= 64:
                    recent.clear()
                found = recent[text] = shingle_set(text)
            return found

        def work(a, b, text_a, text_b):
            kept = [i for i in range(len(a)) if linked(sets(text_a[i]), sets(text_b[i]))]
            yield {"a": [a[i] for i in kept], "b": [b[i] for i in kept]}

        return work

    return map_rows(both, ["a", "b", "text_a", "text_b"], f"a {kind}, b {kind}", make).distinct()


def similar_components(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``documents``."""
    parts = min(1 << 16, max(16, 1 << (documents.count() // DOCUMENTS_PER_PART).bit_length()))
    summary = reliable_checkpoint(_summaries(documents, parts))
    rows = summary.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "d1", "d2", "sketch")
    common = shared_filters(summary.where("kind = 1"), parts)

    classes = written_table(rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(
        "n_shingles", "d1", "d2").agg(F.min("doc_id").alias("node"), F.first("sketch").alias("sketch")), "classes")
    placed = rows.drop("sketch").join(classes.drop("sketch"), ["n_shingles", "d1", "d2"], "left").drop("d1", "d2")
    # Rows of one doc_id with different sets (none where doc_id is a key).
    twins = placed.where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b")).join(
        classes.select(F.col("node").alias("b")), "b", "left_semi")

    groups = written_table(_candidate_groups(documents, common), "groups")
    pairs = groups.where("d1 <> leader").select(F.col("leader").alias("x"), F.col("d1").alias("y"))
    links = written_table(_verified(documents, pairs, classes).unionByName(twins.distinct()), "links")
    components = connected_components(links)
    mixed = _mixed_members(groups, classes, components)
    for turn in range(STAR_ROUNDS):
        if mixed.isEmpty():
            break
        found = written_table(_verified(documents, _star_pairs(mixed, turn), classes), "links")
        if found.isEmpty():
            break
        components = connected_components(_stars(components).unionByName(found))
        mixed = _mixed_members(mixed.select("key", "d1"), classes, components)
    if not mixed.isEmpty():
        found = written_table(_verified(documents, _block_pairs(mixed, classes), classes), "links")
        if not found.isEmpty():
            components = connected_components(_stars(components).unionByName(found))
    return placed.join(components, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"))


def _stars(components: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that have these components."""
    return components.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def _verified(documents: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links among set pairs ``(x, y)``."""
    near = written_table(_near(pairs.distinct(), classes), "near")
    return near if near.isEmpty() else verify_pairs(documents, near)


def _mixed_members(groups: DataFrame, classes: DataFrame, components: DataFrame) -> DataFrame:
    """``(key, d1, component)`` of the keys that join different components; of keys
    with the same members (by two 64-bit digests and their number) the smallest stays."""
    component = classes.join(components, "node", "left").select(
        "d1", F.coalesce("component", "node").alias("component")).groupBy("d1").agg(
        F.min("component").alias("component"))
    members = groups.select("key", "d1").join(component, "d1")
    mixed = members.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size"),
        *[F.bit_xor(F.xxhash64("d1", F.lit(k))).alias(f"members_{k}") for k in (1, 2)]).where("lo < hi")
    kept = mixed.groupBy("size", "members_1", "members_2").agg(F.min("key").alias("key"))
    return written_table(members.join(kept.select("key"), "key", "left_semi"), "mixed")


def _star_pairs(mixed: DataFrame, turn: int) -> DataFrame:
    """``STAR_LEADERS`` members of each key, the first in as many hash orders, each
    with the members outside its component."""
    orders = [F.xxhash64("d1", F.lit(turn * STAR_LEADERS + k)) for k in range(STAR_LEADERS)]
    first = mixed.groupBy("key").agg(*[F.min_by(c, order).alias(f"{c}_{k}") for k, order in enumerate(orders)
                                       for c in ("d1", "component")])
    leaders = F.array_distinct(F.array(*[F.struct(F.col(f"d1_{k}").alias("x"), F.col(f"component_{k}").alias("c"))
                                         for k in range(STAR_LEADERS)]))
    met = mixed.join(first.select("key", leaders.alias("leaders")), "key").select(
        "d1", "component", F.inline("leaders"))
    return met.where("component <> c").select("x", F.col("d1").alias("y"))


def _block_pairs(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``(x, y)`` of members of a key in different components whose sizes and
    sketches allow a link. A key of k blocks is k * (k + 1) / 2 independent pieces."""
    blocks = mixed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("d1", F.lit(99)), F.col("blocks")).cast("int")
    dealt = mixed.join(blocks, "key").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "d1", "component")
    sketches = classes.groupBy("d1").agg(F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n"))
    rows = dealt.join(sketches.where("sketch IS NOT NULL"), "d1")

    def compare(key, table):
        import pyarrow as pa

        if key[1].as_py() != key[2].as_py():
            side = np.array(table.column("own")) == key[1].as_py()
        else:
            side = None
        found = cross_pairs(np.array(table.column("component").to_pylist()), np.array(table.column("n")),
                            table.column("sketch").to_pylist(), side)
        d1 = np.array(table.column("d1"))
        return pa.table({"x": pa.array(d1[found[:, 0]], pa.int64()), "y": pa.array(d1[found[:, 1]], pa.int64())})

    pairs = rows.select("key", "i", "j", "own", "d1", "component", "n", "sketch").groupBy("key", "i", "j").applyInArrow(
        compare, "x long, y long")
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def cross_pairs(component: np.ndarray, sizes: np.ndarray, sketches: list[bytes], side: np.ndarray | None) -> np.ndarray:
    """Index pairs of different components (and different sides, if given) whose
    sizes and sketches allow a link. Sets are in order of size, so that each meets a
    window of sizes; the sketches' distance is summed in pieces while it is small enough."""
    out = []
    lengths = np.array([len(k) for k in sketches])
    for length in np.unique(lengths):
        others = np.flatnonzero((lengths == length) | (lengths == 2 * length))
        others = others[np.argsort(sizes[others], kind="stable")]
        width = length // 8
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint64).reshape(-1, width), axis=0)
                           for i in others])
        size, group, same = sizes[others], component[others], lengths[others] == length
        sides = None if side is None else side[others]
        ends = np.searchsorted(100 * size, 125 * size, "right")  # 80 % of the larger size at least
        starts = np.searchsorted(100 * size, 80 * size, "left")
        place = np.arange(len(others))
        for a in np.flatnonzero(same):
            window = slice(starts[a], ends[a])
            fits = (group[window] != group[a]) & (~same[window] | (place[window] > a))
            if sides is not None:
                fits &= sides[window] != sides[a]
            fits = np.flatnonzero(fits) + starts[a]
            far = np.zeros(len(fits), np.int64)
            step = max(8, width // 4)
            for lo in range(0, width, step):
                if not len(fits):
                    break
                piece = folded[fits, lo:lo + step] ^ folded[a, lo:lo + step]
                far += np.bitwise_count(piece).sum(axis=1, dtype=np.int64)
                near = 9 * far <= size[fits] + size[a]
                fits, far = fits[near], far[near]
            if len(fits):
                out.append(np.stack([np.full(len(fits), others[a]), others[fits]], axis=1))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def op5_similarity_join(spark, sf_dir):
    return similar_components(load_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i + 1:i + least(5, len(w))], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 5, 0) + 1)) AS i FROM words WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN size p ON p.doc_id = x.doc_id JOIN size q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM documents d LEFT JOIN size USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""
