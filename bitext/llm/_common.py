"""Shared helpers: table loading, Arrow batch plumbing, word hashing."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch that a worker turns into Python objects at a time.
SLICE_ROWS = 512
#: Bytes of a batch that Spark hands to a worker; its own 64 MB would hold up to 10,000
#: whole texts at a time, in the JVM's direct memory and again in the worker.
BATCH_BYTES = 4 << 20


def worker_cache() -> dict:
    """Objects a Python worker keeps between its tasks (vocabularies, memos).

    The package travels inside the pickled functions, so its module globals are
    new in every task; the interpreter itself is not.
    """
    import sys

    return sys.__dict__.setdefault("_bitext_llm_cache", {})


def claim_worker(owner: str) -> None:
    """Drop what another operator keeps in this worker and give its memory back."""
    import ctypes
    import gc

    cache = worker_cache()
    if cache.get("owner") != owner:
        cache.clear()
        cache["owner"] = owner
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
        if trim is not None:
            trim(0)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(c, n: int):
    """crc32 of a value as text, modulo ``n`` (NULL stays NULL)."""
    return F.crc32(F.col(c).cast("string").cast("binary")) % n


def crc_mod_py(value, n: int) -> int:
    return zlib.crc32(str(value).encode()) % n


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_BYTES`` where Spark's default still holds."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("64MB", "67108864b"):
        spark.conf.set(key, str(BATCH_BYTES))


def map_rows(df: DataFrame, columns: list, schema: str, make: Callable) -> DataFrame:
    """``mapInArrow`` over the named columns only.

    ``make()`` runs once per task and returns ``f(lists) -> iterator of dicts of
    lists``; ``lists`` holds one Python list per input column, of at most
    ``SLICE_ROWS`` rows, so the Python objects alive at a time are bounded. A worker's
    cache belongs to the module of ``make`` (``claim_worker``). The session's batches
    are held to ``BATCH_BYTES`` from here on.
    """
    bounded_batches(df.sparkSession)
    out, owner = to_arrow_schema(schema), make.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim_worker(owner)
        work = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                for cols in work(*[part.column(i).to_pylist() for i in range(part.num_columns)]):
                    yield record_batch(cols, out)
        flush = getattr(work, "flush", None)
        if flush is not None:
            for cols in flush():
                yield record_batch(cols, out)

    return df.select(*columns).mapInArrow(run, schema)


def record_batch(cols: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
         for f, c in ((f, cols[f.name]) for f in schema)], schema=schema)


def to_arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema as convert

    return convert(T.StructType.fromDDL(ddl))


# --- word hashing ------------------------------------------------------------
# 64-bit polynomial hashes of byte runs, all words of a buffer at once. The
# byte codes and the odd base come from a fixed seed, so every task agrees.
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_BASE = int(_rng.integers(0, 2**63 - 1)) * 2 + 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse."""
    powers = worker_cache().setdefault("powers", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    if len(powers["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.empty(size, np.uint64)
            table[0], filled = 1, 1
            while filled < size:  # doubling: table[k + i] = table[k] * table[i]
                step = np.uint64(pow(base, filled, 2**64))
                table[filled:2 * filled] = table[:filled] * step
                filled *= 2
            powers[name] = table
    return powers["up"], powers["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and 64-bit hashes of the words
    ``[^\\x20\\x09-\\x0D]+`` of UTF-8 ``data``."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64)
    inside = ~_SPACE[raw]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = power_table(len(raw))
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_CODE[raw] * up[:len(raw)], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return starts, ends, mix64(value + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive word hashes (order matters)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    acc = words[:n].copy()
    for j in range(1, k):
        acc *= factor
        acc += words[j:j + n]
    return mix64(acc)
