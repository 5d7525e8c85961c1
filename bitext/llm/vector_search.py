"""Approximate nearest neighbours over balanced posting lists.

Nearness is the inner product. For the index, vectors get one more component,
sqrt(M^2 - |x|^2) with M the largest norm, and queries get zero and norm M: the largest
inner products are then the smallest Euclidean distances.

* Centroids: a bounded sample (``SAMPLE`` vectors) is halved again and again at the median
  along the line between two means, so that all leaves are equally large; a leaf's mean
  is a centroid. One list has about ``LIST_SIZE`` vectors, until ``MAX_LISTS`` lists are
  there; from then on lists grow and are dealt to tasks in parts.
* Every centroid search, of vectors and of queries, is a best-first walk over an in-memory
  graph of neighbouring centroids (broadcast; ``MAX_LISTS`` rows bound it).
* Boundary vectors are replicated: a vector goes to its nearest list and to the next
  ``REPLICAS - 1`` that are no more than ``CLOSURE`` times as far.
* A query reads, of the lists its walk has kept, those no more than ``PROBE_RATIO`` times as far
  as its nearest one.
* Neighbouring lists (``BLOCK_LISTS`` leaves that were halved last) are compared with their
  queries in one cogrouped task, to which a vector and a query are sent once, and which
  hands on the best of a query over all its lists there. A block is dealt in parts of
  ``PART_ROWS`` vectors and ``PART_ROWS`` queries. Scores are exact inner products of the
  original vectors in double precision.
* A query's blocks are read in waves, its nearest block first, each wave ``WAVE_GROWTH``
  times as many as the one before. From the second wave on a task hands on only what is no
  worse than the last of the best found so far, so a query's rows grow with the number
  of waves (the logarithm of its blocks), not with its blocks. No result depends on it.

Vectors without any structure (the test tables' are near to that) have their neighbours
in many lists; the replicas and a walk of ``WALK_QUERIES`` lists or a ``WALK_SHARE`` of all
are chosen for such data.

Equal vectors are one class, searched and compared once. A class keeps its smallest
``k + 1`` ids: no query can have more of them among its ``k`` nearest, since
ties go to the smaller id. Results are given back to the queries of a class by a join
on salted keys, so that a vector shared by a third of all rows stays spread.

Defined results
* Vectors that are NULL, empty, zero or hold NULL or non-finite components, and rows
  with NULL ids, take no part. Shorter vectors count as padded with zeros.
* Rows with a query's own id are never among its results; equal rows count once. A query id
  with different vectors is searched for each of them.
* With ``k`` candidates or fewer in the lists read, those found are returned; a query
  whose lists hold fewer than ``k`` others reads all lists.
* An empty table gives no rows. Extra columns are not read.

Scale: vectors are shuffled once to find equal ones and, in each wave, once per block that
holds them. Driver and tasks hold the sample, the centroids and one part of a list.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bitext.session import ensure_checkpoint_dir

from ._common import load_table, to_arrow_schema

K = 20
QUERY_EVERY = 20
SAMPLE, MAX_LISTS, LIST_SIZE = 65_536, 16_384, 64
PART_ROWS, BLOCK_LISTS, WAVE_GROWTH = 4_096, 32, 5
CLOSURE, REPLICAS = 1.2, 6
PROBE_RATIO = 1.3
#: Centroids kept while walking the graph (for vectors, for queries) and edges per centroid.
WALK_VECTORS, WALK_QUERIES, WALK_SHARE, DEGREE = 24, 128, 0.15, 24
#: Query classes are joined to their queries under this many salted copies.
SALTS = 16
BATCH = 1_024


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (array<double>) of the rows that take part."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return table.select(F.col(id_col).alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def vector_classes(vectors: DataFrame, is_query, keep: int) -> DataFrame:
    """``cls, v, ids, asked``: distinct vectors with their ``keep`` smallest ids; whether a
    query has the vector. The rank filter also runs before the shuffle."""
    marked = vectors.select("id", "v", is_query.alias("asked")).distinct()
    by_vector = Window.partitionBy("v").orderBy("id")
    members = marked.select("v", "id", F.row_number().over(by_vector).alias("place")).where(F.col("place") <= keep)
    ids = members.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = marked.where("asked").select("v").distinct().withColumn("asked", F.lit(True))
    return ids.join(asked, "v", "left").select(
        F.monotonically_increasing_id().alias("cls"), "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked"))


# --- the index ------------------------------------------------------------------------

class Index:
    """Centroids and their graph, in the space with one more component."""

    def __init__(self, dims: int, norm: float, centroids: np.ndarray, degree: int = DEGREE):
        self.dims, self.norm, self.centroids = dims, norm, centroids
        self.square = (centroids ** 2).sum(axis=1)
        self.graph = self._neighbours(degree)
        # Walks start from centroids spread over all leaves (their order follows the halving).
        self.entries = np.unique(np.linspace(0, len(centroids) - 1, min(len(centroids), 16)).astype(np.int64))

    def _neighbours(self, degree: int) -> np.ndarray:
        """Nearest centroids of each, and as many edges to random ones as keep it connected."""
        n = len(self.centroids)
        near = np.empty((n, min(degree, n)), np.int64)
        for lo in range(0, n, BATCH):
            d = self.square[None, :] - 2 * self.centroids[lo:lo + BATCH] @ self.centroids.T
            near[lo:lo + BATCH] = np.argpartition(d, near.shape[1] - 1, axis=1)[:, :near.shape[1]]
        far = np.random.default_rng(7).integers(0, n, (n, 4))
        ring = (np.arange(n)[:, None] + np.array([[1, n - 1]])) % n
        return np.concatenate([near, far, ring], axis=1)

    def points(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.norm
        last = np.sqrt(np.maximum(0.0, 1.0 - (scaled ** 2).sum(axis=1, keepdims=True)))
        return np.concatenate([scaled, last], axis=1).astype(np.float32)

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        scaled = scaled / np.sqrt((scaled ** 2).sum(axis=1, keepdims=True))
        return np.concatenate([scaled, np.zeros((len(vectors), 1))], axis=1).astype(np.float32)

    def walk(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """``ids, distances`` (ascending) of the ``width`` nearest centroids found by
        best-first search: the nearest centroid not yet expanded gives its neighbours,
        until all ``width`` kept ones are expanded. Unfilled places have id -1."""
        n, rows = len(self.centroids), np.arange(len(points))[:, None]
        width = min(width, n)
        norms = (points ** 2).sum(axis=1)[:, None]
        seen = np.zeros((len(points), n), bool)
        ids = np.full((len(points), width), -1, np.int64)
        dist = np.full((len(points), width), np.inf, np.float32)
        done = np.ones((len(points), width), bool)
        found = np.broadcast_to(self.entries, (len(points), len(self.entries)))
        while True:
            order = np.sort(found, axis=1)  # equal ids side by side: the first counts
            new = ~seen[rows, order]
            new[:, 1:] &= order[:, 1:] != order[:, :-1]
            seen[rows, order] = True
            d = norms + self.square[order] - 2 * np.einsum("ijk,ik->ij", self.centroids[order], points)
            d = np.where(new, np.maximum(d, 0), np.inf)
            ids, dist = np.concatenate([ids, order], 1), np.concatenate([dist, d], 1)
            done = np.concatenate([done, ~new], 1)
            best = np.argsort(dist, axis=1, kind="stable")[:, :width]
            ids, dist, done = ids[rows, best], dist[rows, best], done[rows, best]
            if done.all():
                break
            first = np.argmax(~done, axis=1)[:, None]
            found = self.graph[np.where(done[rows, first], ids[:, :1], ids[rows, first])[:, 0]]
            done[rows, first] = True
        ids = np.where(np.isfinite(dist), ids, -1)
        return ids, np.sqrt(dist)

    def lists_of(self, points: np.ndarray) -> list[list[int]]:
        """Lists that hold each vector, its nearest first."""
        out = []
        for lo in range(0, len(points), BATCH):
            ids, dist = self.walk(points[lo:lo + BATCH], WALK_VECTORS)
            close = (ids >= 0) & (dist <= CLOSURE * dist[:, :1])
            close[:, 0], close[:, REPLICAS:] = True, False
            out += [row[keep].tolist() for row, keep in zip(ids, close)]
        return out

    def probes_of(self, points: np.ndarray) -> list[list[int]]:
        """Lists that each query reads."""
        out = []
        for lo in range(0, len(points), BATCH):
            ids, dist = self.walk(points[lo:lo + BATCH], max(WALK_QUERIES, int(WALK_SHARE * len(self.centroids))))
            ok = (ids >= 0) & (dist <= PROBE_RATIO * dist[:, :1])
            out += [row[keep].tolist() for row, keep in zip(ids, ok)]
        return out


def balanced_centroids(points: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` leaves whose sizes differ by rounding only."""
    rng = np.random.default_rng(5)
    leaves, todo = [], [(np.arange(len(points)), lists)]
    while todo:
        rows, k = todo.pop()
        if k == 1 or len(rows) < 2:
            leaves.append(points[rows].mean(axis=0))
            continue
        part = points[rows]
        pair = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(8):  # two means
            side = ((part - pair[0]) ** 2).sum(axis=1) > ((part - pair[1]) ** 2).sum(axis=1)
            if side.all() or not side.any():
                break
            pair = np.stack([part[~side].mean(axis=0), part[side].mean(axis=0)])
        order = np.argsort(part @ (pair[1] - pair[0]), kind="stable")
        cut = len(rows) * (k // 2) // k
        todo += [(rows[order[cut:]], k - k // 2), (rows[order[:cut]], k // 2)]
    return np.stack(leaves).astype(np.float32)


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list array as doubles, padded with zeros."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), dims))
    out[np.arange(dims)[None, :] < n[:, None]] = values
    return out


def fit_index(classes: DataFrame, sample: int = SAMPLE, list_size: int = LIST_SIZE,
              max_lists: int = MAX_LISTS) -> Index | None:
    """The index of ``classes``, None if there are none. Its sample is chosen by hash."""
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    scaled = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / largest) * (x / largest))
    n, dims, norm = classes.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(largest * F.sqrt(scaled))).first()
    if not n:
        return None
    share = min(1.0, sample / n)
    taken = classes.where(F.pmod(F.xxhash64("cls"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else classes
    found = taken.select("v").toArrow()["v"].combine_chunks()
    if not len(found):
        found = classes.select("v").limit(1).toArrow()["v"].combine_chunks()
    index = Index(dims, min(norm, np.finfo(np.float64).max), np.zeros((1, dims + 1), np.float32))
    points = index.points(matrix(found, dims))
    lists = max(1, min(max_lists, -(-n // list_size), len(points)))
    return Index(dims, index.norm, balanced_centroids(points, lists))


# --- search ---------------------------------------------------------------------------

def _placed(classes: DataFrame, shared, kind: str) -> DataFrame:
    """``cls, v (binary), ids, asked, lists, probes`` of every class; ``v`` has components
    of numpy type ``kind``."""
    ids_type = classes.schema["ids"].dataType.simpleString()
    schema = f"cls long, v binary, ids {ids_type}, asked boolean, lists array<int>, probes array<int>"
    out = to_arrow_schema(schema)

    def run(batches):
        index = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                v = matrix(part.column(1), index.dims)
                asked = part.column(3).to_numpy(zero_copy_only=False)
                probes: list = [None] * len(v)
                for at, found in zip(np.flatnonzero(asked), index.probes_of(index.queries(v[asked]))):
                    probes[at] = found
                raw = [row.tobytes() for row in v.astype(kind)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(raw, pa.binary()), part.column(2), part.column(3),
                     pa.array(index.lists_of(index.points(v)), out.field("lists").type),
                     pa.array(probes, out.field("probes").type)], schema=out)

    return classes.select("cls", "v", "ids", "asked").mapInArrow(run, schema)


def _in_block(lists: pa.ChunkedArray) -> np.ndarray:
    """Boolean matrix: which of a block's lists each row names."""
    lists = lists.combine_chunks()
    out = np.zeros((len(lists), BLOCK_LISTS), np.float32)
    rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    out[rows, lists.flatten().to_numpy() % BLOCK_LISTS] = 1
    return out


def _compare(keep: int, id_type, kind: str):
    """Cogrouped task: each query's ``keep`` best classes in the lists it reads here, those
    below its ``bound`` left out."""
    schema = pa.schema([("asker", pa.int64()), ("score", pa.float64()), ("ids", id_type)])

    def run(queries: pa.Table, members: pa.Table) -> pa.Table:
        if not queries.num_rows or not members.num_rows:
            return schema.empty_table()
        q, v = (np.stack([np.frombuffer(x, kind) for x in column.to_pylist()]).astype(np.float64)
                for column in (queries["query"], members["vector"]))
        reads, held = _in_block(queries["lists"]), _in_block(members["lists"])
        ids = members["ids"].combine_chunks()
        lowest = np.array([x[0] for x in ids.to_pylist()])
        least = queries["bound"].to_numpy()
        out = []
        with np.errstate(all="ignore"):
            slack = 1e-9 * (np.abs(least) + np.abs(q).sum(axis=1) * np.abs(v).max())
            for lo in range(0, len(q), 256):
                shared = reads[lo:lo + 256] @ held.T > 0
                rough = q[lo:lo + 256] @ v.T
                rough = np.where(shared & ~np.isnan(rough), rough, -np.inf)
                for i, row in enumerate(rough, lo):
                    pick = np.flatnonzero(shared[i - lo])
                    if least[i] > -np.inf:  # rounding and sums that are no number included
                        pick = pick[(row[pick] >= least[i] - slack[i]) | np.isinf(row[pick])]
                    if len(pick) > keep:
                        # All that may be among the best, ties and rounding included.
                        bound = np.partition(row, len(row) - keep)[len(row) - keep]
                        pick = pick[row[pick] >= bound - 1e-9 * np.abs(bound)]
                    score = (v[pick] * q[i]).sum(axis=1)
                    best = np.lexsort((lowest[pick], -score))[:keep]
                    best = best[~(score[best] < least[i])]
                    out.append((i, pick[best], score[best]))
        rows = np.concatenate([np.full(len(p), i) for i, p, _ in out])
        picked = np.concatenate([p for _, p, _ in out])
        return pa.Table.from_arrays([queries["asker"].combine_chunks().take(pa.array(rows)),
                                     pa.array(np.concatenate([s for _, _, s in out])),
                                     ids.take(pa.array(picked))], schema=schema)

    return run


def _blocks(rows: DataFrame, lists: str) -> DataFrame:
    """``rows`` once per block of their lists, with ``lists`` of that block only; ``_at``:
    how many of its blocks are named before."""
    blocks = rows.select("*", F.posexplode(_blocks_of(lists)).alias("_at", "_block"))
    return blocks.withColumn(lists, F.filter(lists, lambda x: _block_of(x) == F.col("_block")))


def _block_of(x):
    return F.floor(x / BLOCK_LISTS).cast("int")


def _blocks_of(lists: str):
    return F.array_distinct(F.transform(lists, _block_of))


def _search(placed: DataFrame, asking: DataFrame, keep: int, kind: str, folder: str) -> DataFrame | None:
    """``asker, score, ids``: the ``keep`` best classes of each asking class, read in waves
    that are written below ``folder``; None without asking classes."""
    most = asking.agg(F.max(F.size(_blocks_of("probes")))).first()[0]
    found, paths, lo, size = None, [], 0, 1
    while most is not None and lo < most:
        bounds = asking.select("cls", "v", F.col("probes").alias("lists"))
        if found is None:
            bounds = bounds.withColumn("bound", F.lit(float("-inf")))
        else:
            last = found.groupBy(F.col("asker").alias("cls")).agg(
                F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= keep).drop("n")
            bounds = bounds.join(last, "cls", "left").fillna(float("-inf"), "bound")
        wave = _blocks(bounds, "lists").where(F.col("_at").between(lo, lo + size - 1))
        paths.append(f"{folder}/{len(paths)}")
        _compared(placed, wave, keep, kind).write.parquet(paths[-1])
        found = _best_classes(asking.sparkSession.read.parquet(*paths), keep)
        lo, size = lo + size, size * WAVE_GROWTH
    return found


def _compared(placed: DataFrame, queries: DataFrame, keep: int, kind: str) -> DataFrame:
    """``asker, score, ids``: for each query its best classes of each part read."""
    members = _blocks(placed.select("cls", "v", "ids", "lists"), "lists")
    # One row per block: MAX_LISTS / BLOCK_LISTS rows at most.
    sizes = members.groupBy("_block").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts"))
    asked = queries.groupBy("_block").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("shares"))
    sizes = F.broadcast(sizes.join(asked, "_block"))
    deal = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = members.join(sizes, "_block").withColumn("part", deal("parts")).select(
        "_block", "part", every("shares").alias("share"), F.col("v").alias("vector"), "ids", "lists")
    queries = queries.join(sizes, "_block").withColumn("share", deal("shares")).select(
        "_block", every("parts").alias("part"), "share", F.col("cls").alias("asker"), F.col("v").alias("query"), "lists",
        "bound")
    key = ["_block", "part", "share"]
    ids_type = placed.schema["ids"].dataType.simpleString()
    return queries.groupBy(*key).cogroup(members.groupBy(*key)).applyInArrow(
        _compare(keep, to_arrow_schema(f"ids {ids_type}").field(0).type, kind), f"asker long, score double, ids {ids_type}")


def _best_classes(found: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best classes of each query (ties by smallest id), before any of their ids
    is listed: no other class can have an id among its ``keep`` nearest."""
    order = Window.partitionBy("asker").orderBy(F.desc("score"), F.element_at("ids", 1))
    return found.distinct().withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= keep).drop("_place")


def nearest(table: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
            index_options: dict | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows found for each row for
    which ``is_query`` (a condition on ``id``) holds."""
    spark: SparkSession = table.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vectors-{uuid.uuid4().hex}"
    vectors = usable(table, id_col, vector_col)
    vector_classes(vectors, is_query, k + 1).write.parquet(f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")
    index = fit_index(classes, **(index_options or {}))
    id_type = table.schema[id_col].dataType.simpleString()
    nothing = spark.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    if index is None:
        return nothing
    # Single-precision input is kept as it is, four bytes a component.
    kind = "<f4" if table.schema[vector_col].dataType.elementType.typeName() == "float" else "<f8"
    _placed(classes, spark.sparkContext.broadcast(index), kind).write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")
    asking = placed.where("asked")
    found = _search(placed, asking, k + 1, kind, f"{folder}/found")
    if found is None:
        return nothing
    # Queries whose lists hold too few others read all lists.
    reached = found.groupBy("asker").agg(F.sum(F.size("ids")).alias("n")).where(F.col("n") > k)
    short = asking.join(reached.select(F.col("asker").alias("cls")), "cls", "left_anti").drop("probes").withColumn(
        "probes", F.sequence(F.lit(0), F.lit(len(index.centroids) - 1)))
    more = _search(placed, short, k + 1, kind, f"{folder}/more")
    if more is not None:
        found = _best_classes(found.unionByName(more), k + 1)
    best = found.select("asker", "score", F.explode("ids").alias("vec_id")).distinct()
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k + 1)
    answers = best.groupBy("asker").agg(F.sort_array(F.collect_list(F.struct("_place", "vec_id", "score"))).alias("found"))
    salted = classes.select(F.col("cls").alias("asker"), "v").join(answers, "asker").select(
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "v", "found")
    queries = vectors.where(is_query).distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    own = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    return queries.join(salted, ["v", "salt"]).select(F.col("id").alias("query_id"), "found").select(
        "query_id", F.posexplode(F.slice(own, 1, k))).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"),
        F.col("col.score").alias("score"))


def op13_nearest_vectors(spark, sf_dir) -> DataFrame:
    return nearest(load_table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_EVERY == 0)
