"""Approximate nearest neighbours by an inverted multi-index.

A vector's two halves are quantised separately; a pair of centroids is a cell.
A query visits cells in order of summed distance (a heap over the two sorted
centroid lists) until the cells hold enough entries, and reranks all entries of
the visited cells by the exact measure.  How many are enough is measured: some
trial queries are searched by brute force and the least number that gives them
the wanted recall holds for all.  On vectors without structure that is a large
share of all rows; on clustered ones it is small.

There are more centroids the more rows there are.  Queries are dealt to calls by
their nearest first centroid, so those of a call visit much the same shards, and
a shard's entries go to the calls that visit it and to no others.

Defined cases: vectors that are null, of another length, zero, or hold a null
or non-finite component take no part; ties go to the smaller id; with fewer
candidates than asked all of them come back; repeated rows are all candidates;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise, partitions

#: Rows that the codebooks are fitted on, at most (picked by a hash of the id); every row is indexed.
FIT_ROWS = 20_000
#: Centroids of each half: so many for 50,000 rows or fewer, growing with the fourth root of their number.
CENTROIDS, CENTROID_ROWS = 64, 50_000
#: The share of entries that a query's cells hold is the least that gives this recall on trial queries.
RECALL = 0.95
TRIALS = 64
BLOCK = 4_096
ROUNDS = 12


@dataclass
class Codebooks:
    """``first`` and ``second``: centroids of the two halves, float64."""

    first: np.ndarray
    second: np.ndarray

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return _nearest(vectors[:, :half], self.first) * len(self.second) + _nearest(vectors[:, half:], self.second)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(axis=1) - 2 * (x @ centroids.T), axis=1)


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centroids = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        at = _nearest(x, centroids)
        counts = np.bincount(at, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, x)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[rng.integers(len(x), size=k)])
    return centroids


def cell_order(query: np.ndarray, books: Codebooks, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells in order of summed distance until they hold ``enough`` entries; distance is the negated inner product."""
    half = books.first.shape[1]
    a, b = -(books.first @ query[:half]), -(books.second @ query[half:])
    rows, columns = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    heap, held, out = [(a[rows[0]] + b[columns[0]], 0, 0)], 0, []
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(rows[i]) * len(b) + int(columns[j])
        if sizes[cell]:
            out.append(cell)
            held += sizes[cell]
        if i + 1 < len(rows):
            heapq.heappush(heap, (a[rows[i + 1]] + b[columns[j]], i + 1, j))
        if i == 0 and j + 1 < len(columns):
            heapq.heappush(heap, (a[rows[0]] + b[columns[j + 1]], 0, j + 1))
    return out


def usable(vectors: DataFrame, key: str, vector: str, is_query: Column) -> DataFrame:
    """Columns ``_id``, ``_v`` (array of double) and ``_q`` of the vectors that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_q"))
    rows = rows.where("_v IS NOT NULL AND _id IS NOT NULL")
    return rows.where(~F.exists("_v", bad) & F.exists("_v", lambda x: x != 0.0))


def fit(rows: DataFrame, width: int, total: int, centroids: int) -> Codebooks:
    draw = F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, 0.9 * FIT_ROWS / total))
    sample = rows.where(draw) if total > FIT_ROWS else rows
    points = np.array(sample.select("_v").toArrow().column(0).combine_chunks().flatten()).reshape(-1, width)
    half = width // 2
    return Codebooks(_kmeans(points[:, :half], centroids, 1), _kmeans(points[:, half:], centroids, 2))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw)).reshape(len(raw), -1)


def nearest(asked: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, visited: np.ndarray | None = None, column: np.ndarray | None = None):
    """(query, id, score) of the ``k`` best ids of each query among the entries whose ``column`` it has ``visited``.

    Every score is summed in one fixed order, so equal vectors tie exactly.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n = min(k, len(ids))
    for at in range(0, len(asked), 256):
        rough = queries[at : at + 256] @ vectors.T
        if visited is not None:
            rough[~visited[at : at + 256][:, column]] = -np.inf
        cuts = np.partition(rough, len(ids) - n, axis=1)[:, len(ids) - n]
        for r, cut in enumerate(cuts):
            near = np.flatnonzero((rough[r] >= cut - 1e-9 * max(1.0, abs(cut))) if np.isfinite(cut) else (rough[r] > -np.inf))
            score = (vectors[near] * queries[at + r]).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:n]
            out.append((np.full(len(best), asked[at + r]), ids[near][best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def calibrate(entries: DataFrame, trials: np.ndarray, books: Codebooks, sizes: np.ndarray, k: int) -> int:
    """Entries to visit: the least number at which the trial queries, searched by brute force, reach ``RECALL``."""
    spark = entries.sparkSession
    shared = spark.sparkContext.broadcast(trials)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = nearest(np.arange(len(shared.value)), shared.value, np.arange(batch.num_rows), _matrix(batch.column(1)), k)
                cells = batch.column(0).take(pa.array(found[1]))
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), cells, pa.array(found[2])], names=["trial", "cell", "score"])

    found = entries.select("cell", "v").mapInArrow(brute, "trial long, cell int, score double")
    best = Window.partitionBy("trial").orderBy(F.desc("score"), "cell")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("trial", "cell").collect()
    needed: list[int] = []
    for t, query in enumerate(trials):
        order = cell_order(query, books, sizes, int(sizes.sum()))
        reached = dict(zip(order, np.cumsum(sizes[order]).tolist(), strict=True))
        needed += [reached[r["cell"]] for r in found if r["trial"] == t]
    needed.sort()
    return needed[min(len(needed) - 1, int(RECALL * len(needed)))] if needed else 0


def search(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", centroids: int | None = None) -> DataFrame:
    """The ``k`` nearest found of each row where ``is_query``: query_id, rank, the id, score (inner product in double).

    Equal vectors are indexed once with their ``k + 1`` smallest ids, which are
    all that can come back, and equal queries are searched once.
    """
    spark = vectors.sparkSession
    schema = f"query_id long, rank int, `{key}` long, score double"
    rows = usable(vectors, key, vector, is_query)
    shape = rows.groupBy(F.size("_v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if shape is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("_v") == shape["n"])
    centroids = centroids or int(CENTROIDS * max(1.0, shape["count"] / CENTROID_ROWS) ** 0.25)
    fitted = spark.sparkContext.broadcast(fit(rows, shape["n"], shape["count"], centroids))
    books = fitted.value
    columns = len(books.second)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = np.array(batch.column(1).flatten()).reshape(batch.num_rows, -1)
                cells = fitted.value.cells(v).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells), pa.array([x.tobytes() for x in v], pa.binary()), batch.column(2)], names=["_id", "cell", "v", "q"])

    indexed = materialise(rows.mapInArrow(assign, "_id long, cell int, v binary, q boolean"), "multi-index")
    equal = Window.partitionBy("v").orderBy("_id")
    entries = indexed.withColumn("n", F.row_number().over(equal)).where(F.col("n") <= k + 1).select("cell", "_id", "v")
    entries = materialise(entries, "entries")
    asked = materialise(indexed.where("q").groupBy("v").agg(F.min("_id").alias("query_id")).select("query_id", "v"), "asked")
    counted = entries.groupBy("cell").count().toArrow()
    sizes = np.zeros(len(books.first) * columns, np.int64)
    sizes[counted.column("cell").to_numpy()] = counted.column("count").to_numpy()
    trials = _matrix(asked.orderBy(F.xxhash64("query_id"), "query_id").limit(TRIALS).select("v").toArrow().column(0))
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], schema)
    guide = spark.sparkContext.broadcast((sizes, calibrate(entries, trials, books, sizes, k + 1)))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, enough = guide.value
        for batch in batches:
            shards, take, marks = [], [], []
            for r, query in enumerate(_matrix(batch.column(1)) if batch.num_rows else ()):
                found = np.array(cell_order(query, fitted.value, sizes, max(enough, k + 1)))
                for shard in np.unique(found // columns):
                    mark = np.zeros(columns, np.uint8)
                    mark[found[found // columns == shard] % columns] = 1
                    shards.append(shard)
                    take.append(r)
                    marks.append(mark.tobytes())
            rows = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), batch.column(2).take(rows), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(marks, pa.binary())], names=["shard", "call", "query_id", "v", "mark"])

    # all cells of one first centroid form a shard; its entries and the queries are cut into blocks, each pair of blocks that meets is a group
    by_shard = sizes.reshape(-1, columns).sum(axis=1)
    parts = F.element_at(F.array(*(F.lit(int(max(1, -(-n // BLOCK)))) for n in by_shard)), F.col("shard") + 1)
    half = shape["n"] // 2

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = np.argmax(_matrix(batch.column(1))[:, :half] @ fitted.value.first.T, axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], names=["query_id", "v", "near"])

    nearby = materialise(asked.mapInArrow(first, "query_id long, v binary, near int"), "nearby")
    held = np.zeros(len(books.first), np.int64)
    for x in nearby.groupBy("near").count().collect():  # a number for each centroid
        held[x["near"]] = x["count"]
    before = np.cumsum(held) - held
    rank = F.element_at(F.array(*(F.lit(int(n)) for n in before)), F.col("near") + 1) + F.pmod(F.xxhash64("query_id"), F.element_at(F.array(*(F.lit(max(1, int(n))) for n in held)), F.col("near") + 1))
    called = nearby.select("query_id", F.floor(rank / BLOCK).cast("int").alias("call"), "v")
    left = materialise(called.select("query_id", "v", "call").repartition(partitions(spark)).mapInArrow(visits, "shard int, call int, query_id long, v binary, mark binary"), "visits")
    meets = left.select(F.col("shard").alias("shard"), F.col("call").alias("call")).distinct()
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = left.select("shard", "call", every(parts).alias("part"), "query_id", "v", "mark")
    right = entries.select((F.col("cell") / columns).cast("int").alias("shard"), (F.col("cell") % columns).alias("column"), "_id", "v").join(meets, "shard")
    right = right.select("shard", "call", F.pmod(F.xxhash64("_id"), parts).cast("int").alias("part"), "column", "_id", "v")
    names = ["query_id", key, "score"]

    def rerank(asked: pa.Table, own: pa.Table) -> pa.Table:
        if not asked.num_rows or not own.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        marks = np.frombuffer(b"".join(asked.column("mark").to_pylist()), np.uint8).reshape(asked.num_rows, -1).astype(bool)
        ids, queries = asked.column("query_id").to_numpy(), _matrix(asked.column("v"))
        found = nearest(ids, queries, own.column("_id").to_numpy(), _matrix(own.column("v")), k + 1, marks, own.column("column").to_numpy())
        return pa.table([pa.array(x) for x in found], names=names)

    at = ["shard", "call", "part"]
    found = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(rerank, f"query_id long, `{key}` long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col(key))
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
    own = indexed.where("q").select(F.col("_id").alias("own"), "v").join(asked, "v").select("own", "query_id")
    found = own.join(found.drop("rank"), "query_id").where(F.col(key) != F.col("own"))
    best = Window.partitionBy("own").orderBy(F.desc("score"), F.col(key))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(F.col("own").alias("query_id"), "rank", key, "score")
