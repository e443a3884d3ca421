"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut into halves, and each half is quantised by its own
centroids, fitted on a bounded sample; a cell is a pair of centroids. A query
goes through the pairs by the sum of the two squared distances, with a heap, until the
cells passed hold its budget of entries. Entries of those cells are reranked by
exact cosine in double precision.

The budget is set by measurement: a bounded set of probe queries is searched by
brute force over all rows, and the budget is the least number of entries that
would have found TARGET of their neighbours. Clustered vectors need few, random
ones many.

A query visits the cells of one first-half centroid as one bit mask, and entries
and queries meet in blocks of bounded size (BLOCK entries, QUERIES queries), so
a cell with a third of all rows is many blocks, and no pairs are ever rows.

Defined results: vectors that are null, zero, hold null or non-finite
components, or differ in length from most, take no part, nor do rows without
an id. Rows that repeat an id are entries each; none of a query's own id is its
neighbour. Fewer candidates than k: all. No valid vectors: an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, tidy, written

SAMPLE, PROBES, TARGET = 16_384, 128, 0.97
BLOCK, QUERIES = 1024, 256


def centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means on the rows of x; a centroid that loses all its rows stays."""
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return distances(x, c).argmin(axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; equal rows give equal values wherever they stand. Rows whose squares overflow or vanish are scaled first."""

    def scaled(x: np.ndarray) -> np.ndarray:
        most = np.abs(x).max(axis=1, keepdims=True)
        far = (most > 1e120) | (most < 1e-120)
        return np.where(far, x / np.where(far, most, 1), x) if far.any() else x

    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def traverse(left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Pairs (i, j) by left[i] + right[j], and how many entries the pairs so far hold; empty cells are passed over."""
    by_left, by_right = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    x, y = left[by_left].tolist(), right[by_right].tolist()
    at_left, at_right = by_left.tolist(), by_right.tolist()
    heap, total = [(x[0] + y[0], 0, 0)], 0
    while heap:
        _, a, b = heapq.heappop(heap)
        if n := int(counts[at_left[a], at_right[b]]):
            total += n
            yield at_left[a], at_right[b], total
        if b + 1 < len(y):
            heapq.heappush(heap, (x[a] + y[b + 1], a, b + 1))
        if b == 0 and a + 1 < len(x):
            heapq.heappush(heap, (x[a + 1] + y[0], a + 1, 0))


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """_id and _v (doubles) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), v.alias("_v")).where(
        F.col("_id").isNotNull() & F.expr("size(_v) > 0 and forall(_v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(_v, x -> x != 0)")
    )
    most = rows.groupBy(F.size("_v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("_v") == (most.n if most else 0))


def _sample(rows: DataFrame, most: int = SAMPLE) -> list:
    """At most that many rows, about as many where there are so many: those of small hashes, and no sort."""
    n = rows.count()
    part = rows if n <= most else rows.where(F.pmod(F.xxhash64("_id", "_v", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * 0.95 * most / n))
    found = part.limit(most).collect()
    # repeated rows have the same hash: all or none of them are there
    return found or rows.limit(most).collect()


def _stacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def nearest_neighbours(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", codes: int = 64) -> DataFrame:
    """query_id, rank, vec_id and score for the rows whose id is divisible by every."""
    spark = vectors.sparkSession
    ship(spark)
    if codes > 64:
        raise ValueError("a mask holds 64 second-half centroids")
    rows = valid(vectors, id_col, vector_col)
    schema = "query_id long, rank int, vec_id long, score double"
    some = _sample(rows)
    if not some:
        return spark.createDataFrame([], schema)
    x = unit(np.array([r._v for r in some], np.float64))
    half = max(1, x.shape[1] // 2)
    books = spark.sparkContext.broadcast((centroids(x[:, :half], codes), centroids(x[:, half:], codes) if x.shape[1] > 1 else np.zeros((1, 0))))
    size = (len(books.value[0]), len(books.value[1]))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = books.value
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(1).values.to_numpy().reshape(b.num_rows, -1) if b.column(1).offset == 0 else np.array(b.column(1).to_pylist())
            u = unit(v)
            raw = [r.tobytes() for r in np.ascontiguousarray(v, "<f8")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nearest(u[:, :half], first).astype(np.int32)), pa.array(nearest(u[:, half:], second).astype(np.int32)), pa.array(raw, pa.binary())], ["_id", "_i", "_j", "_v"])

    index = written(rows.mapInArrow(tidy(assigned), "_id long, _i int, _j int, _v binary"), "index")
    counts = np.zeros(size, np.int64)
    for r in index.groupBy("_i", "_j").count().collect():  # at most codes ** 2
        counts[r._i, r._j] = r["count"]
    queries = index.where(F.col("_id") % every == 0)
    budget = _budget(index, queries, books.value, counts, half, k)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = books.value
        for b in batches:
            if not b.num_rows:
                continue
            v = _stacked(b.column(1))
            u = unit(v)
            a, c = distances(u[:, :half], first), distances(u[:, half:], second)
            at, group, mask = [], [], []
            for n in range(b.num_rows):
                own: dict[int, int] = {}
                for i, j, total in traverse(a[n], c[n], counts):
                    own[i] = own.get(i, 0) | 1 << j
                    if total > budget:
                        break
                at += [n] * len(own)
                group += own.keys()
                mask += own.values()
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), pa.array(group, pa.int32()), pa.array(np.array(mask, np.uint64).view(np.int64)), b.column(1).take(take)], ["_q", "_i", "_mask", "_u"])

    per_group = counts.sum(axis=1)
    chunks = F.element_at(F.array(*[F.lit(int(max(1, -(-n // BLOCK)))) for n in per_group]), F.col("_i") + 1)
    blocks = index.groupBy("_i", F.pmod(F.xxhash64("_id", "_v"), chunks).alias("_c")).agg(F.collect_list(F.struct("_id", "_j", "_v")).alias("_entries"))
    n_queries = queries.count()
    asked = queries.select("_id", "_v").mapInArrow(tidy(probes), "_q long, _i int, _mask long, _u binary")
    asked = asked.groupBy("_i", F.pmod(F.xxhash64("_q"), F.lit(max(1, -(-n_queries // QUERIES)))).alias("_d")).agg(F.collect_list(F.struct("_q", "_mask", "_u")).alias("_asked"))
    # each block of queries goes to every block of its centroid by name, so a heavy centroid is as many keys as it has blocks
    asked = asked.select("_i", F.explode(F.sequence(F.lit(0).cast("long"), chunks.cast("long") - 1)).alias("_c"), "_asked")
    pairs = blocks.withColumn("_c", F.col("_c").cast("long")).join(asked, ["_i", "_c"]).select("_entries", "_asked")

    def reranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in range(b.num_rows):
                entries, asks = b.column(0)[n].values, b.column(1)[n].values
                ids, j, v = entries.field(0).to_numpy(), entries.field(1).to_numpy(), _stacked(entries.field(2))
                q, mask, u = asks.field(0).to_numpy(), asks.field(1).to_numpy().view(np.uint64), _stacked(asks.field(2))
                near = unit(u) @ unit(v).T
                near[((mask[:, None] >> j.astype(np.uint64)) & np.uint64(1) == 0) | (q[:, None] == ids)] = -np.inf
                rows_q, rows_v = [], []
                for a in range(len(q)):
                    line = near[a]
                    least = np.partition(line, -k)[-k] if len(line) > k else -np.inf
                    hit = np.flatnonzero((line >= least - 1e-9) & (line > -np.inf))
                    rows_q.append(np.full(len(hit), a))
                    rows_v.append(hit)
                if not rows_q:
                    continue
                at_q, at_v = np.concatenate(rows_q), np.concatenate(rows_v)
                score = cosine(u[at_q], v[at_v])
                order = np.lexsort((ids[at_v], -score, at_q))
                at_q, at_v, score = at_q[order], at_v[order], score[order]
                start = np.searchsorted(at_q, at_q)
                best = np.arange(len(at_q)) - start < k
                yield pa.RecordBatch.from_arrays([pa.array(q[at_q[best]]), pa.array(ids[at_v[best]]), pa.array(score[best])], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(tidy(reranked), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _budget(index: DataFrame, queries: DataFrame, books: tuple, counts: np.ndarray, half: int, k: int) -> int:
    """Entries to pass so that TARGET of the neighbours of PROBES queries are among them; measured over all rows."""
    probe = queries.orderBy(F.xxhash64("_id", F.lit(3)), "_id").limit(PROBES).collect()
    if not probe:
        return 0
    ids, u = np.array([r._id for r in probe]), unit(np.frombuffer(b"".join(bytes(r._v) for r in probe), "<f8").reshape(len(probe), -1))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for a in range(0, b.num_rows, 4096):
                part = b.slice(a, 4096)
                near = u @ unit(_stacked(part.column(3))).T
                near[ids[:, None] == part.column(0).to_numpy()] = -np.inf
                top = np.argsort(-near, axis=1)[:, :k]
                i, j = part.column(1).to_numpy(), part.column(2).to_numpy()
                held += [(n, float(near[n, t]), int(i[t]), int(j[t])) for n in range(len(ids)) for t in top[n] if near[n, t] > -np.inf]
                if len(held) > 64 * k * len(ids):
                    held = _best(held, k)
        if held:
            cols = zip(*_best(held, k), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.float64(), pa.int32(), pa.int32()), strict=True)], ["n", "score", "i", "j"])

    w = Window.partitionBy("n").orderBy(F.desc("score"))
    true = index.mapInArrow(tidy(best), "n int, score double, i int, j int").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).collect()  # PROBES * k
    need = []
    for n in range(len(ids)):
        cells = {(r.i, r.j) for r in true if r.n == n}
        many = [(r.i, r.j) for r in true if r.n == n]
        a, c = distances(u[n : n + 1, :half], books[0])[0], distances(u[n : n + 1, half:], books[1])[0]
        for i, j, total in traverse(a, c, counts):
            if (i, j) in cells:
                need += [total] * many.count((i, j))
                cells.discard((i, j))
                if not cells:
                    break
    return int(np.quantile(need, TARGET, method="higher")) if need else 0


def _best(rows: list[tuple], k: int) -> list[tuple]:
    out, seen = [], {}
    for r in sorted(rows, key=lambda r: (r[0], -r[1])):
        if seen.setdefault(r[0], 0) < k:
            seen[r[0]] += 1
            out.append(r)
    return out
