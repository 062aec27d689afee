"""Operator 3: nearest neighbours with a permutation index.

Every vector is represented by its ``LENGTH`` nearest pivots, in order. It is
posted in the inverted files of its first pivots, and a query reads the files
of its own first pivots. There, entries are ranked by the footrule distance of the
two orders (a pivot that is missing counts as being in the place after the last);
those within a bound are compared by the distance of the original vectors.

Pivots come from a bounded sample. So do the number of files that a vector is posted in and read
and the footrule bound: they are the smallest for which ``RECALL``
of the true neighbours of sample vectors in the sample are found. In all rows
neighbours are nearer than in a sample, so their orders are more alike.
There is no limit on candidates. Files are cut into blocks of bounded
size, as are the queries that read them; each block gives its best few for a
query, and the best of these are the result. A pair is compared in the first
file where it meets. A query that finds too few is compared with all vectors.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sliceflow.llm.common import hash_sample, spill, worker
from sliceflow.llm.vectors import dimensions, matrix, usable

PIVOTS = 128
LENGTH = 32
#: vectors that pivots, bound and number of files are learned from, at most
SAMPLE = 10_000
#: sample vectors that serve as queries there
PROBES = 300
RECALL = 0.985
#: vectors, queries in a cell
BLOCK, QUERIES = 8192, 512
_ALL = -1


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``x`` from ``q``, from differences."""
    d = x - q
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def orders(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each row, in order; ties to the smaller number."""
    square = (pivots * pivots).sum(1) - 2 * x @ pivots.T
    if length < len(pivots):
        # ties at the end of the list are cut the same way for equal vectors
        near = np.argpartition(square, length - 1, axis=1)[:, :length]
        near.sort(axis=1)
    else:
        near = np.tile(np.arange(len(pivots)), (len(x), 1))
    rank = np.argsort(np.take_along_axis(square, near, 1), axis=1, kind="stable")
    return np.take_along_axis(near, rank, 1).astype(np.uint16)


def places(order: np.ndarray, n_pivots: int) -> np.ndarray:
    """(rows, pivots): place of each pivot in the row's order, or its length."""
    n, length = order.shape
    out = np.full((n, n_pivots), length, dtype=np.int16)
    np.put_along_axis(out, order.astype(np.int64), np.broadcast_to(np.arange(length, dtype=np.int16), (n, length)), 1)
    return out


def footrule(place: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Footrule distances of rows (by their places) from one order."""
    length = len(order)
    at = place[:, order.astype(np.int64)].astype(np.int32)
    return length * (length + 1) // 2 + (np.abs(at - np.arange(length)) - (length - at)).sum(1)


def fit(sample: np.ndarray, k: int, recall: float = RECALL) -> tuple[np.ndarray, int, int, int]:
    """(pivots, length of orders, files of a vector, footrule bound)."""
    pivots = np.unique(sample, axis=0)
    pivots = pivots[np.sort(np.random.default_rng(3).permutation(len(pivots))[:PIVOTS])]
    length = min(LENGTH, len(pivots))
    order = orders(sample, pivots, length)
    place = places(order, len(pivots))
    files, bound = [], []
    for i in range(min(PROBES, len(sample))):
        d = distances(sample, sample[i])
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, len(sample) - 1)]
        if len(near):
            bound.append(footrule(place[near], order[i]))
            # the smallest number of first pivots that both have one of in common
            both = np.maximum(place[near][:, order[i].astype(np.int64)], np.arange(length)) + 1
            files.append(both.min(1))
    if not files:
        return pivots, length, 1, length * (length + 1)
    top = lambda x: int(np.sort(np.concatenate(x))[min(int(np.ceil(recall * sum(map(len, x)))), sum(map(len, x))) - 1])
    return pivots, length, min(top(files), length), top(bound)


def _orders(pivots, length):
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                order = orders(matrix(part.column(1)), pivots, length).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, order.size + 1, length, dtype=np.int32)), pa.array(order.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), flat], names=["id", "vector", "pivots"])
    return worker(run)


def _cells(k: int, n_pivots: int, files: int, bound: int):
    """Sorted rows of cells (list, e, q, query, id, vector, pivots) -> the best
    ``k`` of a cell for each of its queries."""
    def done(parts):
        t = pa.Table.from_batches(parts)
        query = t["query"].to_numpy()
        if query.all() or not query.any():
            return []
        ids, x, order = t["id"].to_numpy(), matrix(t["vector"]), matrix(t["pivots"], np.int64)
        e, here = np.flatnonzero(query == 0), t["list"][0].as_py()
        own, vec = ids[e], x[e]
        place = places(order[e], n_pivots) if here != _ALL else None
        out = []
        for q in np.flatnonzero(query).tolist():
            ok = own != ids[q]
            if here != _ALL:
                mine = order[q]
                for p in mine[:files]:  # met in an earlier file
                    if p == here:
                        break
                    ok &= place[:, p] >= files
                at = np.flatnonzero(ok)
                at = at[footrule(place[at], mine) <= bound]
            else:
                at = np.flatnonzero(ok)
            d = distances(vec[at], x[q])
            if len(d) > k:
                keep = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                at, d = at[keep], d[keep]
            best = np.lexsort((own[at], d))[:k]
            out.append((np.full(len(best), ids[q]), own[at[best]], d[best]))
        return out

    def run(batches):
        held, key, out, n = [], None, [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"])

        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("list", "e", "q")]
            change = np.zeros(b.num_rows - 1, dtype=bool)
            for c in cols:
                change |= c[1:] != c[:-1]
            start = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
            for s, e in zip(start, start[1:]):
                now = tuple(c[s] for c in cols)
                if now != key and held:
                    out += done(held)
                    held = []
                key = now
                held.append(b.slice(s, e - s))
            if sum(len(c[0]) for c in out) > 1 << 15:
                yield batch()
                out = []
        if held:
            out += done(held)
        if out:
            yield batch()
    return worker(run)


def _search(entries: DataFrame, queries: DataFrame, k: int, n_pivots: int, files: int, bound: int) -> DataFrame:
    """Best ``k`` of each cell; both tables: (list, id, vector, pivots)."""
    count = lambda t, n, name: t.groupBy("list").agg(F.ceil(F.count("*") / n).cast("long").alias(name))
    # one row for each file at most
    size = count(entries, BLOCK, "es").join(count(queries, QUERIES, "qs"), "list")
    block = lambda t, n: F.pmod(F.xxhash64("id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    e = entries.join(size, "list").withColumn("e", block(entries, "es")).withColumn("q", every("qs")).withColumn("query", F.lit(0))
    q = queries.join(size, "list").withColumn("q", block(queries, "qs")).withColumn("e", every("es")).withColumn("query", F.lit(1))
    cols = ["list", "e", "q", "query", "id", "vector", "pivots"]
    return (e.select(cols).unionByName(q.select(cols)).repartition("list", "e", "q").sortWithinPartitions("list", "e", "q")
            .mapInArrow(_cells(k, n_pivots, files, bound), "query_id long, vec_id long, score double"))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found for each
    query (all, if there are fewer), by Euclidean distance in double
    precision, ties to the smaller id; a row of the query's id is no
    candidate.

    Rows without an id, and vectors that are null, empty, zero or hold null or
    non-finite components take no part, neither as queries nor as candidates.
    Vectors of another length are no candidates; each length has an index of its own.
    Repeated rows count once. Other columns are ignored; empty tables give no rows.
    """
    base = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    asked = queries.select(queries[id_col].cast("long").alias("id"), queries[vector_col].alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    of = lambda t, d: t.where(F.size("vector") == d).dropDuplicates(["id", "vector"])
    found = [_nearest(of(base, d), of(asked, d), k) for d in dimensions(base, "vector")]
    if not found:
        return asked.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).where("false")
    return reduce(DataFrame.unionByName, found)


def _nearest(base: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The search among vectors of one length."""
    sample = hash_sample(base, F.xxhash64("id"), SAMPLE).select("vector").toArrow()
    pivots, length, files, bound = fit(matrix(sample["vector"]), k)
    kind = base.schema["vector"].dataType.simpleString()
    indexed, probing = (spill(t.mapInArrow(_orders(pivots, length), f"id long, vector {kind}, pivots array<int>"), "orders") for t in (base, asked))
    post = lambda t: t.select(F.explode(F.slice("pivots", 1, files)).alias("list"), "id", "vector", "pivots")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = lambda t: t.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    result = spill(found(_search(post(indexed), post(probing), k, len(pivots), files, bound)), "found")
    # queries whose files hold too few
    n = indexed.count()
    enough = result.groupBy("query_id").count().where(F.col("count") >= min(k, n - 1))
    short = spill(probing.join(enough, probing["id"] == enough["query_id"], "left_anti"), "short")
    if not short.isEmpty():
        every = lambda t: t.select(F.lit(_ALL).alias("list"), "id", "vector", "pivots")
        rest = found(_search(every(indexed), every(short), k, len(pivots), files, bound))
        result = result.join(enough.select("query_id"), "query_id", "left_semi").unionByName(rest)
    return result.select("query_id", "rank", "vec_id", "score")


def op3_permutation_index(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(rows, rows.where("vec_id % 100 = 0"))
