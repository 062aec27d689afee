"""Operator 6: near duplicates of vectors by iterative quantisation.

A rotation is learned (on a bounded sample) that turns unit vectors towards the
corners of a cube, so that the signs of their coordinates are balanced bits.
It does not shift the vectors: angles stay as they are, and so does the chance that
two vectors at a given angle agree in a bit, wherever most vectors lie.
Codes are cut into tables of ``s`` bits. Vectors that agree in all bits of a
table meet in a bucket (multi-index Hamming tables); pairs whose whole codes are near
enough are compared by the cosine of their original vectors.

``s`` grows with the logarithm of the rows, so buckets stay small. The number of
tables follows from the sample: as many as make a pair at the threshold itself
meet with probability ``1 - MISS`` at least; nearer pairs meet more surely.

Equal vectors are one node. A pair counts in the first table where it meets.
Buckets give a row for each linked vector (its links there, and the smallest
vector that it is connected with there), never the pairs. Large buckets are
compared block against block.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sliceflow.llm.common import connected_components, hash_sample, spill, worker
from sliceflow.llm.vectors import dimensions, lists, matrix, usable

THRESHOLD = 0.98
#: vectors that the rotation is learned from, at most; those of the smallest hash
SAMPLE = 20_000
#: chance that a pair at the threshold meets in no table, in the sample
MISS = 0.002
#: vectors in a bucket that codes would have if they were random, about
BUCKET = 16
#: vectors in a block of a large bucket
BLOCK = 2048
ROUNDS = 30


def unit(m: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square
    overflows or vanishes."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def learn_rotation(x: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """ITQ: a rotation R that brings x R near to its own signs."""
    d = x.shape[1]
    r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(x @ r > 0, 1.0, -1.0).T @ x)
        r = (u @ v).T
    return r


def subcodes(x: np.ndarray, rotations: np.ndarray, tables: int, s: int) -> np.ndarray:
    """(rows, tables) codes of s bits of unit vectors."""
    bits = (x @ rotations)[:, : tables * s] > 0
    return (bits.reshape(len(x), tables, s) @ (1 << np.arange(s))).astype(np.int32)


def fit(sample: np.ndarray, s: int, threshold: float, miss: float = MISS) -> tuple[np.ndarray, int, int]:
    """(rotations side by side, number of tables, largest Hamming distance of
    whole codes that a link may have). Pairs at exactly the threshold are made
    from the sample to measure what meets."""
    n, d = sample.shape
    near = np.random.default_rng(7).standard_normal((max(4096, n), d))
    base = sample[np.arange(len(near)) % n]
    near -= (near * base).sum(1, keepdims=True) * base
    length = np.sqrt((near * near).sum(1, keepdims=True))
    near = np.where(length > 1e-9, threshold * base + math.sqrt(1 - threshold ** 2) * near / np.maximum(length, 1e-9), base)
    rotations, tables, alone = [], 0, np.ones(len(near), dtype=bool)
    while True:  # one rotation after another, until few pairs are left that never meet
        rotations.append(learn_rotation(sample, len(rotations)))
        r = np.concatenate(rotations, axis=1)
        for t in range(tables, r.shape[1] // s):
            tables = t + 1
            part = r[:, t * s: tables * s]
            alone &= ((base @ part > 0) != (near @ part > 0)).any(1)
            if alone.mean() <= miss / 2:
                r = r[:, : tables * s]
                far = ((base @ r > 0) != (near @ r > 0)).sum(1)
                return r, tables, int(far.max()) + tables
        if len(rotations) * d > 1 << 14:
            raise ValueError("no code keeps near vectors together")


def _codes(r, tables, s):
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                code = subcodes(unit(matrix(part.column(2))), r, tables, s)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), part.column(3), lists(code)],
                                                 names=["node", "label", "embedding", "w", "code"])
    return worker(run)


def _compare(threshold: float, radius: int):
    """Sorted rows of cells -> (node, lo, n): its links in the cell and the
    smallest node that it is connected with there."""
    def done(parts):
        t = pa.Table.from_batches(parts)
        table, two = t["t"][0].as_py(), t["i"][0].as_py() != t["j"][0].as_py()
        node, w, x = t["node"].to_numpy(), t["w"].to_numpy(), unit(matrix(t["embedding"]))
        code = matrix(t["code"], np.int32)
        block = t["block"].to_numpy()
        rows = np.flatnonzero(block == t["i"][0].as_py()) if two else np.arange(len(node))
        cols = np.flatnonzero(block != t["i"][0].as_py()) if two else rows
        label, links, linked = np.arange(len(node)), np.zeros(len(node), np.int64), []
        for k in range(0, len(rows), 256):
            a = rows[k: k + 256]
            ok = x[a] @ x[cols].T >= threshold
            if not two:
                ok &= a[:, None] < cols[None, :]
            p, q = np.nonzero(ok)
            p, q = a[p], cols[q]
            ok = np.ones(len(p), dtype=bool)
            for e in range(table):  # met in an earlier table
                ok &= code[p, e] != code[q, e]
            ok &= np.bitwise_count((code[p] ^ code[q]).astype(np.uint32)).sum(1) <= radius
            p, q = p[ok], q[ok]
            np.add.at(links, p, w[q])
            np.add.at(links, q, w[p])
            while True:
                lo = np.minimum(label[p], label[q])
                if (label[p] == label[q]).all():
                    break
                np.minimum.at(label, p, lo)
                np.minimum.at(label, q, lo)
            linked.append((p, q))
        while True:  # labels of earlier rows may have fallen since
            moved = False
            for p, q in linked:
                lo = np.minimum(label[p], label[q])
                if (label[p] != label[q]).any():
                    moved = True
                    np.minimum.at(label, p, lo)
                    np.minimum.at(label, q, lo)
            if not moved:
                break
        at = np.flatnonzero(links)
        return node[at], node[label[at]], links[at]

    def run(batches):
        held, key, out, n = [], None, [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["node", "lo", "n"])

        for b in batches:
            if not b.num_rows:
                continue
            names = ("label", "t", "sub", "i", "j")
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in names]
            change = np.zeros(b.num_rows - 1, dtype=bool)
            for c in cols:
                change |= c[1:] != c[:-1]
            start = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
            for s, e in zip(start, start[1:]):
                now = tuple(c[s] for c in cols)
                if now != key and held:
                    out.append(done(held))
                    n += len(out[-1][0])
                    held = []
                key = now
                held.append(b.slice(s, e - s))
            if n > 1 << 16:
                yield batch()
                out, n = [], 0
        if held:
            out.append(done(held))
        if out:
            yield batch()
    return worker(run)


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``rows``: (vec_id, n_links, component_id, kept).

    Two vectors link when their labels are equal and not null and their cosine
    in double precision is ``threshold`` or more. Vectors that are null, empty,
    zero, or hold null or non-finite components link with nothing. Vectors of different
    lengths never link; each length has codes of its own. Every row is a vector: rows that repeat an id count
    each. Null ids are never the smallest; a component of null ids has id
    null. Other columns are ignored; an empty table gives no rows.
    """
    base = rows.select(rows[id_col].cast("long").alias("vec_id"), rows[vector_col].cast("array<double>").alias("embedding"), rows[label_col].cast("long").alias("label"))
    takes_part = usable(F.col("embedding")) & F.col("label").isNotNull()
    node = F.xxhash64("label", "embedding")
    base = base.withColumn("node", F.when(takes_part, node))
    copies = spill(base.where("node is not null").groupBy("node", "label", "embedding").agg(F.count("*").alias("w"), F.min("vec_id").alias("least"))
                   .select("node", "label", "embedding", "w", "least"), "vectors")
    found = [_linked(copies.where(F.size("embedding") == d), threshold) for d in dimensions(copies, "embedding")]
    if not found:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    named = reduce(DataFrame.unionByName, found)
    root = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(root, "component").select(F.col("node").alias("_node"), "n_links", "component_id")
    out = base.select("vec_id", "node").join(named, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("_node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _linked(copies: DataFrame, threshold: float) -> DataFrame:
    """(node, least, n_links, component) of the distinct vectors (node, label, embedding,
    w, least) of one length."""
    sample = hash_sample(copies.select("node", "embedding"), F.xxhash64("node"), SAMPLE).select("embedding").toArrow()
    most = copies.groupBy("label").count().agg(F.max("count")).first()[0]
    s = max(6, math.ceil(math.log2(max(1, most) / BUCKET)))
    r, tables, radius = fit(unit(matrix(sample["embedding"])), s, threshold)
    codes = spill(copies.select("node", "label", "embedding", "w").mapInArrow(_codes(r, tables, s), "node long, label long, embedding array<double>, w long, code array<int>"), "codes")
    keys = codes.select("label", F.posexplode("code").alias("t", "sub"))
    shared = (keys.groupBy("label", "t", "sub").agg(F.count("*").alias("c")).where("c > 1")
              .select("label", "t", "sub", F.ceil(F.col("c") / BLOCK).cast("long").alias("blocks")))
    cell = (codes.select("*", F.posexplode("code").alias("t", "sub")).join(shared, ["label", "t", "sub"])
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
            .withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("label", "t", "sub", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "node", "w", "embedding", "code"))
    links = spill(cell.repartition("label", "t", "sub", "i", "j").sortWithinPartitions("label", "t", "sub", "i", "j")
                  .mapInArrow(_compare(threshold, radius), "node long, lo long, n long"), "links")
    degree = links.groupBy("node").agg(F.sum("n").alias("n"))
    group = connected_components(links.select("node", "lo"))
    return copies.select("node", "w", "least").join(degree, "node", "left").join(group, "node", "left").select(
        "node", "least", (F.coalesce("n", F.lit(0).cast("long")) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))


def op6_itq_dedup(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
 AND len(list_filter(e, lambda x: x <> 0)) > 0),
near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM near GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, c AS component_id, v.vec_id = c AS kept FROM v JOIN least ON least.a = v.vec_id LEFT JOIN degree ON degree.a = v.vec_id"""
