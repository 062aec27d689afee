"""Helpers shared by the operators: shared-folder tables and files, batching,
hashing of words, and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sliceflow.session import scratch_path

#: texts are handled in slices of about so many characters, so that memory does
#: not follow the number of rows in an Arrow batch
SLICE_CHARS = 1 << 20


def spill(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: a
    lineage cut that survives lost executors. Shuffles that only ``df`` needed
    are garbage then; a collection lets Spark delete their files."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.spilled = path
    del df
    gc.collect()
    spark._jvm.System.gc()
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a spilled table that no plan will read again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.spilled)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def only(docs: DataFrame, **columns: str) -> DataFrame:
    """The columns of ``docs`` with exactly these names under new ones (``new="old"``),
    whatever other columns there are, also names that differ by case alone."""
    at = {name: i for i, name in reversed(list(enumerate(docs.columns)))}
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.select(*[F.col(f"c{at[old]}").alias(new) for new, old in columns.items()])


def worker(run):
    """``run`` over the batches of a task; when it ends, the Python worker, which
    Spark keeps for later tasks, gives its free memory back. Caches are large and hold
    no cycles, so none are looked for while the task runs."""
    def wrapped(batches):
        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library
                ctypes.CDLL(None).malloc_trim(0)
    return wrapped


def per_process(key: tuple, make):
    """``make()`` once for each key in a Python process. Functions are sent to workers by
    value, with the globals that they use, so a global is new in each task; a module
    that the process has made for itself is not."""
    held = sys.modules.setdefault("sliceflow_held", types.ModuleType("sliceflow_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def hash_sample(df: DataFrame, h: Column, limit: int) -> DataFrame:
    """At most ``limit`` rows, by a hash of them. One row in so many is kept
    first, so that what tasks send for the order is about the sample itself,
    however many tasks there are."""
    return df.where(F.pmod(h, F.lit(max(1, df.count() // limit))) == 0).orderBy(h, *df.columns).limit(limit)


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder that the driver and all executors can reach."""
    return scratch_path(spark, name)


def filesystem(uri: str):
    """pyarrow file system and path of a folder URI (plain paths are local)."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))  # names that Hadoop has for it


def crc32_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def text_slices(texts: list, limit: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of ``texts`` whose total length is about ``limit``; a text
    that is longer than that has a range of its own."""
    i, total, limit = 0, 0, limit or SLICE_CHARS
    for j, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if j > i and total + n > limit:
            yield i, j
            i, total = j, 0
        total += n
    if i < len(texts):
        yield i, len(texts)


# --------------------------------------------------------------------------
# 64-bit hashes with numpy; the same on every machine and in every process

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_CHUNK = 1 << 20
_POW: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """Invertible mixing of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POW:
        def table(base: int) -> np.ndarray:
            t = np.full(_CHUNK + 2, base, dtype=np.uint64)
            t[0] = 1
            return np.multiply.accumulate(t, dtype=np.uint64)

        _POW.extend((table(_BASE), table(pow(_BASE, -1, 1 << 64))))
    return _POW[0], _POW[1]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start offset of each word ``[^\\x20\\x09-\\x0D]+`` of ``data``."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + _CHUNK)
        if end < len(data):  # cut at white space; a longer word is hashed alone
            cut = end
            while cut > at and not _SPACE[data[cut - 1]]:
                cut -= 1
            if cut == at:
                cut = end
                while cut < len(data) and not _SPACE[data[cut]]:
                    cut += 1
                if cut - at > _CHUNK:
                    h = np.array([zlib.crc32(data[at:cut]) | (zlib.adler32(data[at:cut]) << 32)], dtype=np.uint64)
                    hashes.append(mix64(h))
                    starts.append(np.array([at], dtype=np.int64))
                    at = cut
                    continue
            end = cut
        h, s = _chunk_hashes(np.frombuffer(data, dtype=np.uint8, count=end - at, offset=at))
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def _chunk_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _powers()
    word = np.zeros(len(buf) + 2, dtype=np.int8)
    word[1:-1] = ~_SPACE[buf]
    edge = np.diff(word)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], out=total[1:])
    h = (total[last] - total[first]) * inverse[first]
    return mix64(h + (last - first).astype(np.uint64) * _M1), first


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; with fewer words the
    whole sequence is one shingle; no words, no shingle."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        k = n
    h = np.full(n - k + 1, k, dtype=np.uint64)
    for i in range(k):
        h *= np.uint64(_BASE)
        h += words[i: n - k + 1 + i]
    return np.unique(mix64(h))


# --------------------------------------------------------------------------
# connected components


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of the edges u-v."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u):]
    root = np.arange(len(nodes))
    while True:  # hook the larger root under the smaller, then jump pointers
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            return nodes, nodes[root]
        np.minimum.at(root, np.maximum(ra, rb)[differ], np.minimum(ra, rb)[differ])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


@worker
def _contract(batches):
    """Edges of a partition -> one edge (node, smallest node) per node."""
    u = v = np.empty(0, np.int64)
    for b in batches:
        if b.num_rows:
            u = np.concatenate([u, b.column(0).to_numpy(zero_copy_only=False)])
            v = np.concatenate([v, b.column(1).to_numpy(zero_copy_only=False)])
        if len(u) > 1 << 21:
            u, v = forest(u, v)
            keep = u != v
            u, v = u[keep], v[keep]
    if len(u):
        u, v = forest(u, v)
        keep = u != v
        yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], names=["hi", "lo"])


def connected_components(edges: DataFrame, contract: bool = True) -> DataFrame:
    """(node, component: smallest node reachable) for every node of ``edges``
    (two long columns); nodes without an edge are not listed.

    Each partition first replaces its edges by one per node (``contract``; not worth
    it for edges of spanning forests). Then alternating
    star contraction: every node points its larger neighbours to its smallest
    one, then its smaller neighbours and itself; the minima are partial
    aggregates, so a hub is reduced before the shuffle, and no neighbour list is
    gathered. Rounds grow as the logarithm of the longest chain. Each round is
    a table in the shared folder.
    """
    a, b = edges.columns
    e = edges.where((F.col(a) != F.col(b)) & F.col(a).isNotNull() & F.col(b).isNotNull())
    e = e.select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo"))
    e = spill(e.mapInArrow(_contract, "hi long, lo long") if contract else e, "edges")
    seen = None
    while True:
        both = e.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionByName(
            e.select(F.col("lo").alias("n"), F.col("hi").alias("m")))
        least = both.groupBy("n").agg(F.min("m").alias("s")).select("n", F.least("n", "s").alias("s"))
        large = (both.where("m > n").join(least, "n").where("m > s")
                 .select(F.col("m").alias("hi"), F.col("s").alias("lo")).distinct())
        small = large.groupBy("hi").agg(F.min("lo").alias("s"))
        last, e = e, spill(large.join(small, "hi").where("lo > s").select(F.col("lo").alias("hi"), F.col("s").alias("lo"))
                  .unionByName(small.select("hi", F.col("s").alias("lo"))).distinct(), "stars")
        discard(last)
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
        if now == seen or now[0] == 0:
            break
        seen = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
