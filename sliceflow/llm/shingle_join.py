"""Operator 9: Jaccard join of word-shingle sets with parity sketches.

Two sets A, B with ``100 * |A & B| >= t * |A | B|`` differ in at most
``D = (100 - t) / (100 + t) * (|A| + |B|)`` shingles. That is used twice:

* **Pigeonhole join per size band.** In band k (sizes from ``lo`` to ``hi``; a
  set also enters the bands above that a linked set may have) shingles are dealt over
  ``p = D + 1 + spare`` parts, and each part is the XOR of its shingles' 64-bit
  hashes. A differing shingle changes one part at most, so two linked sets agree
  in at least ``spare + 1`` parts, and (band, part, value) is an equi-join key.
  The first ``spare`` parts without shingles are left out. Nothing is lost by that:
  were all equal parts of a linked pair empty, at least ``spare + 1`` would be, and
  the last of them comes after ``spare`` empty ones in both sets: both send it. As
  unrelated sets meet in such a key, ``spare`` is so large that few sets send one.
* **Bit sketch.** Shingles are XORed into single bits of a second sketch; its
  Hamming distance is a lower bound of the number of differing shingles.

Buckets are never expanded into output pairs. Buckets of up to ``SMALL`` sets
give candidate pairs, which are made distinct; larger ones are compared inside
a task, block against block, on bit sketches. Both leave only the edges of a
spanning forest. Sets are then gathered by candidate component, block against
block for large ones, and verified exactly; a pair is skipped once its two sets
are connected, which changes no component.

Sets are identified by a 64-bit fingerprint of all their shingles; shingles
by 64-bit hashes.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sliceflow.llm.common import (connected_components, discard, forest, mix64, shingle_set, spill, text_slices, word_hashes, worker)

#: parts beyond D + 1, see above
MARGIN = 2
#: sizes in a band differ by this factor
BAND = 1.5
#: buckets up to this size are written as pairs
SMALL = 8
#: sets in a block, when a large bucket or component is compared block by block
BLOCK = 4096
#: shingles in a block of a component
BLOCK_SHINGLES = 1 << 22
#: 64-bit words of the second sketch of a set of up to 1024 shingles; it doubles
#: with the size, so that it has about as many bits as the set has shingles
SKETCH_WORDS = 16
#: least words of the sketch that goes with the rows of large buckets
SHORT_WORDS = 8
#: words that are compared at once
CELL_WORDS = 1 << 21
_C1, _C2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A3564E3B1D2F35)


def text_words(text: str | None) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased."""
    return word_hashes((text or "").encode("utf-8", "surrogatepass").lower())[0]


def fingerprint(shingles: np.ndarray) -> int:
    """64-bit identity of a set."""
    x = np.array([np.bitwise_xor.reduce(shingles), np.sum(shingles, dtype=np.uint64), len(shingles)], dtype=np.uint64)
    return int(np.bitwise_xor.reduce(mix64(mix64(x) + _C1 * np.arange(1, 4, dtype=np.uint64))).view(np.int64))


def bands(size: int, percent: int) -> list[tuple[int, int]]:
    """(band, parts) that a set of ``size`` shingles enters."""
    k = max(0, int(math.log(size) / math.log(BAND)) - 1)
    while _border(k + 1) <= size:
        k += 1
    own = [k]
    while 100 * size >= percent * _border(own[-1] + 1):
        own.append(own[-1] + 1)
    return [(b, _parts(b, percent)[0]) for b in own]


def _parts(band: int, percent: int) -> tuple[int, int]:
    """(parts of a band, how many empty ones a set leaves out): as many as its smallest set
    is expected to have and two deviations more, or one, or none. More parts have more empty
    ones, so that may have no solution; where parts would be more than doubled it is MARGIN."""
    need = (100 - percent) * 2 * (_border(band + 1) - 1) // (100 + percent) + 1
    least, spares = percent * _border(band) / 100, range(MARGIN, MARGIN + need + 1)
    for deviations in (2, 1, 0):
        def enough(spare):
            empty = (need + spare) * math.exp(-least / (need + spare))
            return spare >= empty + deviations * math.sqrt(empty)
        at = bisect_left(spares, True, key=enough)
        if at < len(spares):
            return need + spares[at], spares[at]
    return need + MARGIN, MARGIN


def _border(k: int) -> int:
    return max(k + 1, math.ceil(BAND ** k))


def part_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Join keys of a set."""
    out, high = [], shingles >> np.uint64(32)
    for band, parts in bands(len(shingles), percent):
        part = ((high * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        # shingles are sorted, so parts are in order
        first = np.flatnonzero(np.diff(part, prepend=-1))
        value = np.bitwise_xor.reduceat(shingles, first)
        at = part[first].astype(np.uint64)
        empty = np.setdiff1d(np.arange(parts), part[first])[_parts(band, percent)[1]:]
        value, at = np.append(value, np.zeros(len(empty), np.uint64)), np.append(at, empty.astype(np.uint64))
        out.append(mix64(mix64(value + (at + np.uint64(1)) * _C1) + np.array([band + 1], np.uint64) * _C2))
    return np.concatenate(out)


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles per bit, as 64-bit words. The number of words is a
    power of two; the halves of a sketch XORed are the sketch of half the width."""
    words = SKETCH_WORDS
    while 64 * words < len(shingles):
        words *= 2
    bit = (shingles & np.uint64(64 * words - 1)).astype(np.int64)  # parts take the high bits
    return np.packbits((np.bincount(bit, minlength=64 * words) & 1).astype(np.uint8)).view(np.uint64)


def _fold(sketch: np.ndarray) -> np.ndarray:
    half = sketch.shape[-1] // 2
    return sketch[..., :half] ^ sketch[..., half:]


def _narrow(sketch: np.ndarray, words: int) -> np.ndarray:
    while len(sketch) > words:
        sketch = _fold(sketch)
    return sketch


def short_sketch(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch of SHORT_WORDS words, or of more for a set of more shingles than these have
    bits: sets that differ wholly would look alike. A set in many large buckets is sent with it many times."""
    words = SHORT_WORDS
    while 64 * words < size:
        words *= 2
    return _narrow(sketch, words)


def _allowed(distance, x, y, percent: int):
    """Whether sets of sizes x and y that differ in ``distance`` shingles can link."""
    return distance * (100 + percent) <= (100 - percent) * (x + y)


def _first_pass(k: int, percent: int):
    schema = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("sketch", pa.binary()), ("short", pa.binary()), ("text", pa.int64())])

    def batch(kind, key, node, size, sketch=None, short=None, text=None):
        n = len(node)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n, kind, np.int8)), key if isinstance(key, pa.Array) else pa.array(key), pa.array(node, pa.int64()), pa.array(size, pa.int32()),
            *(pa.nulls(n, pa.binary()) if x is None else pa.array(x, pa.binary()) for x in (sketch, short)), pa.nulls(n, pa.int64()) if text is None else text], schema=schema)

    def run(batches):
        # rows of kind 0: documents (key: doc_id); 1: keys; 2: sets with sketch
        seen: set[int] = set()
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for i, j in text_slices(texts):
                nodes, sizes, new, keys, owner = [], [], [], [], []
                for t in texts[i:j]:
                    s = shingle_set(text_words(t), k)
                    nodes.append(fingerprint(s) if len(s) else None)
                    sizes.append(len(s))
                    if not len(s) or nodes[-1] in seen:
                        continue
                    if len(seen) >= 1 << 20:  # only saves work: a set may be sent twice
                        seen.clear()
                    seen.add(nodes[-1])
                    wide = bit_sketch(s)
                    new.append((nodes[-1], len(s), wide.tobytes(), short_sketch(wide, len(s)).tobytes()))
                    keys.append(part_keys(s, percent).view(np.int64))
                    owner.append(len(new) - 1)
                yield batch(0, ids.slice(i, j - i).cast(pa.int64()), nodes, sizes, text=b.column(2).slice(i, j - i))
                if new:
                    n, z, *sk = zip(*new)
                    yield batch(2, pa.nulls(len(n), pa.int64()), list(n), list(z), *sk)
                    at = np.repeat(np.arange(len(n)), [len(x) for x in keys])
                    yield batch(1, np.concatenate(keys), np.array(n, np.int64)[at], np.array(z, np.int32)[at])
    return worker(run)


def _buckets():
    """Rows (key, node) in order of key and node -> distinct pairs of the
    small buckets (kind 0), rows of the large ones (kind 1: key, node)."""
    def run(batches):
        rows: list[int] = []  # of the current key, until it is known to be large
        key, large, last = None, False, None
        found: set[tuple[int, int]] = set()
        big: list[tuple[int, int]] = []

        def close():
            if not large:
                for i, a in enumerate(rows):
                    found.update((a, b) for b in rows[i + 1:])

        def out(kind, pairs):
            n = len(pairs)
            a, b = np.array(pairs, np.int64).reshape(n, 2).T
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            k, node = (b.column(c).to_numpy(zero_copy_only=False) for c in range(2))
            start = np.concatenate([[0], np.flatnonzero(np.diff(k)) + 1, [len(k)]])
            length = np.diff(start)
            # runs of one row are alone, except those that may go on beyond the batch
            many = np.flatnonzero(length > 1)
            for r in sorted({0, len(length) - 1, *many.tolist()}):
                i, j = int(start[r]), int(start[r + 1])
                if k[i] != key:
                    close()
                    key, rows, large, last = int(k[i]), [], False, None
                for x in node[i:j].tolist():
                    if x == last:
                        continue
                    last = x
                    if large:
                        big.append((key, x))
                    else:
                        rows.append(x)
                        if len(rows) > SMALL:
                            large = True
                            big.extend((key, x) for x in rows)
                            rows = []
                if len(big) >= 1 << 16:
                    yield out(1, big)
                    big = []
                if len(found) >= 1 << 18:
                    yield out(0, list(found))
                    found.clear()
        close()
        if big:
            yield out(1, big)
        if found:
            yield out(0, list(found))
    return worker(run)


def _near(percent: int):
    """Pairs with sketches -> those whose sketches allow a link."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            a, c, x, y = (b.column(n).to_numpy(zero_copy_only=False) for n in ("a", "b", "size_a", "size_b"))
            left, right = (b.column(n).to_pylist() for n in ("sketch_a", "sketch_b"))
            width = np.array([(len(p), len(q)) for p, q in zip(left, right)])
            ratio = 100 * np.minimum(x, y).astype(np.int64) >= percent * np.maximum(x, y)
            ok = np.zeros(len(a), dtype=bool)
            for m, n in np.unique(width, axis=0):
                at = np.flatnonzero((width == (m, n)).all(1))
                p, q = (np.frombuffer(b"".join(side[i] for i in at), dtype=np.uint64).reshape(len(at), w // 8) for side, w in ((left, m), (right, n)))
                while p.shape[1] > q.shape[1]:
                    p = _fold(p)
                while q.shape[1] > p.shape[1]:
                    q = _fold(q)
                ok[at] = _allowed(np.bitwise_count(p ^ q).sum(1, dtype=np.int64), x[at].astype(np.int64), y[at], percent)
            ok &= ratio
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(c[ok])], names=["a", "b"])
    return worker(run)


def _cell(node, size, sketches, left, percent, check=None):
    """Spanning edges among the sets of a cell. ``left``: True for the first
    block of the cell, None when it has one block only. A pair is compared
    unless it is connected already."""
    if check is None and left is None and len(node) <= 512:  # many at once
        words = min(map(len, sketches))
        s = np.stack([_narrow(x, words) for x in sketches])
        ok = np.empty((len(s), len(s)), dtype=bool)
        step = max(1, CELL_WORDS // s.size)
        for i in range(0, len(s), step):
            at = slice(i, i + step)
            far = np.bitwise_count(s[at, None] ^ s[None]).sum(2, dtype=np.int64)
            ok[at] = _allowed(far, size[at, None], size[None], percent) & (100 * np.minimum(size[at, None], size) >= percent * np.maximum(size[at, None], size))
        p, q = np.nonzero(np.triu(ok, 1))
        return [(node[a], node[b]) for a, b in zip(*forest(p, q)) if a != b] if len(p) else []
    label, edges = np.arange(len(node)), []
    width = np.array([len(s) for s in sketches])
    by_width = {}
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        m = np.stack([sketches[i] for i in at])
        by_width[w] = at, m, _fold(m)
    for i in range(len(node) - 1) if left is None else np.flatnonzero(left).tolist():
        w = int(width[i])
        for v in (w // 2, w, 2 * w):  # sizes of linked sets differ by a factor of 2 at most
            if v not in by_width:
                continue
            at, full, half = by_width[v]
            pick = (label[at] != label[i]) & (100 * np.minimum(size[at], size[i]) >= percent * np.maximum(size[at], size[i]))
            pick &= at > i if left is None else ~left[at]
            pick = np.flatnonzero(pick)
            mine = _fold(sketches[i]) if v < w else sketches[i]
            far = np.bitwise_count((half if v > w else full)[pick] ^ mine).sum(1, dtype=np.int64)
            for x in at[pick[_allowed(far, size[at[pick]], size[i], percent)]].tolist():
                if label[x] != label[i] and (check is None or check(i, x)):
                    edges.append((node[i], node[x]))
                    label[label == label[x]] = label[i]
    return edges


def _cell_edges(percent: int, k: int = 0):
    """Sorted rows (group, i, j, block, node, size, sketch or text) -> pairs that
    sketches allow, or links of the ``k``-word shingles of the texts: a spanning forest for each cell.
    Texts are smaller to send than their shingles."""
    def done(parts):
        t = pa.Table.from_batches(parts)
        node, size = t["node"].to_numpy(), t["size"].to_numpy().astype(np.int64)
        two = t["i"][0].as_py() != t["j"][0].as_py()
        left = t["block"].to_numpy() == t["i"].to_numpy() if two else None
        if k:
            sets = [shingle_set(text_words(x), k) for x in t["data"].to_pylist()]
            # a row that repeats an id may have another text
            own = [i for i, s in enumerate(sets) if len(s) and fingerprint(s) == node[i]]
            sets, node, left = [sets[i] for i in own], node[own], left[own] if two else None
            size = np.array([len(s) for s in sets], dtype=np.int64)

            def check(i, j):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                return 100 * both >= percent * (size[i] + size[j] - both)
            return _cell(node, size, [bit_sketch(x) for x in sets], left, percent, check)
        return _cell(node, size, [np.frombuffer(x, dtype=np.uint64) for x in t["data"].to_pylist()], left, percent)

    def run(batches):
        held, key, edges = [], None, []
        for b in batches:
            if not b.num_rows:
                continue
            g, i, j = (b.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "i", "j"))
            start = [0, *(np.flatnonzero((np.diff(g) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1).tolist(), b.num_rows]
            for s, e in zip(start, start[1:]):
                now = (g[s], i[s], j[s])
                if now != key and held:
                    edges += done(held)
                    held = []
                key = now
                held.append(b.slice(s, e - s))
            if len(edges) >= 1 << 16:
                u, v = forest(*np.array(edges, np.int64).T)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["a", "b"])
                edges = []
        if held:
            edges += done(held)
        if edges:
            u, v = forest(*np.array(edges, np.int64).T)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["a", "b"])
    return worker(run)


def _blocks(shingles: int):
    """Blocks of a group: of BLOCK sets and so many shingles."""
    return F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.col("size").cast("long")) / shingles)).cast("long").alias("c")


def _cells(rows: DataFrame) -> DataFrame:
    """Rows (grp, c, node, size, data) dealt over the cells (i <= j) of their
    group, which has ``c`` blocks."""
    at = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("c")))
    other = at.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)))
    return (other.select("grp", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "node", "size", "data")
            .repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j"))


#: bits of the filter that keeps texts from being sent in vain: 65,536 rows are broadcast at most
FILTER_BITS = 1 << 22


def with_bits(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without most of those that have no row of ``wanted`` with equal columns ``on``: a
    hash of these is a bit, and rows of other bits go. It leaves more when there are many
    wanted, and never takes one that is."""
    bit = F.pmod(F.xxhash64(*on), F.lit(FILTER_BITS))
    mask = F.expr("shiftleft(1L, cast(pmod(_bit, 64) as int))")
    split = lambda t: t.withColumn("_bit", bit).withColumn("_word", F.floor(F.col("_bit") / 64)).withColumn("_mask", mask)
    words = split(wanted.select(*on)).groupBy("_word").agg(F.bit_or("_mask").alias("_set"))
    return split(rows).join(F.broadcast(words), "_word").where(F.col("_set").bitwiseAND(F.col("_mask")) != 0).select(*rows.columns)


def similar_documents(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id).

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, A-Z lower-cased. Two
    documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets
    of ``k``-word shingles. Null or empty texts have no shingle and link with
    nothing, fewer than ``k`` words are one shingle. ``component_id`` is the
    smallest id reachable by links. Rows that repeat an id are one document
    with several texts: each row is returned, all with the same component. A
    null id has component null. Other columns are ignored, an empty table
    gives an empty result.
    """
    if not 50 <= percent < 100:
        raise ValueError("percent must be from 50 to 99")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    first = spill(base.select("id", "text", "hash").mapInArrow(_first_pass(k, percent), "kind byte, key long, node long, size int, sketch binary, short binary, text long"), "sketches")
    documents = spill(first.where("kind = 0").select(F.col("key").alias("doc_id"), "node", F.col("size").cast("long").alias("n_shingles"), F.col("text").alias("hash")), "documents")
    sets = spill(first.where("kind = 2").dropDuplicates(["node"]).select("node", "size", "sketch", "short"), "sets")

    bucket = spill(first.where("kind = 1").select("key", "node").repartition("key").sortWithinPartitions("key", "node")
                   .mapInArrow(_buckets(), "kind byte, a long, b long"), "buckets")
    discard(first)
    pairs = bucket.where("kind = 0").select("a", "b").distinct()
    side = lambda c: sets.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    near = (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b")
            .mapInArrow(_near(percent), "a long, b long"))
    large = bucket.where("kind = 1").select(F.col("a").alias("grp"), F.col("b").alias("node"))
    count = large.join(sets.select("node", "size"), "node").groupBy("grp").agg(_blocks(16 * BLOCK_SHINGLES))
    dense = (_cells(large.join(sets.select("node", "size", F.col("short").alias("data")), "node").join(count, "grp"))
             .mapInArrow(_cell_edges(percent), "a long, b long"))
    candidates = spill(connected_components(near.unionByName(dense), contract=False), "candidates")
    discard(bucket)

    # the sets of candidate components, each made from one document that has it; of all texts
    # only these are sent, but for a few that share a bit with one of them
    row = [F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0).cast("long")).alias("id"), "hash"]
    chosen = (documents.withColumnRenamed("doc_id", "id").join(candidates, "node").select("node", "component", F.struct(*row).alias("row"))
              .groupBy("node", "component").agg(F.min("row").alias("row")).select("node", F.col("component").alias("grp"), "row.*", F.lit(0).alias("size")))
    blocks = sets.join(candidates, "node").groupBy(F.col("component").alias("grp")).agg(_blocks(BLOCK_SHINGLES))
    # before the texts are there, which would be moved once more
    chosen = spill(chosen.join(blocks, "grp"), "chosen")
    wanted = with_bits(base.select(*row, "text"), chosen, ["none", "id", "hash"])
    texts = wanted.groupBy("none", "id", "hash").agg(F.first("text").alias("data"))  # rows that repeat are one
    rows = texts.join(chosen, ["none", "id", "hash"]).select("grp", "c", "node", "size", "data")
    links = _cells(rows).mapInArrow(_cell_edges(percent, k), "a long, b long")
    joined = connected_components(links, contract=False)
    # a document is a node too, so that rows that repeat an id hold together
    documents = documents.drop("hash")
    smallest = documents.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = smallest.join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "least")
    component = (named.groupBy("component").agg(F.min("least").alias("root")).join(named.select("node", "component"), "component")
                 .select("node", "root"))
    found = documents.join(component, "node", "left")
    repeated = (found.where("root is not null and doc_id is not null").groupBy("doc_id")
                .agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi"))
    again = spill(connected_components(found.join(repeated.select("doc_id"), "doc_id").select("root", "doc_id"), contract=False), "repeats")
    return (found.join(again.withColumnRenamed("node", "root"), "root", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNull(), F.lit(None).cast("long"))
                    .otherwise(F.coalesce("component", "root", "doc_id")).alias("component_id")))


def op9_ngram_jaccard_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return similar_documents(docs, k=3, percent=90)
