"""Operator 2: best-fit decreasing packing of token sequences.

Lengths are integers up to the capacity, so best-fit decreasing over *all*
documents depends only on how many pieces there are of each length. The plan is
made from that table (at most ``capacity`` rows, whatever the data): pieces
are placed from the longest on, and a segment tree over the remaining
capacities finds the tightest open sequence in logarithmic time. Pieces of
equal length meet many equally filled sequences; such a run is one step for each piece
that a sequence takes, so the plan is short too. It says for each length which ranks of it go to which
sequences; executors number the pieces of a length and look their places up.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sliceflow.llm.common import crc32_ids, spill, text_slices, worker
from sliceflow.llm.tokenizing import encoder

CAPACITY = 2048


class TightestFit:
    """Segment tree over remaining capacities 0..capacity with a count each."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        i = room + self.leaves
        while i:
            self.tree[i] += n
            i //= 2

    def find(self, need: int) -> int | None:
        """The smallest room of at least ``need`` that an open sequence has."""
        i = need + self.leaves
        if self.tree[i]:
            return need
        while i > 1:  # up to the first subtree on the right that is not empty
            if i % 2 == 0 and self.tree[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.leaves:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        return i - self.leaves


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces of each length. Steps
    (length, rank, n, sequence, offset): the n pieces of that length from that
    rank on go to n consecutive sequences from that one on, at that offset.
    """
    tree, rooms, opened, steps = TightestFit(capacity), {}, 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.find(length)
            if room is None:  # as many new sequences as pieces of this length fill
                n = -(-left // (capacity // length))
                rooms.setdefault(capacity, deque()).append((opened, n))
                tree.add(capacity, n)
                opened += n
                continue
            # once a piece lies in the tightest sequence, that is still the tightest while it has room
            first, n = rooms[room].popleft()
            each = room // length
            k = min(n, left // each)
            if not k:
                k, each = 1, left
            if k < n:
                rooms[room].appendleft((first + k, n - k))
            for j in range(each):
                steps.append((length, rank, k, first, capacity - room + j * length))
                rank += k
            tree.add(room, -k)
            tree.add(room - each * length, k)
            rooms.setdefault(room - each * length, deque()).append((first, k))
            left -= k * each
    return steps


def _pieces(tokenizer: str, end_id: int, capacity: int, with_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())][: len(names)]

    def run(batches):
        code, seen = encoder(tokenizer), np.zeros(capacity + 1, dtype=np.int64)
        part = TaskContext.get().partitionId()
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in text_slices(texts):
                rows = []
                for doc, x in zip(ids[i:j], code.ids([t or "" for t in texts[i:j]])):
                    x = np.append(x, np.uint32(end_id))
                    for k, at in enumerate(range(0, len(x), capacity)):
                        piece = x[at: at + capacity]
                        row = (doc, k, at, len(piece), crc32_ids(piece), part, int(seen[len(piece)]))
                        seen[len(piece)] += 1
                        rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return worker(run)


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text (null: empty), then ``end_id``, cut into pieces of
    at most ``capacity``: (doc_id, piece, start, length, ids_crc32, part, rank
    [, ids]); rank numbers the pieces of a length within a part. A table in
    the shared folder."""
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long" + ", ids array<int>" * with_ids
    return spill(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(_pieces(tokenizer, end_id, capacity, with_ids), kind), "pieces")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds (sequence_id, offset) to pieces that have (length, part, rank),
    rank from 0 without gaps for each part and length. Columns are kept. Only
    the number of pieces of each length, at most ``capacity`` + 1 rows, and
    the plan made from it pass the driver.
    """
    spark = pieces.sparkSession
    each = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = each.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    steps = plan_best_fit(counts, capacity)
    plan: dict[int, list[np.ndarray]] = {}
    for length, rank, _, first, offset in steps:
        plan.setdefault(length, []).append((rank, first, offset))
    plan = {k: np.array(v, dtype=np.int64).T for k, v in plan.items()}
    shared = spark.sparkContext.broadcast(plan)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        n, r = length.to_numpy(), rank.to_numpy()
        for x in np.unique(n):
            at = np.flatnonzero(n == x)
            ranks, first, place = shared.value[int(x)]
            step = np.searchsorted(ranks, r[at], side="right") - 1
            sequence[at], offset[at] = first[step] + r[at] - ranks[step], place[step]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    keep = [c for c in pieces.columns if c not in ("part", "rank")]
    return (pieces.join(base, ["part", "length"]).withColumn("place", place("length", F.col("rank") + F.col("base")))
            .select(*keep, "place.sequence_id", "place.offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, input_ids, lengths) of pieces packed with their ids: at
    most ``capacity`` ids in a group."""
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "length"))).alias("x"))
            .select("sequence_id", F.flatten(F.col("x.ids")).alias("input_ids"), F.col("x.length").alias("lengths")))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents and their places in the sequences. Null texts are
    empty; repeated rows are packed each; an empty table gives no rows."""
    import public_tokenizers

    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 0, capacity, with_ids), capacity)


def op2_best_fit_packing(spark, sf_dir):
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
