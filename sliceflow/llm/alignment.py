"""Operator 12: alignment of the tokens of two tokenizers, and how often ids meet.

Both tokenizers cut the same bytes. Where a token of each ends and the next token of each
begins with a space, the text is cut into windows: the ids of the one and of the other
between two such anchors. Words recur, so windows do: each is aligned once in a block and
kept by its ids. Within a window, ends that both share cut groups, and tokens whose bytes
overlap are linked.

How often a pair of ids is linked is a count over the whole corpus, which no task has
while it aligns. So texts are aligned in blocks; a block writes its windows, each
distinct one once, to a file in the shared folder and hands its pair counts to Spark.
Spark adds them up and sends every block the sums of its own pairs only; the block's
file then gives the sums of each document. Texts are tokenised once, and neither texts nor
links are shuffled.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sliceflow.llm.common import filesystem, only, per_process, shared_folder, spill, text_slices, worker
from sliceflow.llm.tokenizing import encoder, piece_encoder

#: slices of texts in a block, about a million characters each
BLOCK_SLICES = 4
#: words of each tokenizer that a worker keeps; changes speed only
WORDS_KEPT = 400_000

_BLOCK = pa.schema([("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())),
                    ("n_links", pa.list_(pa.int64())), ("groups_sha256", pa.list_(pa.string())), ("groups", pa.list_(pa.large_string())), ("n_windows", pa.list_(pa.int64())),
                    ("windows", pa.list_(pa.int32())), ("links", pa.list_(pa.int32())), ("pair_of", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64()))])


class Aligner:
    """Both tokenizers, and what their ids stand for."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = encoder(a_path, plain=True, keep=WORDS_KEPT), piece_encoder(b_path, WORDS_KEPT)
        with open(a_path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        size = max(self.a.vocabulary, max(vocabulary.values()) + 1)
        self.a_length, self.a_space = np.ones(size, dtype=np.int64), np.zeros(size, dtype=bool)
        for token, i in vocabulary.items():  # byte-level: a sign for each byte
            self.a_length[i], self.a_space[i] = len(token), token[0] == "Ġ"
        self.b_length = np.array([max(1, len(x)) for x in self.b.bytes], dtype=np.int64)
        self.b_space = np.array([x[:1] == b" " for x in self.b.bytes])
        # ids as they are written: of A within a group or last in it, of B within a group, last in it or last in its window
        self.written = [f"{i}{end}" for end, n in ((",", size), ("|", size), (",", len(self.b.bytes)), (";", len(self.b.bytes)), ("", len(self.b.bytes))) for i in range(n)]

    def windows(self, texts: list[str]) -> tuple[list[tuple[bytes, bytes]], np.ndarray, np.ndarray, np.ndarray]:
        """Windows of all texts in order, and how many windows, A and B ids each text has."""
        b = self.b.ids(texts)
        a = self.a.ids([" " + t if t and x is not None else "" for t, x in zip(texts, b)])
        b = [x if t and x is not None else np.empty(0, np.uint32) for t, x in zip(texts, b)]
        n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        a, b = np.concatenate(a).astype("<u4"), np.concatenate(b).astype("<u4")
        if not len(a):
            return [], np.zeros(len(texts), np.int64), n_a, n_b
        end_a, end_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        at = np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)
        i = np.flatnonzero(end_b[at] == end_a)  # shared ends
        j = at[i]
        text_ends = np.cumsum(n_a)[n_a > 0] - 1
        last = np.isin(i, text_ends)
        if last.sum() != len(text_ends):
            raise ValueError("the tokenizers do not cut the same bytes")
        anchor = last.copy()
        anchor[:-1] |= self.a_space[a[i[:-1] + 1]] & self.b_space[b[j[:-1] + 1]]
        to_a, to_b = (i[anchor] + 1) * 4, (j[anchor] + 1) * 4
        raw_a, raw_b = a.tobytes(), b.tobytes()
        keys = [(raw_a[s:e], raw_b[t:f]) for s, e, t, f in zip([0, *to_a[:-1].tolist()], to_a.tolist(), [0, *to_b[:-1].tolist()], to_b.tolist())]
        ends = np.searchsorted(i[anchor], np.cumsum(n_a) - 1, side="right")
        return keys, np.diff(ends, prepend=0), n_a, n_b

    def align(self, windows: list[tuple[bytes, bytes]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Groups of each window as ``a1,a2|b1;a3|b2``, how many groups and how many links
        each has, and the linked pairs ``a << 32 | b``, one for each pair of tokens whose bytes
        overlap: where the ends of both sides cut the bytes, each part lies in one token of each."""
        (a, n_a), (b, n_b) = ((np.frombuffer(b"".join([w[k] for w in windows]), dtype="<u4").astype(np.int64), np.array([len(w[k]) // 4 for w in windows])) for k in (0, 1))
        end_a, end_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        ends = np.union1d(end_a, end_b)
        i, j = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        of = np.searchsorted(np.cumsum(n_a) - 1, i)
        shared = (end_a[i] == ends) & (end_b[j] == ends)
        last_a, last_b = i[shared], j[shared]  # of each group
        in_a, in_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        place_a = np.arange(len(a)) + np.repeat(np.cumsum(in_b) - in_b, in_a)
        place_b = np.arange(len(b)) + np.repeat(np.cumsum(in_a), in_b)
        size_a, size_b = len(self.a_length), len(self.b_length)
        code = np.empty(len(a) + len(b), dtype=np.int64)
        code[place_a], code[place_b] = a, 2 * size_a + b
        code[place_a[last_a]] += size_a
        code[place_b[last_b]] += size_b
        stop = place_b[np.cumsum(n_b) - 1]
        code[stop] += size_b
        written = list(map(self.written.__getitem__, code.tolist()))
        stop = (stop + 1).tolist()
        texts = ["".join(written[s:e]) for s, e in zip([0, *stop], stop)]
        return texts, np.bincount(of[shared], minlength=len(windows)), np.bincount(of, minlength=len(windows)), a[i] << 32 | b[j]


class _Block:
    """Documents of a block and its distinct windows."""

    def __init__(self, aligner: Aligner, with_groups: bool):
        self.aligner, self.with_groups = aligner, with_groups
        self.number = defaultdict(count().__next__)  # of each window, by its ids
        self.text: list[str] = []
        self.n_groups = self.n_links = self.links = np.empty(0, np.int64)
        self.docs = defaultdict(list)
        self.windows: list[np.ndarray] = []

    def add(self, ids: list, texts: list[str | None]) -> None:
        keys, each, n_a, n_b = self.aligner.windows([t or "" for t in texts])
        at = np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))
        if len(self.number) > len(self.text):
            text, n_groups, n_links, links = self.aligner.align(list(islice(self.number, len(self.text), None)))
            self.text += text
            self.n_groups, self.n_links = np.concatenate([self.n_groups, n_groups]), np.concatenate([self.n_links, n_links])
            self.links = np.concatenate([self.links, links])
        ends = np.cumsum(each)
        for name, per in (("n_groups", self.n_groups), ("n_links", self.n_links)):
            total = np.concatenate([[0], np.cumsum(per[at])])
            self.docs[name] += (total[ends] - total[ends - each]).tolist()
        text, at_list = self.text, at.tolist()
        for e, n in zip(ends.tolist(), each.tolist()):
            joined = ";".join([text[k] for k in at_list[e - n: e]])
            self.docs["groups_sha256"].append(hashlib.sha256(joined.encode()).hexdigest() if n else "")
            if self.with_groups:
                self.docs["groups"].append(joined)
        self.docs["doc_id"] += ids
        self.docs["n_a"] += n_a.tolist()
        self.docs["n_b"] += n_b.tolist()
        self.docs["n_windows"] += each.tolist()
        self.windows.append(at.astype(np.int32))

    def batch(self) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
        """The block as a row, its pairs, and how often each is linked in it."""
        windows = np.concatenate(self.windows)
        pairs, of = np.unique(self.links, return_inverse=True)
        times = np.bincount(windows, minlength=len(self.text))
        n = np.bincount(of, weights=np.repeat(times, self.n_links), minlength=len(pairs)).astype(np.int64)
        values = {**self.docs, "windows": windows, "links": self.n_links.astype(np.int32), "pair_of": of.astype(np.int32), "pairs": pairs}
        row = [pa.array([values.get(f.name, [])], f.type) for f in _BLOCK]
        return pa.RecordBatch.from_arrays(row, schema=_BLOCK), pairs, n


def _write(folder: str, a_path: str, b_path: str, with_groups: bool):
    def run(batches):
        fs, root = filesystem(folder)
        aligner, part = per_process(("aligner", a_path, b_path), lambda: Aligner(a_path, b_path)), TaskContext.get().partitionId()
        uri, out, block, slices, n = f"{folder}/blocks-{part:06d}-{uuid.uuid4().hex}.arrow", None, None, 0, 0

        def done():
            nonlocal out, file
            if out is None:
                fs.create_dir(root, recursive=True)
                file = fs.open_output_stream(f"{root}/{uri.rsplit('/', 1)[1]}")
                out = pa.ipc.new_file(file, _BLOCK, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            batch, pairs, times = block.batch()
            out.write_batch(batch)
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | n], pa.int64()), pa.array([uri]), pa.array([n], pa.int32()),
                                               pa.array([pairs], pa.list_(pa.int64())), pa.array([times], pa.list_(pa.int64()))], names=["block", "uri", "at", "pairs", "times"])

        file = None
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in text_slices(texts):
                block = block or _Block(aligner, with_groups)
                block.add(ids[i:j], texts[i:j])
                slices += 1
                if slices == BLOCK_SLICES:
                    yield done()
                    block, slices, n = None, 0, n + 1
        if block:
            yield done()
        if out is not None:
            out.close()
            file.close()
    return worker(run)


def write_alignments(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Align every whole text. Returns the blocks (block, uri, at: place in the file, pairs,
    times), a table in the shared folder; files of a repeated task are read by nobody."""
    folder = shared_folder(docs.sparkSession, "alignments")
    rows = only(docs, id=id_col, text=text_col).select(F.col("id").cast("long"), F.col("text").cast("string"))
    return spill(rows.mapInArrow(_write(folder, a_path, b_path, with_groups), "block long, uri string, at int, pairs array<long>, times array<long>"), "blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, n, best) of all linked pairs of ids: how many links hold the pair in the
    corpus, and whether no pair of this ``b`` has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    n = spill(each.groupBy("pairs").agg(F.sum("times").alias("n")).select(F.shiftright("pairs", 32).alias("a"), F.col("pairs").bitwiseAND(0xFFFFFFFF).alias("b"), "n"), "pairs")
    return n.join(n.groupBy("b").agg(F.max("n").alias("most")), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(table: pa.Table) -> pa.Table:
    """Rows of a block's documents, from its file and the counts of its pairs."""
    place = table.filter(pc.is_valid(table["uri"])).slice(0, 1).to_pylist()[0]
    counted = table.filter(pc.is_null(table["uri"]))
    fs, path = filesystem(place["uri"])
    with fs.open_input_file(path) as f:
        row = pa.ipc.open_file(f).get_batch(place["at"])
    value = {c: row.column(c).flatten() for c in row.schema.names}
    pairs, of, links = (value[c].to_numpy() for c in ("pairs", "pair_of", "links"))
    at = np.searchsorted(pairs, counted["pair"].to_numpy())
    out = {}
    windows, ends = value["windows"].to_numpy(), np.cumsum(value["n_windows"].to_numpy())
    for name, column in (("n_best", counted["best"].cast(pa.int64())), ("count_sum", counted["n"])):
        of_pair = np.zeros(len(pairs), dtype=np.int64)
        of_pair[at] = column.to_numpy()
        total = np.concatenate([[0], np.cumsum(of_pair[of])])
        stop = np.cumsum(links, dtype=np.int64)
        of_window = total[stop] - total[stop - links]
        total = np.concatenate([[0], np.cumsum(of_window[windows])])
        out[name] = pa.array(total[ends] - total[ends - value["n_windows"].to_numpy()])
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    groups = value["groups"] if len(value["groups"]) else pa.nulls(len(value["doc_id"]), pa.large_string())
    return pa.table({**{c: value[c] for c in names}, **out, "groups_sha256": value["groups_sha256"], "groups": groups.cast(pa.string())})


def document_alignments(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document of ``blocks``: (doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256, groups: their text if it was asked for)."""
    pair = F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("pair")
    each = blocks.select("block", F.explode("pairs").alias("pair")).join(counts.select(pair, "n", "best"), "pair")
    place = blocks.select("block", "uri", "at")
    none = lambda kind: F.lit(None).cast(kind)
    rows = (each.select("block", "pair", "n", "best", none("string").alias("uri"), none("int").alias("at"))
            .unionByName(place.select("block", none("long").alias("pair"), none("long").alias("n"), none("boolean").alias("best"), "uri", "at")))
    return rows.groupBy("block").applyInArrow(_sums, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string")


def align_documents(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """Alignments of all documents with counts over all of them. Null and empty texts,
    and texts whose bytes a tokenizer changes, have no tokens: zeros and ''. Repeated rows
    and ids count each, an empty table gives no rows, other columns are ignored."""
    blocks = write_alignments(docs, a_path, b_path, with_groups)
    found = document_alignments(blocks, pair_counts(blocks))
    return found if with_groups else found.drop("groups")


def op12_tokenizer_alignment(spark, sf_dir):
    import public_tokenizers as P

    return align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
