"""Operator 1: token ids in Arrow stream files of fixed-size-list batches.

Every range of documents (in order of doc_id) is one shard with two files:

* ``tokens-*.arrow``: record batches of ``input_ids: fixed_size_list<uintN>[L]``
  and ``mask: fixed_size_list<uint8>[L / 8]``, a bit for each place. All sequences have ``L`` places; the
  documents of the shard lie in them end to end, and only the last sequence of
  a shard is padded (mask 0). Ids are uint16 when the vocabulary fits.
* ``index-*.arrow``: (doc_id, start in the shard, n_tokens) in the same order.

Batches are not compressed, so ``TokenFile`` maps a file and gives any sequence
as a view of the mapped bytes. A shard is written by one task under a name of
its own attempt; only files listed in the manifest, which Spark commits, are
ever read. A task that is repeated after a lost executor therefore leaves a
file that nobody reads, and never a wrong one.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sliceflow.llm.common import filesystem, shared_folder, spill, text_slices, worker
from sliceflow.llm.tokenizing import encoder

#: places of a sequence
SEQUENCE = 2048
#: sequences in a record batch
BATCH = 128


class TokenFile:
    """Random access to the sequences of a tokens file."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self.source = pa.memory_map(path) if fs.type_name == "local" else pa.BufferReader(fs.open_input_file(path).read_buffer())
        self.batches = list(pa.ipc.open_stream(self.source))

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def _row(self, i: int, column: int) -> np.ndarray:
        for b in self.batches[i // BATCH:]:  # every batch but the last is full
            lists = b.column(column)
            n, at = lists.type.list_size, i % BATCH
            return lists.values.to_numpy(zero_copy_only=True)[(lists.offset + at) * n: (lists.offset + at + 1) * n]
        raise IndexError(i)

    def ids(self, i: int) -> np.ndarray:
        """Ids of sequence ``i``: a view of the file's bytes."""
        return self._row(i, 0)

    def mask_bits(self, i: int) -> np.ndarray:
        """Packed mask of sequence ``i``, lowest bit first: a view of the file's bytes."""
        return self._row(i, 1)

    def mask(self, i: int) -> np.ndarray:
        """1 for the places of sequence ``i`` that hold a token."""
        return np.unpackbits(self.mask_bits(i), bitorder="little")


def _write(folder: str, tokenizer: str, end_id: int, length: int):
    def run(batches):
        fs, root = filesystem(folder)
        code = encoder(tokenizer)
        kind = np.uint16 if max(code.vocabulary, end_id) < 1 << 16 else np.uint32
        arrow = pa.from_numpy_dtype(kind)
        tokens = pa.schema([("input_ids", pa.list_(arrow, length)), ("mask", pa.list_(pa.uint8(), length // 8))])
        index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}.arrow"
        out = docs = None
        held, n_held, total, n_docs = [], 0, 0, 0
        step = BATCH * length

        def put(flat: np.ndarray, real: int):
            mask = np.zeros(len(flat), dtype=np.uint8)
            mask[:real] = 1
            out.write_batch(pa.RecordBatch.from_arrays([
                pa.FixedSizeListArray.from_arrays(pa.array(flat), length), pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(mask, bitorder="little")), length // 8)], schema=tokens))

        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for i, j in text_slices(texts):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    files = [fs.open_output_stream(f"{root}/{k}-{name}") for k in ("tokens", "index")]
                    out, docs = pa.ipc.new_stream(files[0], tokens), pa.ipc.new_stream(files[1], index)
                code_ids = code.ids([t or "" for t in texts[i:j]])
                n = np.array([len(x) + 1 for x in code_ids], dtype=np.int64)
                start = total + np.cumsum(n) - n
                docs.write_batch(pa.RecordBatch.from_arrays([ids.slice(i, j - i).cast(pa.int64()), pa.array(start), pa.array(n)], schema=index))
                end = np.array([end_id], dtype=kind)
                for x in code_ids:
                    held += [x.astype(kind), end]
                n_held += int(n.sum())
                total += int(n.sum())
                n_docs += j - i
                if n_held >= step:
                    flat = np.concatenate(held)
                    full = n_held // step * step
                    for k in range(0, full, step):
                        put(flat[k: k + step], step)
                    held, n_held = [flat[full:].copy()], n_held - full
        if out is not None:
            if n_held:
                flat = np.concatenate(held)
                put(np.concatenate([flat, np.zeros(-len(flat) % length, dtype=kind)]), len(flat))
            for x in (out, docs, *files):
                x.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{folder}/tokens-{name}"]), pa.array([f"{folder}/index-{name}"]),
                                              pa.array([n_docs], pa.int64()), pa.array([total], pa.int64()), pa.array([-(-total // length)], pa.int64())],
                                             names=["shard", "tokens_uri", "index_uri", "n_docs", "n_tokens", "n_sequences"])
    return worker(run)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = SEQUENCE, shards: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of every whole text, each followed by ``end_id``, in
    ascending order of id; returns the manifest: (shard, tokens_uri,
    index_uri, n_docs, n_tokens, n_sequences, start: tokens before the shard).

    Null texts count as empty. Null ids come first. Rows that repeat an id
    are all written, in order of text. Other columns are ignored, an empty
    table has an empty manifest. Memory is bounded by a slice of texts and a
    record batch; a shard is sorted by Spark, which spills.
    """
    if length % 8:
        raise ValueError("length must be a multiple of 8")
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .repartitionByRange(n, "id").sortWithinPartitions("id", "text"))
    manifest = spill(rows.mapInArrow(_write(folder, tokenizer, end_id, length),
                                     "shard int, tokens_uri string, index_uri string, n_docs long, n_tokens long, n_sequences long"), "manifest")
    # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


@worker
def _read(batches):
    for b in batches:
        for r in b.to_pylist():
            file, at, buffer = TokenFile(r["tokens_uri"]), 0, np.empty(0, np.uint32)
            fs, path = filesystem(r["index_uri"])
            with fs.open_input_stream(path) as f:
                for x in pa.ipc.open_stream(f):
                    crc = []
                    for n in x.column(2).to_pylist():
                        c = 0
                        while n:  # a document goes through many batches if it is long
                            if not len(buffer):
                                part = file.batches[at]
                                buffer = part.column(0).flatten().to_numpy(zero_copy_only=True)[np.unpackbits(part.column(1).flatten().to_numpy(zero_copy_only=True), bitorder="little") == 1]
                                at += 1
                            take = min(n, len(buffer))
                            c = zlib.crc32(buffer[:take].astype("<u4").tobytes(), c)
                            buffer, n = buffer[take:], n - take
                        crc.append(c)
                    start = pa.array(x.column(1).to_numpy() + r["start"])
                    yield pa.RecordBatch.from_arrays([x.column(0), start, x.column(2), pa.array(crc, pa.int64()), pa.array([r["shard"]] * len(crc), pa.int32())],
                                                     names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document read back from the files of ``manifest``:
    (doc_id, start, n_tokens, ids_crc32, shard)."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (manifest.select("shard", "tokens_uri", "index_uri", "start").repartition(n, "shard")
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"))


def op1_token_files(spark, sf_dir):
    import public_tokenizers

    folder = shared_folder(spark, "tokens")
    manifest = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(manifest)
