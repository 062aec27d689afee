"""Operator 10: WARC archives of Zstandard frames with a shared dictionary.

An archive (``*.warc.zst``) starts with a skippable frame that holds the
dictionary; every record after it is one frame made with that dictionary, so a
record can be read alone. ``read_archives`` loads the dictionary from the
leading frame, decodes frame by frame and checks the header block, the
lengths and the digests. Of records with equal payloads one is the response;
the others revisit it and hold no payload.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sliceflow.llm.common import filesystem, hash_sample, shared_folder, spill, worker

#: skippable frame that carries a dictionary
DICTIONARY_FRAME = 0x184D2A5D
#: payloads below this size are never revisits
LEAST_BYTES = 100
#: the dictionary is trained on at most so many pages, of at most so many bytes each
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16_384, 65_536
DATE = "2024-01-01T00:00:00Z"


def train_dictionary(pages: DataFrame, body: str = "html") -> bytes:
    """A dictionary from a bounded sample of pages (those with the smallest hash
    of their page_id); empty when there is too little to learn from."""
    rows = hash_sample(pages.where(F.length(body) > 0).select("page_id", F.substring(body, 1, SAMPLE_BYTES).alias("x")), F.xxhash64("page_id"), SAMPLE_PAGES).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r["x"].encode("utf-8", "surrogatepass")[:SAMPLE_BYTES] for r in rows], level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record(page_id, url, kind, digest, size, refers_to, payload: bytes) -> bytes:
    """The bytes of a record."""
    if kind == "response":
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size) + payload
        content = "application/http; msgtype=response"
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        content = "application/http; msgtype=response"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}", f"Content-Type: {content}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(folder: str, dictionary: bytes):
    def run(batches):
        fs, root = filesystem(folder)
        name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        out, n = None, 0
        zdict = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=3, dict_data=zdict, write_checksum=True, write_content_size=True)
        for b in batches:
            for r in chain.from_iterable(b.slice(i, 256).to_pylist() for i in range(0, b.num_rows, 256)):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}")
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                payload = (r["html"] or "").encode("utf-8", "surrogatepass")
                out.write(press.compress(record(r["page_id"], r["url"], r["kind"], r["digest"], r["size"], r["refers_to"], payload)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64())], names=["uri", "n_records"])
    return worker(run)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Write one record per row; returns (uri, n_records) of the archives.

    The payload is the body in UTF-8 (null: empty). Of rows with equal payloads
    of at least ``LEAST_BYTES`` those with the smallest id are responses, the
    others revisit it. A null id is never the smallest; when a payload has null
    ids only, its rows are responses. Other columns are ignored; an empty table
    writes no archive. Payloads are compared by SHA-256; a hot payload is
    reduced by partial aggregates before the join. Archives of repeated tasks
    have names of their own and stay unread.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(body_col).cast("string").alias("html"))
    dictionary = train_dictionary(base)
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    base = base.withColumn("size", F.octet_length(body).cast("long")).withColumn("digest", F.sha2(body, 256))
    least = (base.where(F.col("size") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("digest", "first"))
    rows = base.join(least, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", F.when(~again, F.col("html")).alias("html"), F.when(again, "revisit").otherwise("response").alias("kind"), "digest", "size",
                       F.when(again, F.col("first")).alias("refers_to"))
    return spill(rows.mapInArrow(_write(folder, dictionary), "uri string, n_records long"), "archives")


class WarcError(ValueError):
    """A record or frame that is not as it says."""


def read_records(stream):
    """(headers, block) of each record of an archive, one frame at a time."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_FRAME:
        raise WarcError("the archive does not start with a dictionary frame")
    size = struct.unpack("<I", head[4:])[0]
    raw = stream.read(size)
    if len(raw) != size:
        raise WarcError("the dictionary is cut off")
    if raw[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may itself be compressed
        raw = zstandard.ZstdDecompressor().decompress(raw)
    zdict = zstandard.ZstdCompressionDict(raw) if raw else None
    unpack, left = zstandard.ZstdDecompressor(dict_data=zdict), b""
    while True:
        left = left or stream.read(1 << 18)
        if not left:
            return
        frame, parts = unpack.decompressobj(), []
        while not frame.eof:
            if not left:
                left = stream.read(1 << 18)
                if not left:
                    raise WarcError("the last frame is cut off")
            parts.append(frame.decompress(left))
            left = frame.unused_data
        yield parse_record(b"".join(parts))


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record, validated."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise WarcError("no WARC header block")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in headers:
            raise WarcError(f"bad header line: {line[:80]}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no {name}")
    if not headers["content-length"].isascii() or not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError("the block is not as long as Content-Length says")
    return headers, rest[:-4]


def _page(value: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d*)>", value)
    if not m:
        raise WarcError(f"bad record id: {value[:80]}")
    return int(m[1]) if m[1] else None


def page_row(headers: dict[str, str], block: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload)."""
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
    size, page = int(headers["warc-payload-length"]), _page(headers["warc-record-id"])
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not http.startswith(b"HTTP/1."):
        raise WarcError("no HTTP header block")
    if kind == "revisit":
        if payload:
            raise WarcError("a revisit record with a payload")
        return page, size, digest, kind, _page(headers["warc-refers-to"]), None
    m = re.search(rb"\r\nContent-Length: (\d+)", http)
    if kind != "response" or not m or int(m[1]) != len(payload) or size != len(payload):
        raise WarcError("the payload is not as long as its headers say")
    if hashlib.sha256(payload).hexdigest() != digest:
        raise WarcError("the payload does not have its digest")
    return page, size, digest, kind, None, payload


_ROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                  ("url", pa.string()), ("payload", pa.binary())])


def _read(payloads: bool):
    schema = _ROW if payloads else _ROW.remove(6)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, path = filesystem(r["uri"])
                rows, held, n = [], 0, 0
                with fs.open_input_stream(path) as f:
                    for headers, block in read_records(f):
                        *row, payload = page_row(headers, block)
                        url = headers.get("warc-target-uri")
                        url = None if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url)
                        rows.append((*row, url, payload) if payloads else (*row, url))
                        held, n = held + len(block) * payloads + 200, n + 1
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, held = [], 0
                if n != r["n_records"]:
                    raise WarcError(f"{r['uri']} has {n} records, not {r['n_records']}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return worker(run)


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record: (page_id, payload_bytes, payload_digest, record_type,
    refers_to, url[, payload]). Size and digest are those of the full
    payload; a revisit has them from its header, a response is checked."""
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * payloads
    return archives.repartition(n, "uri").mapInArrow(_read(payloads), kind)


def op10_warc_zstd(spark, sf_dir):
    archives = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), shared_folder(spark, "warc"))
    return read_archives(archives).drop("url")
