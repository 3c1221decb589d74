"""WARC archives with dictionary-compressed records.

Pages with a payload of at least 100 bytes that another page has as well become revisits of the page with
the smallest id. Records are dealt out by page id and each task writes archives: it gathers records of a
bounded total, trains a Zstandard dictionary on them, writes it in a leading skippable frame and then each
record as a frame of its own, so one record can be read with nothing but the dictionary. Archives go to a
folder that all executors share, under names no other attempt uses; the manifest, which Spark commits,
says which of them count.

Defined results: null html is an empty payload, a null url leaves the target header out; rows with equal
payload and the same smallest page_id are all responses, and so are pages whose payload only null ids
have; a null page_id is written and read back as null; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Payloads shorter than this are never revisited.
MIN_BYTES = 100
#: Payload bytes that an archive is made of, about; one record more may follow.
ARCHIVE_BYTES = 24 << 20
DICTIONARY_BYTES = 32 << 10
#: Bytes of an archive's own records, evenly spread over it, that its dictionary is trained on.
SAMPLE_BYTES = 2 << 20
LEVEL = 3
#: The skippable frame that holds a dictionary, and a trained dictionary's own first bytes.
DICTIONARY_FRAME = 0x184D2A5D
_DATE = b"1970-01-01T00:00:00Z"
_REVISIT = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "path string, n_records long, n_bytes long"
_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _urn(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"null" if page_id is None else b"%d" % page_id)


def _page_id(urn: bytes) -> int | None:
    name = urn.rpartition(b":")[2].rstrip(b">")
    return None if name == b"null" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit carries the HTTP head with the payload's length, not the payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + _urn(page_id), b"WARC-Date: " + _DATE]
    if url is not None:
        # Line ends would break the head.
        head.append(b"WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~").encode())
    head.append(b"WARC-Payload-Digest: sha256:" + digest.encode())
    if revisit:
        head += [b"WARC-Profile: " + _REVISIT, b"WARC-Refers-To: " + _urn(refers_to)]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES, sample: int = SAMPLE_BYTES) -> zstandard.ZstdCompressionDict:
    """Trained on records evenly spread over the archive; too few to train on become the dictionary themselves."""
    total = sum(map(len, records))
    step = max(1, -(-total // sample))
    # A long record gives its head only: a dictionary can't hold more.
    samples = [r[:size] for r in records[::step]]
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:size] or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def compress(records: list[bytes], level: int = LEVEL) -> Iterator[bytes]:
    """The frames of an archive."""
    words = dictionary(records)
    raw = words.as_bytes()
    yield struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw
    compressor = zstandard.ZstdCompressor(level=level, dict_data=words, write_checksum=True)
    for r in records:
        yield compressor.compress(r)


def opened(source) -> io.BufferedReader:
    """An archive's records one after another, uncompressed, from its byte stream."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive has no dictionary frame")
    words = zstandard.ZstdCompressionDict(source.read(size))
    return io.BufferedReader(zstandard.ZstdDecompressor(dict_data=words).stream_reader(source, read_across_frames=True), 1 << 18)


def records(stream) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Head fields and block of each record."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("not a WARC record")
        fields = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.partition(b": ")
            fields[name] = value[:-2]
        block = stream.read(int(fields[b"Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield fields, block


def decisions(pages: DataFrame, min_bytes: int = MIN_BYTES, salts: int = 16) -> DataFrame:
    """(page_id, digest, refers_to) of every revisit, from pages with `digest` and `n`.

    A payload that many pages share is one row after the pre-aggregation; joined back, its pages are
    spread over `salts` tasks.
    """
    long = pages.filter(F.col("n") >= min_bytes).select("page_id", "digest")
    firsts = long.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
    firsts = firsts.filter("copies > 1 and refers_to is not null").select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = long.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"))
    found = salted.join(firsts, ["digest", "salt"]).filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return found.select("page_id", "digest", "refers_to").distinct()


def write(pages: DataFrame, out: str, scratch: Scratch, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) to archives below `out`; the committed manifest, a row per archive."""

    def archives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(out)
        store.create_dir(root, recursive=True)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            name, n = f"{root}/{uuid.uuid4().hex}.warc.zst", 0
            with store.open_output_stream(name) as f:
                for frame in compress(held):
                    n += f.write(frame)
            row = {"path": [name], "n_records": [len(held)], "n_bytes": [n]}
            held, size = [], 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(record(*row))
                size += len(row[2])
                if size >= archive_bytes:
                    yield flush()
        if held:
            yield flush()

    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    revisits = decisions(rows.select("page_id", "digest", F.octet_length("payload").alias("n")))
    revisits = revisits.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    ready = rows.join(revisits, same, "left").select("page_id", "url", "payload", "digest", "refers_to")
    return scratch.table("manifest", ready.mapInArrow(archives, _MANIFEST))


def read(manifest: DataFrame, out: str) -> DataFrame:
    """A row per record of the archives that the manifest names, in the form of _RECORDS."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(out)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                found = []
                with store.open_input_stream(name) as f:
                    for fields, block in records(opened(f)):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
                        kind = fields[b"WARC-Type"].decode()
                        n = int(http.rpartition(b"Content-Length: ")[2])
                        if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != n):
                            raise ValueError(f"{name} holds a damaged payload")
                        refers = fields.get(b"WARC-Refers-To")
                        found.append((_page_id(fields[b"WARC-Record-ID"]), n, digest, kind, None if refers is None else _page_id(refers)))
                kinds = ("int64", "int64", "string", "string", "int64")
                names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    paths = manifest.select("path")
    return paths.repartition(max(1, min(paths.count(), 4096)), "path").mapInArrow(rows, _RECORDS)
