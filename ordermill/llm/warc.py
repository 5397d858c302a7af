"""WARC archives with a Zstandard dictionary in front and every record compressed by itself.

An archive file is one leading skippable frame (magic 0x184D2A5D, length, dictionary) and then one
Zstandard frame per record. The dictionary is built from records of the file itself: the first
ones up to ``SAMPLE_BYTES``, which are spread over the pages by hash. Where they are too few to
train on, their bytes are the dictionary as they are. A reader needs nothing but the file.

Of records with equal payloads of at least ``LEAST_BYTES``, that with the smallest id is written as
a response and the others as revisits of it, which hold no payload.

Files go to the folder all executors share. A task writes under a name of its own and reports it when
done; the list of reported files is a written table, so files of lost or repeated tasks are
never read. Reading streams one frame at a time.

Defined results: a NULL payload is empty. Of several rows that share the smallest id and the payload,
each is a response. A NULL id sorts after all others; if there is no other, all are responses. A
NULL url is an empty target. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import sys
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = 0x184D2A5D               # of the skippable frame that holds a dictionary
DICTIONARY_BYTES = 64 * 1024
SAMPLE_BYTES = 4 * 1024 * 1024   # records of a file that its dictionary is built from
LEAST_SAMPLES = 16               # fewer records are not trained on
FILE_BYTES = 256 * 1024 * 1024   # compressed size from which on a task starts another file
LEAST_BYTES = 100                # payloads below this are never revisits
LEVEL = 3
BATCH_BYTES = 8 * 1024 * 1024

RECORDS = ("record_id string, record_type string, target string, page_id long, refers_to long, "
           "payload binary, payload_bytes long, payload_digest string")


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the path in it."""
    scheme, colon, path = folder.partition(":")
    if not colon:
        return fs.LocalFileSystem(), folder
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


# --- one record ------------------------------------------------------------------------

def record_name(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None) -> bytes:
    """A response, or a revisit of the page ``refers_to`` with the response's HTTP header only."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n")
    revisit = refers_to is not None
    block = http.encode() + (b"" if revisit else payload)
    target = " ".join((url or "").split())
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{record_name(page_id, digest)}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{record_name(refers_to, digest)}>",
                  f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _header(text: bytes) -> dict[str, str]:
    pairs = (line.partition(": ") for line in text.decode().split("\r\n")[1:])
    return {name.lower(): value for name, _, value in pairs}


def parse_record(data: bytes) -> dict:
    """The fields of a record; a response whose payload does not match its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _header(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    length = int(_header(http)["content-length"])
    response = fields["warc-type"] == "response"
    if response and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    number = {name: int(fields[name]) if name in fields else None
              for name in ("page-id", "refers-to-page-id")}
    return {"record_id": fields["warc-record-id"].strip("<>"), "record_type": fields["warc-type"],
            "target": fields["warc-target-uri"], "page_id": number["page-id"],
            "refers_to": number["refers-to-page-id"], "payload": payload if response else None,
            "payload_bytes": length, "payload_digest": digest}


# --- one file --------------------------------------------------------------------------

def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on records, or made of their bytes if there are too few."""
    if len(records) >= LEAST_SAMPLES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, records)
        except zstandard.ZstdError:  # for instance, all records are tiny or equal
            pass
    return zstandard.ZstdCompressionDict(b"".join(records)[-DICTIONARY_BYTES:],
                                         dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes records to ``stream``; the first ones are held back to build the dictionary."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.size = stream, 0
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0
        self.compressor: zstandard.ZstdCompressor | None = None

    def add(self, record: bytes) -> None:
        if self.compressor:
            self._write(self.compressor.compress(record))
            return
        self.waiting.append(record)
        self.waiting_bytes += len(record)
        if self.waiting_bytes >= SAMPLE_BYTES:
            self._start()

    def close(self) -> None:
        if self.waiting:
            self._start()

    def _start(self) -> None:
        dictionary = build_dictionary(self.waiting)
        content = dictionary.as_bytes()
        self._write(struct.pack("<II", MAGIC, len(content)) + content)
        dictionary.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        for record in self.waiting:
            self._write(self.compressor.compress(record))
        self.waiting = []

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)


def read_archive(stream: BinaryIO, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    start = stream.read(8)
    if not start:
        return
    magic, length = struct.unpack("<II", start)
    if magic != MAGIC:
        raise ValueError("no dictionary in front")
    content = stream.read(length)
    kind = (zstandard.DICT_TYPE_FULLDICT if content[:4] == b"\x37\xa4\x30\xec"
            else zstandard.DICT_TYPE_RAWCONTENT)
    decompressor = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind))
    frame, parts = decompressor.decompressobj(), []
    data = stream.read(chunk)
    while data:
        parts.append(frame.decompress(data))
        data = b""
        if frame.eof:
            yield b"".join(parts)
            data = frame.unused_data
            frame, parts = decompressor.decompressobj(), []
        data = data or stream.read(chunk)
    if parts:  # bytes of a frame that did not end
        raise ValueError("the last record is cut off")


# --- tables ----------------------------------------------------------------------------

def _write_files(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        writer, names, stream = None, [], None
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in columns)):
                if writer is None:
                    names.append(f"{uuid.uuid4().hex}.warc.zst")
                    stream = files.open_output_stream(f"{root}/{names[-1]}")
                    writer = ArchiveWriter(stream)
                writer.add(record_bytes(page_id, url, (html or "").encode(), digest, refers_to))
                if writer.size >= FILE_BYTES:
                    writer.close()
                    stream.close()
                    writer = None
        if writer is not None:
            writer.close()
            stream.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])
    return write


def _read_files(folder: str):
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()),
                        ("target", pa.string()), ("page_id", pa.int64()),
                        ("refers_to", pa.int64()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{root}/{name}") as stream:
                    for record in read_archive(stream):
                        rows.append(parse_record(record))
                        size += len(record) + 200
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
    return read


def with_revisits(pages: DataFrame, scratch: Scratch, page_id: str = "page_id",
                  url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, html, digest, refers_to): which page's payload a page repeats."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.col(html).alias("html"), F.sha2(payload, 256).alias("digest"),
                        (F.octet_length(payload) >= LEAST_BYTES).alias("long_enough"))
    # Only digests that occur more than once; combined before the shuffle, so no digest is hot.
    firsts = (rows.where("long_enough").groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 and first is not null").select("digest", "first"))
    firsts = scratch.table(firsts, "firsts")
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")),
                       F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write the pages as archives; returns the table of file names, and their folder."""
    scratch = Scratch(pages.sparkSession, "warc")
    folder = folder or scratch.path("archives")
    store(folder)[0].create_dir(store(folder)[1], recursive=True)
    rows = with_revisits(pages, scratch)
    names = scratch.table(rows.mapInArrow(_write_files(folder), "file string"), "files")
    return names, folder


def read_archives(names: DataFrame, folder: str) -> DataFrame:
    """All records of the named files, with columns RECORDS."""
    spark = names.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    return names.repartition(tasks, "file").mapInArrow(_read_files(folder), RECORDS)
