"""WARC archives of individually compressed records with an embedded dictionary.

Payload digests are counted with built-in functions; of records with equal
payloads the smallest identifier is the response and the others revisit it, so
a hot payload is written once. The join with these decisions is the payloads' only
exchange: it deals rows by identifier and digest, and each task streams its rows
into archives: a Zstandard dictionary is built from the first
records (a bounded sample), stored in a leading skippable frame, and every
record becomes a frame of its own that can be read alone.

Archives go to a folder all executors share, through the file systems Arrow
knows (local or mounted folders, HDFS, S3). A task writes under a name of its
attempt and renames when done; rows are sorted, so a repeated task renames the
same bytes over the same name.

Defined results: a null payload is empty; a null url has no target header. Of
rows that repeat the smallest identifier of a payload each is a response. A
null identifier revisits any other; alone it is the response.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accounthealth.llm.frames import new_folder, staged, text_or_empty

LEAST_BYTES = 0  # payloads below are never revisits
SAMPLE_RECORDS, SAMPLE_BYTES = 400, 4 << 20  # records the dictionary is built from
DICTIONARY_BYTES = 32 << 10
ARCHIVE_BYTES = 256 << 20  # raw bytes after which a new archive begins
ROWS_AT_ONCE = 64  # rows of a batch that are Python objects at a time
READ_BYTES = 4 << 20  # raw bytes after which a batch of records read goes back to Spark
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"  # one date for all records, so that reruns agree
# Fixed by the format: the skippable frame that holds a dictionary, and the
# profile of a revisit with an identical payload.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # public name space for URLs


def base32_sha1(text):
    """Bare upper-case base32 SHA-1 of a string column: five hex digits are four
    base32 digits."""
    digest = F.sha1(F.encode(text, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page/{page_id}')}>"


def record(page_id, url, payload: bytes | None, digest: str, size: int, refers_to) -> bytes:
    """One WARC record; ``payload`` None makes a revisit."""
    kind = "revisit" if payload is None else "response"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}",
            f"WARC-Date: {DATE}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if payload is None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_record_id(refers_to)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from records; the records' own bytes where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def archive(records: list[bytes], rest: Iterator[bytes], out) -> tuple[int, int]:
    """Writes one archive to a file object; (records, raw bytes) written.

    ``records`` are the first ones, the dictionary's sample; ``rest`` yields the others.
    """
    words = dictionary([r for r in records])
    out.write(struct.pack("<II", DICTIONARY_FRAME, len(words)) + words)
    packer = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    n = size = 0

    def every():
        yield from records
        yield from rest

    for r in every():
        out.write(packer.compress(r))
        n, size = n + 1, size + len(r)
        if size >= ARCHIVE_BYTES:
            break
    return n, size


def read_archive(source) -> Iterator[bytes]:
    """The records of an archive, decompressed one at a time."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary frame")
    words = source.read(size)
    reader = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    data = source.read(1 << 20)
    while data:
        frame, out = reader.decompressobj(), []
        while not frame.eof:
            if not data:
                raise ValueError("the archive ends inside a record")
            out.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else source.read(1 << 20)
        yield b"".join(out)
        data = data or source.read(1 << 20)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of a record; the payload follows the HTTP header."""
    head, _, block = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def decisions(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``key, own, refers_to`` for the distinct (identifier, payload digest) pairs.

    Only digests that repeat have a head worth joining. The heads are written, so
    that Spark either broadcasts them by their size or splits a hot digest."""
    keys = pages.select("page_id", base32_sha1(text_or_empty("html")).alias("digest"),
                        F.octet_length(text_or_empty("html")).alias("size")).distinct()
    heads = staged(keys.filter(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.min("page_id").alias("head"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("digest", "head"), "heads")
    revisit = ~F.col("page_id").eqNullSafe(F.col("head"))
    return keys.join(heads, "digest", "left").select(
        F.col("page_id").alias("key"), F.col("digest").alias("own"),
        F.when(revisit, F.col("head")).alias("refers_to"))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of Arrow batches; only a few of them are Python objects at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield from batch.slice(k, ROWS_AT_ONCE).to_pylist()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``page_id, url, html`` rows into archives under ``folder``;
    returns ``file, records, bytes`` of those written."""
    base = pages.select("page_id", "url", text_or_empty("html").alias("html"))
    base = base.withColumn("digest", base32_sha1(F.col("html")))
    made = decisions(pages)
    joined = base.join(made, base.page_id.eqNullSafe(made.key) & (base.digest == made.own), "left")
    rows = joined.select(
        "page_id", "url", "digest", "refers_to", F.octet_length("html").alias("size"),
        F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"))

    def write(batches):
        def records():
            for r in rows_of(batches):
                payload = None if r["refers_to"] is not None else (r["html"] or "").encode()
                yield record(r["page_id"], r["url"], payload, r["digest"], r["size"],
                             r["refers_to"])

        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        task, stream, nth = TaskContext.get(), records(), 0
        while True:
            first, size = [], 0
            for r in stream:
                first.append(r)
                size += len(r)
                if len(first) >= SAMPLE_RECORDS or size >= SAMPLE_BYTES:
                    break
            if not first:
                return
            name = f"part-{task.partitionId():05d}-{nth:04d}.warc.zst"
            own = f"{path}/{name}.{task.taskAttemptId()}.tmp"
            with fs.open_output_stream(own, compression=None) as out:
                n, raw = archive(first, stream, out)
            fs.move(own, f"{path}/{name}")
            nth += 1
            yield pa.RecordBatch.from_pylist([{"file": name, "records": n, "bytes": raw}])

    # The join has dealt the rows by identifier and digest, or left them where they were read.
    sorted_rows = rows.sortWithinPartitions("page_id", "digest", "url")
    made = sorted_rows.mapInArrow(write, "file string, records long, bytes long")
    # One row an archive: gathered, so that the tasks that hold payloads need not each store a
    # file for it (Hadoop starts two processes for a local one).
    return made.repartition("file")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to``
    of every record. Digest and length of a response are taken from its payload.
    ``files`` are counted first, so they should be stored."""
    def read(batches):
        fs, path = pafs.FileSystem.from_uri(folder)

        def pack(rows):
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as source:
                    for data in read_archive(source):
                        head, payload = parse(data)
                        new = head["WARC-Type"] == "response"
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        length = int(head["X-Payload-Length"])
                        if new:
                            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            if (found, len(payload)) != (digest, length):
                                raise ValueError(f"{name}: a record differs from its digest")
                        page, head_page = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
                        rows.append({
                            "page_id": page and int(page), "url": head.get("WARC-Target-URI"),
                            "payload": payload if new else None, "payload_bytes": length,
                            "payload_digest": digest, "record_type": head["WARC-Type"],
                            "refers_to": head_page and int(head_page)})
                        size += len(data)
                        if size >= READ_BYTES:
                            yield pack(rows)
                            rows, size = [], 0
                if rows:
                    yield pack(rows)

    # A number of its own: the names are so short that Spark would gather all in one task.
    most = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("file").repartition(max(1, min(most, files.count()))).mapInArrow(
        read, "page_id long, url string, payload binary, payload_bytes long, "
        "payload_digest string, record_type string, refers_to long")


def op4_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = new_folder(spark, "warc")
    files = staged(write_archives(pages, folder), "warc-files")
    return read_archives(files, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

