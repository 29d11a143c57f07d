"""WARC archives compressed with a Zstandard dictionary.

A dictionary is trained on a bounded sample of the records, stored in a skippable frame at the head of every archive,
and each record is a frame of its own that uses it, so records can be read one by one. Records with equal payloads of
at least ``least`` bytes are stored once: that of the largest id is a response, the others are revisits of it.

Every partition writes archives of its own into the shared folder, named by task attempt; only those listed in the
manifest, which is a table written by successful attempts, are ever read.

NULL payloads count as empty. Rows with a NULL id are never referred to unless all rows of that payload have none; rows
that repeat an id and its payload are all responses. NULL addresses become ``urn:page:<id>``. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import attach, hot_of
from .common import shared_folder, stage

# Fixed values of the format.
SKIPPABLE = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: Characters of a page that its sample record gives at most.
SAMPLE_TEXT = 1 << 16
#: Pages of one payload that a task takes at most.
HOT_PAGES = 50_000
MANIFEST = "path string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def of_urn(text: str | None):
    value = text.strip("<>").rpartition(":")[2] if text else "none"
    return None if value == "none" else int(value)


def record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One record; a revisit keeps the response's header lines but not its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{urn(page_id)}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url, safe='!#$%&()*+,/:;=?@[]~' + chr(39)) if url else urn(page_id)}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{urn(refers_to)}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(pages: DataFrame, id: str, url: str, payload: str, sample: int, size: int) -> bytes:
    """A dictionary from the ``sample`` records that come first by hash; trained in one task, ``size`` bytes at most.

    A bound on the hash leaves about four times that many records to choose from, however many partitions there are, and
    a record gives its first ``SAMPLE_TEXT`` characters, so what reaches the task does not grow with the table. Too few
    or too uniform records give no dictionary; the frame is then empty.
    """

    def run(batches):
        import zstandard

        records = [
            record(i, u, (p or "").encode(), None, False)
            for b in batches for i, u, p in zip(*(c.to_pylist() for c in b.columns), strict=True)
        ]
        try:
            made = zstandard.train_dictionary(size, records).as_bytes() if len(records) >= 8 else b""
        except zstandard.ZstdError:
            made = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([made], pa.binary())})

    name = F.xxhash64(id, payload)
    rows, most = max(1, pages.count()), (1 << 63) - 1
    few = pages.filter(F.shiftrightunsigned(name, 1) <= F.lit(most * min(rows, 4 * sample) // rows))
    first = few.select(id, url, F.substring(payload, 1, SAMPLE_TEXT).alias(payload)).orderBy(F.xxhash64(id, payload)).limit(sample)
    made = first.coalesce(1).mapInArrow(run, "dictionary binary").first()
    return bytes(made[0]) if made else b""


def keepers(pages: DataFrame, id: str, payload: str, least: int) -> DataFrame:
    """Pages with the digest of their payload and, where several share it, the id that keeps it."""
    body = F.coalesce(payload, F.lit(""))
    rows = pages.select(
        F.col(id).cast("long").alias("page_id"), F.col("url"), body.alias("payload"),
        F.when(F.octet_length(body) >= least, F.sha1(body)).alias("sha1"))
    shared = rows.filter("sha1 IS NOT NULL").groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    shared = stage(shared.filter("n > 1").withColumn("shared", F.lit(True)), "warc-shared")
    # payloads that many pages share are dealt over as many tasks as their rows need, and short ones by themselves
    hot = hot_of(shared, "sha1", "n", HOT_PAGES)
    rows = rows.withColumn("sha1", F.coalesce("sha1", F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))))
    rows = attach(rows, shared.drop("n"), "sha1", hot)
    revisit = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.select("page_id", "url", "payload", "keeper", revisit.alias("revisit"))


def write(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", *, folder: str | None = None,
          least: int = 0, sample: int = 512, dictionary_bytes: int = 65536, archive_bytes: int = 1 << 28) -> DataFrame:
    """Write a record per row; returns the manifest (path, records, bytes) of the archives.

    ``sample`` bounds the records that the dictionary is built from; an archive is closed at ``archive_bytes``.
    """
    pages = pages.select(F.col(id), F.col(url).alias("url"), F.col(payload).alias("payload"))
    folder = folder or shared_folder(pages.sparkSession, "warc")
    dictionary = train(pages, id, "url", "payload", sample, dictionary_bytes)

    def run(batches):
        import zstandard

        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=known)
        plain = zstandard.ZstdCompressor(level=3).compress(dictionary)
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        task, out, done = TaskContext.get(), None, []
        for b in batches:
            for page_id, url, payload, keeper, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.zst"
                    out, n = fs.open_output_stream(f"{root}/{name}"), 0
                    out.write(struct.pack("<II", SKIPPABLE, len(plain)) + plain)
                out.write(packer.compress(record(page_id, url, payload.encode(), keeper, revisit)))
                n += 1
                if out.tell() >= archive_bytes:
                    done.append((f"{folder}/{name}", n, out.tell()))
                    out.close()
                    out = None
        if out is not None:
            done.append((f"{folder}/{name}", n, out.tell()))
            out.close()
        columns = list(zip(*done, strict=True)) or [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "records", "bytes"])

    return stage(keepers(pages, id, "payload", least).mapInArrow(run, MANIFEST), "warc-manifest")


def records_of(source):
    """Header lines and block of every record of an open archive, one at a time."""
    import zstandard

    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive does not begin with a dictionary frame")
    dictionary = zstandard.ZstdDecompressor().decompress(source.read(size))
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    frames = zstandard.ZstdDecompressor(dict_data=known).stream_reader(source, read_across_frames=True)
    lines = io.BufferedReader(frames, 1 << 16)
    while first := lines.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError("a record does not begin with its version")
        header = {}
        while (line := lines.readline().decode().rstrip("\r\n")):
            name, _, value = line.partition(": ")
            header[name] = value
        block = lines.read(int(header["Content-Length"]))
        lines.read(4)
        yield header, block


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of all archives of a manifest: id, url, payload size and digest, type, reference and payload.

    The digest of every response is computed again from what is stored; a difference raises.
    """
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def rows(path):
        fs, name = pafs.FileSystem.from_uri(path)
        with fs.open_input_stream(name) as source:
            for header, block in records_of(source):
                http, _, body = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                stated, kind = header["WARC-Payload-Digest"].removeprefix("sha1:"), header["WARC-Type"]
                if kind == "response" and (len(body) != size or digest(body) != stated):
                    raise ValueError(f"{path}: {header['WARC-Record-ID']} does not hold what its digest says")
                yield (
                    of_urn(header["WARC-Record-ID"]), header["WARC-Target-URI"], size, stated, kind,
                    of_urn(header.get("WARC-Refers-To")), body if payloads and kind == "response" else None)

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                some, held = [], 0
                for row in rows(path):
                    some.append(row)
                    held += len(row[-1] or b"") + 200
                    if held > 1 << 23:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)
                        some, held = [], 0
                if some:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)

    archives = max(1, manifest.count())  # a number of its own is not merged into fewer tasks
    return manifest.select("path").repartition(archives, "path").mapInArrow(run, RECORDS)
