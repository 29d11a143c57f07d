"""Which keys of a document occur in other documents too, found without a row per key.

A task turns some megabytes of text into one batch. The batch sends every bucket of the key space one packed row: its
keys there, and for each the numbers of the batch's documents that have it. A bucket counts the documents of each key over
all batches and answers each batch with the keys that at least two documents have; the batch's answers meet again
by batch. Rows per key are packed into bytes, so a shuffle carries about seven bytes for a key of a document.

A key that an eighth of a batch's documents share sends its count alone, and its documents wait at the batch. So a key of
a third of all documents costs its bucket one entry per batch. Buckets and batches are bounded by bytes of text, not by documents.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import BATCH, Texts, slices

#: Text bytes for each bucket of the key space, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 1_000_000, 256
LOW = np.uint64((1 << 40) - 1)
#: A batch keeps the documents of a key to itself from this share and number of its documents.
COMMON_SHARE, COMMON_LEAST = 8, 16
MOST_DOCS = 60_000  # numbers of documents in a batch take two bytes

MESSAGE = "bucket int, batch long, about string, payload binary"
NAMES = ["bucket", "batch", "about", "payload"]

#: (text numbers, keys, number of keys of each text) of a batch; a key occurs once per text.
Keys = Callable[[Texts], tuple[np.ndarray, np.ndarray, np.ndarray]]


def parts(*arrays: np.ndarray) -> bytes:
    """Arrays in one string of bytes, each after its length."""
    return b"".join(struct.pack("<q", a.nbytes) + a.tobytes() for a in arrays)


def unpacked(payload: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = struct.unpack_from("<q", payload, at)[0]
        out.append(np.frombuffer(payload, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


def low_bytes(keys: np.ndarray, width: int = 5) -> np.ndarray:
    """The lower five bytes of every key, or as many as ``width``."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def from_low_bytes(data: np.ndarray, width: int = 5) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(-1, width)
    return out.view("<u8").reshape(-1)


def messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.string(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def bucket_count(docs: DataFrame, text: str, bucket_bytes: int = BUCKET_BYTES, least: int = LEAST_BUCKETS) -> int:
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(least, -(-size // bucket_bytes))


def sent(docs: DataFrame, keys: Keys, buckets: int, batch_bytes: int = 0, slice_bytes: int = BATCH) -> DataFrame:
    """Messages of all batches of ``docs`` (doc_id, text_hash, text).

    A batch is a slice of the text, or as many slices as have ``batch_bytes``, of which only the keys are held.
    """

    def run(batches):
        made, held, size, docs = 0, [], 0, 0

        def batch() -> pa.RecordBatch:
            number = made | TaskContext.get().partitionId() << 32
            return messages(batch_messages(*(np.concatenate(x) for x in zip(*held, strict=True)), number, buckets))

        for b in batches:
            for at, column in slices(b.column(2), slice_bytes):
                for first in range(0, len(column), MOST_DOCS):
                    texts = Texts(column.slice(first, MOST_DOCS))
                    if held and (size >= batch_bytes or docs + len(texts.starts) > MOST_DOCS):
                        yield batch()
                        made, held, size, docs = made + 1, [], 0, 0
                    ids, hashes = (b.column(k).slice(at + first, len(texts.starts)) for k in (0, 1))
                    owner, found, sizes = keys(texts)
                    known = ids.is_valid().to_numpy(zero_copy_only=False)
                    held.append((ids.fill_null(0).to_numpy().copy(), known, hashes.to_numpy().copy(), owner + docs, found, sizes))
                    size, docs = size + len(texts.bytes), docs + len(texts.starts)
        if held:
            yield batch()

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, MESSAGE)


def home(batch: int, buckets: int) -> int:
    """The bucket that passes on what a batch keeps to itself; numbers have the task in their upper half."""
    return ((batch >> 32) * 97 + (batch & 0xFFFFFFFF)) % buckets


def batch_messages(ids, known, hashes, owner, found, sizes, batch: int, buckets: int) -> list[tuple]:
    to = ((found >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    names = to << np.uint64(40) | found & LOW  # what tells keys apart from here on
    order = np.argsort(names, kind="stable")
    names, owner = names[order], owner[order].astype(np.uint16)
    new = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.empty(0, np.int64)
    counts = np.diff(np.append(new, len(names)))
    distinct = names[new]
    common = counts >= max(COMMON_LEAST, -(-len(sizes) // COMMON_SHARE))
    apart = np.repeat(common, counts)
    own = parts(ids, known, hashes, sizes.astype(np.int32), distinct[common], counts[common].astype(np.int32), owner[apart])
    rows = [(home(batch, buckets), batch, "docs", own)]
    owner, shown = owner[~apart], np.where(common, 0, counts)
    ends = np.cumsum(shown)
    bucket = (distinct >> np.uint64(40)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.empty(0, np.int64)
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        listed = owner[ends[a] - shown[a] : ends[z - 1]]
        rows.append((int(bucket[a]), batch, "keys", parts(low_bytes(distinct[a:z]), counts[a:z].astype(np.uint16), common[a:z], listed)))
    return rows


def answered(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The answers of one bucket: per batch the keys of at least two documents and how many have them."""
    about, payloads, batches = (table.column(n).to_pylist() for n in ("about", "payload", "batch"))
    rows = [(0, b, "docs", p) for a, p, b in zip(about, payloads, batches, strict=True) if a == "docs"]
    asked = [(b, *unpacked(p, "u1", "u2", "?", "u2")) for a, p, b in zip(about, payloads, batches, strict=True) if a == "keys"]
    if asked:
        asked = [(b, from_low_bytes(k), c.astype(np.int64), common, listed) for b, k, c, common, listed in asked]
        names = np.concatenate([x[1] for x in asked])
        order = np.argsort(names, kind="stable")
        ordered = names[order]
        new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        totals = np.add.reduceat(np.concatenate([x[2] for x in asked])[order], new)
        of = np.empty(len(names), np.int64)
        of[order] = np.repeat(totals, np.diff(np.append(new, len(names))))
        prefix, at = np.uint64(key[0].as_py()) << np.uint64(40), 0
        for b, k, c, common, listed in asked:
            total = of[at : at + len(k)]
            at += len(k)
            kept = total >= 2
            if kept.any():
                stays = np.repeat(kept, np.where(common, 0, c))
                rows.append((0, b, "keys", parts(k[kept] | prefix, total[kept].astype(np.int32), c[kept].astype(np.uint16), common[kept], listed[stays])))
    return pa.Table.from_batches([messages(rows)])


class Answers:
    """What a batch has learned: its documents, and each (document, key, number of documents with the key) of shared keys."""

    def __init__(self, table: pa.Table):
        owners, names, totals = [], [], []
        own = next(p for a, p in zip(table.column("about").to_pylist(), table.column("payload").to_pylist(), strict=True) if a == "docs")
        self.ids, self.known, self.hashes, self.sizes, common_keys, common_counts, common_owners = unpacked(own, "i8", "?", "i8", "i4", "u8", "i4", "u2")
        starts = dict(zip(common_keys.tolist(), zip(np.cumsum(common_counts) - common_counts, common_counts, strict=True), strict=True))
        for about, payload in zip(table.column("about").to_pylist(), table.column("payload").to_pylist(), strict=True):
            if about == "keys":
                k, total, c, common, listed = unpacked(payload, "u8", "i4", "u2", "?", "u2")
                shown = np.where(common, 0, c.astype(np.int64))
                owners.append(listed)
                names.append(np.repeat(k, shown))
                totals.append(np.repeat(total, shown))
                for i in np.flatnonzero(common).tolist():
                    at, n = starts[int(k[i])]
                    owners.append(common_owners[at : at + n])
                    names.append(np.full(n, k[i]))
                    totals.append(np.full(n, total[i]))
        self.owners = np.concatenate(owners).astype(np.int64) if owners else np.empty(0, np.int64)
        self.keys = np.concatenate(names) if names else np.empty(0, np.uint64)
        self.totals = np.concatenate(totals) if totals else np.empty(0, np.int32)


def shared_keys(docs: DataFrame, keys: Keys, finish: Callable[[Answers], pa.Table], schema: str, buckets: int | None = None, **sizes: int) -> DataFrame:
    """``finish`` of every batch of ``docs`` (doc_id long, text_hash long, text); ``sizes`` go to ``sent``."""
    asked = sent(docs, keys, buckets or bucket_count(docs, "text"), **sizes)
    answers = asked.groupBy("bucket").applyInArrow(answered, MESSAGE)

    def finished(table: pa.Table) -> pa.Table:
        return finish(Answers(table))

    return answers.groupBy("batch").applyInArrow(finished, schema)


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, text): a row is known by the first two."""
    text = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text)
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
