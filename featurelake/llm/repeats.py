"""Removal of byte strings that an earlier document has, with a collection Burrows-Wheeler transform per share of the text.

Every 50-byte string is named by the least hash of its 24-byte substrings, so equal strings have equal names wherever
they stand. Names that several documents have (``postings``) select the text that takes part; its strings of one name are
runs, cut into pieces of at most 76 bytes, and the pieces of all documents meet in the bucket of their name. A bucket builds, for
a share of the names at a time, the transform of its different pieces with the common prefixes of their sorted suffixes
(``bwt``); suffixes that share 50 bytes are one string, and it is removed in every document but those of its least id. Buckets
are bounded by bytes of text, and equal pieces enter the transform once, so a passage of a third of all documents is one piece there.

Texts are UTF-8 bytes; NULL and empty texts have none and lose none. Strings never cross documents. Documents of one id
do not count as earlier than each other; documents without an id lose nothing and take nothing from others. Repeated
rows are returned each. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bwt import common_windows
from .common import stage
from .postings import LOW, MESSAGE, Answers, bucket_count, from_low_bytes, home, keyed, low_bytes, messages, parts, shared_keys, unpacked
from .words import Texts, mix, powers, slices, substring_hashes

WIDTH, SEED = 50, 24
MOST_WINDOWS = WIDTH - SEED + 1
NO_ID = -(1 << 63)  # stands for NULL
#: Bytes of text whose hashes are made at once, of text or pieces of a batch, of text of a bucket, and of pieces of a transform.
#: Every batch sends every bucket a message, so both are large; there are ``LEAST_BUCKETS`` of them at least, to be dealt evenly.
SLICE_BYTES, BATCH_BYTES, BUCKET_BYTES, SHARE_BYTES = 1 << 18, 1 << 23, 1 << 23, 1 << 20
LEAST_BUCKETS = 1024
#: Bits of a name that select text, and bytes of it that go with a piece: names that agree in them only bring text that nothing
#: else has to the transform, which tells it apart.
PICK, NAME_BYTES = np.int64((1 << 32) - 1), 3


def runs(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, windows, name) of the runs of windows with one name."""
    empty = np.empty(0, np.int64)
    n = len(texts.bytes)
    if n < WIDTH:
        return empty, empty, empty, np.empty(0, np.uint64)
    sums = texts.sums(fold=False)
    least = (sums[SEED:] - sums[:-SEED]) * powers(n + 1, True)[: n - SEED + 1]
    del sums
    span = 1
    while 2 * span <= MOST_WINDOWS:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < MOST_WINDOWS:
        least = np.minimum(least[: span - MOST_WINDOWS], least[MOST_WINDOWS - span :])
    edge = np.ones(len(least) + 1, bool)
    np.not_equal(least[1:], least[:-1], out=edge[1:-1])
    whose = np.flatnonzero(texts.ends - texts.starts >= WIDTH)
    begun, closed = texts.starts[whose], texts.ends[whose] - WIDTH + 1
    edge[begun] = edge[closed] = True
    at = np.flatnonzero(edge)
    first = np.searchsorted(at, begun)
    counts = np.searchsorted(at, closed) - first  # what follows crosses the end of the text
    owner = np.repeat(whose, counts)
    taken = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(len(owner))
    start = at[taken]
    name = mix(least[start] ^ np.uint64(WIDTH))  # least hashes are small: spread them again
    return owner, start - texts.starts[owner], at[taken + 1] - start, name


def distinct_names(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner, _, _, name = runs(texts)
    order = np.argsort(name, kind="stable")  # runs are in the order of their texts
    owner, name = owner[order], name[order]
    if len(owner):
        kept = np.concatenate([[True], (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])])
        owner, name = owner[kept], name[kept]
    return owner, name, np.bincount(owner, minlength=len(texts.starts))


def shared_names(batch: Answers) -> pa.Table:
    """The shared names of every document that has some."""
    order = np.argsort(batch.owners, kind="stable")
    counts = np.bincount(batch.owners, minlength=len(batch.ids))
    some = np.flatnonzero(counts)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts[some])]), pa.int32()), pa.array(batch.keys[order].astype(np.uint32).view(np.int32)))
    return pa.table({"doc_id": batch.ids[some], "text_hash": batch.hashes[some], "names": lists})


def pieces_sent(docs: DataFrame, buckets: int) -> DataFrame:
    """Messages of all batches of ``docs`` (doc_key, text_hash, text, names): per bucket its pieces, and where they stood."""

    def run(batches):
        made, held, size, docs, most = 0, [], 0, 0, 0

        def batch() -> pa.RecordBatch:
            number = made | TaskContext.get().partitionId() << 32
            return messages(piece_messages(*(np.concatenate(x) for x in zip(*held, strict=True)), number, buckets))

        for b in batches:
            for at, column in slices(b.column(2), SLICE_BYTES):
                ids, hashes, names = (b.column(k).slice(at, len(column)) for k in (0, 1, 3))
                texts = Texts(column)
                owner, start, windows, to, name = pieces(texts, names.flatten().to_numpy(), buckets)
                held.append((ids.to_numpy().copy(), hashes.to_numpy().copy(), texts.bytes.copy(), owner + docs, size + texts.starts[owner] + start, start, windows, to, name))
                size, docs, most = size + len(texts.bytes), docs + len(ids), most + int(windows.sum()) + (WIDTH - 1) * len(windows)
                if max(size, most) >= BATCH_BYTES:
                    yield batch()
                    made, held, size, docs, most = made + 1, [], 0, 0, 0
        if held:
            yield batch()

    return docs.select("doc_key", "text_hash", "text", "names").mapInArrow(run, MESSAGE)


def pieces(texts: Texts, names: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """(text number, start, windows, bucket, name) of the runs with one of ``names``, cut into pieces.

    A name that one text here shares with others is shared wherever it stands, so the texts' names are one list.
    """
    owner, start, windows, name = runs(texts)
    to = ((name >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    name = (to << np.uint64(40) | name & LOW).astype(np.int64)
    names, pick = np.sort(names.view(np.uint32)), (name & PICK).astype(np.uint32)
    taken = names[np.minimum(np.searchsorted(names, pick), len(names) - 1)] == pick if len(names) else np.zeros(len(name), bool)
    owner, start, windows, to, name = owner[taken], start[taken], windows[taken], to[taken].astype(np.int64), name[taken]
    many = -(-windows // MOST_WINDOWS)  # text of a short period has one name for long
    part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    owner, start, windows, to, name = (np.repeat(x, many) for x in (owner, start, windows, to, name))
    return owner, start + part * MOST_WINDOWS, np.minimum(windows - part * MOST_WINDOWS, MOST_WINDOWS), to, name


def piece_messages(ids, hashes, data, owner, begun, start, windows, to, name, batch: int, buckets: int) -> list[tuple]:
    order = np.argsort(to, kind="stable")
    owner, begun, start, windows, to, name = (x[order] for x in (owner, begun, start, windows, to, name))
    edges = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]])) if len(to) else np.zeros(1, np.int64)
    own = parts(ids, hashes, to[edges[:-1]].astype(np.int32), np.diff(edges).astype(np.int32), owner.astype(np.int32), start.astype(np.int32), windows.astype(np.uint8))
    rows = [(home(batch, buckets), batch, "docs", own)]
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        kept = data[places(begun[a:z], windows[a:z] + WIDTH - 1)]
        rows.append((int(to[a]), batch, "keys", parts(ids[owner[a:z]], windows[a:z].astype(np.uint8), low_bytes(name[a:z], NAME_BYTES), kept)))
    return rows


def places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places from each start on, one stretch after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def later(docs: np.ndarray, windows: np.ndarray, names: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For every window of every piece, whether a document with a smaller id has its string.

    Equal pieces are one string of the collection, with the least of their ids. A piece whose name no other piece has
    shares no window with any, so only the others enter the transform.
    """
    lengths = windows.astype(np.int64) + WIDTH - 1
    ends = np.cumsum(lengths)
    texts = Texts(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(data)]))
    _, first, which = np.unique(substring_hashes(texts.sums(fold=False), ends - lengths, ends), return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, which, docs)
    _, of_name, several = np.unique(names[first], return_inverse=True, return_counts=True)
    counts = windows.astype(np.int64)
    offset = np.cumsum(counts[first]) - counts[first]
    by_window = np.repeat(least, counts[first])
    compared = np.flatnonzero(several[of_name] > 1)
    if len(compared):
        string, place, group = common_windows(data, (ends - lengths)[first[compared]], lengths[first[compared]], WIDTH)
        lowest = np.full(group.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(lowest, group, least[compared[string]])
        by_window[offset[compared[string]] + place] = lowest[group]
    here = np.repeat(offset[which] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return by_window[here] < np.repeat(docs, counts)


def shares_later(docs: np.ndarray, windows: np.ndarray, names: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``later`` of a bucket's pieces, in shares of their names: a transform is one of few bytes, whatever the bucket's size."""
    shares = -(-len(data) // SHARE_BYTES)
    if shares < 2:
        return later(docs, windows, names, data)
    share = (names * np.uint64(shares)) >> np.uint64(8 * NAME_BYTES)
    order = np.argsort(share, kind="stable")
    counts, lengths = windows.astype(np.int64), windows.astype(np.int64) + WIDTH - 1
    first, begun = np.cumsum(counts) - counts, np.cumsum(lengths) - lengths
    out = np.empty(counts.sum(), bool)
    edges = np.searchsorted(share[order], np.arange(shares + 1, dtype=np.uint64))
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own = order[a:z]
        if len(own):
            out[places(first[own], counts[own])] = later(docs[own], windows[own], names[own], data[places(begun[own], lengths[own])])
    return out


def judged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The answers of one bucket: for each batch a bit per window of its pieces."""
    rows, asked = [], []
    for about, batch, payload in zip(*(table.column(n).to_pylist() for n in ("about", "batch", "payload")), strict=True):
        if about == "docs":
            rows.append((0, batch, about, payload))
        else:
            ids, windows, names, data = unpacked(payload, "i8", "u1", "u1", "u1")
            asked.append((batch, ids, windows, from_low_bytes(names, NAME_BYTES), data))
    if asked:
        found = shares_later(*(np.concatenate([x[k] for x in asked]) for k in (1, 2, 3, 4)))
        at = 0
        for batch, _, windows, _, _ in asked:
            n = int(windows.sum(dtype=np.int64))
            rows.append((key[0].as_py(), batch, "keys", np.packbits(found[at : at + n]).tobytes()))
            at += n
    return pa.Table.from_batches([messages(rows)])


SPANS = "doc_key long, text_hash long, starts array<long>, ends array<long>"


def spans(table: pa.Table) -> pa.Table:
    """What a batch's documents lose, as maximal spans of bytes."""
    bits, own = {}, None
    for about, bucket, payload in zip(*(table.column(n).to_pylist() for n in ("about", "bucket", "payload")), strict=True):
        if about == "docs":
            own = payload
        else:
            bits[bucket] = np.unpackbits(np.frombuffer(payload, np.uint8))
    ids, hashes, to, pieces, owner, start, windows = unpacked(own, "i8", "i8", "i4", "i4", "i4", "i4", "u1")
    counts = windows.astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(pieces)])
    lost = [bits[b][: counts[a:z].sum()] for b, a, z in zip(to.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    lost = np.concatenate(lost).astype(bool) if lost else np.empty(0, bool)
    # runs of lost windows of a piece, then in the order of the texts
    first, last = np.cumsum(counts) - counts, np.cumsum(counts) - 1
    opens, closes = lost.copy(), lost.copy()
    opens[1:] &= ~lost[:-1]
    closes[:-1] &= ~lost[1:]
    opens[first], closes[last] = lost[first], lost[last]
    opens, closes = np.flatnonzero(opens), np.flatnonzero(closes)
    piece = np.searchsorted(first, opens, "right") - 1
    owner, shift = owner[piece].astype(np.int64), start[piece] - first[piece]
    opens, closes = opens + shift, closes + shift + WIDTH
    order = np.argsort(owner << 32 | opens)
    owner, opens, closes = owner[order], opens[order], closes[order]
    if not len(owner):
        return pa.table({"doc_key": pa.array([], pa.int64()), "text_hash": pa.array([], pa.int64()), "starts": pa.array([], pa.list_(pa.int64())), "ends": pa.array([], pa.list_(pa.int64()))})
    apart = (owner[1:] != owner[:-1]) | (opens[1:] > closes[:-1])
    first, last = np.concatenate([[True], apart]), np.concatenate([apart, [True]])
    per_doc = np.bincount(owner[first], minlength=len(ids))
    some = np.flatnonzero(per_doc)
    offsets = pa.array(np.concatenate([[0], np.cumsum(per_doc[some])]), pa.int32())
    return pa.table({
        "doc_key": ids[some], "text_hash": hashes[some], "starts": pa.ListArray.from_arrays(offsets, pa.array(opens[first])),
        "ends": pa.ListArray.from_arrays(offsets, pa.array(closes[last]))})


def found(rows: DataFrame) -> DataFrame:
    """(doc_key, text_hash, starts, ends): the byte spans that rows (doc_key, text_hash, text) lose, if any."""
    known = rows.filter(F.col("doc_key") != NO_ID).withColumnRenamed("doc_key", "doc_id")
    buckets = bucket_count(known, "text", BUCKET_BYTES, LEAST_BUCKETS)
    names = shared_keys(known, distinct_names, shared_names, "doc_id long, text_hash long, names array<int>", buckets, batch_bytes=BATCH_BYTES, slice_bytes=SLICE_BYTES)
    names = stage(names.dropDuplicates(["doc_id", "text_hash"]).withColumnRenamed("doc_id", "doc_key"), "shared-names")
    asked = pieces_sent(rows.join(names, ["doc_key", "text_hash"]), buckets)
    answers = asked.groupBy("bucket").applyInArrow(judged, MESSAGE)
    return answers.groupBy("batch").applyInArrow(spans, SPANS).dropDuplicates(["doc_key", "text_hash"])


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` are the bytes that stay, in order.

    The texts are joined twice on the same keys, which are never NULL, so that one shuffle of them serves both.
    """
    rows = keyed(docs, id, text)
    rows = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_key"), "text_hash", "text")

    def run(batches):
        for b in batches:
            out = []
            for data, starts, ends in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                starts, ends = starts or [], ends or []
                kept = b"".join(data[a:z] for a, z in zip([0, *ends], [*starts, len(data)], strict=True))
                out.append((len(data), len(data) - len(kept), len(starts), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    both = rows.join(found(rows), ["doc_key", "text_hash"], "left")
    both = both.select(F.nullif("doc_key", F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("binary"), "starts", "ends")
    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
