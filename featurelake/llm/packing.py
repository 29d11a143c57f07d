"""Best-fit packing of tokenized documents into sequences, by rounds over ever fewer bins.

Every partition packs its own pieces by best fit (largest first, each into the fullest bin that still takes it). Bins
that are nearly full are finished; the underfull ones become the items of the next round, in fewer partitions, until one
partition has packed the last of them or no two of them fit together. A task packs ``block`` items at a time, so its memory is bounded.

NULL and empty texts hold the closing id alone. NULL ids are carried, and repeated rows are packed each. Only documents
longer than a sequence are cut. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .words import BLANKS, Texts, released, slices, substring_hashes

CLOSING_ID = 0
CAPACITY = 2048

PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
BINS = "size int, done boolean, sequence_id long, members array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>>"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The byte that begins the letters from U+00C0 to U+00FF, and the second bytes of the two signs among them.
LATIN, LATIN_SIGNS = 0xC3, (0x97, 0xB7)


def byte_classes() -> np.ndarray:
    """0 blank, 1 letter, 2 mark, 3 anything that is left to the tokenizer."""
    table = np.full(256, 3, np.uint8)
    table[list(BLANKS)] = 0
    table[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = 2
    table[[c for c in range(128) if chr(c).isalpha()] + [LATIN]] = 1
    return table


CLASSES = byte_classes()


class Tokens:
    """Ids of whole texts. The tokenizer drops white space, lower-cases and joins neither what white space parts nor
    letters with marks, so the ids of a text are those of its words and marks in order, and each different one is
    tokenized once. What holds digits, apostrophes or other scripts is parted at white space only.

    Texts that may hold a special token go through the tokenizer whole. Strings are known by their hash; at most
    ``most`` are remembered.
    """

    def __init__(self, path: str, most: int = 1_500_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.specials = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        words = sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])
        self.closes = np.array([bool(suffix) and w.endswith(suffix) for w, _ in words])
        self.forget()

    def forget(self) -> None:
        self.known, self.ids = np.empty(0, np.uint64), np.empty(0, np.uint32)
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)

    def parts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text number, start, end, whether it is all letters or all marks) of what is tokenized on its own."""
        owner, starts, ends = texts.words()
        if not len(starts):
            return owner, starts, ends, np.empty(0, bool)
        classes = CLASSES[texts.bytes]
        second = np.flatnonzero(texts.bytes[:-1] == LATIN) + 1
        classes[second[~np.isin(texts.bytes[second], LATIN_SIGNS)]] = 1
        other = np.concatenate([[0], np.cumsum(classes == 3)])
        plain = other[ends] == other[starts]
        inner = np.flatnonzero((classes[1:] != classes[:-1]) & (classes[1:] > 0) & (classes[:-1] > 0)) + 1
        of = np.searchsorted(starts, inner, "right") - 1
        inner, of = (x[plain[of] & (starts[of] != inner)] for x in (inner, of))
        at = np.searchsorted(starts, inner)
        return (np.insert(owner, at, owner[of]), np.insert(starts, at, inner), np.insert(ends, np.searchsorted(ends, inner), inner),
                np.insert(plain, at, True))

    def tokenized(self, words: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all strings, where those of each begin, how many they are).

        Plain strings go in one text, in which each ends with a token that closes a word.
        """
        starts, lengths, made, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
        alone = np.flatnonzero(~plain).tolist()
        together = np.flatnonzero(plain)
        for k in range(0, len(together), 2000):
            some = together[k : k + 2000]
            ids = np.array(self.tokenizer.encode(" ".join([words[i] for i in some.tolist()]), add_special_tokens=False).ids, np.uint32)
            cuts = np.concatenate([[0], np.flatnonzero(self.closes[ids]) + 1])
            if len(cuts) == len(some) + 1:
                starts[some], lengths[some] = total + cuts[:-1], np.diff(cuts)
                made.append(ids)
                total += len(ids)
            else:
                alone += some.tolist()
        for k in range(0, len(alone), 2000):
            some = alone[k : k + 2000]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([words[i] for i in some], add_special_tokens=False), strict=True):
                starts[i], lengths[i] = total, len(e.ids)
                made.append(np.array(e.ids, np.uint32))
                total += len(e.ids)
        return np.concatenate([np.empty(0, np.uint32), *made]), starts, lengths

    def learn(self, hashes: np.ndarray, words: list[str], plain: np.ndarray) -> None:
        """``hashes`` are in rising order and new."""
        ids, starts, lengths = self.tokenized(words, plain)
        at = np.searchsorted(self.known, hashes)
        self.starts = np.insert(self.starts, at, len(self.ids) + starts)
        self.lengths = np.insert(self.lengths, at, lengths)
        self.known = np.insert(self.known, at, hashes)
        self.ids = np.concatenate([self.ids, ids])

    def of(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of every text of a column of bytes."""
        texts = Texts(column)
        if len(self.known) > self.most:
            self.forget()
        owner, starts, ends, plain = self.parts(texts)
        hashes, first, which = np.unique(substring_hashes(texts.sums(fold=True), starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        new = at == len(self.known) if not len(self.known) else self.known[np.minimum(at, len(self.known) - 1)] != hashes
        if new.any():
            data = texts.bytes.tobytes()
            fresh = first[new]
            self.learn(hashes[new], [data[s:e].decode() for s, e in zip(starts[fresh].tolist(), ends[fresh].tolist(), strict=True)], plain[fresh])
            at = np.searchsorted(self.known, hashes)
        words = at[which]
        lengths = self.lengths[words]
        done = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.starts[words] - done + lengths, lengths) + np.arange(done[-1] if len(done) else 0)]
        cuts = np.concatenate([[0], done])[np.searchsorted(owner, np.arange(len(column) + 1))]
        out = [ids[a:z] for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for i, text in enumerate(column.to_pylist()):
            if text and any(s in text.lower() for s in self.specials):
                out[i] = np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
        return out


@cache
def tokens_of(path: str) -> Tokens:
    """One per Python worker."""
    return Tokens(path)


def cut(docs: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY,
        ids: bool = False, keep: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32, and with ``ids`` the token ids themselves.

    With ``keep`` a worker remembers the words it has tokenized for its next task; without, it gives the memory back, for
    jobs whose other stages need it.
    """
    path = tokenizer or default_tokenizer()
    fields = list(PIECE) + ([pa.field("ids", pa.list_(pa.int32()))] if ids else [])

    def run(batches):
        tokens = tokens_of(path)
        for b in batches:
            for at, column in slices(b.column(1)):
                rows = []
                for key, found in zip(b.column(0).slice(at, len(column)).to_pylist(), tokens.of(column), strict=True):
                    whole = np.append(found, np.uint32(CLOSING_ID)).astype("<u4")
                    for k, start in enumerate(range(0, len(whole), capacity)):
                        part = whole[start : start + capacity]
                        rows.append((key, k, start, len(part), zlib.crc32(part.tobytes()), *([part.astype(np.int32)] if ids else [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], names=[f.name for f in fields])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return docs.select(F.col(id).cast("long"), F.col(text).cast("binary")).mapInArrow(released(run) if keep else released(run, tokens_of), schema)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: items in falling order of size, each into the bin with the least room that takes it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if left := room - size:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins


def packed(items: DataFrame, capacity: int, slack: int, block: int, level: int) -> DataFrame:
    """One round: the bins (``BINS``) that each partition makes of its items (size, members)."""

    def made(sizes, members):
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], str(members[i][0])))  # whatever order rows come in
        sizes, members = np.array([sizes[i] for i in order]), [members[i] for i in order]
        nonlocal count
        size, done, ids, held = [], [], [], []
        for b in best_fit(sizes, capacity):
            size.append(int(sizes[b].sum()))
            done.append(size[-1] >= capacity - slack)
            ids.append(level << 56 | TaskContext.get().partitionId() << 32 | count)
            held.append([m for i in b for m in members[i]])
            count += 1
        return pa.RecordBatch.from_arrays(
            [pa.array(size, pa.int32()), pa.array(done, pa.bool_()), pa.array(ids, pa.int64()), pa.array(held, pa.list_(PIECE))],
            names=["size", "done", "sequence_id", "members"])

    count = 0

    def run(batches):
        sizes, members = [], []
        for b in batches:
            sizes += b.column(0).to_pylist()
            members += b.column(1).to_pylist()
            while len(sizes) >= block:
                yield made(sizes[:block], members[:block])
                sizes, members = sizes[block:], members[block:]
        if sizes:
            yield made(sizes, members)

    return items.select("size", "members").mapInArrow(run, BINS)


def pack(pieces: DataFrame, capacity: int = CAPACITY, *, slack: int = 8, block: int = 50_000, fan_in: int = 8) -> DataFrame:
    """Every piece with its sequence_id and its offset there.

    Bins with at most ``slack`` free places are finished at once, and so is, in every round, a bin with less room than
    the least bin needs. ``fan_in`` partitions of a round feed one of the next, but none gets more than ``block`` bins.
    Where that leaves several partitions, bins are dealt in turn by hash and by the lesser of size and room, so that
    those that fill each other up meet; the end is when neither merges anything.
    """
    item = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    items = pieces.select(F.col("length").cast("int").alias("size"), F.array(item).alias("members"))
    items = stage(items, "pieces")  # the tokenizer's workers are done before those of the first round begin
    bins = stage(packed(items, capacity, slack, block, 0), "packing")
    rounds, level, parts, idle = [], 0, max(bins.rdd.getNumPartitions(), 1), 0
    while True:
        least, open_bins = bins.filter("NOT done").agg(F.min("size"), F.count(F.lit(1))).first()
        fits = ~F.col("done") & (F.col("size") <= capacity - (least or 0))
        left = bins.filter(fits).count() if open_bins > 1 else 0
        idle = idle + 1 if level and open_bins == came else 0
        if left < 2 or idle == 2 or level and parts == 1:
            rounds.append(bins)
            break
        rounds.append(bins.filter(~fits))
        level, came, parts = level + 1, left, max(-(-parts // fan_in), -(-left // block))
        near = F.least(F.col("size"), capacity - F.col("size"))
        rest = bins.filter(fits)
        if parts > 1 and level % 2 == 0:
            rest = rest.repartitionByRange(parts, near, F.xxhash64("members", F.lit(level)))
        else:
            rest = rest.repartition(parts, F.xxhash64("members", F.lit(level)))
        bins = stage(packed(rest, capacity, slack, block, level), "packing")
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)

    def laid_out(batches):
        for b in batches:
            members = b.column(1)
            flat, counts = members.flatten(), np.diff(members.offsets.to_numpy())
            lengths = flat.field("length").to_numpy()
            ends, last = np.cumsum(lengths), np.cumsum(counts)
            begun = np.repeat(np.concatenate([[0], ends])[last - counts], counts)
            columns = [flat.field(f.name) for f in PIECE] + [pa.array(np.repeat(b.column(0).to_numpy(), counts)), pa.array(ends - lengths - begun)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in PIECE] + ["sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return out.select("sequence_id", "members").mapInArrow(laid_out, schema)
