"""Burrows-Wheeler transform of a collection of strings with the common prefixes of its sorted suffixes, built column by
column: round j inserts, for every string at once, the suffix of length j.

The transform and the prefix lengths are sequential files: a round reads both from front to back and writes them anew
with the insertions. They stay in memory up to ``SPOOL`` bytes. Positions follow from counting symbols, so no suffix is ever
compared with another; the rows in the order of their symbols, which give the counts, are kept from round to round.
"""

from __future__ import annotations

import tempfile

import numpy as np

SPOOL = 1 << 26
NARROW = 1 << 24  # rows that fit a word of 32 bits beside a symbol
END = 0


class Sequence:
    """A file of small numbers that is written and read in one go."""

    def __init__(self):
        self.file = tempfile.SpooledTemporaryFile(max_size=SPOOL)

    def write(self, values: np.ndarray) -> None:
        self.file.seek(0)
        self.file.write(values.tobytes())
        self.file.truncate()

    def read(self) -> np.ndarray:
        self.file.seek(0)
        return np.frombuffer(self.file.read(), np.uint8)


def common_windows(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, place, group) of every substring of ``width`` bytes; equal substrings, and only they, share a group."""
    m = len(starts)
    symbols = np.zeros(256, np.uint8)
    used = np.flatnonzero(np.bincount(data, minlength=256))
    if len(used) > 255:
        raise ValueError("UTF-8 text has fewer than 255 different bytes")
    symbols[used] = np.arange(1, len(used) + 1)
    columns = np.full((int(lengths.max()) + 1, m), END, np.uint8)  # symbol of each string before its suffix of a length
    for length in range(len(columns) - 1):
        some = np.flatnonzero(lengths > length)
        columns[length, some] = symbols[data[(starts + lengths)[some] - length - 1]]
    transform, prefixes = Sequence(), Sequence()
    before, shared = columns[0], np.zeros(m, np.uint8)
    transform.write(before)
    prefixes.write(shared)
    # (symbol, row) in order, as the suffixes longer by that symbol are; what a round inserts is merged in
    kind = np.uint32 if len(data) + m < NARROW else np.uint64
    bits = kind(8 * kind().itemsize - 8)
    low = (kind(1) << bits) - kind(1)
    keys = before.astype(kind) << bits | np.arange(m, dtype=kind)
    string = np.argsort(keys)
    keys = keys[string]
    at, ended = np.arange(m), 0  # where the last inserted rows are among the keys, and whose they are
    for column in columns[1:]:
        before, shared = transform.read(), prefixes.read()
        done = int(np.searchsorted(keys[at] >> bits, 1))  # END is the least symbol
        at, string, ended = at[done:], string[done:], ended + done
        rows = at - ended + m
        new = column[string]
        kept = np.ones(m + len(before) - ended, bool)
        kept[rows] = False
        after, longer = np.empty(len(kept), np.uint8), np.zeros(len(kept), np.uint8)
        after[kept], longer[kept] = before, shared
        after[rows] = new
        # a suffix shares one symbol more with the one above than the least that was shared between their rests
        changed = np.column_stack([rows, rows + 1]).ravel()  # rows ascend
        changed = changed[np.append(changed[1:] != changed[:-1], changed[-1:] < len(after))]
        longer[changed] = 0
        here = changed - m + ended
        here, changed = here[changed > m], changed[changed > m]
        upper, lower = keys[here - 1], keys[here]
        same = upper >> bits == lower >> bits
        upper, lower, changed = upper[same] & low, lower[same] & low, changed[same]
        if len(changed):
            spans = np.column_stack([upper, lower]).ravel().astype(np.int64) + 1
            least = np.minimum.reduceat(np.append(shared, np.uint8(255)), spans)[::2]
            longer[changed] = np.minimum(least.astype(np.int64) + 1, width)
        transform.write(after)
        prefixes.write(longer)
        above = np.diff(rows - np.arange(len(rows)), prepend=0, append=len(before))
        keys += np.repeat(np.arange(len(rows) + 1, dtype=kind), above)[keys & low]  # rows move down by what came above them
        inserted = new.astype(kind) << bits | rows.astype(kind)
        order = np.argsort(inserted)
        inserted, string = inserted[order], string[order]
        at = np.searchsorted(keys, inserted) + np.arange(len(inserted))
        kept = np.ones(len(after), bool)
        kept[at] = False
        merged = np.empty(len(after), kind)
        merged[kept], merged[at] = keys, inserted
        keys = merged
    before, shared = transform.read(), prefixes.read()
    ended = int((before == END).sum())
    step = np.empty(len(before), np.int64)
    step[keys & low] = np.arange(len(before)) - ended + m
    group = np.cumsum(shared < width)
    rows, string, found = np.arange(m), np.arange(m), []
    for length in range(1, int(lengths.max()) + 1):
        going = before[rows] != END
        rows, string = step[rows[going]], string[going]
        if length >= width:
            found.append((string, lengths[string] - length, group[rows]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
