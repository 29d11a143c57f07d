"""Secret scan: an Aho-Corasick pass finds keywords, anchored patterns run only where one was hit, and tokens that
carry a checksum are kept only if it is right.

Kinds: ``assign`` (a credential assigned to a name), ``access`` (cloud access keys), ``hex`` (long hexadecimal
strings), ``github`` and ``npm`` (tokens whose last six characters are the CRC-32 of the rest in base 62).

Matches of one kind are the leftmost non-overlapping ones of its pattern over the whole text; those that fail the
kind's check afterwards are dropped. NULL and empty texts have no spans; NULL ids are carried; repeated rows are
scanned each; other columns are ignored by the scan and kept by ``redact``.
"""

from __future__ import annotations

import itertools
import re
import zlib
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns of the kinds, and the least lengths checked after matching.
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS, ACCESS_NAME = r"AKIA[A-Z0-9]+", "AKIA"
HEX, HEX_DIGITS = r"[0-9a-f]+", "0123456789abcdef"
GITHUB, GITHUB_NAMES = r"gh[pousr]_[A-Za-z0-9]{36}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
NPM, NPM_NAME = r"npm_[A-Za-z0-9]{36}", "npm_"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS = "array<struct<kind:string,start:int,end:int>>"


def checksum_holds(token: str) -> bool:
    """The last six characters are the CRC-32 of what lies between the prefix and them."""
    body, check = token[token.index("_") + 1 : -6], token[-6:]
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits == check


#: For each kind: its anchored pattern and the check that a match must pass.
RULES = (
    (re.compile(ASSIGN, re.ASCII | re.IGNORECASE), lambda m: len(m.group(2)) >= LEAST_VALUE),
    (re.compile(ACCESS), lambda m: len(m.group()) >= LEAST_ACCESS),
    (re.compile(HEX), lambda m: len(m.group()) >= LEAST_HEX),
    (re.compile(GITHUB), lambda m: checksum_holds(m.group())),
    (re.compile(NPM), lambda m: checksum_holds(m.group())),
)


@cache
def automaton():
    """All keywords in one automaton, built once per Python worker.

    A match of ``hex`` starts with four hexadecimal digits, so these are its keywords; names of ``assign`` stand in
    every mixture of cases.
    """
    import ahocorasick

    words: dict[str, list[int]] = {}

    def add(word: str, kind: str) -> None:
        words.setdefault(word, []).append(KINDS.index(kind))

    for name in ASSIGN_NAMES:
        for letters in itertools.product(*({c, c.upper()} for c in name)):
            add("".join(letters), "assign")
    add(ACCESS_NAME, "access")
    for digits in itertools.product(HEX_DIGITS, repeat=4):
        add("".join(digits), "hex")
    for name in GITHUB_NAMES:
        add(name, "github")
    add(NPM_NAME, "npm")
    found = ahocorasick.Automaton()
    for word, kinds in words.items():
        found.add_word(word, (len(word) - 1, kinds))
    found.make_automaton()
    return found


def scan_text(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every secret, ordered by start and kind."""
    spans, free = [], [0] * len(KINDS)
    for last, (back, kinds) in automaton().iter(text):
        start = last - back
        for kind in kinds:
            if start < free[kind]:
                continue
            pattern, holds = RULES[kind]
            if m := pattern.match(text, start):
                free[kind] = m.end()
                if holds(m):
                    spans.append((start, kind, m.end()))
    return sorted(spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans count as one."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``spans`` (kind, start, end in code points, end exclusive)."""

    def run(batches):
        for b in batches:
            rows = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan_text(t)] if t else []
                for t in b.column(1).to_pylist()
            ]
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kinds)], names=[id, "spans"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, spans {SPANS}")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced by its kind; no row is dropped."""

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index(text)
            texts = [masked(t, spans) if t and (spans := scan_text(t)) else t for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def report(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts per kind, a hash of the base spans, and all spans as text."""
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return found.select(
        id, *(n(k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"))
