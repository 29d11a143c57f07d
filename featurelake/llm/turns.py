"""Conversation structure repair: the cheapest edits that make a conversation alternate, and which ones.

Rows of a conversation are taken by turn, then role, then a hash of the text. A row can be kept, given the other
role, deleted, and preceded by an inserted row; the last may be followed by one. What comes out must read
``(s?(ua)+)?`` in role initials. The state between rows is what came out last (nothing, s, u or a), so a conversation
is a graph of four nodes between any two rows, whose edges are the edits of the row.

A weight is one integer. Its high digits carry the cost; below stands one octal digit per row, of fixed place, for the
letters of the row's edits (D, ID, IK, IR, K, R in ASCII order; none of them begins another, so the digits compare as
the letters do), and a last digit for an insertion at the end, zero if there is none. The least integer over all paths
is the cheapest repair with the least audit: nothing else decides. Two insertions never follow each other in a cheapest
repair, as leaving both out is cheaper, or deleting a lone s is.

Conversations of any length are cut into leaves of at most 1,024 rows. A leaf gives the least weights from each node to
each node; leaves of a range partition and then the partitions of a conversation are put together by the same least
weights, where a path through a part is known by its rank among the part's sixteen. Decisions come back the same way.
Only the digest of one conversation, a chain of hashes by its nature, is made in one task, by rows that stream through
it in order and are not held.

NULL roles and texts are one space. A NULL turn comes first and counts for no gap; NULL conversations are one. An empty
role or one with another initial cannot be kept. Rows may repeat; equal rows are interchangeable. Other columns are
ignored. Tables without rows give frames without rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import AT, laid_out, part_of
from .common import stage

BLANKS = " \t\n\x0b\x0c\r"
LEAF_BITS = 10
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
EMITTED = ["", "system", "user", "assistant"]
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
LETTERS = ["", "D", "ID", "IK", "IR", "K", "R"]  # by digit
OK, CUT, BLANK, TWICE = range(4)  # first fault of a row
ROW = ["conv", "turn", "role", "h1", "h2"]
NODE = ("conv {kind}, part long, leaf long, first int, last int, illegal long, blank long, duplicate long, truncated long, "
        "t_min long, t_max long, turns long, costs array<long>, paths array<string>")


def clean_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text) without NULL roles and texts."""
    some = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), *some)


def with_hash(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})


def node_after(node: int) -> int:
    """What an inserted or changed row has to be."""
    return ASSISTANT if node == USER else USER


@lru_cache(maxsize=None)
def edges(code: str) -> list:
    """For each node: (next node, cost, digit, row inserted, row that takes the place) of every edit of a row."""
    initial, fault = divmod(ord(code) - 97, 4)
    out = []
    for node in range(4):
        some = []
        for digits, cost, inserted, at in (((1, 5, 6), 0, 0, node), ((2, 3, 4), INSERT, node_after(node), node_after(node))):
            delete, keep, change = digits
            some.append((at, cost + DELETE, delete, inserted, NOTHING))
            if fault < BLANK:
                extra = cost + (TRUNCATED if fault == CUT else 0)
                role = (SYSTEM, USER, ASSISTANT, NOTHING)[initial]
                if role == SYSTEM and at == NOTHING or role >= USER and role == node_after(at):
                    some.append((role, extra + KEEP, keep, inserted, role))
                some.append((node_after(at), extra + REROLE, change, inserted, node_after(at)))
        out.append(some)
    return out


def least(steps: list, width: int) -> tuple[list, list]:
    """Least weights from every node to every node over ``steps``: costs (-1: no way) and digits, as 16 entries each.

    A step gives for a node its edges (next node, cost, digit, …); a digit has ``width`` bits.
    """
    n = len(steps)
    low = width * n
    costs, digits = [-1] * 16, [0] * 16
    for start in range(4):
        best = {start: 0}
        for k, step in enumerate(steps):
            place, found = width * (n - 1 - k), {}
            for node, weight in best.items():
                for to, cost, digit, *_ in step[node]:
                    w = weight + (cost << low) + (digit << place)
                    if to not in found or w < found[to]:
                        found[to] = w
            best = found
        for node, weight in best.items():
            costs[start * 4 + node] = weight >> low
            digits[start * 4 + node] = weight & ((1 << low) - 1)
    return costs, digits


@lru_cache(maxsize=1 << 15)
def solve_short(codes: str) -> tuple[list, list]:
    return solve(codes)


def solve(codes: str) -> tuple[list, list]:
    costs, digits = least([edges(c) for c in codes], 3)
    return costs, [f"{d:0{len(codes)}o}" if c >= 0 else "" for c, d in zip(costs, digits, strict=True)]


def count_illegal(codes: str) -> int:
    initials = [(ord(c) - 97) // 4 for c in codes]
    return sum(unfit(a, b) for a, b in zip(initials, initials[1:], strict=False))


def unfit(a: int, b: int) -> bool:
    """Adjacent initials (0 s, 1 u, 2 a, 3 other) other than su, ua and au."""
    return (a, b) not in ((0, 1), (1, 2), (2, 1))


def batches_of(run, schema: pa.Schema):
    """A function for mapInArrow from one that turns a row (a tuple) into a row."""

    def mapped(batches):
        for b in batches:
            out = [run(*row) for row in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            columns = zip(*out, strict=True) if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return mapped


def arrow_schema(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def leaves(coded: DataFrame) -> DataFrame:
    """A node per conversation and run of at most 1,024 places."""
    rows = F.sort_array(F.collect_list(F.struct(AT, "code")))
    grouped = coded.groupBy("conv", part_of().alias("part"), F.shiftright(AT, LEAF_BITS).alias("leaf")).agg(
        F.array_join(F.transform(rows, lambda r: r["code"]), "").alias("codes"),
        *[F.sum((F.col("fault") == k).cast("long")).alias(n) for n, k in (("blank", BLANK), ("duplicate", TWICE), ("truncated", CUT))],
        F.min("turn").alias("t_min"), F.max("turn").alias("t_max"), F.size(F.collect_set("turn")).cast("long").alias("turns"))
    ddl = NODE.format(kind=coded.schema["conv"].dataType.simpleString()) + ", codes string"

    def run(conv, part, leaf, codes, blank, duplicate, truncated, t_min, t_max, turns):
        costs, paths = solve_short(codes) if len(codes) <= 16 else solve(codes)
        ends = [(ord(c) - 97) // 4 for c in (codes[0], codes[-1])]
        return (conv, part, leaf, *ends, count_illegal(codes), blank, duplicate, truncated, t_min, t_max, turns, costs, paths, codes)

    return grouped.mapInArrow(batches_of(run, arrow_schema(coded, ddl)), ddl)


def merged(nodes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Nodes put together in ``order``: sums, what their borders add, and the least weights through all of them.

    A path is a digit for each node, the rank of the way through it among the sixteen, as a letter from a.
    """
    parts = [c.split()[0] for c in NODE.split(", ")][3:]
    grouped = nodes.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, *parts))).alias("nodes"))
    absent = [c for c in ("conv", "part", "leaf") if c not in keys]
    grouped = grouped.select(*keys, *[F.lit(None).cast("long").alias(c) for c in absent], "nodes").select("conv", "part", "leaf", "nodes")
    ddl = NODE.format(kind=nodes.schema["conv"].dataType.simpleString()) + ", children array<long>, ranks array<string>"

    def run(conv, part, leaf, nodes):
        steps, ranks = [], []
        illegal, turns, before = 0, 0, None
        for k, node in enumerate(nodes):
            ways = list(zip(node["paths"], node["costs"], strict=True))
            rank = {p: r for r, p in enumerate(sorted({p for p, c in ways if c >= 0}))}
            ranked = [rank[p] if c >= 0 else -1 for p, c in ways]
            steps.append([
                [(t, node["costs"][s * 4 + t], ranked[s * 4 + t]) for t in range(4) if node["costs"][s * 4 + t] >= 0] for s in range(4)])
            ranks.append("".join(chr(97 + r) if r >= 0 else "-" for r in ranked))
            illegal += node["illegal"] + (k > 0 and unfit(nodes[k - 1]["last"], node["first"]))
            if node["t_min"] is not None:
                turns += node["turns"] - (before == node["t_min"])
                before = node["t_max"]
        if len(nodes) == 1:
            costs, paths = nodes[0]["costs"], [r if r != "-" else "" for r in ranks[0]]
        else:
            costs, digits = least(steps, 4)
            paths = ["".join(chr(97 + int(h, 16)) for h in f"{d:0{len(nodes)}x}") if c >= 0 else "" for c, d in zip(costs, digits, strict=True)]
        t = [x[c] for x in nodes for c in ("t_min", "t_max") if x[c] is not None]
        return (
            conv, part, leaf, nodes[0]["first"], nodes[-1]["last"], illegal, *[sum(x[c] for x in nodes) for c in ("blank", "duplicate", "truncated")],
            min(t, default=None), max(t, default=None), turns, costs, paths, [x[order] for x in nodes], ranks)

    return grouped.mapInArrow(batches_of(run, arrow_schema(nodes, ddl)), ddl)


def descended(chosen: DataFrame, column: str) -> DataFrame:
    """(conv, <column>, start, path) of the children of nodes of which ``start`` and ``path`` are known."""
    ddl = f"conv {chosen.schema['conv'].dataType.simpleString()}, ways array<struct<child: long, start: int, to: int>>"

    def run(conv, children, ranks, start, path):
        ways, node = [], start
        for child, rank, letter in zip(children, ranks, path, strict=True):
            to = rank.index(letter, node * 4, node * 4 + 4) - node * 4
            ways.append({"child": child, "start": node, "to": to})
            node = to
        return conv, ways

    rows = chosen.select("conv", "children", "ranks", "start", "path").mapInArrow(batches_of(run, arrow_schema(chosen, ddl)), ddl)
    return rows.select("conv", F.explode("ways").alias("way")).select("conv", F.col("way.child").alias(column), "way.start", "way.to")


def on_keys(df: DataFrame, other: DataFrame, keys, how: str = "inner") -> DataFrame:
    on, other = F.lit(True), other.withColumnsRenamed({k: f"o_{k}" for k in keys})
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"o_{k}"))
    return df.join(other, on, how).drop(*[f"o_{k}" for k in keys])


@dataclass
class Repair:
    """``report``: one row per conversation. ``audits``: its letters by leaf. ``edits``: one row per row. ``rows``: the input."""

    report: DataFrame
    audits: DataFrame
    edits: DataFrame
    rows: DataFrame

    def audit(self) -> DataFrame:
        """(conv, audit): all letters of a conversation as one text."""
        pieces = F.sort_array(F.collect_list(F.struct("part", "leaf", "letters")))
        found = self.audits.groupBy("conv").agg(F.array_join(F.transform(pieces, lambda p: p["letters"]), "").alias("audit"))
        ended = on_keys(found, self.report.select("conv", "end"), ["conv"])
        return ended.select("conv", F.concat("audit", F.when(F.col("end") != 0, "I").otherwise("")).alias("audit"))

    def repaired(self) -> DataFrame:
        """(conv, place, turn, role, text): repaired rows. A partition holds whole conversations, in order.

        Texts meet their edits by content in one shuffle, sorted as the edits were, and stream through the task.
        """
        nothing = {"last": F.lit(0), "kind": F.lit(0), AT: F.lit(0).cast("long"), "inserted": F.lit(0), "replaced": F.lit(0)}
        texts = self.rows.withColumns(nothing)
        edits = self.edits.withColumns({"last": F.lit(0), "kind": F.lit(1), "text": F.lit(None).cast("string")})
        ends = self.report.filter("end != 0").select("conv", F.col("end").alias("inserted"), F.lit(1).alias("last"), F.lit(1).alias("kind"), F.lit(0).alias("replaced"))
        every = texts.unionByName(edits).unionByName(ends, allowMissingColumns=True)
        dealt = every.repartition("conv").sortWithinPartitions("conv", "last", "turn", "role", "h1", "h2", "kind", AT)
        ddl = f"conv {self.rows.schema['conv'].dataType.simpleString()}, place long, turn long, role string, text string"
        schema = arrow_schema(self.rows, ddl)

        def run(batches):
            current, place, text, begun = None, 0, None, False
            for b in batches:
                out = []
                for conv, turn, role, kind, inserted, replaced, given in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if not begun or conv != current:
                        current, place, begun = conv, 0, True
                    if kind == 0:
                        text = given
                        continue
                    if inserted:
                        out.append((conv, place, None, EMITTED[inserted], ""))
                        place += 1
                    if replaced:
                        out.append((conv, place, turn, role if replaced == 9 else EMITTED[replaced], text))
                        place += 1
                columns = zip(*out, strict=True) if out else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        return dealt.select("conv", "turn", "role", "kind", "inserted", "replaced", "text").mapInArrow(run, ddl)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest repair of every conversation.

    ``report`` has conv, gaps, blank, duplicate, truncated, illegal, cost and ``end`` (role inserted at the end: 0 for
    none). ``edits`` has the row's content key, its place, ``inserted`` before it and what ``replaced`` it (0: deleted,
    9: kept as it is, else the role's number).
    """
    rows = with_hash(clean_rows(rows, conv, turn, role, text))
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(body == "", BLANK).when(~F.right(body, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(OK)
    laid = laid_out(rows.select(*ROW, fault.alias("fault")), ROW)
    firsts = laid.groupBy("conv", "role", "h1", "h2").agg(F.min(AT).alias(AT)).select(AT, F.lit(True).alias("is_first"))
    initial = F.position(F.substring("role", 1, 1), F.lit("sua"))
    kind = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1)
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("is_first").isNull(), TWICE).otherwise(F.col("fault"))
    coded = laid.join(firsts, AT, "left").withColumn("fault", fault)
    coded = coded.select("conv", "turn", AT, "fault", F.char(kind * 4 + F.col("fault") + 97).alias("code"))
    small = stage(leaves(coded), "turn-leaves")
    middle = stage(merged(small.drop("codes"), ["conv", "part"], "leaf"), "turn-parts")
    whole = merged(middle.drop("children", "ranks"), ["conv"], "part")
    ends = F.array(*[
        F.struct((F.get("costs", F.lit(t)) + c).alias("cost"), F.get("paths", F.lit(t)).alias("path"), F.lit(e).alias("end"), F.get("costs", F.lit(t)).alias("ok"))
        for t, c, e in ((NOTHING, 0, 0), (ASSISTANT, 0, 0), (USER, INSERT, ASSISTANT))])
    best = F.array_min(F.filter(ends, lambda e: e["ok"] >= 0))
    whole = whole.withColumn("best", best)
    gaps = F.coalesce(F.col("t_max") - F.col("t_min") + 1 - F.col("turns"), F.lit(0))
    top = stage(whole.select(
        "conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "best.cost", "best.end", "best.path",
        F.lit(NOTHING).alias("start"), "children", "ranks"), "turn-report")
    report = top.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "end")
    parts = on_keys(middle, descended(top, "part"), ["conv", "part"])
    way = F.get("paths", F.col("start") * 4 + F.col("to"))
    below = descended(parts.withColumn("path", way), "leaf")
    found = on_keys(small, below, ["conv", "leaf"]).withColumn("path", way)
    ddl = f"conv {rows.schema['conv'].dataType.simpleString()}, part long, leaf long, letters string, inserted array<int>, replaced array<int>"

    def run(conv, part, leaf, codes, start, path):
        node, letters, inserted, replaced = start, [], [], []
        for code, digit in zip(codes, path, strict=True):
            to, _, _, before, after = next(e for e in edges(code)[node] if e[2] == int(digit))
            letters.append(LETTERS[int(digit)])
            inserted.append(before)
            replaced.append(9 if digit in "35" else after)
            node = to
        return conv, part, leaf, "".join(letters), inserted, replaced

    decided = found.select("conv", "part", "leaf", "codes", "start", "path").mapInArrow(batches_of(run, arrow_schema(rows, ddl)), ddl)
    decided = stage(decided, "turn-decisions")
    base = laid.groupBy("conv", F.shiftright(AT, LEAF_BITS).alias("leaf")).agg(F.min(AT).alias("base"))
    placed = on_keys(laid.withColumn("leaf", F.shiftright(AT, LEAF_BITS)), on_keys(base, decided.drop("part", "letters"), ["conv", "leaf"]), ["conv", "leaf"])
    index = (F.col(AT) - F.col("base")).cast("int")
    edits = placed.select(*ROW, AT, F.get("inserted", index).alias("inserted"), F.get("replaced", index).alias("replaced"))
    return Repair(report, decided.select("conv", "part", "leaf", "letters"), edits, rows)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256) of ``role:text`` of a conversation's rows, joined by line feeds; rows as ``repaired`` gives them."""
    ddl = f"conv {repaired.schema['conv'].dataType.simpleString()}, sha256 string"
    schema = arrow_schema(repaired, ddl)

    def run(batches):
        begun, current, digest = False, None, None
        for b in batches:
            out = []
            for conv, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not begun or conv != current:
                    if begun:
                        out.append((current, digest.hexdigest()))
                    begun, current, digest = True, conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            columns = zip(*out, strict=True) if out else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((current, digest.hexdigest()), schema, strict=True)], schema=schema)

    return repaired.select("conv", "role", "text").mapInArrow(run, ddl)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults by the hash of conversation and turn: dropped, emptied, cut, repeated, given the role user."""
    some = clean_rows(rows, conv, turn, role, text)
    blank = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    some = some.withColumn("fate", F.crc32(F.concat(blank[0], F.lit(":"), blank[1]).cast("binary")) % 20).filter("fate != 0")
    fate = F.col("fate")
    return some.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.when(fate == 4, "user").otherwise(F.col("role")).alias(role),
        F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias(text),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
