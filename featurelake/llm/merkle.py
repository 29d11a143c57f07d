"""Merkle manifest of a table: a hash tree per group, a tree over the groups' roots, and a proof per row.

Leaves are ranked within their group. Every node is labelled with the interval [lo, hi) of the leaf ranks it covers: a
node of level l covers one run of ``fanout ** l`` ranks, cut off at the group's end. The labels say all that the tree's
shape does, so no pointers are kept and nothing is walked:

* a node's ancestors are the nodes whose intervals contain its own. They are attached by one join of containment,
  bucketed by level: at level l only the node that begins where the run of ``lo`` begins can contain it.
* a node's siblings are what its parent's interval has beyond its own: children that end where it begins, or before,
  stand left of it, the others right.

Trees grow in bands of levels, so that a block, which holds at most BLOCK nodes of the band's lowest level, fits one
task whatever the size of a group, and no bucket of the join is larger. The lowest nodes of a band get the siblings on
their way up the band; the bands, and the tree over the groups, are then strung together from the top.

Hashes are kept as 32 bytes, and enter the hash of their parent as lower-case hex text. Groups are known by a text that is
not NULL, so that the joins keep the partitioning that the aggregates before them made.

Ties of the order are broken by the leaf hash; rows that are equal in everything are leaves of their own. NULL groups
and NULL order values are allowed and come first. A lone leaf is its group's root. Empty tables give empty frames.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import ranked
from .common import stage

BLOCK = 1024
NODE = ["grp", "size", "lo", "hi", "hash"]
CHAIN = "array<struct<left: binary, right: binary>>"


def field(name: str) -> Column:
    """``-`` for NULL, else the UTF-8 length in bytes, a colon and the value."""
    text = F.col(name).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(names) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(n) for n in names]), 256))


def hex_text(c: Column | str) -> Column:
    return F.lower(F.hex(c))


def band_height(fanout: int, block: int) -> int:
    """Levels of a band: as many as a block allows, one at least."""
    height = 1
    while fanout ** (height + 1) <= block:
        height += 1
    return height


def span(level: Column, fanout: int) -> Column:
    """Leaf ranks that a node of a level covers."""
    return F.get(F.array(*[F.lit(fanout**k) for k in range(64) if fanout**k < 1 << 62]), level)


def run_of(lo: Column, width: Column) -> Column:
    """Where the run of ``width`` ranks that holds a rank begins."""
    return lo - lo % width


def grow(base: DataFrame, low: int, height: int, fanout: int) -> DataFrame:
    """Nodes of the levels ``low`` to ``low + height`` over the nodes ``base`` of level ``low``, themselves included."""

    def run(key, block):
        size = block.column("size")[0].as_py()
        nodes = sorted(zip(*(block.column(c).to_pylist() for c in ("lo", "hi", "hash")), strict=True))
        out = [(low, *node) for node in nodes]
        for level in range(low + 1, low + height + 1):
            if size <= fanout ** (level - 1):
                break  # the group's root is reached
            runs: dict[int, list] = {}
            for node in nodes:
                runs.setdefault(node[0] // fanout**level, []).append(node)
            nodes = [(r[0][0], r[-1][1], hashlib.sha256(b"".join(h for *_, h in r).hex().encode()).digest()) for r in runs.values()]
            out += [(level, *node) for node in nodes]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
        group = block.column("grp").take(pa.array([0] * len(out)))
        same = [group, pa.array([size] * len(out), pa.int64())]
        return pa.Table.from_arrays([*same, *columns], names=["grp", "size", "level", "lo", "hi", "hash"])

    blocks = base.select(*NODE).groupBy("grp", run_of(F.col("lo"), F.lit(fanout ** (low + height))).alias("block"))
    return blocks.applyInArrow(run, "grp string, size long, level int, lo long, hi long, hash binary")


def with_siblings(nodes: DataFrame, top: int, fanout: int) -> DataFrame:
    """Nodes below level ``top`` that have a parent, with the hashes of their siblings on either side, in order."""
    below = nodes.filter((F.col("level") < top) & (span(F.col("level"), fanout) < F.col("size")))
    parent = run_of(F.col("lo"), span(F.col("level") + 1, fanout)).alias("parent")
    families = below.groupBy("grp", "level", parent).agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "hash"))).alias("children"))
    rows = families.select("grp", "level", "children", F.explode("children").alias("me"))

    def beyond(side) -> Column:
        return F.reduce(F.filter("children", side), F.lit(b""), lambda h, c: F.concat(h, c["hash"]))

    return rows.select(
        "grp", "level", "me.lo", "me.hi", beyond(lambda c: c["hi"] <= F.col("me.lo")).alias("left"),
        beyond(lambda c: c["lo"] >= F.col("me.hi")).alias("right"))


def chains(base: DataFrame, kin: DataFrame, low: int, height: int, fanout: int) -> DataFrame:
    """For each node of ``base``: the siblings of itself and of the ancestors that the band has, from below."""
    inner = base.select("grp", "lo", "hi", F.explode(F.sequence(F.lit(low), F.lit(low + height - 1))).alias("level"))
    inner = inner.withColumn("bucket", run_of(F.col("lo"), span(F.col("level"), fanout)))
    outer = kin.withColumnsRenamed({c: f"o_{c}" for c in ("grp", "level", "lo", "hi")})
    bucket = (F.col("grp") == F.col("o_grp")) & (F.col("level") == F.col("o_level")) & (F.col("bucket") == F.col("o_lo"))
    contained = (F.col("o_lo") <= F.col("lo")) & (F.col("hi") <= F.col("o_hi"))
    steps = inner.join(outer, bucket & contained).select("grp", "lo", F.struct("level", "left", "right").alias("step"))
    found = steps.groupBy("grp", "lo").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    chain = F.transform("steps", lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right")))
    return found.select("grp", "lo", chain.alias("chain"))


def plant(leaves: DataFrame, fanout: int, block: int) -> tuple[list, DataFrame]:
    """The bands (lowest level, its nodes, their chains) of the trees over ``leaves``, and the root node of each group."""
    height, low, bands, roots = band_height(fanout, block), 0, [], None
    base = leaves
    while True:
        nodes = stage(grow(base, low, height, fanout), "merkle-nodes")
        bands.append((low, base, chains(base, with_siblings(nodes, low + height, fanout), low, height, fanout)))
        top = nodes.filter("lo = 0 AND hi = size").select(*NODE)
        roots = top if roots is None else roots.unionByName(top)
        low += height
        base = nodes.filter((F.col("level") == low) & (F.col("size") > fanout**low)).select(*NODE)
        if base.isEmpty():
            return bands, roots


def strung(bands: list, tops: DataFrame, fanout: int, block: int) -> DataFrame:
    """The leaves with their whole chain; ``tops`` tells for each group (grp, size) what goes on above its root."""
    height, full = band_height(fanout, block), None
    carried = [c for c in tops.columns if c not in ("grp", "size", "chain")]
    for low, base, chain in reversed(bands):
        reach = fanout ** (low + height)
        ends = tops.filter(F.col("size") <= reach).select("grp", F.lit(0).cast("long").alias("run"), F.col("chain").alias("up"), *carried)
        if full is not None:
            ends = ends.unionByName(full.select("grp", F.col("lo").alias("run"), F.col("chain").alias("up"), *carried))
        rows = base.join(chain, ["grp", "lo"], "left").withColumn("run", run_of(F.col("lo"), F.lit(reach)))
        rows = rows.join(ends, ["grp", "run"], "left")
        own = F.coalesce("chain", F.array().cast(CHAIN))
        full = rows.withColumn("chain", F.concat(own, "up")).drop("up", "run")
    return full


def manifest(rows: DataFrame, group: str, order, leaf: str = "leaf", fanout: int = 2, block: int = BLOCK) -> DataFrame:
    """The rows with ``lo``, ``hi`` (their interval), ``subroot`` (root of their group), ``root`` and ``chain``.

    ``leaf`` is the row's hash, as ``leaf_hash`` makes it. ``chain`` has a step for every level on the way to the root:
    the siblings' hashes left and right of the path, each in order and put together. Groups are leaves of the upper tree
    in their own order. Rows carry only the columns given, so select few.
    """
    order, kind = [order] if isinstance(order, str) else list(order), rows.schema[group].dataType
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    named = rows.select(F.struct("*").alias("row"), name.alias("grp"), F.col(leaf).alias("hash"), *[F.col(c).alias(f"o{k}") for k, c in enumerate(order)])
    leaves = ranked(named, ["grp"], [f"o{k}" for k in range(len(order))] + ["hash"], "lo")
    leaves = stage(leaves.select("row", "grp", "size", "lo", (F.col("lo") + 1).alias("hi"), "hash"), "merkle-leaves")
    bands, roots = plant(leaves, fanout, block)
    value = F.when(F.col("grp") != "", F.substr("grp", F.lit(2))).cast(kind)
    upper = ranked(roots.select(F.col("grp").alias("name"), F.col("size").alias("rows"), value.alias("value"), F.lit("").alias("grp"), "hash"), [], ["value"], "lo")
    upper = stage(upper.withColumn("hi", F.col("lo") + 1), "merkle-groups")
    upper_bands, root = plant(upper, fanout, block)
    top = root.select("grp", "size", F.col("hash").alias("root"), F.array().cast(CHAIN).alias("chain"))
    tops = strung(upper_bands, top, fanout, block)
    tops = tops.select(F.col("name").alias("grp"), F.col("rows").alias("size"), F.col("hash").alias("subroot"), "root", "chain")
    full = strung(bands, stage(tops, "merkle-tops"), fanout, block)
    return full.select("row.*", "lo", "hi", "subroot", "root", "chain")


def proof(chain: Column | str) -> Column:
    """All siblings of a chain, level by level, each level from left to right."""
    return F.reduce(chain, F.lit(b""), lambda h, s: F.concat(h, s["left"], s["right"]))


def fold(leaf: Column | str, chain: Column | str) -> Column:
    """The root that a leaf and a chain of siblings lead to."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.reduce(chain, leaf, lambda h, s: F.unhex(F.sha2(hex_text(F.concat(s["left"], h, s["right"])), 256)))
