"""Set-similarity join of documents on word shingles, by rare-first prefix filtering.

1. Shingles that no other document has are told from shared ones (``postings``), with how many documents have each.
   A document's shingles are ordered rare first. With n shingles, the first n - ceil(t n) + 1 are its prefix: two
   documents that reach the similarity t share a shingle in their prefixes. A prefix of unshared shingles has no partner.
2. Documents with equal sets form a class, and one stands for it from here on.
3. Prefix shingles are joined. A pair passes the length filter, the positional filter (what can still follow the
   shared shingle in both) and the suffix filter (the sets are parted by hash, and parts overlap by the smaller one at
   most), is made once, and is verified by counting its common shingles.
4. Only components are asked for, so pairs inside one component need not be looked at. In rounds, every document of a
   prefix shingle meets some documents of it, picked at random; a large group of near copies is connected by few such
   rounds, each linear in its size. After the rounds, documents of different components that still share a
   prefix shingle meet all the others of it, the largest component of a shingle never within itself.

Words are what ASCII blanks part, with A-Z lower-cased. A text of fewer words than a shingle is one shingle of all its
words; NULL and blank texts have none and link with nothing. Shingles are compared by 64-bit hashes. A document is known
by its id and text, so repeated rows agree, and rows that share an id but not the text are documents of their own whose
links count for that id. NULL ids take part and have a NULL component unless a linked document has an id. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .components import components
from .postings import Answers, keyed, shared_keys
from .words import Texts, shingles

WIDTH, PERCENT = 5, 80
PARTS = 16
#: Documents of a shingle that all others meet, round by round; what is apart then is looked at in full. In the first
#: round shingles of one family tend to pick the same document, so that few pairs arise.
PICKED, FAMILIES = (1, 32, 128), 8

PROFILE = ("doc_id long, text_hash long, n int, class binary, keys array<long>, prefix array<long>, unshared int, parts array<int>")


def distinct_shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner, hashes = shingles(texts, WIDTH)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    if len(owner):
        kept = np.concatenate([[True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])])
        owner, hashes = owner[kept], hashes[kept]
    return owner, hashes, np.bincount(owner, minlength=len(texts.starts))


def profiled(batch: Answers) -> pa.Table:
    """A row per document; those whose prefix has a shared shingle also get their shared shingles and their prefix."""
    n = batch.sizes.astype(np.int64)
    prefix = n - (n * PERCENT + 99) // 100 + 1
    order = np.lexsort((batch.keys, batch.totals, batch.owners))
    owners, keys = batch.owners[order], batch.keys[order].astype(np.int64)
    shared = np.bincount(owners, minlength=len(n))
    ends = np.cumsum(shared)
    rows = []
    for i in range(len(n)):
        unshared = int(n[i] - shared[i])
        head = (int(batch.ids[i]) if batch.known[i] else None, int(batch.hashes[i]), int(n[i]))
        if unshared >= prefix[i] or not n[i]:
            rows.append((*head, None, None, None, None, None))
            continue
        own = keys[ends[i] - shared[i] : ends[i]]
        whole = np.sort(own)
        alone = batch.hashes[i].tobytes() if unshared else b""  # no other text has the same set then
        name = hashlib.blake2b(whole.tobytes() + alone, digest_size=16).digest()
        rows.append((*head, name, whole, own[: prefix[i] - unshared], unshared, np.bincount(whole & (PARTS - 1), minlength=PARTS)))
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int32()))
    names = [c.split()[0] for c in PROFILE.split(", ")]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def needed(a: Column, b: Column) -> Column:
    """The least number of common shingles of two linked sets."""
    return F.ceil(F.lit(PERCENT) * (a + b) / F.lit(100 + PERCENT) - 1e-9)


def promising(pairs: DataFrame) -> DataFrame:
    """Pairs (x, y: struct<class, n, position>, root_x, root_y) of different roots that pass the length and positional
    filters, each once as (a, b, root_a, root_b), the roots in order."""
    x, y = F.col("x"), F.col("y")
    length = F.lit(100) * F.least(x["n"], y["n"]) >= F.lit(PERCENT) * F.greatest(x["n"], y["n"])
    position = F.least(x["n"] - x["position"], y["n"] - y["position"]) >= needed(x["n"], y["n"])
    out = pairs.filter((F.col("root_x") != F.col("root_y")) & length & position)
    return out.select(
        F.least(x["class"], y["class"]).alias("a"), F.greatest(x["class"], y["class"]).alias("b"),
        F.least("root_x", "root_y").alias("root_a"), F.greatest("root_x", "root_y").alias("root_b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The roots (root_a, root_b) of the pairs that pass the suffix filter and are linked; ``sets`` has class, n, parts and keys."""
    named = lambda c: sets.select(F.col("class").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("n", "parts", "keys")))
    both = pairs.join(named("b"), "b").join(named("a"), "a")
    most = F.aggregate(F.zip_with("parts_a", "parts_b", lambda x, y: F.least(x, y)), F.lit(0), lambda acc, v: acc + v)
    common = F.size(F.array_intersect("keys_a", "keys_b"))
    both = both.filter(most >= needed(F.col("n_a"), F.col("n_b")))
    return both.filter(common * 100 >= PERCENT * (F.col("n_a") + F.col("n_b") - common)).select("root_a", "root_b")


def rooted(sets: DataFrame) -> list[DataFrame]:
    """Tables (node, root) that, one after the other, lead from each class to the least class that links reach."""
    rows = sets.select("class", "n", "unshared", F.posexplode("prefix").alias("at", "key"))
    rows = rows.select("key", F.struct("class", "n", (F.col("at") + F.col("unshared")).alias("position")).alias("doc"))
    several = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    postings = stage(rows.join(several, "key").select("key", "doc", F.col("doc.class").alias("root")), "postings")
    tried, steps = [], []
    for k, slots in enumerate(PICKED):
        # every document of a shingle meets some of them, picked at random: one in each slot
        slot = F.pmod(F.xxhash64("doc.class", F.lit(k)), F.lit(slots)).alias("slot")
        chance = F.xxhash64("doc.class", F.pmod("key", F.lit(FAMILIES)), F.lit(k))
        parted = postings.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a != b").select("key")
        postings = postings.join(parted, "key")
        picked = postings.groupBy("key", slot).agg(F.min_by(F.struct("doc", "root"), chance).alias("pivot"))
        met = postings.join(picked, "key").select(
            F.col("doc").alias("x"), F.col("root").alias("root_x"), F.col("pivot.doc").alias("y"), F.col("pivot.root").alias("root_y"))
        pairs = without(promising(met), tried)
        tried.append(stage(pairs, "pairs"))
        links = stage(verified(tried[-1], sets), "links")
        if links.isEmpty():
            break
        steps.append(components(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))))
        next_ = steps[-1].select(F.col("node").alias("root"), F.col("root").alias("next"))
        postings = postings.join(next_, "root", "left").select("key", "doc", F.coalesce("next", "root").alias("root"))
        postings = stage(postings, "postings")
    sizes = postings.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    parted = sizes.groupBy("key").agg(F.max(F.struct("size", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    parted = stage(parted.filter("roots > 1").select("key", F.col("main.root").alias("main")), "parted-keys")
    open_ = postings.join(parted, "key")
    x = open_.filter("root != main").select("key", F.col("doc").alias("x"), F.col("root").alias("root_x"))
    y = open_.select("key", F.col("doc").alias("y"), F.col("root").alias("root_y"), "main")
    met = x.join(y, "key").filter((F.col("root_y") == F.col("main")) | (F.col("x.class") < F.col("y.class")))
    rest = stage(without(promising(met), tried), "other-pairs")
    links = stage(verified(rest, sets), "other-links")
    return [*steps, components(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))]


def without(pairs: DataFrame, tried: list[DataFrame]) -> DataFrame:
    """The pairs that have not been verified before."""
    for before in tried:
        pairs = pairs.join(before, ["a", "b"], "left_anti")
    return pairs


def join(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row, component_id the least id that links reach."""
    return joined(docs, id, text).select("doc_id", "n_shingles", "component_id")


def joined(docs: DataFrame, id: str, text: str) -> DataFrame:
    """As ``join``, with the hash of the text and a number that the rows of a component share (NULL without words)."""
    profiles = stage(shared_keys(keyed(docs, id, text), distinct_shingles, profiled, PROFILE), "shingle-profiles")
    members = profiles.filter("class IS NOT NULL")
    # one member's row stands for each class
    heads = members.groupBy("class").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash")).alias("head"))
    heads = stage(heads, "classes")
    own = F.col("head.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("head.text_hash") == F.col("text_hash"))
    sets = members.select("doc_id", "text_hash", "class", "n", "keys", "prefix", "unshared", "parts")
    sets = sets.join(heads.select("head", F.col("class").alias("of")), own & (F.col("of") == F.col("class")), "left_semi")
    sets = stage(sets.drop("doc_id", "text_hash").dropDuplicates(["class"]), "class-sets")
    named = heads.select("class", "least").withColumn("root", F.col("class"))
    for roots in rooted(sets):
        named = named.join(roots.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
        named = named.select("class", "least", F.coalesce("next", "root").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(named.join(least, "root").select("class", "root", "component_id"), "class-components")
    rows = profiles.select("doc_id", "text_hash", "n", "class").join(named, "class", "left")
    rows = rows.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "component_id", "root")


def clean(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, all columns kept: the one with the least id, of equal ids that with the least hash
    of its text, and of repeated rows any one. Rows without an id come after all others. Texts without words stay.
    """
    found = joined(docs, id, text)
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    kept = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(name).alias("name")).select("name._id", "name._hash")
    kept = kept.unionByName(found.filter("root IS NULL").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    rows = docs.withColumns({"__id": F.col(id).cast("long"), "__hash": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    first = rows.withColumn("__nth", F.row_number().over(Window.partitionBy("__id", "__hash").orderBy("__hash"))).filter("__nth = 1")
    same = F.col("a.__id").eqNullSafe(F.col("b._id")) & (F.col("a.__hash") == F.col("b._hash"))
    return first.alias("a").join(kept.alias("b"), same, "left_semi").select(*(F.col(f"a.`{c}`") for c in docs.columns))
