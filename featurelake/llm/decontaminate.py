"""Short test items inside long documents: size-partitioned MinHash containment search, then exact containment.

Items are partitioned by the number of their shingles. The sketch of an item is the part of its shingles with the least
hash values (a bottom-k MinHash), and the partition fixes how many: with n shingles, of which at least a share t must
occur in a document, any n - ceil(t n) + 1 of them include one that occurs, so a document that contains the item always
meets its sketch and no hash count can miss it. A document probes the partitions that its own size allows. What meets is
then counted exactly on the shingles themselves.

Words are runs of letters and digits, lower-cased. A shingle is ``width`` words; an item with fewer words is one shingle of
all of them. Items without words, NULL texts and empty texts match nothing. Documents and items are known by the hash of id and
text, so NULL ids are searched and reported as any other; rows that share an id are searched one by one and reported once
if they hold the same text. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, whole_text

WIDTH, SHARE = 5, 0.8
#: Sketch rows up to which the sketches are sent to all executors; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def runs(tokens: Column, width: Column | int) -> Column:
    """All runs of ``width`` words, as text."""
    width = F.lit(width) if isinstance(width, int) else width
    starts = F.when(F.size(tokens) >= width, F.sequence(F.lit(1), F.size(tokens) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, width), " "))


def hashed_runs(hashes: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, from the hashes of the words."""
    starts = F.when(F.size(hashes) >= width, F.sequence(F.lit(0), F.size(hashes) - width)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(width))))


def with_words(df: DataFrame, text: str) -> DataFrame:
    """Adds ``tokens`` and their ``hashes``."""
    df = df.withColumn("tokens", words(whole_text(text)))
    return df.withColumn("hashes", F.transform("tokens", lambda w: F.xxhash64(w)))


def size_class(n: Column) -> Column:
    return F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")


def sketched(items: DataFrame, width: int, share: float) -> DataFrame:
    """(item_id, item, tokens, width, n, least, size_class, sketch) of every item that has words."""
    rows = items.filter(F.size("tokens") > 0).withColumn("width", F.least(F.size("tokens"), F.lit(width)))
    own = hashed_runs(F.col("hashes"), width)
    for w in range(1, width):
        own = F.when(F.col("width") == w, hashed_runs(F.col("hashes"), w)).otherwise(own)
    rows = rows.withColumn("own", F.array_sort(F.array_distinct(own))).withColumn("n", F.size("own"))
    rows = rows.withColumn("least", F.ceil(F.lit(share) * F.col("n") - 1e-9).cast("int"))
    sketch = F.slice("own", F.lit(1), F.col("n") - F.col("least") + 1)
    return rows.select("item_id", "item", "tokens", "width", "n", "least", size_class(F.col("least")).alias("size_class"), sketch.alias("sketch"))


def find(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
         width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared): every document with every item of which it holds the share at least."""
    return held(docs, items, id, text, item, item_text, width, share).drop("key").distinct()


def held(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
         width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """As ``find``, with the ``key`` of the document: the hash of its id and text."""
    named = items.select(F.col(item).alias("item_id"), F.col(item_text).alias("text"))
    named = named.withColumn("item", F.xxhash64("item_id", "text")).dropDuplicates(["item"])
    tests = stage(sketched(with_words(named, "text"), width, share), "test-items")
    keys = tests.select("item", "size_class", F.explode("sketch").alias("hash"))
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    widths = sorted(r[0] for r in tests.select("width").distinct().collect())  # at most ``width`` values
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    probes = with_words(rows, "text")
    every = F.concat(*(hashed_runs(F.col("hashes"), w) for w in widths)) if widths else F.array().cast("array<long>")
    probes = probes.select("key", size_class(F.size("hashes")).alias("doc_class"), F.explode(every).alias("hash"))
    met = probes.join(keys, (probes["hash"] == keys["hash"]) & (keys["size_class"] <= probes["doc_class"]))
    met = stage(met.select("key", "item").distinct(), "test-candidates")
    pairs = rows.join(met, "key").join(tests.select("item_id", "item", F.col("tokens").alias("asked"), "width", "n", "least"), "item")
    # as a generated column, so that the words are made once per row and not again for every run of them
    pairs = pairs.select("doc_id", "key", "item_id", "asked", "width", "n", "least", F.explode(F.array(words(whole_text("text")))).alias("tokens"))
    shared = F.size(F.array_intersect(runs(F.col("tokens"), F.col("width")), runs(F.col("asked"), F.col("width"))))
    pairs = pairs.select("doc_id", "key", "item_id", F.col("n").cast("long").alias("n_shingles"), shared.cast("long").alias("n_shared"), "least")
    return pairs.filter("n_shared >= least").drop("least").distinct()


def clean(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that hold no test item, all columns kept; each row is judged by its own text, whatever its id."""
    gone = held(docs, items, id, text, **options).select(F.col("key").alias("__gone")).distinct()
    return docs.join(gone, F.xxhash64(id, text) == F.col("__gone"), "left_anti")
