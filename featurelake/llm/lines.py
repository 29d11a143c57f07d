"""Line deduplication: a line that many documents hold stays in one of them.

Texts are split at line feeds, lines get a key (blanks stripped at both ends, A-Z lower-cased), and keys are known by
two 64-bit hashes. One combined aggregate finds the keys in two documents or more, with the largest of them; only lines
of those keys go on. Their distinct documents are counted, and lines of keys in too many are dropped but in the largest
document. Lines that go are gathered per row as positions, and the lines between them are put together again.

NULL and empty texts are one empty line. Rows with a NULL id count as one document, smaller than all others. Rows that
repeat id and text count once and come out as often as they came in. Columns of other names pass through; the columns
added replace any of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import attach, hot_of
from .common import ascii_lower, stage, whole_text

BLANKS = " \t\n\x0b\x0c\r"
DOCUMENTS = 3  # a key in so many documents is dropped from all but one
LEAST = 20  # code points of a key that counts
KEY = ["h1", "h2"]


def lowered(line: Column) -> Column:
    """A-Z lower-cased; ``lower`` does just that, and faster, where there are no other letters."""
    return F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(ascii_lower(line))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def keyed_lines(docs: DataFrame, id: str, text: str, least: int) -> DataFrame:
    """(doc, h, at, h1, h2): lines whose key counts, by document and hash of the whole text."""
    body = whole_text(text)
    rows = docs.select(F.col(id).alias("doc"), F.xxhash64(body).alias("h"), F.posexplode(lines_of(body)).alias("at", "line"))
    rows = rows.withColumn("bare", F.btrim("line", F.lit(BLANKS))).filter(F.length("bare") >= least)
    rows = rows.select("doc", "h", "at", lowered(F.col("bare")).alias("key"))
    return rows.select("doc", "h", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def keepers(lines: DataFrame) -> DataFrame:
    """Keys in two documents or more, with the largest of them and the number of their lines."""
    found = lines.groupBy(*KEY).agg(
        F.min("doc").alias("first"), F.max("doc").alias("keeper"), F.bool_or(F.col("doc").isNull()).alias("none"), F.count(F.lit(1)).alias("n"))
    return found.filter(F.col("keeper").isNotNull() & (F.col("none") | (F.col("first") < F.col("keeper")))).drop("first", "none")


def dropped_lines(lines: DataFrame, documents: int) -> DataFrame:
    """(doc, h, at) of the lines that go; lines of keys with very many are dealt over as many tasks as they need."""
    found = stage(keepers(lines), "line-keepers")
    hot = hot_of(found, KEY, "n")
    shared = attach(lines, found.drop("n"), KEY, hot, "inner", null_safe=False)
    shared = stage(shared.filter(F.col("doc").isNull() | (F.col("doc") < F.col("keeper"))).drop("keeper"), "shared-lines")
    others = shared.select(*KEY, "doc").distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    many = others.filter(F.col("n") >= documents - 1).select(*KEY)  # the keeper is not among the others
    return attach(shared, many, KEY, hot, "inner", null_safe=False).select("doc", "h", "at")


def between(lines: Column, gone: Column) -> Column:
    """The lines but those at the ascending positions ``gone``: the slices between them, put together."""
    ends = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    gaps = F.transform(
        F.sequence(F.lit(1), F.size(gone) + 1),
        lambda k: F.slice(lines, F.get(ends, k - 1) + 2, F.get(ends, k) - F.get(ends, k - 1) - 1))
    return F.flatten(gaps)


def dedupe_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", documents: int = DOCUMENTS, least: int = LEAST) -> DataFrame:
    """The documents with their text less the lines that go, and ``n_lines``, ``n_dropped`` (long).

    A key of at least ``least`` code points in at least ``documents`` documents stays only in the one of the largest id.
    """
    gone = dropped_lines(stage(keyed_lines(docs, id, text, least), "line-keys"), documents)
    gone = gone.distinct().groupBy("doc", "h").agg(F.sort_array(F.collect_list("at")).alias("__gone"))
    gone = gone.withColumnsRenamed({"doc": "__doc", "h": "__h"})
    body = whole_text(text)
    rows = docs.withColumn("__hash", F.xxhash64(body))
    rows = rows.join(gone, F.col(id).eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__h")), "left")
    rows = rows.withColumn("__lines", lines_of(body))
    kept = F.when(F.col("__gone").isNull(), body).otherwise(F.array_join(between(F.col("__lines"), F.col("__gone")), "\n"))
    rows = rows.withColumns({
        "n_lines": F.size("__lines").cast("long"), "n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("long"), text: kept})
    return rows.drop("__hash", "__doc", "__h", "__lines", "__gone")
