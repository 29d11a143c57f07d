"""Toxicity by a classifier chain: linear models predict the categories one after the other, and each sees the
probabilities that the earlier ones gave.

While training, the earlier probabilities are out-of-fold: each row's come from a model that did not see the row, so
that later models do not learn to trust them too much. Features are the presence of whole words and of their first
four bytes (inflected forms share them), known by hash; whole texts are read. Only features that the classes clearly
differ in have a weight; they are kept as a sorted list of hashes, so that words of no weight do not fall together with them.

A long text is not judged by the sum of all it holds, which grows with its length: it is scored in overlapping passages
of ``PASSAGE`` words that together cover it, and has the highest chance of any of them.

The training rows are a bounded sample of the labelled rows (``most``, the first by hash), their texts whole, not in
passages; scoring covers every row.
NULL and empty texts have no features. NULL labels and NULL ids do not train. A category with a single class among its
labels has that class's share as probability everywhere; without any labels it is 0. Repeated rows are scored each, and
all columns of the documents are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .words import MARKS, Texts, mix, released, slices, substring_hashes

STEM = 4
#: Bits of a feature's hash; the rest of 64 bits number the passages that are treated together.
BITS = 40
#: Words of a passage; each begins half a passage after the one before.
PASSAGE = 512
#: Documents of at least this probability are rejected.
REJECT = 0.4
FOLDS, STEPS, RATE, DECAY = 3, 300, 0.1, 1e-5
#: Features take part if this many training rows have them and their share of class 1 is this many deviations off.
LEAST_ROWS, LEAST_DEVIATIONS = 5, 6
MODEL = "left_out int, bias double, features binary, values binary, earlier binary"


@dataclass(frozen=True)
class Weights:
    """The features that have a weight, sorted, and their weights; then one weight per earlier category, and the bias."""

    features: np.ndarray
    values: np.ndarray
    earlier: np.ndarray
    bias: float

    def __len__(self) -> int:
        """The weights, zero ones among them."""
        return (1 << BITS) + len(self.earlier) + 1


@dataclass(frozen=True)
class Chain:
    """Categories in order, and the weights of each."""

    categories: tuple[str, ...]
    weights: tuple[Weights, ...]


def features(texts: Texts, passage: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of all passages, each once per passage and in their order, how many each passage has, and the
    first passage of each text. Without ``passage`` a text is one passage."""
    owner, starts, ends = texts.words(MARKS)
    n = len(texts.starts)
    first = np.arange(n)
    if passage:
        words, half = np.bincount(owner, minlength=n), passage // 2
        many = np.maximum(1, -(-words // half) - 1)
        first = np.cumsum(many) - many
        at = (np.arange(len(owner)) - np.repeat(np.cumsum(words) - words, words)) // half
        own, before = at < many[owner], at > 0  # a word is in the passage that begins in its half, and in the one before
        at = first[owner] + at
        owner, starts, ends = np.concatenate([at[own], at[before] - 1]), *(np.concatenate([x[own], x[before]]) for x in (starts, ends))
        n = int(many.sum())
    sums = texts.sums(fold=True)
    found = [substring_hashes(sums, starts, ends), mix(substring_hashes(sums, starts, np.minimum(ends, starts + STEM)) ^ np.uint64(STEM))]
    keys = np.unique(np.concatenate([owner.astype(np.uint64) << np.uint64(BITS) | h >> np.uint64(64 - BITS) for h in found]))
    counts = np.bincount((keys >> np.uint64(BITS)).astype(np.int64), minlength=n)
    return (keys & np.uint64((1 << BITS) - 1)).astype(np.int64), counts, first


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def margins(weights: Weights, numbers: np.ndarray, counts: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(counts))
    if len(weights.features):
        at = np.minimum(np.searchsorted(weights.features, numbers), len(weights.features) - 1)
        known = weights.features[at] == numbers
        sums = np.bincount(np.repeat(np.arange(len(counts)), counts)[known], weights.values[at[known]], len(counts))
    return sums + earlier @ weights.earlier + weights.bias


def fit(numbers: np.ndarray, counts: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> Weights:
    """Logistic regression by adaptive gradient steps over all rows, on the features that the classes clearly differ in."""
    if not len(y) or y.min() == y.max():
        bias = 30.0 if len(y) and y[0] == 1 else -30.0
        return Weights(np.empty(0, np.int64), np.empty(0), np.zeros(earlier.shape[1]), bias)
    share = y.mean()
    keys, place = np.unique(numbers, return_inverse=True)
    n = len(keys)
    had, of_one = (np.bincount(place, w, n) for w in (None, np.repeat(y, counts)))
    off = np.abs(of_one - had * share) / np.sqrt(np.maximum(had, 1) * share * (1 - share))
    telling = (had >= LEAST_ROWS) & (off >= LEAST_DEVIATIONS)
    row = np.repeat(np.arange(len(y)), counts)[telling[place]]
    place, keys = (np.cumsum(telling) - 1)[place[telling[place]]], keys[telling]
    n = len(keys)
    weights = np.zeros(n + earlier.shape[1] + 1)
    weights[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for k in range(1, STEPS + 1):
        margin = np.bincount(row, weights[place], len(y)) + earlier @ weights[n:-1] + weights[-1]
        error = (logistic(margin) - y) / len(y)
        slope = np.concatenate([np.bincount(place, error[row], n), error @ earlier, [error.sum()]]) + DECAY * weights
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights -= RATE * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
    return Weights(keys, weights[:n], weights[n:-1], float(weights[-1]))


def fitted(k: int, before: list[dict[int, np.ndarray]]):
    """Fits category ``k`` on the rows of all folds but the one that the group leaves out."""

    def run(key, part):
        lists = part.column("numbers").combine_chunks()
        numbers, counts = lists.flatten().to_numpy().astype(np.int64), np.diff(lists.offsets.to_numpy())
        own, y = part.column("fold").to_numpy(), part.column(f"_y{k}").to_numpy()
        earlier = np.zeros((len(y), 0))
        for models in before:  # the chance of each row by the model that left its fold out
            chances = np.zeros(len(y))
            for f in range(FOLDS):
                chances[own == f] = logistic(margins(models[f], numbers, counts, earlier))[own == f]
            earlier = np.column_stack([earlier, chances])
        kept = own != key[0].as_py()
        made = fit(numbers[np.repeat(kept, counts)], counts[kept], earlier[kept], y[kept])
        return pa.table({
            "left_out": pa.array([key[0].as_py()], pa.int32()), "bias": pa.array([made.bias]),
            **{n: pa.array([getattr(made, n).tobytes()], pa.binary()) for n in ("features", "values", "earlier")}})

    return run


def only_telling(sample: DataFrame, truth: list[str]) -> DataFrame:
    """The training rows with those features only that some fit may choose, by one grouped count of all features.

    A fit sees the rows of all folds but one. Its features have enough rows and are far enough off in those; the
    borders are a trifle lower here, as the fit decides for itself.
    """
    lots = [F.col("fold") != f for f in range(FOLDS + 1)]
    sums = {f"{c}_{f}": F.sum(F.when(kept, v)) for f, kept in enumerate(lots) for c, v in (("n", F.lit(1.0)), *((t, F.col(t)) for t in truth))}
    sums = {k: F.coalesce(v, F.lit(0.0)) for k, v in sums.items()}
    whole = sample.agg(*[v.alias(k) for k, v in sums.items()]).first()  # one row of totals
    each = sample.select("row", "fold", *truth, F.explode("numbers").alias("number"))
    counts = each.groupBy("number").agg(*[v.alias(k) for k, v in sums.items()])
    telling = F.lit(False)
    for f in range(FOLDS + 1):
        for t in truth:
            share = whole[f"{t}_{f}"] / whole[f"n_{f}"] if whole[f"n_{f}"] else 0.0
            if 0 < share < 1:
                had, of_one = F.col(f"n_{f}"), F.col(f"{t}_{f}")
                off = F.abs(of_one - had * share) / F.sqrt(had * share * (1 - share))
                telling = telling | (had >= LEAST_ROWS) & (off >= LEAST_DEVIATIONS - 1e-6)
    kept = each.select("row", "number").join(counts.filter(telling).select("number"), "number")
    kept = kept.groupBy("row").agg(F.sort_array(F.collect_list("number")).alias("kept"))
    few = sample.drop("numbers").join(kept, "row", "left")
    return few.select(F.coalesce("kept", F.array().cast("array<bigint>")).alias("numbers"), "fold", *truth)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], *, id: str = "doc_id", text: str = "text",
          most: int = 10_000) -> Chain:
    """Fit the chain; ``categories`` maps each name, in order, to its 0/1 column of ``labels``.

    Rows whose categories are all known train, ``most`` of them at most. The models of the folds and the one of all rows
    are fitted in tasks of their own.
    """
    names = list(categories)
    known = labels.select(F.col(id).alias("_id"), *(c.cast("double").alias(f"_y{k}") for k, c in enumerate(categories.values())))
    known = known.dropna().orderBy(F.xxhash64("_id"), "_id").limit(most)
    truth = [f"_y{k}" for k in range(len(names))]
    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text"))
    rows = rows.join(F.broadcast(known), "_id")  # ``most`` rows of a few numbers
    fold = F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")

    def extracted(batches):
        for b in batches:
            for at, column in slices(b.column(0)):
                numbers, counts, _ = features(Texts(column))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(numbers, pa.int64()))
                yield pa.RecordBatch.from_arrays([lists, *(c.slice(at, len(column)) for c in b.columns[1:])], names=["numbers", "fold", *truth])

    schema = "numbers array<bigint>, fold int, " + ", ".join(f"{t} double" for t in truth)
    sample = rows.select("_text", fold, *truth).mapInArrow(released(extracted), schema)
    sample = stage(sample.withColumn("row", F.monotonically_increasing_id()), "toxicity-sample")
    few = stage(only_telling(sample, truth), "toxicity-telling")
    groups = few.withColumn("left_out", F.explode(F.array(*(F.lit(f) for f in range(FOLDS + 1)))))
    found: list[dict[int, np.ndarray]] = []
    for k in range(len(names)):
        models = groups.groupBy("left_out").applyInArrow(fitted(k, list(found)), MODEL).collect()  # FOLDS + 1 rows
        nothing = fit(np.empty(0, np.int64), np.empty(0, np.int64), np.zeros((0, k)), np.empty(0))
        found.append({f: nothing for f in range(FOLDS + 1)} | {
            r.left_out: Weights(np.frombuffer(r.features, np.int64), np.frombuffer(r["values"]), np.frombuffer(r.earlier), r.bias) for r in models})
    return Chain(tuple(names), tuple(models[FOLDS] for models in found))


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """The documents with a column ``p_<category>`` for every category; it replaces one of that name."""
    names = [f"p_{c}" for c in chain.categories]
    docs = docs.drop(*names)

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index(text)
            parts = []
            for _, column in slices(b.column(at).cast(pa.binary())):
                numbers, counts, first = features(Texts(column), PASSAGE)
                chances = np.zeros((len(counts), 0))
                for weights in chain.weights:
                    chances = np.column_stack([chances, logistic(margins(weights, numbers, counts, chances))])
                parts.append(np.maximum.reduceat(chances, first))
            if parts:
                for name, column in zip(names, np.concatenate(parts).T, strict=True):
                    b = b.append_column(name, pa.array(column))
                yield b

    return docs.mapInArrow(released(run), docs.withColumns({n: F.lit(0.0) for n in names}).schema)


def clean(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not rejected, all columns kept."""
    scored = score(docs, train(docs, labels, label_categories(), id=id, text=text), text)
    return scored.filter(F.col("p_toxic") < REJECT).select(docs.columns)


def label_categories() -> dict[str, Column]:
    """The categories of the ``labels`` table: poor text, then toxic text."""
    return {"poor": 1 - F.col("quality"), "toxic": F.col("toxic")}
