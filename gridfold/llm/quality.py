"""A quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Words are runs of letters and digits; runs of other marks are words too, so what is glued to a word is seen. Case is
kept; a pair of one word twice is the same feature for all words. Single words and pairs are hashed to 2 ** ``BITS`` features, each with its share of the text's n-grams; a
constant feature stands for the prior and is all that an empty text has. A text's score is the logistic of one
sparse dot product.

Training. FTRL-proximal keeps for each feature the sum of its adjusted gradients and of their squares; the weight is
the regularised leader's closed form, zero below ``L1``. The learner takes a bounded sample of labelled rows, at most
``MOST``: one row for each labelled doc_id, chosen by hash over all labels. Their n-grams are counted where the texts
lie; the learner reads counts, ``EPOCHS`` times in another order each, as one bounded task. The weights, 2 ** BITS
single floats at most, are what scoring tasks get.

Texts are read whole, in slices of bounded size. Training labels come from rows that the caller allows;
nothing but the text enters a score.

Defined cases: a null text is an empty one. Labels other than 0 and 1, without id, or contradicting another label of
that id teach nothing; repeated equal labels count once; of rows that share an id one is learnt from. Without any label,
or with one kind only, scores follow that prior (0.5 without any). Empty tables give empty ones; columns
other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfold.llm import scratch, textvec
from gridfold.llm.tables import ROW, share, with_row

BITS, MOST, EPOCHS = 20, 16_384, 3
#: FTRL's learning rate and its offset, and the penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
#: Shares of n-grams are small; times this a word that is half of a text is worth 5.
SCALE = 10.0
#: Scores from here on count as label 1.
CUT = 0.3
#: What a word that follows itself is hashed as.
TWICE = np.uint64(1)
_WORD, _MARK, _SPACE = 1, 2, 0
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = _WORD


def words(data: np.ndarray) -> np.ndarray:
    """The hashes of a text's words, bytes of one class in a row, in order; in slices that end where a word ends."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + textvec.SLICE)
        kinds = _CLASS[data[at:end]]
        if end < len(data):
            cuts = np.flatnonzero(np.diff(kinds)) + 1
            if len(cuts):
                end = at + int(cuts[-1])
            else:
                while end < len(data) and _CLASS[data[end]] == kinds[-1]:
                    end += 1
                kinds = _CLASS[data[at:end]]
            kinds = kinds[: end - at]
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(kinds)) + 1, [len(kinds)]])
        starts, ends = bounds[:-1], bounds[1:]
        real = kinds[starts] != _SPACE
        out.append(textvec.span_hashes(data[at:end], starts[real], ends[real]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of one text, ascending, and how often each occurs."""
    one = words(data)
    two = textvec.mix(np.where(one[:-1] == one[1:], TWICE, one[:-1] * np.uint64(3) + one[1:]))
    return np.unique((np.concatenate([one, two]) >> np.uint64(64 - BITS)).astype(np.int32), return_counts=True)


def values(counts: np.ndarray) -> np.ndarray:
    return counts * (SCALE / max(int(counts.sum()), 1))


@dataclass
class Model:
    weights: np.ndarray
    prior: float

    def scores(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        out = np.empty(len(bounds) - 1)
        for i in range(len(out)):
            at, counts = features(data[bounds[i] : bounds[i + 1]])
            out[i] = self.prior + float(self.weights[at].astype(np.float64) @ values(counts))
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


class Learner:
    """FTRL-proximal, one row after the other; the last feature is the constant one, without penalty."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, free = self.z[at], at == 1 << BITS
        l1, l2 = np.where(free, 0, L1), np.where(free, 0, L2)
        return np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, 1 << BITS), np.append(x, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -500, 500))) - label) * x
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, bounds in textvec.parts(iter([batch])):
            found = [features(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "label": part.column("label"),
                "features": pa.array([f for f, _ in found], pa.list_(pa.int32())), "counts": pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32())),
            })


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    learner = Learner()
    for batch in batches:
        for label, at, counts in zip(*(batch.column(c) for c in ("label", "features", "counts")), strict=True):
            learner.learn(at.values.to_numpy(), values(counts.values.to_numpy()), label.as_py())
    weights = learner.weights(np.arange((1 << BITS) + 1))
    live = np.flatnonzero(weights)
    yield pa.RecordBatch.from_pydict({"feature": pa.array(live.astype(np.int32)), "weight": pa.array(weights[live])})


def sample(labels: DataFrame, allowed: Column, label_column: str, most: int) -> DataFrame:
    """At most ``most`` ids with one label each. Which ones is a matter of the ids alone."""
    once = labels.where(allowed & F.col("doc_id").isNotNull() & F.col(label_column).isin(0, 1)).groupBy("doc_id")
    clear = once.agg(F.min(label_column).cast("int").alias("label"), F.max(label_column).cast("int").alias("other")).where("label = other").select("doc_id", "label")
    n = clear.count()
    # The expected size is four deviations below the bound, so the limit never cuts; it makes the bound one.
    wanted = clear if n <= most else clear.where(share((most - 4 * most**0.5) / n, "doc_id"))
    return wanted.limit(most)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label_column: str = "quality", most: int = MOST) -> Model:
    """Learns from the labels that ``allowed``, a condition on their doc_id, lets through."""
    chosen = scratch.cut(sample(labels.select("doc_id", label_column), allowed, label_column, most), "quality-labels")
    placed = with_row(docs.select("doc_id", "text"))
    rows = placed.select("doc_id", ROW).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min(ROW).alias(ROW))
    texts = placed.select(ROW, "text").join(F.broadcast(scratch.cut(rows, "quality-rows")), ROW).select("doc_id", "label", "text")
    counted = scratch.cut(texts.mapInArrow(_counted, "doc_id long, label int, features array<int>, counts array<int>"), "quality-counts")
    epochs = counted.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS)))).repartitionByRange(1, "epoch").sortWithinPartitions("epoch", F.xxhash64("doc_id", "epoch"))
    weights = np.zeros((1 << BITS) + 1, np.float32)
    for r in epochs.select("label", "features", "counts").mapInArrow(_learn, "feature int, weight double").toLocalIterator():
        weights[r["feature"]] = r["weight"]
    return Model(weights[:-1], float(weights[-1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in textvec.parts(batches):
            s = model.scores(data, bounds)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": pa.array(s), "predicted": pa.array((s >= CUT).astype(np.int32))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, "doc_id long, score double, predicted int")
