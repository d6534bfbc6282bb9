"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A text is a sequence of words: runs of letters, of digits, or of signs. Its features are hashed word pairs and single
words with their share among all of the text's n-grams, so long and short texts weigh alike, and two that stand for
repetition: words that repeat the one before, and runs of three words met before in the text. A score is a sparse dot
product with the learned weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.langid import bounded_sample
from tablegate.llm.store import bounded_batches
from tablegate.llm.text import buffers, chunks, mix, runs, shingles, span_hashes

BITS = 18  # of a feature's number
SAMPLE_DOCS = 3000  # labelled documents learned from, the smallest hashes of doc_id
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
SCALE = 10.0  # of the shares, so that usual weights stay near 1
THRESHOLD = 0.3
SAME, AGAIN, BIAS = 0, 1, 2  # features with numbers of their own
OWN_FEATURES = 3

_KIND = np.full(256, 3, np.uint8)  # by byte: 0 white space, 1 letter, 2 digit, 3 sign
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_KIND[48:58] = 2


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and their bounds by text."""
    kinds = _KIND[data]
    found = [runs(kinds == k, offsets) for k in (1, 2, 3)]
    starts = np.concatenate([s for s, _ in found])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.concatenate([e for _, e in found])[order]
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _repeats(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, how many runs of three words equal an earlier one of the same text."""
    three, cuts = shingles(hashes, bounds, 3)
    owner = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)).astype(np.uint64)
    keyed = mix(three + owner * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed, kind="stable")
    again = np.zeros(len(keyed), bool)
    again[order[1:]] = keyed[order[1:]] == keyed[order[:-1]]
    counts = np.concatenate([[0], np.cumsum(again)])
    return counts[cuts[1:]] - counts[cuts[:-1]]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of each text's n-grams with their bounds, and the shares of the two signs of repetition."""
    hashes, bounds = _words(data, offsets)
    pairs, cuts = shingles(hashes, bounds, 2)
    size = np.uint64((1 << BITS) - OWN_FEATURES)
    place = lambda values: (values % size).astype(np.int64) + OWN_FEATURES
    counts = np.diff(bounds)
    owner = np.concatenate([np.repeat(np.arange(len(counts)), counts), np.repeat(np.arange(len(counts)), np.diff(cuts))])
    order = np.argsort(owner, kind="stable")
    numbers = np.concatenate([place(hashes), place(pairs)])[order]
    total = np.concatenate([[0], np.cumsum(counts + np.diff(cuts))])
    words = np.maximum(counts, 1)
    following = np.zeros(len(hashes), bool)
    following[1:] = hashes[1:] == hashes[:-1]
    following[bounds[:-1][counts > 0]] = False
    sums = np.concatenate([[0], np.cumsum(following)])
    return numbers, total, (sums[bounds[1:]] - sums[bounds[:-1]]) / words, _repeats(hashes, bounds) / words


def scores(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each text; an empty text has the bias alone."""
    numbers, bounds, same, again = features(data, offsets)
    sums = np.concatenate([[0.0], np.cumsum(weights[numbers], dtype=np.float64)])
    shares = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)
    total = SCALE * (shares + weights[SAME] * same + weights[AGAIN] * again) + weights[BIAS]
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def train(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of (numbers, values) examples by per-coordinate follow-the-regularised-leader updates."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * L1 - z[at]
        return np.where(np.abs(z[at]) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    draw = np.random.default_rng(1)
    for _ in range(epochs):
        for i in draw.permutation(len(examples)):
            at, values = examples[i]
            w = weights(at)
            chance = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            slope = (chance - labels[i]) * values
            root = np.sqrt(n[at])
            n[at] += slope * slope
            z[at] += slope - (np.sqrt(n[at]) - root) / ALPHA * w
    return weights(np.arange(1 << BITS)).astype(np.float32)


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Weights from (doc_id, text, label), label 0 or 1; rows with another or no label or text are passed over.

    At most ``sample_docs`` documents are used, whole; what reaches the driver is bounded by their sizes. Without rows of
    both labels all weights are 0.
    """
    rows = bounded_batches(labelled).select("doc_id", F.col("text").cast("string").alias("text"), F.col("label").cast("int").alias("label"))
    rows = rows.filter("label IN (0, 1) AND text IS NOT NULL")
    sample = bounded_sample(rows, "doc_id", sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            numbers, bounds, same, again = features(*buffers(piece.column(1)))
            found = []
            for a, b, s, g in zip(bounds, bounds[1:], same, again):
                at, counts = np.unique(numbers[a:b], return_counts=True)
                values = SCALE * np.concatenate([[s, g, 1 / SCALE], counts / max(1, b - a)])
                found.append((np.concatenate([[SAME, AGAIN, BIAS], at]).astype("<i4").tobytes(), values.astype("<f4").tobytes()))
            at, values = (pa.array(c, pa.binary()) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), at, values], ["doc_id", "label", "at", "values"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    drawn = sample.mapInArrow(run, f"doc_id {kind}, label int, at binary, values binary").collect()
    drawn.sort(key=lambda r: (str(r["doc_id"]), bytes(r["at"])))
    labels = np.array([r["label"] for r in drawn], float)
    if len(set(labels.tolist())) < 2:
        return np.zeros(1 << BITS, np.float32)
    examples = [(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["values"], "<f4").astype(float)) for r in drawn]
    return train(examples, labels)


def predict(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """docs with score and predicted (1 from the threshold on), which replace columns of these names.

    Only ``text`` is read, all of it; null is empty, and an empty text has the score of the bias.
    """

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        column = pa.array(texts, pa.string(), from_pandas=True)
        pieces = chunks(iter([pa.RecordBatch.from_arrays([column], ["text"])]), "text")
        return pd.Series(np.concatenate([scores(weights, *buffers(p.column(0))) for p in pieces] or [np.empty(0)]))

    # Called nondeterministic, lest a filter on the result has Spark compute it once more.
    scored = bounded_batches(docs).withColumn("score", score.asNondeterministic()(F.col("text").cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
