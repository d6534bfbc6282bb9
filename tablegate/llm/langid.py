"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Two gated recurrent layers read a window of bytes from either side; at every position their states give a probability
for each language, and the document's probability pools those of its letters over all windows, that is, over the whole
text. The network is trained by backpropagation through time on windows from a bounded sample of labelled documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.store import bounded_batches
from tablegate.llm.text import buffers, chunks

HIDDEN = 8
WINDOW = 96  # bytes read together; the last window of a text is padded
SAMPLE_DOCS = 2400  # labelled documents learned from, the smallest hashes of doc_id
DOC_WINDOWS = 12  # windows drawn from all over each of them
STEPS, BATCH, RATE = 350, 256, 0.02
SEED = 5
TOGETHER = 1024  # windows read side by side
UNDETERMINED = "und"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights by name; ``in_*`` holds the gates' input per byte, so reading a byte is a table lookup."""

    def __init__(self, languages: list[str], weights: dict[str, np.ndarray] | None = None) -> None:
        self.languages = languages
        draw = np.random.default_rng(SEED)
        small = lambda *shape: (draw.normal(size=shape) * 0.2).astype(np.float32)
        h = HIDDEN
        self.weights = weights or {
            "in_f": small(256, 3 * h), "rec_f": small(h, 3 * h), "bias_f": np.zeros(h, np.float32),
            "in_b": small(256, 3 * h), "rec_b": small(h, 3 * h), "bias_b": np.zeros(h, np.float32),
            "out": small(2 * h, len(languages)), "bias": np.zeros(len(languages), np.float32),
        }

    def _layer(self, side: str, data: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each of the (time, window) bytes, in the order given."""
        w, u, bias = (self.weights[f"{k}_{side}"] for k in ("in", "rec", "bias"))
        h = HIDDEN
        state = np.zeros((data.shape[1], h), np.float32)
        out = np.empty((*data.shape, h), np.float32)
        for t in range(len(data)):
            given = w[data[t]]
            back = state @ u
            gates = _sigmoid(given[:, : 2 * h] + back[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            inner = back[:, 2 * h :] + bias
            new = np.tanh(given[:, 2 * h :] + reset * inner)
            if keep is not None:
                keep.append((state, update, reset, inner, new))
            state = new + update * (state - new)
            out[t] = state
        return out

    def scores(self, data: np.ndarray) -> np.ndarray:
        """Log-probabilities (time, window, language) of every position."""
        forward, backward = self._layer("f", data), self._layer("b", data[::-1])[::-1]
        w = self.weights["out"]
        logits = forward @ w[:HIDDEN] + backward @ w[HIDDEN:] + self.weights["bias"]
        logits -= logits.max(-1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(-1, keepdims=True))

    def gradients(self, data: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over weighted positions and its gradients, back through every step of both layers."""
        kept_f: list = []
        kept_b: list = []
        forward, backward = self._layer("f", data, kept_f), self._layer("b", data[::-1], kept_b)[::-1]
        both = np.concatenate([forward, backward], -1)
        logits = both @ self.weights["out"] + self.weights["bias"]
        logits -= logits.max(-1, keepdims=True)
        chances = np.exp(logits)
        chances /= chances.sum(-1, keepdims=True)
        share = weight / max(weight.sum(), 1e-9)
        at = np.arange(data.shape[1])
        loss = -float((np.log(chances[:, at, labels] + 1e-9) * share).sum())
        wrong = chances
        wrong[:, at, labels] -= 1
        wrong *= share[:, :, None]
        flat = wrong.reshape(-1, wrong.shape[-1])
        found = {"out": both.reshape(-1, both.shape[-1]).T @ flat, "bias": flat.sum(0)}
        states = wrong @ self.weights["out"].T
        found |= self._back("f", data, kept_f, states[..., :HIDDEN])
        found |= self._back("b", data[::-1], kept_b, states[::-1, :, HIDDEN:])
        return loss, found

    def _back(self, side: str, data: np.ndarray, kept: list, given: np.ndarray) -> dict[str, np.ndarray]:
        w, u = self.weights[f"in_{side}"], self.weights[f"rec_{side}"]
        h = HIDDEN
        d_in, d_rec, d_bias = np.zeros_like(w), np.zeros_like(u), np.zeros(h, np.float32)
        later = np.zeros_like(given[0])
        for t in range(len(data) - 1, -1, -1):
            state, update, reset, inner, new = kept[t]
            d = given[t] + later
            d_new = d * (1 - update) * (1 - new * new)
            d_update = d * (state - new) * update * (1 - update)
            d_reset = d_new * inner * reset * (1 - reset)
            d_inner = d_new * reset
            d_back = np.concatenate([d_update, d_reset, d_inner], 1)
            d_rec += state.T @ d_back
            d_bias += d_inner.sum(0)
            np.add.at(d_in, data[t], np.concatenate([d_update, d_reset, d_new], 1))
            later = d * update + d_back @ u.T
        return {f"in_{side}": d_in, f"rec_{side}": d_rec, f"bias_{side}": d_bias}


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS) -> Network:
    """Adam on balanced batches; windows are (n, WINDOW) bytes, 0 for padding, labels places in languages."""
    network = Network(languages)
    draw = np.random.default_rng(SEED)
    mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
    square = {k: np.zeros_like(v) for k, v in network.weights.items()}
    of = [np.flatnonzero(labels == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        chosen = np.concatenate([draw.choice(rows, BATCH // len(languages) + 1) for rows in of])
        data = windows[chosen].T
        _, found = network.gradients(data, labels[chosen], _LETTER[data].astype(np.float32))
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        size = max(1.0, float(np.sqrt(sum((g * g).sum() for g in found.values()))))
        for name, g in found.items():
            g = g / size
            mean[name] = 0.9 * mean[name] + 0.1 * g
            square[name] = 0.99 * square[name] + 0.01 * g * g
            ahead, spread = mean[name] / (1 - 0.9**step), square[name] / (1 - 0.99**step)
            network.weights[name] = (network.weights[name] - rate * ahead / (np.sqrt(spread) + 1e-6)).astype(np.float32)
    return network


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts as padded windows, and the text of each window."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[:-1][owner] + (np.arange(len(owner)) - first) * WINDOW
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < offsets[1:][owner][:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(np.uint8), owner


def probabilities(network: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, language): the mean log-probability over all letters of a text, normalised. Without letters all equal."""
    windows, owner = windows_of(data, offsets)
    n, languages = len(offsets) - 1, len(network.languages)
    sums, letters = np.zeros((n, languages)), np.zeros(n)
    for start in range(0, len(windows), TOGETHER):
        part = windows[start : start + TOGETHER].T
        letter = _LETTER[part]
        per_window = np.einsum("twl,tw->wl", network.scores(np.ascontiguousarray(part)), letter.astype(np.float32))
        own = owner[start : start + TOGETHER]
        np.add.at(sums, own, per_window)
        np.add.at(letters, own, letter.sum(0))
    pooled = sums / np.maximum(letters, 1)[:, None]
    chances = np.exp(pooled - pooled.max(1, keepdims=True))
    return chances / chances.sum(1, keepdims=True)


def bounded_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows of the smallest hashes of a key, and of the whole row where keys are equal or missing.

    Only rows that are equal in everything share the last hash, so which of these are taken makes no difference.
    """
    h = F.struct(F.xxhash64(F.col(key), F.lit(SEED)).alias("of_key"), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).alias("of_row"))
    smallest = [r["h"] for r in rows.select(h.alias("h")).orderBy("h").limit(n).collect()]
    if not smallest:
        return rows.limit(0)
    last = F.struct(*[F.lit(smallest[-1][c]).alias(c) for c in ("of_key", "of_row")])
    return rows.filter(h < last).unionAll(rows.filter(h == last).limit(smallest.count(smallest[-1])))


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """A network from (doc_id, text, lang); null langs and texts are passed over. None without anything to learn.

    At most ``sample_docs`` documents are used, and of each at most ``DOC_WINDOWS`` windows, so what reaches the driver
    is bounded; the windows are drawn from the whole text.
    """
    rows = bounded_batches(labelled).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sample = bounded_sample(rows, "doc_id", sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            data, offsets = buffers(piece.column(1))
            windows, owner = windows_of(data, offsets)
            names = piece.column(2).to_pylist()
            chosen = []
            for doc, (a, b) in enumerate(zip(np.searchsorted(owner, np.arange(len(names))), np.searchsorted(owner, np.arange(len(names)), "right"))):
                places = np.random.default_rng([SEED, zlib.crc32(data[offsets[doc] : offsets[doc + 1]])]).permutation(np.arange(a, b))[:DOC_WINDOWS]
                chosen += [(names[doc], windows[p].tobytes()) for p in places if _LETTER[windows[p]].any()]
            if chosen:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*chosen), (pa.string(), pa.binary()))], ["lang", "bytes"])

    drawn = sorted((r["lang"], bytes(r["bytes"])) for r in sample.mapInArrow(run, "lang string, bytes binary").collect())
    if not drawn:
        return None
    languages = sorted({lang for lang, _ in drawn})
    windows = np.frombuffer(b"".join(b for _, b in drawn), np.uint8).reshape(-1, WINDOW)
    place = {lang: k for k, lang in enumerate(languages)}
    return train(windows, np.array([place[lang] for lang, _ in drawn]), languages)


def predict(docs: DataFrame, network: Network | None, columns: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the language and its score (0 to 1) in the two named columns, which replace columns of these names.

    Only ``text`` is read, all of it. Null texts, texts without a letter, and everything if there is no network, are
    ``und`` with score 0. Equal probabilities go to the language that sorts first.
    """
    language, score = columns
    rest = bounded_batches(docs).drop(language, score)
    if network is None:
        return rest.withColumn(language, F.lit(UNDETERMINED)).withColumn(score, F.lit(0.0))
    key = f"found_{uuid4().hex}"  # no column of the caller's has this name
    languages, weights = network.languages, network.weights

    @F.pandas_udf("language string, score double")
    def label(texts):
        import pandas as pd

        column = pa.array(texts, pa.string(), from_pandas=True)
        known, scores = [], []
        reader = Network(languages, weights)
        for piece in chunks(iter([pa.RecordBatch.from_arrays([column], ["text"])]), "text"):
            chances = probabilities(reader, *buffers(piece.column(0)))
            known += [languages[k] for k in chances.argmax(1)]
            scores += chances.max(1).tolist()
        return pd.DataFrame({"language": pd.Series(known, dtype=object), "score": pd.Series(scores, dtype=float)})

    text = F.col("text").cast("string")
    told = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    # Called nondeterministic, lest a filter on the result has Spark compute it once more.
    found = rest.withColumn(key, label.asNondeterministic()(text))
    return found.select(
        *[F.col(f"`{c}`") for c in rest.columns],
        F.when(told, F.col(key)["language"]).otherwise(UNDETERMINED).alias(language),
        F.when(told, F.col(key)["score"]).otherwise(0.0).alias(score),
    )
