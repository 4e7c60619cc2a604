"""Language identification with a byte convolutional network, trained in numpy.

Windows of ``WINDOW`` bytes are embedded, convolved with filters of several widths,
max-pooled over places and classified by softmax. The network learns from a
bounded, documented sample of labelled windows (``SAMPLE_PER_LANGUAGE`` distinct texts per
language at most, chosen by hash over all labelled documents) that one task holds;
its weights are a few hundred kilobytes, whatever the input. Every window of every
whole text is predicted: a document's scores are the mean of its windows' log
probabilities.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipforge.llm.common import broadcast_if_small, stored, text_bytes

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 24
EMBEDDING = 8
#: Bounds of the training sample: distinct texts per language, distinct texts in all (with more
#: languages each has fewer, one at least), and windows of each text, evenly spread over it.
SAMPLE_PER_LANGUAGE = 600
SAMPLE = 38_400
WINDOWS_PER_DOCUMENT = 3
EPOCHS = 6
RATE = 0.004
BATCH = 64
#: Windows scored at once.
CHUNK = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class ByteCnn:
    """Multi-width convolutions over byte embeddings, max pooling, softmax."""

    def __init__(self, labels: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.labels = labels
        normal = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        self.w = {"emb": normal(256, EMBEDDING, scale=0.5)}
        for k in WIDTHS:
            self.w[f"conv{k}"] = normal(k * EMBEDDING, FILTERS, scale=(2 / (k * EMBEDDING)) ** 0.5)
            self.w[f"bias{k}"] = np.zeros(FILTERS, np.float32)
        self.w["out"] = normal(len(WIDTHS) * FILTERS, len(labels), scale=0.1)
        self.w["out_bias"] = np.zeros(len(labels), np.float32)

    def _forward(self, x: np.ndarray):
        """Logits of byte windows (n, WINDOW) and what the backward pass needs."""
        e = self.w["emb"][x]
        pooled, keep = [], []
        for k in WIDTHS:
            cols = np.lib.stride_tricks.sliding_window_view(e, k, axis=1)  # n, places, EMBEDDING, k
            cols = cols.transpose(0, 1, 3, 2).reshape(len(x), -1, k * EMBEDDING)
            z = cols @ self.w[f"conv{k}"] + self.w[f"bias{k}"]
            best = z.argmax(axis=1)
            top = np.take_along_axis(z, best[:, None, :], 1)[:, 0, :]
            pooled.append(np.maximum(top, 0))
            keep.append((cols, best, top))
        h = np.concatenate(pooled, 1)
        return h @ self.w["out"] + self.w["out_bias"], h, keep

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Scores of windows. A filter's response is a sum of one table entry per byte, so
        the tables (byte x filter) are made once and only looked up."""
        pooled = []
        for k in WIDTHS:
            conv = self.w[f"conv{k}"].reshape(k, EMBEDDING, FILTERS)
            places = x.shape[1] - k + 1
            z = (self.w["emb"] @ conv[0])[x[:, :places]]
            for j in range(1, k):
                z += (self.w["emb"] @ conv[j])[x[:, j:j + places]]
            pooled.append(np.maximum(z.max(axis=1) + self.w[f"bias{k}"], 0))
        logits = np.concatenate(pooled, 1) @ self.w["out"] + self.w["out_bias"]
        logits -= logits.max(1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True))

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        logits, h, keep = self._forward(x)
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        g = {"out": h.T @ p, "out_bias": p.sum(0), "emb": np.zeros_like(self.w["emb"])}
        dh = p @ self.w["out"].T
        for i, k in enumerate(WIDTHS):
            cols, best, top = keep[i]
            d = dh[:, i * FILTERS:(i + 1) * FILTERS] * (top > 0)
            picked = np.take_along_axis(cols, best[:, :, None], 1)  # n, FILTERS, k * EMBEDDING
            g[f"conv{k}"] = np.einsum("nfc,nf->cf", picked, d)
            g[f"bias{k}"] = d.sum(0)
            back = d[:, :, None] * self.w[f"conv{k}"].T[None]
            where = x[np.arange(len(x))[:, None, None], best[:, :, None] + np.arange(k)[None, None]]
            np.add.at(g["emb"], where.ravel(), back.reshape(-1, EMBEDDING))
        return g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        """Adam over shuffled batches; the rate falls to zero."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(a) for k, a in self.w.items()}
        total, t = epochs * -(-len(x) // BATCH), 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for s in range(0, len(x), BATCH):
                rows = order[s:s + BATCH]
                t += 1
                rate = RATE * (1 - t / (total + 1))
                for k, g in self._gradients(x[rows], y[rows]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = (self.w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts (A-Z lower-cased, the last of a text padded with spaces), and
    the number of the text of each."""
    sizes = np.diff(offsets)
    n = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), n)
    first = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n
    start = offsets[:-1][doc] + (np.arange(len(doc)) - first[doc]) * WINDOW
    at = start[:, None] + np.arange(WINDOW)
    inside = at < offsets[1:][doc][:, None]
    x = np.full(at.shape, 32, np.uint8)
    x[inside] = _LOWER[data[at[inside]]]
    return x, doc


def _train(labels: list[str]):
    number = {x: i for i, x in enumerate(labels)}

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("lang", "ascending"), ("pick", "ascending"), ("text", "ascending")])
        data, offsets = text_bytes(rows.column("text"))
        x, doc = windows(data, offsets)
        use = np.concatenate([[True], doc[1:] != doc[:-1]])  # a piece of WINDOW characters has at least one window
        y = np.array([number[v] for v in rows.column("lang").to_pylist()], np.int64)
        x, y = x[use], y[doc[use]]
        net = ByteCnn(labels)
        even = _evened(y)
        net.train(x[even], y[even])
        return pa.table({"model": pa.array([pickle.dumps(net)], pa.binary())})
    return run


def _evened(y: np.ndarray) -> np.ndarray:
    """Rows of the sample with those of each class repeated to the size of the largest, so a
    language of few distinct texts is learned beside one of many."""
    count = np.bincount(y)
    return np.concatenate([np.resize(np.flatnonzero(y == c), count.max()) for c in np.flatnonzero(count)])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", pick: Column | None = None) -> bytes | None:
    """A trained network, pickled; None if no document has a language and a letter.

    Every language is learned. The sample: per language, the distinct texts with the smallest
    hashes, as many as the bounds allow, so a text that repeats counts once and no language
    goes without."""
    d = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).alias("lang")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    names = sorted(r["lang"] for r in d.select("lang").distinct().collect())  # the classes of the network
    if not names:
        return None
    d = d.withColumn("pick", F.xxhash64("text"))
    each = max(1, min(SAMPLE_PER_LANGUAGE, SAMPLE // len(names)))
    # Cut per task before the shuffle: a language of a third of all rows sends a few rows a task.
    first = F.row_number().over(Window.partitionBy("lang").orderBy("pick"))
    picked = d.select("lang", "pick").distinct().withColumn("_n", first).where(F.col("_n") <= each)
    room = F.greatest(F.length("text") - WINDOW, F.lit(0))
    pieces = F.array(*[F.substr("text", (room * (2 * k + 1) / (2 * WINDOWS_PER_DOCUMENT)).cast("int") + 1, F.lit(WINDOW)) for k in range(WINDOWS_PER_DOCUMENT)])
    sample = (d.join(broadcast_if_small(stored(picked.select("lang", "pick"), "language_sample"), 64), ["lang", "pick"], "left_semi")
              .dropDuplicates(["lang", "pick"]).select("lang", "pick", F.explode(F.array_distinct(pieces)).alias("text")))
    model = stored(sample.groupBy(F.lit(0).alias("one")).applyInArrow(_train(names), "model binary"), "language_model").first()
    return model["model"] if model else None


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = pickle.loads(model.value)
        k = len(net.labels)
        for rows in batches:
            data, offsets = text_bytes(rows.column(1))
            total, count = np.zeros((len(rows.column(1)), k)), np.zeros(len(rows.column(1)))
            d = 0
            while d < len(offsets) - 1:  # documents of about CHUNK windows at a time
                e = max(d + 1, int(np.searchsorted(offsets, offsets[d] + CHUNK * WINDOW, "right")) - 1)
                for s in range(int(offsets[d]), max(int(offsets[e]), int(offsets[d]) + 1), CHUNK * WINDOW):
                    z = min(s + CHUNK * WINDOW, int(offsets[e]))
                    x, doc = windows(data, np.clip(offsets[d:e + 1], s, z))
                    if len(x):
                        for c, scores in enumerate(net.log_probabilities(x).T):
                            total[:, c] += np.bincount(d + doc, scores, minlength=len(count))
                        count += np.bincount(d + doc, minlength=len(count))
                d = e
            mean = np.exp(total / np.maximum(count, 1)[:, None])
            mean /= mean.sum(1, keepdims=True)
            best = mean.argmax(1)
            known = rows.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array([net.labels[b] if ok else "und" for b, ok in zip(best.tolist(), known, strict=True)], pa.string()),
                pa.array(np.where(known, mean.max(1), 0.0))], ["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: bytes | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score per document; ``und`` with score 0 for null text, text without a
    letter, or without a model. Every row is judged by its text alone."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    src = src.withColumn("known", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    if model is None:
        return src.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return src.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """The contract's fold: crc32 of the id as text, modulo 4, is 2. A null id is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
