"""A byte-level convolutional quality classifier in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import shingles
from tallyforge.llm.common import crc_mod, least_hashed, map_slices, slices

#: Bytes of a window, bytes from one window to the next, numbers per byte, filters, and windows of a chunk.
WINDOW, STRIDE, DIMS, FILTERS, CHUNK = 16, 4, 4, 16, 256
#: Bounds of the training sample: documents of each class, and chunks taken from each.
SAMPLE_DOCS, SAMPLE_CHUNKS = 1000, 8
_EPOCHS, _RATE, _BATCH = 30, 0.01, 64
_CHUNK_BYTES = WINDOW + STRIDE * (CHUNK - 1)


class ByteConv:
    """Probability of label 1 of a text from its bytes.

    Every byte stands for ``DIMS`` learned numbers; learned filters run over windows of ``WINDOW`` bytes, ``STRIDE``
    apart. In each chunk of ``CHUNK`` windows the largest (and the mean) response of each filter is kept. Chunks overlap
    by the bytes that windows share and cover the whole text, the last one padded with zero bytes; their mean and their
    largest values make up the features of one logistic output.
    """

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.p = {"emb": rng.normal(0, 0.5, (256, DIMS)), "filters": rng.normal(0, 1 / np.sqrt(WINDOW * DIMS), (WINDOW * DIMS, FILTERS)),
                  "bias": np.zeros(FILTERS), "out": np.zeros(4 * FILTERS), "out_bias": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    @staticmethod
    def _windows(count: int) -> int:
        return max(1, -(-max(0, count - WINDOW) // STRIDE) + 1)

    def _responses(self, data: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(embedded windows, filter responses) of the first ``count`` windows of ``data``."""
        need = WINDOW + STRIDE * (count - 1)
        held = np.zeros(need, dtype=np.uint8)
        held[:min(need, len(data))] = data[:need]
        emb = self.p["emb"][held]
        view = np.lib.stride_tricks.as_strided(emb, (count, WINDOW * DIMS), (emb.strides[0] * STRIDE, emb.strides[1]))
        flat = np.ascontiguousarray(view)
        return flat, np.maximum(flat @ self.p["filters"] + self.p["bias"], 0)

    def chunks(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest, mean) responses of each chunk of a text, worked through in pieces of bounded size."""
        total, high, mean = self._windows(len(data)), [], []
        for first in range(0, total, 32 * CHUNK):
            count = min(32 * CHUNK, total - first)
            _, r = self._responses(data[first * STRIDE:], count)
            starts = np.arange(0, count, CHUNK)
            high.append(np.maximum.reduceat(r, starts, axis=0))
            mean.append(np.add.reduceat(r, starts, axis=0) / np.diff(np.append(starts, count))[:, None])
        return np.concatenate(high), np.concatenate(mean)

    def score(self, data: np.ndarray) -> float:
        high, mean = self.chunks(data)
        x = np.concatenate([high.mean(0), high.max(0), mean.mean(0), mean.max(0)])
        return float(1 / (1 + np.exp(-np.clip(x @ self.p["out"] + self.p["out_bias"][0], -30, 30))))

    def fit(self, texts: list[list[bytes]], labels: np.ndarray, seed: int = 0) -> ByteConv:
        """Learns all parameters from texts given as lists of chunks, by Adam on the logistic loss."""
        rng = np.random.default_rng(seed)
        slow = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(_EPOCHS):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), _BATCH):
                grads = {k: np.zeros_like(v) for k, v in self.p.items()}
                for i in order[a:a + _BATCH]:
                    self._gradient(texts[i], float(labels[i]), grads)
                step += 1
                for k, g in grads.items():
                    g /= min(_BATCH, len(order) - a)
                    g += 1e-4 * self.p[k]
                    slow[k] = 0.9 * slow[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.p[k] -= (_RATE * (slow[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        return self

    def _gradient(self, chunks: list[bytes], label: float, grads: dict) -> None:
        parts = []
        for raw in chunks:
            data = np.frombuffer(raw, dtype=np.uint8)
            count = self._windows(len(data))
            flat, r = self._responses(data, count)
            parts.append((data, count, flat, r, r.argmax(0), r.max(0), r.mean(0)))
        high, mean, n = np.array([p[5] for p in parts]), np.array([p[6] for p in parts]), len(parts)
        x = np.concatenate([high.mean(0), high.max(0), mean.mean(0), mean.max(0)])
        d = 1 / (1 + np.exp(-np.clip(x @ self.p["out"] + self.p["out_bias"][0], -30, 30))) - label
        grads["out"] += d * x
        grads["out_bias"] += d
        w = (d * self.p["out"]).reshape(4, FILTERS)
        top, top_mean = high.argmax(0), mean.argmax(0)
        for k, (data, count, flat, r, best, _, _) in enumerate(parts):
            g = np.where(r > 0, (w[2] / n + w[3] * (top_mean == k)) / count, 0)
            g[best, np.arange(FILTERS)] += np.where(r[best, np.arange(FILTERS)] > 0, w[0] / n + w[1] * (top == k), 0)
            grads["filters"] += flat.T @ g
            grads["bias"] += g.sum(0)
            back = (g @ self.p["filters"].T).reshape(count, WINDOW, DIMS)
            held = np.zeros(WINDOW + STRIDE * (count - 1), dtype=np.uint8)
            held[:min(len(held), len(data))] = data[:len(held)]
            at = held[np.arange(count)[:, None] * STRIDE + np.arange(WINDOW)]
            for j in range(DIMS):
                grads["emb"][:, j] += np.bincount(at.ravel(), back[:, :, j].ravel(), minlength=256)


def _sampled_chunks(texts: list[str], most: int) -> list[list[bytes]]:
    out = []
    for text in texts:
        raw = text.encode()
        last = max(0, len(raw) - _CHUNK_BYTES)
        count = min(most, -(-max(1, len(raw)) // _CHUNK_BYTES))
        out.append([raw[a:a + _CHUNK_BYTES] for a in np.linspace(0, last, count).astype(int)])
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, docs_per_class: int = SAMPLE_DOCS, seed: int = 0, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality", chunks_per_doc: int = SAMPLE_CHUNKS) -> ByteConv | None:
    """A classifier learned from at most ``docs_per_class`` labelled texts of each class; None without labelled rows.

    The sample is the rows of least hashed id. At most ``chunks_per_doc`` chunks, spread evenly over each sampled text, reach
    the driver, so what it holds is bounded whatever the tables' sizes; scoring pools over all chunks of a text. Labels other than
    0 and 1, null ids and null texts are not used; of rows that share an id and a label one text counts. Where a class is
    missing the other one decides.
    """
    marked = labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label")).where("key IS NOT NULL AND label IN (0, 1)").distinct()
    hashed = marked.withColumn("h", F.xxhash64("key", F.lit(seed)))
    sample = hashed.join(F.broadcast(least_hashed(hashed, "label", "h", docs_per_class, 2)), ["label", "h"]).select("key", "label")  # two classes
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    picked = texts.join(F.broadcast(sample), "key").select("key", "text", "label")  # an id has at most two labels

    def cut_out(piece):
        texts = piece.column("text").to_pylist()
        return pa.RecordBatch.from_arrays([piece.column("key").cast(pa.int64()), pa.array(_sampled_chunks(texts, chunks_per_doc), pa.list_(pa.binary())),
                                           piece.column("label")], names=["key", "chunks", "label"])

    cut = map_slices(picked, "text", cut_out, "key long, chunks array<binary>, label int")
    rows = sorted(cut.groupBy("key", "label").agg(F.min("chunks").alias("chunks")).collect(), key=lambda r: (r.key, r.label))
    if not rows:
        return None
    return ByteConv(seed).fit([[bytes(c) for c in r.chunks] for r in rows], np.array([r.label for r in rows]), seed)


def score_quality(docs: DataFrame, model: ByteConv | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """A row per input row: doc_id, score, predicted. Whole texts are scored, in memory that does not grow with them.

    Null and empty texts get the score of a text without bytes. Without a model every score is 0.5. Repeated rows repeat,
    other columns are ignored, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(piece):
        conv = shared.value
        data, at = shingles.utf8(piece.column("text"))
        scores = [0.5 if conv is None else conv.score(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = map_slices(rows, "text", run, "doc_id long, score double")
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, model: ByteConv | None, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns, whatever their names.

    Null and empty texts get the score of a text without bytes; without a model every row stays. Repeated rows stay or go
    together, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def body(batches):
        conv = shared.value
        for piece in slices(batches, text_col):
            data, at = shingles.utf8(piece.column(text_col))
            keep = [conv is None or conv.score(data[a:b]) >= threshold for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield piece.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(body, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: a fifth of the documents, by their ids' checksum, is kept from learning."""
    learn = labels.where(crc_mod(F.col("doc_id"), 5) != 0)
    out = score_quality(docs, fit_quality(docs.where(crc_mod(F.col("doc_id"), 5) != 0), learn))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
