"""Quality scores by a factorisation machine.

The input vector of a text holds hashed words (``WORDS`` buckets, counts scaled to
length one), structure statistics and metadata (size).  The score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2)

whose pairwise part needs one pass over the non-zero entries ("sum of squares").
Learning uses at most ``SAMPLE`` labelled rows (those of the smallest id hash), all
rows at once with Adam.  Scoring is one scan of all whole texts.

Edge cases: as for toxicity scores: null is the empty text, without labelled rows of
both classes the score is the share of label 1 (0 without labels), repeated rows
score alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import batches_bytes, ensure_checkpoint_dir, lean, stage, word_hashes
from shoplens.llm.toxicity import _CLASS, labelled

SAMPLE = 6_000         # labelled rows that are learned from, at most
WORDS = 2048
RANK = 8
STEPS, RATE, PENALTY = 120, 0.05, 1e-4
DENSE = 16


def vector(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, weights, statistics) of one text."""
    tokens = raw.lower().split()
    h = word_hashes(tokens)
    n = len(tokens) or 1
    counts = np.bincount((h & np.uint64(WORDS - 1)).astype(np.int64), minlength=0) if len(h) else np.empty(0, np.int64)
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at])
    x = x / (np.sqrt((x * x).sum()) or 1)
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8) if raw else np.zeros(8)
    size = len(raw) or 1
    same = int((h[1:] == h[:-1]).sum()) if len(h) > 1 else 0
    lines = raw.split(b"\n")
    stats = [kinds[1] / size, kinds[2] / size, kinds[3] / size, kinds[4] / size, kinds[5] / size, kinds[6] / size, kinds[7] / size,
             kinds[0] / size, len(np.unique(h)) / n, same / n, min(size / n, 40) / 10, raw.count(b"|") / size, len(set(lines)) / len(lines),
             float(np.log1p(len(lines))) / 5, float(np.log1p(n)) / 8, float(np.log1p(len(raw))) / 10]
    return at, x.astype(np.float32), np.array(stats, np.float32)


def matrix(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    x = np.zeros((len(rows), WORDS + DENSE), np.float32)
    for row, (at, w, stats) in zip(x, rows):
        row[at] = w
        row[WORDS:] = stats
    return x


class Model:
    def __init__(self, share: float, w0=0.0, w=None, v=None, mean=None, scale=None):
        self.share, self.w0, self.w, self.v, self.mean, self.scale = share, w0, w, v, mean, scale

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        x[:, WORDS:] = np.clip((x[:, WORDS:] - self.mean) * self.scale, -4, 4) * np.float32(0.5)
        return x

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.w0 + x @ self.w + 0.5 * (((x @ self.v) ** 2) - (x * x) @ (self.v * self.v)).sum(1)

    def score(self, raws: list[bytes]) -> np.ndarray:
        if self.w is None or not raws:
            return np.full(len(raws), self.share)
        return 1 / (1 + np.exp(-np.clip(self.margin(self._scaled(matrix([vector(r) for r in raws]))), -30, 30)))

    @staticmethod
    def fit(rows: list, y: np.ndarray) -> "Model":
        x = matrix(rows)
        mean = x[:, WORDS:].mean(0)
        model = Model(float(y.mean()), 0.0, None, None, mean, (1 / (x[:, WORDS:].std(0) + 1e-6)).astype(np.float32))
        x = model._scaled(x)
        squares = x * x
        rng = np.random.default_rng(7)
        w, v = np.zeros(x.shape[1], np.float32), rng.normal(0, 0.02, (x.shape[1], RANK)).astype(np.float32)
        w0 = float(np.log(model.share / (1 - model.share)))
        y = y.astype(np.float32)
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, v)]
        moment0 = [0.0, 0.0]
        for step in range(1, STEPS + 1):
            z = x @ v
            margin = w0 + x @ w + 0.5 * ((z * z).sum(1) - (squares @ (v * v)).sum(1))
            e = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / len(y)
            grads = (x.T @ e + PENALTY * w, x.T @ (e[:, None] * z) - v * (squares.T @ e)[:, None] + PENALTY * v)
            for p, g, s in zip((w, v), grads, state):
                s[0] = 0.9 * s[0] + 0.1 * g
                s[1] = 0.99 * s[1] + 0.01 * g * g
                p -= RATE * (s[0] / (1 - 0.9 ** step)) / (np.sqrt(s[1] / (1 - 0.99 ** step)) + 1e-8)
            g0 = float(e.sum())
            moment0 = [0.9 * moment0[0] + 0.1 * g0, 0.99 * moment0[1] + 0.01 * g0 * g0]
            w0 -= RATE * (moment0[0] / (1 - 0.9 ** step)) / (np.sqrt(moment0[1] / (1 - 0.99 ** step)) + 1e-8)
        model.w0, model.w, model.v = w0, w, v
        return model


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    import pyarrow as pa

    ensure_checkpoint_dir(docs.sparkSession)
    picked = stage(labelled(labels, label_col, id_col, SAMPLE), "quality-labels")       # at most SAMPLE small rows
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id").select("y", "h", "text")

    @lean
    def vectors(batches):
        for batch in batches:
            found = [vector(raw) for raw in batches_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("y"), pa.array([f[0].astype(np.uint16).tobytes() for f in found], pa.binary()),
                 pa.array([f[1].tobytes() for f in found], pa.binary()), pa.array([f[2].tobytes() for f in found], pa.binary())],
                names=["h", "y", "at", "x", "stats"])

    got = rows.mapInArrow(vectors, "h long, y double, at binary, x binary, stats binary").collect()     # at most SAMPLE sparse vectors
    got.sort(key=lambda r: (r["h"], bytes(r["x"])))
    y = np.array([float(r["y"] > 0) for r in got])
    share = float(y.mean()) if len(y) else 0.0
    if not len(y) or share in (0.0, 1.0):
        return Model(share)
    return Model.fit([(np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["x"], np.float32),
                       np.frombuffer(r["stats"], np.float32)) for r in got], y)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``quality_score`` (0 to 1)."""
    import pyarrow as pa

    ensure_checkpoint_dir(docs.sparkSession)
    fields = [f for f in docs.schema.fields if f.name != "quality_score"]
    names = [f.name for f in fields]

    @lean
    def run(batches):
        for batch in batches:
            raws, got = batches_bytes(batch.column(text_col)), [np.empty(0)]
            for at in range(0, len(raws), 256):
                got.append(model.score(raws[at:at + 256]))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(np.concatenate(got), pa.float64())], names=[*names, "quality_score"])

    return docs.select(*[f"`{n}`" for n in names]).mapInArrow(run, T.StructType([*fields, T.StructField("quality_score", T.DoubleType())]))
