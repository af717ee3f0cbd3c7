"""Toxicity scores: gradient-boosted trees over dense features, isotonic calibration.

Learning uses at most ``SAMPLE`` labelled rows (those of the smallest id hash).  The
lexicon is the words, and the word beginnings of ``STEMS`` bytes, that are much more
frequent in label-1 documents.  Trees must not see a row through a lexicon that the
row itself has shaped, so each half of the sample has its features from the lexicon of
the other half; new texts have theirs from the lexicon of both.  Predictions of trees
that have not seen a row (three folds) fit the calibration.  Scoring is one scan of
all whole texts.

Features of a text: lexicon densities and counts, second-person words and lexicon
words near them, densest stretch, capitals, punctuation, digits and symbols, elongated
and obfuscated words, and lexicon words that show only once obfuscation is undone.

Edge cases: null is the empty text, which has a score like any other; without
labelled rows of both classes every score is the share of label 1 (0 without labels);
rows without an id or with a null label are not learned from; repeated rows score alike;
of documents with the same text the least id hash counts and the mean label, so that the
order of rows does not matter.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import batches_bytes, ensure_checkpoint_dir, lean, stage

SAMPLE = 20_000        # labelled rows that are learned from, at most
STEMS = (4, 5)         # bytes
SHORT, LONG = STEMS
MIN_DOCS = 3           # documents with label 1 that a lexicon entry needs
RATIO = 8.0            # times as frequent in them
LEXICON = 3_000        # entries of either kind, at most
ROUNDS, DEPTH, RATE, BINS, PENALTY = 60, 3, 0.15, 64, 1.0
NEAR = 5               # words
STRETCH = 50           # words

# Second-person words of the four languages, and look-alike characters.
SECOND_PERSON = frozenset(w.encode() for w in (
    "you your yours yourself u ur du dich dir dein deine deinen euch euer ihr tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros").split())
LOOK_ALIKE = bytes.maketrans(b"013457@$!|", b"oieastasil")

_PUNCT = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_TO_SPACE = bytes.maketrans(_PUNCT, b" " * len(_PUNCT))
_CLASS = np.zeros(256, np.int64)      # 1 capital, 2 small, 3 digit, 4 '!', 5 '?', 6 other symbol, 7 space
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[list(_PUNCT)] = 1, 2, 3, 6
_CLASS[33], _CLASS[63], _CLASS[[9, 10, 11, 12, 13, 32]] = 4, 5, 7
_OBFUSCATED = re.compile(rb"[a-z\x80-\xff]+(?:[0-9@$*|#%]+[a-z\x80-\xff]+)+")
_SPELLED = re.compile(rb"(?<![a-z\x80-\xff])[a-z](?:[ .\-_*][a-z]){3,}(?![a-z\x80-\xff])")
_LONG = re.compile(rb"([a-z])\1\1")
FEATURES = 20


def plain_words(raw: bytes) -> list[bytes]:
    """Words of a lower-cased text without ASCII punctuation."""
    return raw.translate(_TO_SPACE).split()


def features(raw: bytes, words_lexicon: dict, stem_lexicon: dict) -> list[float]:
    low = raw.lower()
    tokens = plain_words(low)
    n = len(tokens) or 1
    hits = [i for i, w in enumerate(tokens) if w in words_lexicon]
    stems = [i for i, w in enumerate(tokens) if w[:SHORT] in stem_lexicon or w[:LONG] in stem_lexicon]
    stem = lambda w: w[:LONG] if w[:LONG] in stem_lexicon else w[:SHORT]
    person = [i for i, w in enumerate(tokens) if w in SECOND_PERSON]
    either = sorted({*hits, *stems})
    near = 0
    if person and either:
        at = np.searchsorted(np.array(person), np.array(either))
        gaps = np.minimum(np.abs(np.array(person)[np.minimum(at, len(person) - 1)] - either),
                          np.abs(np.array(person)[np.maximum(at - 1, 0)] - either))
        near = int((gaps <= NEAR).sum())
    densest = 0
    if either:
        spots = np.array(either)
        densest = int((np.searchsorted(spots, spots + STRETCH) - np.arange(len(spots))).max())
    odd = _OBFUSCATED.findall(low) + [s.translate(None, b" .-_*") for s in _SPELLED.findall(low)]
    undone = 0
    for w in odd:
        for form in (w.translate(LOOK_ALIKE, b"*#%"), w.translate(None, b"*#%")):
            if form in words_lexicon or form[:SHORT] in stem_lexicon or form[:LONG] in stem_lexicon:
                undone += 1
                break
    counts = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8) if raw else np.zeros(8)
    size = len(raw) or 1
    letters = int(counts[1] + counts[2]) or 1
    return [sum([words_lexicon[tokens[i]] for i in hits]) / n, len(hits) / n, float(np.log1p(len(hits))), len({tokens[i] for i in hits}),
            sum([stem_lexicon[stem(tokens[i])] for i in stems]) / n, len(stems) / n, float(np.log1p(len(stems))),
            len({tokens[i] for i in stems}), len(person) / n, near / n, densest, undone, len(odd) / n,
            counts[1] / letters, counts[4] / size, counts[5] / size, counts[6] / size, counts[3] / size,
            len(_LONG.findall(low)) / n, float(np.log1p(len(tokens)))]


# -- trees ------------------------------------------------------------------

class Trees:
    """Boosted regression trees on binned features, logistic loss."""

    def __init__(self, edges: list[np.ndarray], start: float):
        self.edges, self.start, self.trees = edges, start, []

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray) -> "Trees":
        share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        edges = [np.unique(np.append(e, x[x[:, j] > e[-1], j].min() if (x[:, j] > e[-1]).any() else e[-1])) for j, e in enumerate(edges)]
        model = Trees(edges, float(np.log(share / (1 - share))))
        b = model.bin(x)
        margin = np.full(len(y), model.start)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            tree = model._grow(b, g, h)
            model.trees.append(tree)
            margin += model._apply(tree, b)
        return model

    def _grow(self, b, g, h):
        nodes: list = []

        def add(rows, depth):
            k = len(nodes)
            nodes.append(None)
            total_g, total_h = g[rows].sum(), h[rows].sum()
            value = -RATE * total_g / (total_h + PENALTY)
            best = (1e-6, -1, -1)
            if depth < DEPTH and len(rows) >= 4:
                for j, e in enumerate(self.edges):
                    left_g = np.cumsum(np.bincount(b[rows, j], g[rows], len(e) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(b[rows, j], h[rows], len(e) + 1))[:-1]
                    gain = left_g ** 2 / (left_h + PENALTY) + (total_g - left_g) ** 2 / (total_h - left_h + PENALTY) - total_g ** 2 / (total_h + PENALTY)
                    if len(gain) and gain.max() > best[0]:
                        best = (float(gain.max()), j, int(gain.argmax()))
            if best[1] < 0:
                nodes[k] = (-1, 0, 0, 0, value)
                return k
            left = b[rows, best[1]] <= best[2]
            if left.all() or not left.any():
                nodes[k] = (-1, 0, 0, 0, value)
                return k
            lo, hi = add(rows[left], depth + 1), add(rows[~left], depth + 1)
            nodes[k] = (best[1], best[2], lo, hi, value)
            return k

        add(np.arange(len(g)), 0)
        return tuple(np.array(c) for c in zip(*nodes))

    @staticmethod
    def _apply(tree, b):
        feature, cut, lo, hi, value = tree
        at = np.zeros(len(b), np.int64)
        for _ in range(DEPTH):
            f = feature[at]
            left = b[np.arange(len(b)), np.maximum(f, 0)] <= cut[at]
            at = np.where(f < 0, at, np.where(left, lo[at], hi[at]))
        return value[at]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.bin(x)
        return self.start + sum((self._apply(t, b) for t in self.trees), np.zeros(len(x)))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least-squares fit (pool adjacent violators): block places and values."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []         # weight, sum of y, sum of x
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        blocks.append([1.0, b, a])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            w, s, t = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + s, blocks[-1][2] + t]
    return np.array([t / w for w, _, t in blocks]), np.array([s / w for w, s, _ in blocks])


class Model:
    def __init__(self, words_lexicon, stem_lexicon, trees, knots, share):
        self.words, self.stems, self.trees, self.knots, self.share = words_lexicon, stem_lexicon, trees, knots, share

    def score(self, raws: list[bytes]) -> np.ndarray:
        if self.trees is None or not raws:
            return np.full(len(raws), self.share)
        x = np.array([features(r, self.words, self.stems) for r in raws])
        margin = self.trees.margin(x)
        # the uncalibrated score keeps an order among equal calibrated ones
        return 0.995 * np.interp(margin, *self.knots) + 0.005 / (1 + np.exp(-margin))


# -- Spark --------------------------------------------------------------------

def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5 (an id that is null counts as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def labelled(labels: DataFrame, label_col: str, id_col: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """(id, y, h): at most ``sample`` rows to learn from, one per id, held-out ids left out."""
    rows = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(id_col) != 0))
            .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("y"))
            .withColumn("h", F.xxhash64("id")))
    return rows.orderBy("h", "id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    import pyarrow as pa

    ensure_checkpoint_dir(docs.sparkSession)
    picked = stage(labelled(labels, label_col, id_col), "toxicity-labels")         # at most SAMPLE small rows
    rows = stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
                 .groupBy("text").agg((F.avg("y") >= 0.5).cast("double").alias("y"), F.min("h").alias("h")), "toxicity-sample")

    @lean
    def entries(batches):
        for batch in batches:
            seen: dict = {}
            columns = (batches_bytes(batch.column("text")), batch.column("y").to_pylist(), batch.column("h").to_pylist())
            for raw, y, h in zip(*columns):
                found = set(plain_words(raw.lower()))
                for kind, names in ((0, found), (1, {w[:k] for w in found for k in STEMS if len(w) > k})):
                    for w in names:
                        pair = seen.setdefault((kind, w), [0, 0, 0, 0])
                        pair[2 * (h % 2) + int(y > 0)] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.int32()), pa.array([k[1] for k in seen], pa.binary()),
                 *[pa.array([v[k] for v in seen.values()], pa.int64()) for k in range(4)]], names=["kind", "entry", "c0", "t0", "c1", "t1"])

    texts = {(r["p"], r["y"] > 0): r["n"] for r in rows.groupBy(F.pmod("h", F.lit(2)).alias("p"), "y").agg(F.count("*").alias("n")).collect()}
    counts = stage(rows.select("text", "y", "h").mapInArrow(entries, "kind int, entry binary, c0 long, t0 long, c1 long, t1 long")
                   .groupBy("kind", "entry").agg(*[F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")])
                   .filter(F.col("t0") + F.col("t1") >= MIN_DOCS), "toxicity-entries")

    def lexicon_of(parts: tuple[int, ...]) -> tuple[dict, dict]:
        n = [sum(texts.get((p, y), 0) for p in parts) for y in (False, True)]
        clean, toxic = (sum((F.col(f"{c}{p}") for p in parts[1:]), F.col(f"{c}{parts[0]}")) for c in "ct")
        ratio = ((toxic + 0.5) / (n[1] + 1)) / ((clean + 0.5) / (n[0] + 1))
        out: tuple[dict, dict] = ({}, {})
        for kind in (0, 1):
            best = counts.filter((F.col("kind") == kind) & (toxic >= MIN_DOCS) & (ratio >= RATIO)) \
                .select("entry", F.log(ratio).alias("w"), toxic.alias("n")).orderBy(F.desc("n"), F.desc("w"), "entry").limit(LEXICON)
            for r in best.collect():
                out[kind][bytes(r["entry"])] = float(r["w"])
        return out

    halves = {0: lexicon_of((1,)), 1: lexicon_of((0,))}
    lexicons = lexicon_of((0, 1))

    @lean
    def dense(batches):
        for batch in batches:
            x = [features(raw, *halves[h % 2]) for raw, h in zip(batches_bytes(batch.column("text")), batch.column("h").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("y"), pa.array(x, pa.list_(pa.float64()))], names=["h", "y", "x"])

    got = rows.select("h", "y", "text").mapInArrow(dense, "h long, y double, x array<double>").collect()   # at most SAMPLE short rows
    got.sort(key=lambda r: r["h"])
    y = np.array([float(r["y"] > 0) for r in got])
    share = float(y.mean()) if len(y) else 0.0
    if not len(y) or share in (0.0, 1.0):
        return Model(*lexicons, None, None, share)
    x = np.array([r["x"] for r in got])
    part = np.arange(len(y)) % 3
    out = np.zeros(len(y))
    for k in range(3):
        use = part != k
        out[~use] = Trees.fit(x[use], y[use]).margin(x[~use])
    return Model(*lexicons, Trees.fit(x, y), isotonic(out, y), share)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``toxicity`` (0 to 1)."""
    import pyarrow as pa

    ensure_checkpoint_dir(docs.sparkSession)
    fields = [f for f in docs.schema.fields if f.name != "toxicity"]
    names = [f.name for f in fields]

    @lean
    def run(batches):
        for batch in batches:
            raws, got = batches_bytes(batch.column(text_col)), []
            for at in range(0, len(raws), 512):
                got.append(model.score(raws[at:at + 512]))
            got = np.concatenate(got) if got else np.empty(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(got, pa.float64())], names=[*names, "toxicity"])

    return docs.select(*[f"`{n}`" for n in names]).mapInArrow(run, T.StructType([*fields, T.StructField("toxicity", T.DoubleType())]))
