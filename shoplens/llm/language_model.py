"""Log-bilinear language model, trained in numpy by noise-contrastive estimation.

Tokens are lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` and one end token per text.
Every token belongs to one of ``CLASSES`` classes: the end, each of the ``FREQUENT``
most frequent words, and classes of the other words by their last bytes.  Then

    p(token | context) = p(class | two previous classes) * p(token | class)

* p(class | context) is a log-bilinear model: the context's predicted vector is a
  linear map of the two classes' vectors, and a class scores by its inner product
  with it plus a bias.  It is trained on the counts of class triples over all training
  texts, a table of at most CLASSES**3 numbers however large the corpus, by NCE with
  the unigram distribution as noise (whose expectation over the few classes is taken
  in full).  For scoring, one matrix product over all contexts and a softmax give
  normalised log-probabilities.
* p(token | class) is add-half smoothed counts with one place per class for unseen
  words, so the whole is a distribution over words and one unseen slot per class.

Counts of all distinct words are a distributed table.  The commonest ones, at most
``HEAD``, are broadcast; tokens beyond them meet their counts in a join.

Edge cases: null and empty texts have the end token alone; without training texts
every count is 0 and the class model is uniform; repeated rows count and score each.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import GOLDEN, batches_bytes, ensure_checkpoint_dir, lean, mix64, release, stage

CLASSES, FREQUENT = 128, 47
HEAD = 1 << 18              # words whose counts are broadcast, at most
DIMENSION, NOISE, STEPS, RATE = 24, 16, 250, 0.05
HALF = 0.5
END = 0                     # hash of the end token
_PIECE = 2 << 20
_BASE = 0xD6E8FEB86659FD93 | 1
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN + np.uint64(99))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            k = len(cls.up)
            cls.up = np.concatenate((cls.up, cls.up * np.uint64(pow(_BASE, k, 1 << 64))))
            cls.down = np.concatenate((cls.down, cls.down * np.uint64(pow(_BASE, -k, 1 << 64))))
        return cls.up[:n], cls.down[:n]


def _word_arrays(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash and last three bytes (as a number) of each word of a lower-cased text."""
    data = np.frombuffer(b" " + blob + b" ", np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    if not len(starts):
        return starts, np.empty(0, np.uint64), np.empty(0, np.int64)
    up, down = _Powers.of(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up, out=total[1:])
    size = ends - starts
    h = mix64((total[ends] - total[starts]) * down[starts] + size.astype(np.uint64) * GOLDEN)
    tail = data[ends - 1].astype(np.int64)
    for k in (2, 3):
        tail += np.where(size >= k, data[np.maximum(ends - k, 0)].astype(np.int64) << (8 * (k - 1)), 0)
    h[h == END] = 1
    return starts - 1, h, tail


def tokens(raws: list[bytes]):
    """(text, hash, tail) of every token of some texts, in order; the end token closes each text."""
    joined, text, hashes, tails = [], [], [], []

    def flush():
        if not joined:
            return
        first = joined[0][0]
        sizes = np.array([len(r) + 1 for _, r in joined], np.int64)
        begin = np.cumsum(sizes) - sizes
        at, h, tail = _word_arrays(b" ".join([r for _, r in joined]).lower())
        own = np.searchsorted(begin, at, side="right") - 1
        text.append(own + first)
        hashes.append(h)
        tails.append(tail)
        joined.clear()

    size = 0
    for k, raw in enumerate(raws):
        at = 0
        while len(raw) - at > _PIECE:                  # a very long text goes in pieces cut at a space
            flush()
            size = 0
            cut = at + _PIECE
            while cut < len(raw) and not _SPACE[raw[cut]]:
                cut += 1
            joined.append((k, raw[at:cut]))
            flush()
            at = cut
        if size + len(raw) - at > _PIECE or (at and joined):
            flush()
            size = 0
        joined.append((k, raw[at:]))
        size += len(raw) - at
        if at:
            flush()
            size = 0
    flush()
    n = len(raws)
    text = np.concatenate([*text, np.arange(n)]) if n else np.empty(0, np.int64)
    hashes = np.concatenate([*hashes, np.full(n, END, np.uint64)]) if n else np.empty(0, np.uint64)
    tails = np.concatenate([*tails, np.full(n, -1, np.int64)]) if n else np.empty(0, np.int64)
    by = np.argsort(text, kind="stable")
    return text[by], hashes[by], tails[by]


def tail_class(tail: np.ndarray) -> np.ndarray:
    """Class of a word that is not frequent, by its last bytes; the end's is 0."""
    rest = CLASSES - 1 - FREQUENT
    return np.where(tail < 0, 0, 1 + FREQUENT + (mix64(tail.astype(np.uint64) * GOLDEN + np.uint64(5)) % np.uint64(rest)).astype(np.int64))


def classes(hashes: np.ndarray, tail: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Class of each token; ``frequent`` are the sorted hashes of the frequent words."""
    own = tail_class(tail)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        own = np.where((frequent[at] == hashes) & (tail >= 0), 1 + at, own)
    return own


def contexts(text: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Code of the two classes before each token; before a text stands the end's class."""
    one = np.zeros(len(own), np.int64)
    two = np.zeros(len(own), np.int64)
    if len(own):
        same = text[1:] == text[:-1]
        one[1:] = np.where(same, own[:-1], 0)
        two[1:] = np.where(same, one[:-1], 0)
    return two * CLASSES + one


class LogBilinear:
    """Class model: p(class | two classes)."""

    def __init__(self, vectors, maps, out, bias):
        self.vectors, self.maps, self.out, self.bias = vectors, maps, out, bias

    @staticmethod
    def fit(code: np.ndarray, count: np.ndarray, steps: int = STEPS) -> "LogBilinear":
        """Train on counts of (class, class, class) codes by noise-contrastive estimation."""
        k = CLASSES
        rng = np.random.default_rng(11)
        vectors = rng.normal(0, 0.1, (k, DIMENSION)).astype(np.float32)
        maps = np.stack([np.eye(DIMENSION), np.eye(DIMENSION)]).astype(np.float32) * 0.5
        out = rng.normal(0, 0.1, (k, DIMENSION)).astype(np.float32)
        total = float(count.sum())
        q = np.bincount(code % k, count, k) + 0.5
        q = (q / q.sum()).astype(np.float32)
        bias = np.log(q).astype(np.float32)
        model = LogBilinear(vectors, maps, out, bias)
        if not total:
            return model
        seen, row = np.unique(code // k, return_inverse=True)
        n = np.zeros((len(seen), k), np.float32)
        n[row, code % k] = count / total
        far, near = seen // k, seen % k
        weight = n.sum(1, keepdims=True)
        noise = NOISE * weight * q
        shift = np.log(NOISE * q)
        params = [vectors, maps, out, bias]
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
        pick_far, pick_near = np.eye(k, dtype=np.float32)[far].T, np.eye(k, dtype=np.float32)[near].T
        for step in range(1, steps + 1):
            a, b = vectors[far], vectors[near]
            h = a @ maps[0] + b @ maps[1]
            odds = 1 / (1 + np.exp(-np.clip(h @ out.T + bias - shift, -30, 30)))
            g = noise * odds - n * (1 - odds)                   # gradient of the loss by score
            gh = g @ out
            grads = [pick_far @ (gh @ maps[0].T) + pick_near @ (gh @ maps[1].T), np.stack([a.T @ gh, b.T @ gh]), g.T @ h, g.sum(0)]
            rate = RATE * (1 - step / (steps + 1))
            for p, d, s in zip(params, grads, state):
                s[0] = 0.9 * s[0] + 0.1 * d
                s[1] = 0.99 * s[1] + 0.01 * d * d
                p -= rate * (s[0] / (1 - 0.9 ** step)) / (np.sqrt(s[1] / (1 - 0.99 ** step)) + 1e-9)
        return model

    def table(self) -> np.ndarray:
        """log10 p(class | context) of every context, by one matrix product."""
        h = (self.vectors @ self.maps[0])[:, None, :] + (self.vectors @ self.maps[1])[None, :, :]
        s = h.reshape(-1, h.shape[-1]) @ self.out.T + self.bias
        s -= s.max(1, keepdims=True)
        s -= np.log(np.exp(s).sum(1, keepdims=True))
        return (s / np.log(10)).astype(np.float32)


class Scorer:
    """What a task needs to score texts; the table of contexts is made once per worker."""

    def __init__(self, model: LogBilinear, head: np.ndarray, head_counts: np.ndarray, frequent: np.ndarray, norms: np.ndarray):
        self.model, self.head, self.head_counts, self.frequent, self.norms = model, head, head_counts, frequent, norms
        self._table = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None}

    def part(self, raws: list[bytes]):
        """Per text: tokens, known tokens of the head, their base sum, their model sum;
        and the tokens beyond the head as (text, hash, times)."""
        if self._table is None:
            self._table = self.model.table()
        text, h, tail = tokens(raws)
        own = classes(h, tail, self.frequent)
        context = contexts(text, own)
        n = len(raws)
        by_class = self._table[context, own].astype(np.float64)
        inside = own > FREQUENT                                  # tokens that share a class
        at = np.minimum(np.searchsorted(self.head, h), max(len(self.head) - 1, 0))
        known = self.head[at] == h if len(self.head) else np.zeros(len(h), bool)
        log_count = np.log10(np.where(known, self.head_counts[at] if len(self.head) else 0, 0) + HALF)
        count = lambda w: np.bincount(text, w, n)
        base = count(np.where(known, log_count, 0))
        model = count(by_class + np.where(inside, np.where(known, log_count, 0) - self.norms[own], 0))
        tail_text, tail_hash = text[~known], h[~known]
        by = np.lexsort((tail_hash, tail_text))
        tail_text, tail_hash = tail_text[by], tail_hash[by]
        first = np.flatnonzero(np.concatenate(([True], (tail_text[1:] != tail_text[:-1]) | (tail_hash[1:] != tail_hash[:-1])))) \
            if len(by) else np.empty(0, np.int64)
        times = np.diff(np.append(first, len(by)))
        return (np.bincount(text, minlength=n), count(known.astype(np.float64)).astype(np.int64), base, model,
                (tail_text[first], tail_hash[first], times))


def _groups(raws: list[bytes], size: int = 8 << 20):
    first, total = 0, 0
    for k, raw in enumerate(raws):
        if k > first and total + len(raw) > size:
            yield raws[first:k]
            first, total = k, 0
        total += len(raw)
    if raws[first:]:
        yield raws[first:]


def score(docs: DataFrame, train_if, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``train_if`` is a condition on the columns of ``docs`` that marks training texts.
    """
    import pyarrow as pa

    ensure_checkpoint_dir(docs.sparkSession)
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.coalesce(train_if, F.lit(False)).alias("train"))

    @lean
    def count_words(batches):
        for batch in batches:
            h, k = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for raws in _groups(batches_bytes(batch.column("text"))):
                _, hashes, tail = tokens(raws)
                h.append(hashes)
                k.append(tail_class(tail))
            h, k = np.concatenate(h), np.concatenate(k)
            names, first, n = np.unique(h, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(k[first].astype(np.int32)), pa.array(n.astype(np.int64))],
                                             names=["h", "k", "c"])

    counts = stage(base.filter("train").select("text").mapInArrow(count_words, "h long, k int, c long")
                   .groupBy("h", "k").agg(F.sum("c").alias("c")), "lm-counts")
    # sizes by class and by magnitude: at most CLASSES * 8 * 63 rows
    sizes = counts.groupBy("k", F.floor(F.log2("c") * 8).cast("int").alias("m")).agg(F.count("*").alias("v"), F.sum("c").alias("n")).collect()
    n_train, v_train = sum(r["n"] for r in sizes), sum(r["v"] for r in sizes)
    room, least = HEAD, 0
    for m in sorted({r["m"] for r in sizes}, reverse=True):
        room -= sum(r["v"] for r in sizes if r["m"] == m)
        if room < 0:
            least = m + 1
            break
    head = counts.filter(F.floor(F.log2("c") * 8) >= least).toArrow()             # at most HEAD rows
    h = head["h"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    h, c, k = h[order], head["c"].to_numpy().astype(np.int64)[order], head["k"].to_numpy().astype(np.int64)[order]
    words = np.flatnonzero(k > 0)
    top = words[np.lexsort((h[words], -c[words]))][:FREQUENT]
    frequent = np.sort(h[top])
    class_n = np.zeros(CLASSES)
    class_v = np.zeros(CLASSES)
    for r in sizes:
        class_n[r["k"]] += r["n"]
        class_v[r["k"]] += r["v"]
    np.subtract.at(class_n, k[top], c[top])                # frequent words are classes of their own
    np.subtract.at(class_v, k[top], 1)
    norms = np.log10(np.maximum(class_n, 0) + HALF * (np.maximum(class_v, 0) + 1))

    @lean
    def count_triples(batches):
        total = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            for raws in _groups(batches_bytes(batch.column("text"))):
                text, hashes, tail = tokens(raws)
                own = classes(hashes, tail, frequent)
                total += np.bincount(contexts(text, own) * CLASSES + own, minlength=CLASSES ** 3)
        code = np.flatnonzero(total)
        for at in range(0, len(code), 1 << 18):
            part = code[at:at + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["code", "n"])

    triples = stage(base.filter("train").select("text").mapInArrow(count_triples, "code int, n long")
                    .groupBy("code").agg(F.sum("n").alias("n")), "lm-triples")

    @lean
    def fit(batches):
        code, n = [np.empty(0, np.int64)], [np.empty(0, np.float64)]
        for batch in batches:
            code.append(batch.column("code").to_numpy().astype(np.int64))
            n.append(batch.column("n").to_numpy().astype(np.float64))
        code, n = np.concatenate(code), np.concatenate(n)
        by = np.argsort(code)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(LogBilinear.fit(code[by], n[by]))], pa.binary())], names=["model"])

    # one task fits the classes: the table has at most CLASSES**3 rows at any corpus size
    fitted = triples.coalesce(1).mapInArrow(fit, "model binary").first()
    model = pickle.loads(bytes(fitted["model"])) if fitted else LogBilinear.fit(np.empty(0, np.int64), np.empty(0))
    del head
    shared = spark.sparkContext.broadcast(Scorer(model, h, c, frequent, norms))     # bounded by HEAD and CLASSES

    @lean
    def score_texts(batches):
        scorer = shared.value
        for batch in batches:
            ids, columns, rare_h, rare_n = batch.column("id"), [[], [], [], []], [], []
            for raws in _groups(batches_bytes(batch.column("text"))):
                *four, (text, hashes, times) = scorer.part(raws)
                for column, values in zip(columns, four):
                    column.append(values)
                cuts = np.searchsorted(text, np.arange(1, len(raws)))
                rare_h += np.split(hashes.view(np.int64), cuts)
                rare_n += np.split(times.astype(np.int32), cuts)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            made = [pa.array(np.concatenate(x) if x else [], t) for x, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column("train"), *made, pa.array(rare_h, pa.list_(pa.int64())), pa.array(rare_n, pa.list_(pa.int32()))],
                names=["id", "train", "n_tokens", "n_head", "base", "model", "rare", "times"])

    id_type = base.schema["id"].dataType.simpleString()
    scored = stage(base.mapInArrow(score_texts, f"id {id_type}, train boolean, n_tokens long, n_head long, base double, model double, "
                                   "rare array<long>, times array<int>").withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    pairs = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("row", F.col("p.rare").alias("h"), F.col("p.times").alias("t"))
    # words beyond the head: by value, so no key is frequent
    tail = counts.filter(F.floor(F.log2("c") * 8) < least).select("h", "c")
    met = pairs.join(tail, "h", "left").groupBy("row").agg(
        F.sum(F.col("t") * F.log10(F.coalesce("c", F.lit(0)) + HALF)).alias("rare_sum"),
        F.sum(F.when(F.col("c") > 0, F.col("t")).otherwise(0)).alias("rare_known"))
    met = stage(met, "lm-rare")
    release(spark)
    floor = float(np.log10(n_train + HALF * (v_train + 1)))
    rare = F.coalesce("rare_sum", F.lit(0.0))
    # tokens beyond the head are in shared classes, so their share of p(token | class) is this sum too
    return scored.join(met, "row", "left").select(
        F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("n_head") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(n_train)).cast("long").alias("train_tokens"),
        (F.col("base") + rare - F.col("n_tokens") * F.lit(floor)).alias("base_score"), (F.col("model") + rare).alias("score"))
