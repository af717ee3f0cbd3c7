"""Near-duplicate groups by one-permutation MinHash.

A document's set is its distinct 5-word shingles.  One hash of every shingle
fills ``BINS`` bins (the hash's top bits name the bin, the least hash in it is
kept); an empty bin borrows from a non-empty one that a universal hash picks for
it and its attempt number ("optimal densification"), so that every bin agrees
with probability equal to the Jaccard similarity, independently of the others.
``BANDS`` groups of ``ROWS`` bins make the buckets.

1. Equal sets are one class, found by a 128-bit digest; only classes go on.
2. In each bucket, every class is paired with the bucket's least class: a star,
   so candidate pairs are linear in the bucket.
3. Pairs are confirmed on full sets, recomputed from the texts of the classes in
   question.
4. Buckets that then still hold more than one component may hide a link that
   their hub did not show.  The classes that such buckets connect form a cluster;
   its full sets meet in one task (in several, block against block, beyond
   ``BLOCK_BYTES``), are compared exactly by their rarest hashes and sizes, and only
   links between different components come out.  Clusters are found on the components:
   a bucket joins the components it holds, however many classes each has.  So no pair that shares a bucket is dropped, whatever hub
   the star had, and no pairs are emitted but links.

At the threshold of 0.75 a pair misses all 32 bands with probability
(1 - 0.75**4) ** 32 = 5e-6.

Edge cases: null or empty texts, and texts without words, have an empty set and
are linked with nothing; repeated rows fall into one class; a null id stays null;
an empty table gives an empty table.  Ids may be of any type
that has an order (whole numbers come back as long) and are meant to be unique: rows that
repeat an id with another text are judged by their own texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import SHINGLE, batches_bytes, ensure_checkpoint_dir, lean, mix64, shingle_hashes, stage, words
from shoplens.llm.components import connected_components

BINS, ROWS = 128, 4
BANDS = BINS // ROWS
BLOCK_BYTES = 12 << 20    # sets of one cluster compared in one task, at most twice this
_SHIFT = np.uint64(64 - 7)
_EDGES = np.arange(BINS, dtype=np.uint64) << _SHIFT


def _attempts(count: int, first: int) -> np.ndarray:
    """Bin that each bin asks at attempts first .. first + count - 1."""
    t = np.arange(first, first + count, dtype=np.uint64)[None, :]
    i = np.arange(BINS, dtype=np.uint64)[:, None]
    return (mix64(i * np.uint64(0x100000001B3) + t * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) >> _SHIFT).astype(np.int64)


_FIRST, _MORE = _attempts(8, 0), _attempts(512, 8)


def signature(hashes: np.ndarray) -> np.ndarray:
    """16-bit bin values of a sorted, non-empty set of 64-bit hashes."""
    at = np.searchsorted(hashes, _EDGES)
    inside = np.minimum(at, len(hashes) - 1)
    value = hashes[inside]
    full = (at < len(hashes)) & ((value >> _SHIFT) == np.arange(BINS, dtype=np.uint64))
    if not full.all():
        source = np.arange(BINS)
        empty = np.flatnonzero(~full)
        for asked in (_FIRST, _MORE):
            tries = full[asked[empty]]
            got = tries.any(1)
            source[empty[got]] = asked[empty[got], tries[got].argmax(1)]
            empty = empty[~got]
            if not len(empty):
                break
        first = 520
        while len(empty):
            asked = _attempts(4096, first)
            tries = full[asked[empty]]
            got = tries.any(1)
            source[empty[got]] = asked[empty[got], tries[got].argmax(1)]
            empty, first = empty[~got], first + 4096
        value = value[source]
    return mix64(value).astype(np.uint16)


def _digest(hashes: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(hashes.tobytes())


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, digest, bands) of every row; digest and bands null for empty sets."""
    import pyarrow as pa

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_shingles", T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    @lean
    def run(batches):
        for batch in batches:
            ns, digests, bands = [], [], []
            for text in batches_bytes(batch.column("text")):
                h = shingle_hashes(words(text), SHINGLE)
                ns.append(len(h))
                digests.append(_digest(h) if len(h) else None)
                bands.append(signature(h).view(np.int64) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["id", "n_shingles", "digest", "bands"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, s): the shingle sets, as bytes, of the texts of some ids."""
    import pyarrow as pa

    @lean
    def sets(batches):
        for batch in batches:
            found = [shingle_hashes(words(t), SHINGLE).tobytes() for t in batches_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], names=["id", "s"])

    kind = ids.schema["id"].dataType
    texts = docs.select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi")
    return stage(texts.mapInArrow(sets, T.StructType([T.StructField("id", kind), T.StructField("s", T.BinaryType())])).filter("length(s) > 0").dropDuplicates(["id", "s"]), "minhash-sets")


def _confirm(pairs: DataFrame, full: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= threshold * union."""
    import pyarrow as pa

    @lean
    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[at] == p).sum())
                keep.append(100 * both >= threshold * (len(p) + len(q) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    wide = (pairs.join(full.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(full.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"))
    return stage(wide.mapInArrow(compare, _links(full)).distinct(), "minhash-links")


def _links(full: DataFrame) -> T.StructType:
    kind = full.schema["id"].dataType
    return T.StructType([T.StructField("a", kind), T.StructField("b", kind)])


def _links_in(ids: list, labels: list, sets: list[bytes], threshold: int) -> list[tuple]:
    """Links between different labels among some sets, no more than it takes to join the labels.

    Sets are taken by size.  Of each only the rarest hashes, as many as leave fewer than
    the threshold asks for, are looked up among those of the smaller sets before it: two
    similar sets share one of them.  Sets too small, or already joined, are passed over;
    the others are compared in full.
    """
    sizes = np.array([len(s) // 8 for s in sets])
    values, flat, often = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True, return_counts=True)
    rare = np.empty(len(values), np.int32)
    rare[np.argsort(often, kind="stable")] = np.arange(len(values), dtype=np.int32)
    flat = rare[flat]
    starts = np.cumsum(sizes) - sizes
    names = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    least = list(names)
    top = np.arange(len(names))
    own_label = np.array([names[x] for x in labels])
    held = _prefixes(flat, starts, sizes, own_label, threshold)
    seen: dict[int, dict[int, list[int]]] = {}         # hash -> label -> sets
    inside = np.zeros(len(values), bool)
    out = []

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for i in np.argsort(sizes, kind="stable").tolist():
        n, label, near = int(sizes[i]), int(own_label[i]), set()
        mine = find(label)
        for h in held.get(i, ()):
            by = seen.setdefault(h, {})
            for other, held_by in by.items():
                if other != label and find(other) != mine:
                    near.update(held_by)
            by.setdefault(label, []).append(i)
        if not near:
            continue
        near = np.array(sorted(near))
        near = near[100 * sizes[near] >= threshold * n]
        if not len(near):
            continue
        own = flat[starts[i]:starts[i] + n]
        inside[own] = True
        ends = np.cumsum(sizes[near])
        spots = np.arange(ends[-1]) + np.repeat(starts[near] - ends + sizes[near], sizes[near])
        both = np.add.reduceat(inside[flat[spots]], ends - sizes[near], dtype=np.int64)
        for j in near[100 * both >= threshold * (n + sizes[near] - both)].tolist():
            a, b = find(label), find(own_label[j])
            if a != b:
                top[max(a, b, key=lambda x: least[x])] = min(a, b, key=lambda x: least[x])
                out.append((ids[j], ids[i]))
        inside[own] = False
    return out


def _prefixes(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, labels: np.ndarray, threshold: int) -> dict[int, list[int]]:
    """The rarest hashes of each set, as many as leave fewer than the threshold asks for; without
    those that only sets of one label have among theirs."""
    hashes, owners = [], []
    for i, (at, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
        take = n - (threshold * n + 99) // 100 + 1
        own = flat[at:at + n]
        hashes.append(np.partition(own, take - 1)[:take] if take < n else own)
        owners.append(np.full(len(hashes[-1]), i, np.int32))
    hashes, owners = np.concatenate(hashes), np.concatenate(owners)
    by = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[by], owners[by]
    cuts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    own = labels[owners]
    several = np.minimum.reduceat(own, cuts) != np.maximum.reduceat(own, cuts)
    use = np.repeat(several, np.diff(np.append(cuts, len(hashes))))
    out: dict[int, list[int]] = {}
    for h, i in zip(hashes[use].tolist(), owners[use].tolist()):
        out.setdefault(i, []).append(h)
    return out


def _hidden_links(rows: DataFrame, comp: DataFrame, full: DataFrame, threshold: int) -> DataFrame:
    """Links across components in buckets that hold more than one component."""
    import pandas as pd

    named = stage(rows.select("band", "key", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                  .withColumn("component", F.coalesce("component", "rep")), "minhash-rows")
    open_ = stage(named.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                  .filter("lo <> hi").select("band", "key", "lo"), "minhash-open")
    inside = stage(named.join(open_, ["band", "key"]).select("lo", "rep", "component").distinct(), "minhash-inside")
    # classes that are already linked are one node here: a bucket joins its components, not its classes
    cluster = connected_components(inside.filter("lo <> component").select("lo", "component").distinct(), "lo", "component")
    members = stage(inside.select(F.col("rep").alias("id"), "component").distinct()
                    .join(cluster.select(F.col("node").alias("component"), F.col("component").alias("cluster")), "component")
                    .join(full, "id"), "minhash-members")
    sizes = stage(members.groupBy("cluster").agg(F.ceil(F.sum(F.length("s")) / BLOCK_BYTES).cast("int").alias("cells")), "minhash-sizes")
    cells = (members.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
             .select("cluster", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "id", "component", "s"))

    def compare(pdf: "pd.DataFrame") -> "pd.DataFrame":
        found = _links_in(pdf["id"].to_list(), pdf["component"].to_list(), pdf["s"].to_list(), threshold)
        return pd.DataFrame({"a": pd.Series([f[0] for f in found], dtype=pdf["id"].dtype),
                             "b": pd.Series([f[1] for f in found], dtype=pdf["id"].dtype)})

    return stage(cells.groupBy("cluster", "x", "y").applyInPandas(compare, _links(full)).distinct(), "minhash-hidden")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 75) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    ``component_id`` is the least id of the near-duplicate group and ``kept``
    marks the row whose id it is.  ``threshold`` is the similarity in hundredths;
    ``BANDS`` and ``ROWS`` are set for 75 and above.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    if isinstance(kind, T.IntegralType):
        kind = T.LongType()
    signed = stage(signatures(docs, id_col, text_col).withColumn("id", F.col("id").cast(kind)), "minhash-signed")
    classes = stage(signed.filter("digest is not null").groupBy("digest")
                    .agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
                    .filter("rep is not null"), "minhash-classes")
    bucket_rows = classes.select("rep", "n_shingles", F.posexplode("bands").alias("band", "key"))
    hubs = stage(bucket_rows.groupBy("band", "key").agg(F.min(F.struct("rep", "n_shingles")).alias("hub"), F.count("*").alias("size"))
                 .filter("size > 1").select("band", "key", F.col("hub.rep").alias("hub"), F.col("hub.n_shingles").alias("hub_n")), "minhash-hubs")
    rows = stage(bucket_rows.join(hubs, ["band", "key"]), "minhash-buckets")
    pairs = stage(rows.filter("rep <> hub").filter(100 * F.least("n_shingles", "hub_n") >= threshold * F.greatest("n_shingles", "hub_n"))
                  .select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "minhash-pairs")
    full = _full_sets(docs, rows.select(F.col("rep").alias("id")).distinct(), id_col, text_col)
    links = _confirm(pairs, full, threshold)
    comp = connected_components(links)
    hidden = _hidden_links(rows, comp, full, threshold)
    if not hidden.isEmpty():
        comp = connected_components(links.unionByName(hidden))
    named = stage(classes.select("digest", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                  .select("digest", F.coalesce("component", "rep").alias("component")), "minhash-named")
    return (signed.join(named, "digest", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.col(id_col) == F.col("component_id")))
