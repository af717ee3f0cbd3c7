"""Periodic runs of words, by scale-tiled tiles.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical) that no neighbouring word extends and that is at least ``EXPONENT`` periods
and ``LEAST`` words long.

Tiles
    Octave ``k`` looks for the periods from ``B = 2**k`` up to ``2 * B - 1``.  For it a
    document is exploded into tiles of ``max(TILE, 32 * B)`` words that overlap by
    ``6 * B``: a stretch of ``4 * B`` places whose words equal those one period later lies
    wholly in some tile, so that a run of any length is a chain of overlapping fragments.
    Documents of up to ``IN_PLACE`` words have their tiles solved in the task that read
    them; the tiles of longer ones are rows, which any task can solve.
Boundaries
    A run of ``EXPONENT`` periods has two neighbouring aligned blocks of ``B`` words that
    occur again one period later.  Names of all blocks (hashes, by doubling) show at which
    boundaries that may be so; there, two Z-functions, one to the right and one to the
    left, give how far every period of the octave extends.  Names only choose boundaries:
    each fragment is measured on the words themselves.
Stitching
    Fragments are shuffled by document and period, and overlapping ones joined; what is
    then long enough is a run.  A period that is a multiple of a smaller one is dropped
    where its fragment is found, by the Z-function from the fragment's start.

Edge cases: a null or empty text has no words and no runs; an empty table gives an empty
table; rows are independent, so repeated rows, repeated or null ids and ties do not
matter; other columns are carried along, those that have the name of an added column are
replaced.  Work and memory of a document follow its length.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import GOLDEN, batches_bytes, ensure_checkpoint_dir, in_groups, lean, mix64, stage

EXPONENT, LEAST = 4, 6
TILE = 1 << 13
IN_PLACE = 1 << 17        # words of a document whose tiles stay in its task
_CALL = 64                # first window of a Z-function

ADDED = ["run_words", "run_count", "run_start", "run_length", "run_period"]


def z_function(s: list[int]) -> list[int]:
    """For each place, the length of the longest common prefix of ``s`` and its suffix there."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def primes_of(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] if n > 1 else out


def octaves(n: int, exponent: int = EXPONENT) -> int:
    """Number of octaves whose periods fit ``exponent`` times into ``n`` words."""
    return (n // exponent).bit_length()


def tiles(n: int, k: int) -> list[tuple[int, int]]:
    """Tiles (from, to) of a document of ``n`` words in octave ``k``."""
    size, step = max(TILE, 32 << k), max(TILE, 32 << k) - (6 << k)
    out = [(0, min(n, size))]
    while out[-1][1] < n:
        at = out[-1][0] + step
        out.append((at, min(n, at + size)))
    return out


def _forward(ids: np.ndarray, at: int, hi: int, periods: list[int], window: int) -> list[int]:
    """How far the words from ``at`` equal those one period later, for each period."""
    while True:
        window = min(window, hi - at)
        z = z_function(ids[at:at + window].tolist())
        found = [z[p] if p < window else 0 for p in periods]
        if at + window == hi or all(p + f < window for p, f in zip(periods, found)):
            return found
        window *= 4


def _backward(ids: np.ndarray, at: int, lo: int, periods: list[int], window: int) -> list[int]:
    """The same to the left of ``at``."""
    reach = max(periods)
    while True:
        window = min(window, at - lo)
        before = ids[at - window:at][::-1].tolist()
        z = z_function([*before, -1, *ids[at - window:at + reach][::-1].tolist()])
        found = [min(z[window + 1 + reach - p], window) for p in periods]
        if at - window == lo or max(found) < window:
            return found
        window *= 4


def solve(parts: list[np.ndarray], k: int) -> list[tuple[int, int, int, int]]:
    """Fragments (tile, period, from, to) in some tiles, periods ``2**k`` to ``2**(k + 1) - 1``.

    ``parts`` hold the words of each tile as ids of at least 0.  A fragment is a
    maximal stretch of that period within its tile, in words of the tile.  Those that
    lie inside the tile are at least ``EXPONENT`` periods long, those at an edge at
    least ``3 * 2**k`` words and a period; multiples of a smaller period are left out.
    """
    block = 1 << k
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes + 1) - 1                       # each tile and a separator
    starts = ends - sizes
    total = int(ends[-1]) + 1
    ids = np.empty(total + 4 * block, np.int64)
    for part, a, b in zip(parts, starts.tolist(), ends.tolist()):
        ids[a:b] = part
    ids[ends] = -2 - np.arange(len(parts))
    ids[total:] = -2 - len(parts) - np.arange(4 * block)
    names = mix64(ids.view(np.uint64) * GOLDEN)
    for j in range(k):
        names = mix64(names[:-(1 << j)] * GOLDEN + names[1 << j:])
    rows = len(names) // block - 1
    if rows < 2:
        return []
    again = names[block:(rows + 1) * block].reshape(rows, block) == names[:rows * block:block, None]
    at, off = np.nonzero(again[:-1] & again[1:])
    out: list[tuple[int, int, int, int]] = []
    if not len(at):
        return out
    cuts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    place = (at[cuts] * block).tolist()
    tile_of = np.searchsorted(ends, at[cuts] * block, side="right").tolist()
    off, cuts = (off + block).tolist(), [*cuts.tolist(), len(off)]
    covered: dict[int, int] = {}                          # period -> where its last fragment's matches end
    for i, x in enumerate(place):
        periods = [p for p in off[cuts[i]:cuts[i + 1]] if covered.get(p, 0) <= x]
        if not periods:
            continue
        tile = tile_of[i]
        lo, hi = int(starts[tile]), int(ends[tile])
        window = max(_CALL, 8 * block)
        right = _forward(ids, x, hi, periods, window)
        left = _backward(ids, x, lo, periods, window) if x > lo else [0] * len(periods)
        prefix: dict[int, list[int]] = {}
        for p, r, b in zip(periods, right, left):
            s, t = x - b, x + p + r
            if r:
                covered[p] = x + r
            inside = s > lo and t < hi
            if t - p - s < (max((EXPONENT - 1) * p, LEAST - p) if inside else (EXPONENT - 1) * block):
                continue
            z = prefix.get(s)
            if z is None:
                z = prefix[s] = z_function(ids[s:s + 2 * max(periods)].tolist())
            if any(z[p // r_] >= min(p, len(z) - p // r_) for r_ in primes_of(p)):
                continue
            out.append((tile, p, s - lo, t - lo))
    return out


def fragments(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Fragments (period, from, to) of each text, octave by octave and tile by tile."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k in range(max([0, *(octaves(len(t)) for t in texts)])):
        cut = [(i, a, b) for i, t in enumerate(texts) if len(t) >= max(LEAST, EXPONENT << k) for a, b in tiles(len(t), k)]
        if cut:
            for tile, p, s, t in solve([texts[i][a:b] for i, a, b in cut], k):
                i, a, _ = cut[tile]
                out[i].append((p, a + s, a + t))
    return out


def word_ids(raws: list[bytes]) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """Words of each text and their ids, equal for equal words of these texts."""
    known: dict[bytes, int] = {}
    words = [raw.split() for raw in raws]
    number = itertools.count()
    return words, [np.fromiter(map(known.setdefault, w, number), np.int64, len(w)) for w in words]


def drop_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those of runs (start, length, period) beyond the first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


_FRAGMENT = "array<struct<period:long,s:long,t:long>>"


def _scan(docs: DataFrame, text_col: str, others: list[str], digest: bool) -> DataFrame:
    """Rows of documents with their fragments, and rows of tiles that wait for a task of their own.

    Written, so that ``key`` names a row from here on.
    """
    import pyarrow as pa

    quoted = [F.col(f"`{n}`") for n in others]
    base = docs.select(F.struct(*quoted).alias("rest") if quoted else F.lit(None).cast("int").alias("rest"),
                       F.col(f"`{text_col}`").alias("text"), F.monotonically_increasing_id().alias("key"))
    rest = base.schema["rest"].dataType
    out = T.StructType([T.StructField("key", T.LongType()), T.StructField("rest", rest), T.StructField("n", T.LongType()),
                        T.StructField("words", T.BinaryType()), T.StructField("sha", T.StringType()),
                        T.StructField("found", T._parse_datatype_string(_FRAGMENT)),
                        T.StructField("octave", T.IntegerType()), T.StructField("at", T.LongType()), T.StructField("ids", T.BinaryType())])

    @lean
    def run(batches):
        for batch in batches:
            raws = batches_bytes(batch.column("text"))
            for first, group in in_groups(raws):
                size = len(group)
                keys, rests = batch.column("key").slice(first, size), batch.column("rest").slice(first, size)
                words, ids = word_ids(group)
                far = [len(i) > IN_PLACE for i in ids]
                found = fragments([i if not f else i[:0] for i, f in zip(ids, far)])
                joined = [b" ".join(w) for w in words]
                yield pa.RecordBatch.from_arrays(
                    [keys, rests, pa.array(list(map(len, words)), pa.int64()),
                     pa.array([j if f or g or not digest else None for j, f, g in zip(joined, found, far)], pa.binary()),
                     pa.array([hashlib.sha256(j).hexdigest() if digest else None for j in joined], pa.string()),
                     pa.array([[{"period": p, "s": s, "t": t} for p, s, t in f] or None for f in found],
                              pa.list_(pa.struct([("period", pa.int64()), ("s", pa.int64()), ("t", pa.int64())]))),
                     pa.nulls(size, pa.int32()), pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary())],
                    names=out.names)
                for j in (j for j, f in enumerate(far) if f):
                    own = np.unique(ids[j], return_inverse=True)[1].astype(np.int32)
                    for k in range(octaves(len(own))):
                        for a, b in tiles(len(own), k):
                            yield pa.RecordBatch.from_arrays(
                                [keys.slice(j, 1), pa.nulls(1, rests.type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                 pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.struct([("period", pa.int64()), ("s", pa.int64()), ("t", pa.int64())]))),
                                 pa.array([k], pa.int32()), pa.array([a], pa.int64()), pa.array([own[a:b].tobytes()], pa.binary())],
                                names=out.names)

    return stage(base.mapInArrow(run, out), "periodic-scan")


def _far_fragments(rows: DataFrame) -> DataFrame:
    """(key, period, s, t) of the tiles that are rows, dealt over all tasks."""
    import pyarrow as pa

    @lean
    def run(batches):
        for batch in batches:
            for key, k, at, raw in zip(*(batch.column(n).to_pylist() for n in ("key", "octave", "at", "ids"))):
                found = solve([np.frombuffer(raw, np.int32).astype(np.int64)], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(found), pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                     pa.array([at + f[2] for f in found], pa.int64()), pa.array([at + f[3] for f in found], pa.int64())],
                    names=["key", "period", "s", "t"])

    return (rows.filter("octave is not null").select("key", "octave", "at", "ids").repartition("key", "octave", "at")
            .mapInArrow(run, "key long, period long, s long, t long"))


def _stitch(found: DataFrame) -> DataFrame:
    """Runs (key, start, length, period) from fragments (key, period, s, t) of all tiles.

    Fragments of one period whose matching places overlap or touch are one stretch.
    """
    by = Window.partitionBy("key", "period").orderBy("s", "t")
    before = F.max(F.col("t") - F.col("period")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    cut = F.when(F.col("s") <= before, 0).otherwise(1)
    return (found.withColumn("cut", cut).withColumn("island", F.sum("cut").over(by))
            .groupBy("key", "period", "island").agg(F.min("s").alias("start"), (F.max("t") - F.min("s")).alias("length"))
            .filter((F.col("length") >= LEAST) & (F.col("length") >= EXPONENT * F.col("period")))
            .select("key", "start", "length", "period"))


def _solved(docs: DataFrame, text_col: str, others: list[str], digest: bool) -> tuple[DataFrame, DataFrame]:
    rows = _scan(docs, text_col, others, digest)
    near = rows.filter("found is not null").select("key", F.explode("found").alias("f")).select("key", "f.period", "f.s", "f.t")
    return rows.filter("octave is null"), _stitch(near.unionByName(_far_fragments(rows)))


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per run: the other columns of its document, ``run_start`` (word number from 0),
    ``run_length`` and ``run_period`` in words."""
    ensure_checkpoint_dir(docs.sparkSession)
    others = [f.name for f in docs.schema.fields if f.name not in (text_col, *ADDED)]
    rows, runs = _solved(docs, text_col, others, True)
    return rows.join(runs, "key").select(*[F.col("rest").getField(n).alias(n) for n in others], F.col("start").alias("run_start"),
                                         F.col("length").alias("run_length"), F.col("period").alias("run_period"))


def collapse_runs(docs: DataFrame, text_col: str = "text", digest: bool = False) -> DataFrame:
    """``docs`` with every run cut to its first period, one space between words.

    Adds ``run_words`` (words of the input), ``run_count`` and, of the longest run (ties:
    smallest start, then period), ``run_start``, ``run_length``, ``run_period``; null
    without runs.  With ``digest`` the text column goes and ``runs_sha256`` (of the lines
    ``start,length,period`` in order) and ``collapsed_sha256`` come.
    """
    import pyarrow as pa

    ensure_checkpoint_dir(docs.sparkSession)
    added = ADDED + (["runs_sha256", "collapsed_sha256"] if digest else [])
    others = [f.name for f in docs.schema.fields if f.name not in (text_col, *added)]
    rows, runs = _solved(docs, text_col, others, digest)
    listed = runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    out = T.StructType([T.StructField("rest", rows.schema["rest"].dataType), *[T.StructField(n, T.LongType()) for n in ADDED],
                        *[T.StructField(n, T.StringType()) for n in (added[len(ADDED):] if digest else ["text"])]])

    @lean
    def finish(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in out.names[1:]]
            for n, joined, sha, found in zip(batch.column("n").to_pylist(), batch.column("words").to_pylist(),
                                             batch.column("sha").to_pylist(), batch.column("runs").to_pylist()):
                own = [(f["start"], f["length"], f["period"]) for f in found or ()]
                best = min(own, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                kept = b" ".join(drop_repeats(joined.split(b" "), own)) if own else joined
                row = [n, len(own), *best]
                if digest:
                    lines = "".join([f"{s},{l},{p}\n" for s, l, p in own])
                    row += [hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest() if own else sha]
                else:
                    row += [kept.decode("utf-8", "surrogatepass")]
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), *[pa.array(c, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64())
                                         for c, f in zip(columns, out.fields[1:])]], names=out.names)

    done = rows.select("key", "rest", "n", "words", "sha").join(listed, "key", "left").select("rest", "n", "words", "sha", "runs") \
        .mapInArrow(finish, out)
    by_name = {n: F.col("rest").getField(n).alias(n) for n in others} | {n: F.col(n) for n in added}
    if not digest:
        by_name[text_col] = F.col("text").alias(text_col)
    order = [f.name for f in docs.schema.fields if f.name in by_name and f.name not in added]
    return done.select(*[by_name[n] for n in [*order, *added]])
