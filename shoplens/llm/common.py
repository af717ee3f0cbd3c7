"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import gc

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import session
from shoplens.session import materialize

__all__ = ["GOLDEN", "ascii_lower", "batches_bytes", "block_groups", "ensure_checkpoint_dir", "in_groups", "lean", "materialize", "mix64", "read",
           "release", "shingle_hashes", "stage", "word_hashes", "words"]

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)

SHINGLE = 5
GROUP_BYTES = 256 << 10    # of texts that are treated together in arrays

BATCH_BYTES = 8 << 20       # of an Arrow batch, unless the application sets its own

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder; also ships this package and bounds Arrow batches in bytes.

    Every operator calls it before it makes its first Python function.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(BATCH_BYTES))
    return session.ensure_checkpoint_dir(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (Spark's ``lower`` folds every script)."""
    return F.translate(col, _UPPER, _UPPER.lower())


def words(text: str | bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text after lower-casing A-Z, as UTF-8.

    ``bytes.lower`` folds ASCII only and ``bytes.split`` splits at exactly
    ``\\x20\\x09-\\x0D``; UTF-8 continuation bytes never fall in either class.
    """
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    return raw.lower().split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising permutation of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_hashes(tokens: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of one text.

    A text of fewer words than ``size`` has one shingle, its whole sequence; a
    text without words has none.
    """
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    h = word_hashes(tokens)
    width = min(size, n)
    acc = np.full(n - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        acc = mix64(acc * GOLDEN + h[k:n - width + 1 + k])
    return np.unique(acc)


def batches_bytes(column) -> list[bytes]:
    """A string column of an Arrow batch as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type)
                                          else pa.binary()).to_pylist()]


def in_groups(raws: list[bytes], size: int = GROUP_BYTES):
    """(index of the first, texts) of runs of texts of bounded size; a longer text is alone."""
    first, total = 0, 0
    for k, raw in enumerate(raws):
        if k > first and total + len(raw) > size:
            yield first, raws[first:k]
            first, total = k, 0
        total += len(raw)
    if raws[first:]:
        yield first, raws[first:]


def block_groups(texts: list[str], blocks, size: int):
    """Lists of (row, block, whether it is the row's last) over the blocks of some texts, by bounded size."""
    group, total = [], 0
    for row, text in enumerate(texts):
        held = None
        for block in blocks(text):
            if held is not None:
                group.append((row, held, False))
                total += len(held)
                if total > size:
                    yield group
                    group, total = [], 0
            held = block
        group.append((row, held, True))
        total += len(held)
        if total > size:
            yield group
            group, total = [], 0
    if group:
        yield group


def lean(run):
    """A function over Arrow batches that gives the memory it has freed back when its task ends.

    Python workers are kept from task to task and stage to stage; allocators keep what they
    have freed, which would add up over the stages of a pipeline.
    """
    @functools.wraps(run)
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return inner


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are already written.

    They go when the driver collects its garbage, which on a mostly idle driver
    happens rarely; a long job calls this between its stages.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write a stage's result to the shared folder, read it back and free its shuffles."""
    out = materialize(df, tag)
    release(df.sparkSession)
    return out
