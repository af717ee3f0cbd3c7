"""Threshold-scaled document sketches with DataFrame functions only.

A text's sketch is the set of hashes of its distinct 5-word shingles that fall below
a fixed fraction of the hash space (1 / 2**``BITS``).  The rule looks at each hash
alone, so sketches of parts merge by union, and a short text's containment in a very
long one can be estimated from sketches of very different sizes.  A text whose
hashes all lie above the fraction keeps its least hash, so only texts without words
have an empty sketch.

Edge cases: null is the empty text; a text of fewer than five words has its whole
word sequence as one shingle; equal texts have equal sketches; two empty sketches
are alike (1.0), an empty and a full one are not (0.0); repeated rows stay rows; ids may be
of any type that has an order, repeated or null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shoplens.llm.common import SHINGLE, ascii_lower, ensure_checkpoint_dir, stage

BITS = 3                    # one shingle in 8

SPACES = r"[\x20\x09-\x0D]+"


def text_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SPACES), "")


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Hashes of all shingles of an array column of words, in order.

    ``words`` must be a plain column: an expression would be evaluated per shingle.
    """
    n = F.size(words)
    return (F.when(n >= size, F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size))))
            .when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>")))


def keep_below(hashes: Column, bits: int = BITS) -> Column:
    """Sketch (sorted distinct hashes) of an array of shingle hashes, or of merged sketches."""
    low = F.filter(hashes, lambda h: (h >= 0) & (h < (1 << (63 - (bits - 1)))))
    return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))) \
        .when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(F.array().cast("array<bigint>"))


def with_sketch(df: DataFrame, text_col: str, out: str, bits: int = BITS) -> DataFrame:
    """``df`` plus the sketch of a text column (which must not be null)."""
    return df.withColumn("__words", text_words(F.col(text_col))).withColumn("__hashes", shingle_hashes(F.col("__words"))) \
        .withColumn(out, keep_below(F.col("__hashes"), bits)).drop("__words", "__hashes")


def merge(a: Column, b: Column, bits: int = BITS) -> Column:
    """Sketch of two texts' joint shingles from their sketches."""
    return keep_below(F.concat(a, b), bits)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either > 0, both / either).otherwise(F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second holds."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(1.0))


def as_string(sketch: Column) -> Column:
    """Printable form: the hashes in hexadecimal, in order."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


def next_by_id(docs: DataFrame, id_col: str, columns: list[str], derive=lambda df: df) -> DataFrame:
    """``derive(docs)`` plus ``next_<c>`` of the document with the next smaller id
    (after the last one, the first), without ordering all rows in one task.

    Rows are dealt out and written in ranges of their order, which hold about the same
    number each whatever the ids are: far apart, alike for a third of all rows, or
    missing.  The first row of each range is also given to the range before it, so every
    range can be ordered alone.  The table of ranges has one row per partition.
    Ids may be of any type that has an order; null ids come last, and rows of one id are
    ordered by their columns' hash.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    order = [F.desc_nulls_last(id_col), F.asc("__hash")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = stage(docs.withColumn("__hash", F.xxhash64(*docs.columns)).repartitionByRange(n, *order)
                 .withColumn("__range", F.spark_partition_id()), "fingerprint-ranges")
    first = F.struct(F.col(id_col).isNotNull(), F.col(id_col), F.bitwise_not("__hash"))       # the greatest comes first
    heads = held.groupBy("__range").agg(F.max_by(F.struct(*docs.columns, "__hash"), first).alias("__head"))
    by = W.orderBy("__range")                    # one row per partition
    heads = stage(heads.select("__head", F.coalesce(F.lag("__range").over(by), F.max("__range").over(W.partitionBy())).alias("__range")),
                  "fingerprint-heads")
    own = derive(held.withColumn("__extra", F.lit(0)))
    extra = derive(heads.select("__head.*", "__range", F.lit(1).alias("__extra")))
    in_range = W.partitionBy("__range").orderBy("__extra", *order)
    return own.unionByName(extra).select("*", *[F.lead(c).over(in_range).alias(f"next_{c}") for c in columns]) \
        .filter("__extra = 0").drop("__range", "__extra", "__hash")


def fingerprints(docs: DataFrame, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` plus n_chars and sketch; a null text becomes empty."""
    docs = docs.withColumn(text_col, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return with_sketch(docs.withColumn("n_chars", F.length(F.col(f"`{text_col}`")).cast("long")), text_col, "sketch", bits)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """Sketch of each text and of its edited form, whose last half is replaced by the
    beginning of the next document (by descending id), and their likeness."""
    base = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    paired = next_by_id(base, id_col, ["text", "sketch"], lambda df: fingerprints(df, "text", bits))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
                      F.substring(F.col("next_text"), F.lit(1), half))
    done = with_sketch(paired.select(id_col, "n_chars", "sketch", "next_sketch", edited.alias("edited")), "edited", "edited_sketch", bits)
    return done.select(id_col, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "sketch", "edited_sketch",
                       likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
                       containment(F.col("sketch"), F.col("edited_sketch")).alias("held_by_edited"))
