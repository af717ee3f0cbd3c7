"""Benchmark decontamination with DataFrame functions only.

Both sides are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
The items' windows of ``n`` words (an item of fewer words is one window) are a small
table, broadcast if its counted size is within ``BROADCAST_WINDOWS`` and shuffled
otherwise.  A scan of the documents hashes every window of words; a hash that meets
one of the table is verified word by word.  With the broadcast table that is done in
the same stage, so nothing but verified hits is shuffled; with the shuffled one each
window of a document is sent with its own words (at most ``n``) and no others, so the
shuffle grows in proportion to the texts.  Hits are then merged per document.

Edge cases: null or empty texts have no words and are clean; items without words
have no window; rows without an item id are one item, whose windows count like any and
whose entry in ``items`` is null (last); repeated rows are judged alike, each on its own; several items may
share a window and all are counted; an empty benchmark leaves every document clean;
other columns are kept and the added ones replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ascii_lower, stage

WINDOW = 10
BROADCAST_WINDOWS = 1_000_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ADDED = ["n_words", "n_hit", "n_items", "items", "hit_words", "contaminated"]


def item_words(text: Column) -> Column:
    """Lower-cased words of a text as an array; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _window_hashes(words: Column, length: int) -> Column:
    """Hash of every run of ``length`` words, by start."""
    n = F.size(words)
    return F.when(n >= length, F.transform(F.sequence(F.lit(1), n - (length - 1)),
                                           lambda i: F.xxhash64(F.slice(words, i, length)))).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(bench: DataFrame, item_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """(len, h, window, items): the distinct windows of all items, with the items that hold each."""
    items = bench.select(F.col(item_col).cast("string").alias("item"), item_words(F.col(text_col)).alias("words")) \
        .filter(F.size("words") > 0)
    size = F.size("words")
    runs = items.select("item", "words", F.least(size, F.lit(n)).alias("len"),
                        F.explode(F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1)))).alias("at"))
    return (runs.select("item", "len", F.slice("words", F.col("at"), F.col("len")).alias("window"))
            .groupBy("len", "window").agg(F.collect_set(F.struct("item")).alias("items"))      # a struct, as null is an item too
            .select("len", F.xxhash64("window").alias("h"), "window", F.col("items.item").alias("items")))


def windows_of(keyed: DataFrame, length: int) -> DataFrame:
    """(id, tkey, at, h, run) of every window of (id, tkey, words), ``run`` being the window's words alone."""
    spots = keyed.select("id", "tkey", "words", F.posexplode(_window_hashes(F.col("words"), length)).alias("at", "h"))
    return spots.select("id", "tkey", "at", "h", F.slice("words", F.col("at") + 1, length).alias("run"))


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", bench_text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """``docs`` plus n_words, n_hit, n_items (long), items (sorted array of string),
    hit_words (sorted array of word positions from 0) and contaminated.

    A document is recognised by its id and text, so repeated ids are allowed.
    """
    windows = stage(benchmark_windows(bench, item_col, bench_text_col, n), "decontaminate-windows")
    lengths = [r["len"] for r in windows.groupBy("len").count().select("len").collect()]     # at most n numbers
    small = windows.count() <= BROADCAST_WINDOWS
    side = F.broadcast(windows) if small else windows
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    keyed = texts.select("id", F.xxhash64("text").alias("tkey"), item_words(F.col("text")).alias("words"))
    hits = None
    for length in sorted(lengths):
        ours = side.filter(F.col("len") == length).select("h", "window", "items")
        if small:       # the words stay in the scan's stage and are cut only where a hash meets
            spots = keyed.select("id", "tkey", "words", F.posexplode(_window_hashes(F.col("words"), length)).alias("at", "h"))
            # no plain equality, which would become a key of the join and cut every window out
            met = spots.join(ours, "h").filter(F.slice("words", F.col("at") + 1, length).between(F.col("window"), F.col("window")))
        else:
            met = windows_of(keyed, length).join(ours, "h").filter(F.col("run") == F.col("window"))
        found = met.select("id", "tkey", "at", F.lit(length).alias("len"), "items")
        hits = found if hits is None else hits.unionByName(found)
    kept = [f"`{c}`" for c in docs.columns if c not in ADDED]
    base = docs.select(*kept, F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("__tkey"),
                       F.size(item_words(F.col(f"`{text_col}`"))).cast("long").alias("n_words"))
    if hits is None:
        none = F.array().cast("array<string>")
        return base.drop("__tkey").select("*", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                                          none.alias("items"), F.array().cast("array<int>").alias("hit_words"),
                                          F.lit(False).alias("contaminated"))
    merged = (hits.groupBy("id", "tkey")
              .agg(F.collect_set(F.struct("at", "len")).alias("runs"), F.collect_set("items").alias("item_sets"))
              .select(F.col("id").alias("__id"), F.col("tkey").alias("__key"),
                      F.array_sort(F.array_distinct(F.flatten("item_sets"))).alias("items"),
                      F.array_sort(F.array_distinct(F.flatten(F.transform(
                          "runs", lambda r: F.sequence(r["at"], r["at"] + r["len"] - 1))))).alias("hit_words")))
    merged = stage(merged, "decontaminate-hits")
    joined = base.join(merged, (base[f"`{id_col}`"].eqNullSafe(merged["__id"])) & (base["__tkey"] == merged["__key"]), "left")
    count = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long")
    return joined.select(*kept, "n_words", count("hit_words").alias("n_hit"), count("items").alias("n_items"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                         F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
                         F.col("hit_words").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, **names) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    return contaminated(docs, bench, **names).filter(~F.col("contaminated")).select(*[f"`{c}`" for c in docs.columns])


def strip_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", **names) -> DataFrame:
    """``docs`` with the hit words, and what follows each up to the next word, taken out of the text."""
    found = contaminated(docs, bench, text_col=text_col, **names)
    sep = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    units = F.split(F.col(f"`{text_col}`"), f"(?<={sep})(?!{sep})")
    lead = F.when(F.col(f"`{text_col}`").rlike(f"^{sep}"), 1).otherwise(0)     # the first unit may be separators only
    rest = F.array_join(F.filter(units, lambda u, i: ~F.array_contains("hit_words", i - lead)), "")
    new = F.when(F.col("contaminated"), rest).otherwise(F.col(f"`{text_col}`"))
    return found.select(*[(new.alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns])
