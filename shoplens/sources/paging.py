"""Ordered paging and fact-driven dimension samples (semi joins instead of id lists)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.ordered import in_ranges


def page(df: DataFrame, order_cols: Sequence[str], offset: int, length: int) -> DataFrame:
    """Rows [offset, offset + length) of ``df`` in ``order_cols`` order.

    One page of a table that is asked for one page; for several see :class:`Pages`.
    """
    return df.orderBy(*order_cols).offset(int(offset)).limit(int(length))


class Pages:
    """Pages of a table in ``order_cols`` order, each read from the ranges that hold it.

    The rows are written once in ranges of their order, and each range's first position is
    the running sum of the counts before it, a table of one row per range.  A page is the
    rows of at most the ranges it overlaps, numbered within them: no page reads or
    sorts what comes before it.  Rows that ``order_cols`` does not tell apart keep one
    order from page to page.
    """

    def __init__(self, df: DataFrame, order_cols: Sequence[str], ranges: int | None = None):
        every = [F.col(f"`{c}`") for c in df.columns]
        keys = {f"_o{i}": F.col(c) for i, c in enumerate(order_cols)} | {"_tie": F.xxhash64(*every)}
        self.order = list(keys)
        held = df.select(F.struct(*every).alias("row"), *[v.alias(k) for k, v in keys.items()])
        self.rows = in_ranges(held, self.order, "_rng", "pages", ranges)
        counts = self.rows.groupBy("_rng").agg(F.count(F.lit(1)).alias("n")).orderBy("_rng").collect()     # one row per range
        self.first, self.total = {}, 0
        for r in counts:
            self.first[r["_rng"]] = self.total
            self.total += r["n"]

    def ranges_of(self, offset: int, length: int) -> list[int]:
        """The ranges that hold rows of a page."""
        ends = [*list(self.first.values())[1:], self.total]
        return [r for (r, a), b in zip(self.first.items(), ends) if a < offset + length and b > offset]

    def page(self, offset: int, length: int) -> DataFrame:
        """Rows [offset, offset + length), in order."""
        use = self.ranges_of(offset, length)
        part = self.rows.where(F.col("_rng").isin(use) if use else F.lit(False))
        number = F.row_number().over(Window.partitionBy("_rng").orderBy(*self.order))
        start = F.coalesce(*[F.when(F.col("_rng") == r, F.lit(self.first[r])) for r in use], F.lit(0))
        placed = part.withColumn("_at", start + number - 1)
        return placed.where((F.col("_at") >= offset) & (F.col("_at") < offset + length)).orderBy("_at").select("row.*")


def paginated_rows(df: DataFrame, order_cols: Sequence[str], total_rows: int, page_size: int = 100) -> DataFrame:
    """The first ``total_rows`` rows in order, put together from pages of ``page_size``.

    As a paged source does it, page after page until one is short or the total is
    reached, each from the page index.
    """
    if page_size < 1:
        raise ValueError("page_size must be 1 or more")
    pages = Pages(df, order_cols)
    end = min(int(total_rows), pages.total)
    parts = [pages.page(at, min(page_size, end - at)) for at in range(0, end, page_size)] or [pages.page(0, 0)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def first_distinct(df: DataFrame, col: str, order_cols: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` distinct values of ``col`` in order of first appearance."""
    first = df.groupBy(col).agg(F.min(F.struct(*order_cols)).alias("_first"))
    return first.orderBy("_first").limit(int(n)).select(col)


def matching_rows(dim: DataFrame, dim_key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Distinct dimension rows whose key is in ``ids`` (left semi join)."""
    return dim.join(ids.withColumnRenamed(id_col, dim_key), dim_key, "left_semi").distinct()


def star_sample(fact: DataFrame, fact_order: Sequence[str], dims: dict[str, tuple[DataFrame, str, str]],
                n_facts: int = 500, n_ids: int = 80, fallback_rows: int = 100) -> dict[str, DataFrame]:
    """The fact sample (key ``facts``) and, per named (dimension, its key, the fact's key),
    the rows of the first ``n_ids`` keys; where none matches, the dimension's first
    ``fallback_rows`` rows by key."""
    out = {}
    for name, (dim, dim_key, fact_key) in dims.items():
        out["facts"], rows = sample_star(fact, fact_order, dim, dim_key, fact_key, n_facts, n_ids)
        out[name] = page(dim, [dim_key], 0, fallback_rows) if rows.isEmpty() else rows
    return out


def sample_star(fact: DataFrame, fact_order: Sequence[str], dim: DataFrame, dim_key: str, fact_key: str,
                n_facts: int = 500, n_ids: int = 80) -> tuple[DataFrame, DataFrame]:
    """First ``n_facts`` facts and the dimension rows of their first ``n_ids`` distinct keys."""
    facts = fact.orderBy(*fact_order).limit(int(n_facts))
    ids = first_distinct(facts, fact_key, list(fact_order), n_ids)
    return facts, matching_rows(dim, dim_key, ids, fact_key)
