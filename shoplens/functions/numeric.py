"""Numeric helpers with numpy/pandas semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def np_round(col: Column | str, digits: int) -> Column:
    """numpy/pandas ``round``: ``rint(x * 10^n) / 10^n`` (half to even on the scaled value)."""
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def py_round(col: Column | str, digits: int) -> Column:
    """Python's ``round``: the double's exact value rounded half to even.

    The scaled product may fall on a half only by its own rounding; the product's
    exact error (split multiplication) then tells on which side the value lies.
    """
    c = F.col(col) if isinstance(col, str) else col
    scale = F.lit(float(10 ** digits))
    p = c * scale
    high = c * F.lit(134217729.0)
    high = high - (high - c)
    error = (high * scale - p) + (c - high) * scale
    low = F.floor(p).cast("double")
    on_half = p - low == F.lit(0.5)
    r = F.rint(p)
    # no branches: what they share would be worked out in each of them
    up, down = on_half & (error > 0) & (r == low), on_half & (error < 0) & (r != low)
    return (r + up.cast("double") - down.cast("double")) / scale


NUMBER = r"^[ \t\r\n\f]*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])[ \t\r\n\f]*$"


def parse_number(col: Column) -> Column:
    """A text as double if it reads as a number; NULL otherwise (``10d`` is none)."""
    text = F.trim(col.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def clip(col: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """pandas ``clip``: NULL stays NULL, bounds applied with least/greatest."""
    out = col
    if lower is not None:
        out = F.when(out.isNull(), None).otherwise(F.greatest(out, F.lit(float(lower))))
    if upper is not None:
        out = F.when(out.isNull(), None).otherwise(F.least(out, F.lit(float(upper))))
    return out


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL instead of raising (ANSI mode) on a zero divisor."""
    return F.try_divide(num, den)


def days_between(later: Column, earlier: Column) -> Column:
    """Elapsed whole days between two timestamps (``Timedelta.days``: floor)."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def exact_sum(col: Column | str, scale: int = 9) -> Column:
    """Sum of doubles accumulated as DECIMAL(38, scale): independent of summation order,
    so partitioning and task order never change the last bit.  NaN counts as missing, as
    in pandas; infinite values make the sum infinite (NaN if there are both)."""
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    infinite = F.abs(c) == F.lit(float("inf"))
    finite = F.sum(F.when(~infinite & ~F.isnan(c), c).cast(f"decimal(38,{scale})")).cast("double")
    return F.coalesce(F.sum(F.when(infinite, c)), finite)


def exact_mean(col: Column | str, scale: int = 9) -> Column:
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    return exact_sum(c, scale) / F.count(F.when(~F.isnan(c), c))


def count_cuts_below(col: Column, cuts: list[float], inclusive: bool = False) -> Column:
    """Number of sorted ``cuts`` below ``col`` (``<=`` when ``inclusive``) as a balanced
    CASE tree: log2(len(cuts)) plain comparisons, no lambda, inside codegen."""
    def below(c: float) -> Column:
        return F.lit(c) <= col if inclusive else F.lit(c) < col

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(below(cuts[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(cuts)).cast("int")
