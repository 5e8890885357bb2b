"""Numeric expressions with one rounding rule and order-independent sums."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Ten digits after the point, eighteen before it; the sum of many has room for ten more digits.
EXACT = "decimal(28,10)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int = 0) -> Column:
    """Halves away from zero, on doubles; the only rounding used in the package.

    NaN, infinities and numbers too large to have digits behind the point stay as they are.
    """
    scale = float(10 ** digits)
    x = _col(c).cast("double")
    size = F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(F.isnan(x) | (F.abs(x) * F.lit(scale) >= F.lit(2.0 ** 53)), x).otherwise(
        F.when(x < 0, -size).otherwise(size) + F.lit(0.0))


def percent(num: Column | str, den: Column | str, digits: int | None = None) -> Column:
    """num / den * 100, and 0 where the denominator is 0 or missing."""
    den = _col(den).cast("double")
    value = F.when(F.coalesce(den, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
        F.try_divide(_col(num).cast("double"), den) * F.lit(100.0))
    return value if digits is None else round_half_up(value, digits)


def exact_sum(c: Column | str) -> Column:
    """Sum that does not depend on the order in which partitions merge, exact to ten digits behind the point.

    With values that don't fit (NaN, infinities, 1e18 and more) it is the plain sum of doubles.
    """
    x = _col(c)
    exact = x.try_cast(EXACT)
    return F.when(F.count(exact) == F.count(x), F.sum(exact).cast("double")).otherwise(F.sum(x.cast("double")))


def exact_avg(c: Column | str) -> Column:
    """Mean over the non-null values, built on `exact_sum`; null for no values."""
    c = _col(c)
    return F.try_divide(exact_sum(c), F.count(c))


def clamp(c: Column | str, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), _col(c)))


def bubble_size(votes: Column | str) -> Column:
    """Log-scaled marker size; 10 for missing votes."""
    votes = _col(votes)
    return F.when(votes.isNull(), F.lit(10)).otherwise((F.log(votes + 1) * 5).cast("int"))


def quadrant_label(rate: Column, score: Column, rate_cut: float, score_cut: float,
                   names: tuple[str, str, str, str]) -> Column:
    """Four classes: (high rate, high score), (low, high), (high, low), (low, low)."""
    both, praised, popular, neither = names
    return (F.when((rate > rate_cut) & (score > score_cut), both)
            .when((rate <= rate_cut) & (score > score_cut), praised)
            .when((rate > rate_cut) & (score <= score_cut), popular)
            .otherwise(neither))


def hash_unit(key: Column | str, seed: str = "") -> Column:
    """Deterministic number in [0, 1) from the first 32 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(seed), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
