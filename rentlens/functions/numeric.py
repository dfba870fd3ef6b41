"""Aggregates and ratios that give the same answer under any partitioning and never divide by zero."""

import math
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import as_column

# Numbers below the limit are added exactly, as whole millionths in limbs of a long each; larger ones are in the plain sum
# beside them. Below ``NEAR`` the millionths fit the 53 bits of a double; larger numbers give a limb of 2^32 off first.
EXACT_LIMIT = 1e20
NEAR = 9e9
TOP_LIMB = 1 << 32
LOW_BITS = 24


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, NULL where the denominator is zero or unknown."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    """Percentage with a single division, so that halves stay halves when rounded."""
    return ratio(F.lit(100.0) * as_column(part), whole)


def exact_sum(c: Column | str) -> Column:
    """Sum of the values as they are, the same under any row order to the last digits that matter.

    Each value is split into whole millionths, whose sum is exact, and the rest, which is below a millionth and has only
    rounding errors of its own size. Nothing is rounded away and nothing saturates; NaN and infinity stay in the plain part
    and make the sum what Spark's ``sum`` makes it.
    """
    return whole_of(*exact_parts(c))


def whole_of(millionths: Column | str, rest: Column | str) -> Column:
    """The sum whose parts ``exact_parts`` gives."""
    return (as_column(millionths) * F.lit(Decimal("0.000001"))).cast("double") + as_column(rest)


def exact_parts(c: Column | str) -> tuple[Column, Column]:
    """Sums of the whole millionths, as a decimal without places, and of the rest; both add up over parts of the rows.

    Rows only add longs and doubles, which stay in generated code; decimals are made once per group. A limb of 2^24 lasts for
    more than 10^11 rows; beyond that the sum of longs raises an error.
    """
    x = as_column(c).cast("double")
    size = F.abs(x)
    top = F.when((size >= F.lit(NEAR)) & (size < F.lit(EXACT_LIMIT)), F.floor(x / F.lit(float(TOP_LIMB)))).otherwise(F.lit(0).cast("bigint"))
    below = x - top.cast("double") * F.lit(float(TOP_LIMB))
    near = F.when(size < F.lit(EXACT_LIMIT), F.rint(below * F.lit(1e6)))
    limbs = near.cast("bigint")
    high, low = F.shiftright(limbs, LOW_BITS), limbs.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    # A quotient of whole numbers below 2^53 is the double nearest to it, so a value with six places leaves nothing.
    rest = below - F.coalesce(near / F.lit(1e6), F.lit(0.0))
    whole = lambda s: F.coalesce(F.sum(s), F.lit(0)).cast("decimal(20,0)")
    scaled = lambda s, times: (whole(s) * F.lit(Decimal(times))).cast("decimal(38,0)")
    total = scaled(F.when(top != 0, top), TOP_LIMB * 1_000_000) + scaled(high, 1 << LOW_BITS) + whole(low)
    return total.cast("decimal(38,0)"), F.sum(rest)


def exact_mean(total: Column | str, n: Column) -> Column:
    """Sum of a value over a count. The whole millionths are divided as a whole number by a whole number, so that a mean
    half-way between two digits stays there."""
    return mean_of(*exact_parts(total), n)


def mean_of(millionths: Column, rest: Column, n: Column) -> Column:
    """The mean whose sum is in the parts that ``exact_parts`` gives."""
    return F.try_divide(millionths.cast("double"), n.cast("double") * F.lit(1e6)) + F.try_divide(rest, n.cast("double"))


def exact_avg(c: Column | str) -> Column:
    return exact_mean(c, F.count(as_column(c)))


def sketch_quantiles(c: Column | str, points: list[float], accuracy: int) -> Column:
    """Array of quantiles from one sketch: exact for a group of up to accuracy / 2 rows, else within
    n / accuracy ranks, by a path that depends on the layout of the rows."""
    return F.percentile_approx(as_column(c), F.array(*[F.lit(p) for p in points]), F.lit(accuracy))


def guarded_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over complete pairs; NULL when either side is constant."""
    x, y = as_column(x).cast("double"), as_column(y).cast("double")
    px, py = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    varies = (F.min(px) < F.max(px)) & (F.min(py) < F.max(py))
    return F.when(
        varies, F.try_divide(F.covar_samp(px, py), F.stddev_samp(px) * F.stddev_samp(py))
    )


def occupancy(available: Column | str, capacity: float = 365.0) -> Column:
    """Share of the capacity that is not available."""
    return F.lit(1.0) - as_column(available) / F.lit(float(capacity))


def cyclic(c: Column | str, period: float = 12.0) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = as_column(c).cast("double") * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def digest(*columns: Column | str, seed: int = 42) -> Column:
    """MD5 digest of a seed and a key, on which every engine and every layout agrees."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[as_column(c).cast("string") for c in columns]))


def hash_bucket(*columns: Column | str, buckets: Column | int = 100, seed: int = 42) -> Column:
    """Bucket of a key, from the start of its digest."""
    return F.pmod(F.conv(F.substring(digest(*columns, seed=seed), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
