"""Category labels derived from a value."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import as_column

# Class names and limits that results are grouped by.
PRICE_BANDS = ((30, "budget_<30"), (75, "mid_30-75"), (150, "upper_75-150"))
TOP_BAND = "luxury_150+"
NIGHTS_BUCKETS = ((1, 1, "one_night"), (2, 3, "weekend"), (4, 6, "week_short"))
LONGEST_STAY = "long_stay"


def above(c: Column | str, limit: float, yes: str, no: str) -> Column:
    """Two-class label; an unknown value takes the second class."""
    return F.when(as_column(c) > limit, yes).otherwise(no)


def host_type(listing_count: Column | str, limit: float = 1) -> Column:
    return above(listing_count, limit, "multi", "single")


def bands(c: Column | str, limits=PRICE_BANDS, top: str = TOP_BAND) -> Column:
    """Label of the first limit the value is below; unknown values take the top label."""
    c, out = as_column(c), F
    for limit, label in limits:
        out = out.when(c < limit, label)
    return out.otherwise(top)


def nights_bucket(c: Column | str) -> Column:
    """Length-of-stay class; NULL, zero and fractions between classes count as long stays."""
    c, out = as_column(c), F
    for low, high, label in NIGHTS_BUCKETS:
        out = out.when(c.between(low, high), label)
    return out.otherwise(LONGEST_STAY)


def shorten(c: Column | str, width: int, mark: str = "...") -> Column:
    """Cut a label to the width, its end replaced by the mark."""
    c = as_column(c)
    cut = F.concat(F.substring(c, 1, width - len(mark)), F.lit(mark))
    return F.when(F.length(c) > width, cut).otherwise(c)
