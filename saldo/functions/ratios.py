"""Rounding and ratios of the two value regimes.

Table regime: exact decimals, rounded half away from zero, as SQL does.
Frame regime: doubles, scaled, rounded half to even and scaled back, as data frames do;
churn and lifetime value are rounded one by one instead, by their exact value.
A zero denominator gives NULL in both.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_ratio(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(num, den), 2)


def sql_pct(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(num, den) * 100, 2)


def frame_round(x: Column, digits: int = 2) -> Column:
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def exact_round(x: Column, digits: int = 2) -> Column:
    """Rounds the exact binary value of a double, as Python's builtin `round` does.

    Scaling rounds too and may make a tie of what is none. Where it did, the rest that it lost
    (from the product in two halves) says on which side the value lies; a true tie goes to even.
    """
    scale = float(10**digits)
    scaled = x * scale
    split = x * 134217729.0  # 2**27 + 1
    high = split - (split - x)
    rest = (high * scale - scaled) + (x - high) * scale
    down = F.floor(scaled).cast("double")
    nearest = F.when((scaled - down != 0.5) | (rest == 0), F.rint(scaled)).when(rest > 0, down + 1).otherwise(down)
    return nearest / scale


def frame_ratio(num: Column, den: Column) -> Column:
    return frame_round(F.try_divide(num.cast("double"), den.cast("double")))


def frame_pct(num: Column, den: Column) -> Column:
    return frame_round(F.try_divide(num.cast("double"), den.cast("double")) * 100)


def mean_of_rounded(x: Column, digits: int = 2) -> Column:
    """Mean of values that already have `digits` decimals.

    The sum is decimal, so the mean does not depend on the order of the partitions.
    """
    exact = x.cast(f"decimal(18,{digits})")
    return F.try_divide(F.sum(exact).cast("double"), F.count(exact))
