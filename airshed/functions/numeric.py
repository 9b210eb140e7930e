"""Numeric expressions (FN7-FN10, FN16) and an order-independent average."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def current_value(latest, fallback) -> Column:
    """FN7: latest reading if present, else the window average."""
    return F.coalesce(_col(latest), _col(fallback))


def default_fill(c, default: float) -> Column:
    """FN8: ``x or default`` — null *and zero* are replaced."""
    c = _col(c)
    return F.when(c.isNull() | (c == 0), F.lit(float(default))).otherwise(c)


def congestion_ratio(current_speed, free_flow) -> Column:
    """FN9: max(0, round(1 - cur / max(free, 1), 3)); rounding happens before banding."""
    ratio = F.lit(1.0) - _col(current_speed) / F.greatest(_col(free_flow), F.lit(1.0))
    return F.greatest(F.lit(0.0), round_half_even(ratio, 3))


def round_half_even(c, digits: int) -> Column:
    """Round half-to-even on the scaled binary value: rint(x * 10^d) / 10^d.

    Close to Python's ``round`` (which the serving layer uses) and, unlike ``F.round`` on a
    decimal string, reproducible bit for bit by any engine with IEEE ``rint``.
    """
    scale = float(10 ** digits)
    return F.rint(_col(c) * scale) / scale


def clamp_prediction(c) -> Column:
    """FN16: max(0, round(p, 1))."""
    return F.greatest(F.lit(0.0), round_half_even(c, 1))


def exact_avg(c, scale: int = 6) -> Column:
    """``avg``, with an exact sum where the values allow one.

    If every value of a group is a number of at most ``scale`` decimals (to within the noise of a
    double) and fits a long in units of 10^-scale, the values are summed as longs, whole part
    and remainder, so the result does not depend on partitioning or task order. Any other value, NaN
    among them, makes the group's result that of plain ``avg``; none is left out.
    """
    return average_of(average_state(c, scale), scale)


def average_state(c, scale: int = 6) -> Column:
    """What ``exact_avg`` keeps of a group, as a struct: it can be stored and merged with that of other
    groups, so an average needs only the states of the parts that changed."""
    unit = 10 ** scale
    v = _col(c).cast("double")
    near = F.rint(v * float(unit))
    fits = (F.abs(near) < float(2 ** 53)) & (F.abs(v - near / float(unit))
                                             <= 1e-11 * F.greatest(F.abs(v), F.lit(1.0)))
    u = F.when(fits, near).try_cast("long")
    frac = F.pmod(u, F.lit(unit))
    whole = ((u - frac) / F.lit(unit)).cast("long")
    return F.struct(F.count(v).alias("n"), F.count(u).alias("fit"), F.sum(whole).alias("whole"),
                    F.sum(frac).alias("frac"), F.avg(v).alias("avg"))


def merged_state(state: str) -> Column:
    """The states of several groups as one: exact where all of them are."""
    s = lambda f: F.sum(F.col(f"{state}.{f}"))
    n = s("n")
    mean = F.try_divide(F.sum(F.col(f"{state}.avg") * F.col(f"{state}.n")), n.cast("double"))
    return F.struct(n.alias("n"), s("fit").alias("fit"), s("whole").alias("whole"), s("frac").alias("frac"),
                    mean.alias("avg"))


def average_of(state: Column, scale: int = 6) -> Column:
    unit = 10 ** scale
    total = (state["whole"].cast("decimal(38,0)") * F.lit(unit) + state["frac"]) / F.lit(unit)
    exact = F.try_divide(total.cast("double"), state["fit"].cast("double"))
    return F.when(state["fit"] == state["n"], exact).otherwise(state["avg"])
