"""Banding and label expressions (FN1-FN5, FN11), all JVM-side ``when`` chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.functions import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _band(c: Column, bands, top: str, inclusive: bool) -> Column:
    expr = None
    for bound, label in bands:
        cond = (c <= bound) if inclusive else (c < bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(top)


def aqi_category(c, null_label: str | None = None) -> Column:
    """US EPA band of an AQI value.

    ``null_label=None`` is the batch-job form: a null falls through to "Hazardous".
    The serving form passes ``null_label="Unknown"``.
    """
    c = _col(c)
    banded = _band(c, K.AQI_BANDS, K.AQI_TOP_LABEL, inclusive=True)
    if null_label is None:
        return banded
    return F.when(c.isNull(), F.lit(null_label)).otherwise(banded)


def congestion_level(c) -> Column:
    """Traffic band of a congestion ratio; a null ratio falls through to "Severe"."""
    return _band(_col(c), K.CONGESTION_BANDS, K.CONGESTION_TOP_LABEL, inclusive=False)


def uv_band(c) -> Column:
    """WHO UV band; null or NaN -> em dash."""
    c = _col(c)
    banded = _band(c, K.UV_BANDS, K.UV_TOP_LABEL, inclusive=True)
    return F.when(c.isNull() | F.isnan(c), F.lit(K.UV_MISSING_LABEL)).otherwise(banded)


def compass_point(deg) -> Column:
    """Octant name of a wind direction: index round-half-up(deg/45) mod 8; null, NaN or
    infinite -> ''.

    The remainder keeps the sign of the dividend (as the dashboard's ``%`` does), so a
    negative index has no name and yields ''.
    """
    deg = _col(deg)
    idx = F.floor(deg / 45.0 + 0.5) % 8
    names = F.array(*[F.lit(n) for n in K.COMPASS])
    name = F.when(idx >= 0, F.element_at(names, (idx + 1).cast("int")))
    # NaN or an infinite angle has no octant (the dashboard shows nothing for it)
    undefined = deg.isNull() | F.isnan(deg) | (F.abs(deg) == float("inf"))
    return F.when(undefined, F.lit("")).otherwise(F.coalesce(name, F.lit("")))


def pretty_name(slug) -> Column:
    """'jakarta-pusat' -> 'Jakarta Pusat': split on '-', upper-case each first letter only."""
    slug = _col(slug)
    words = F.transform(F.split(slug, "-", -1),
                        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.when(slug.isNull() | (slug == ""), F.lit("")).otherwise(F.array_join(words, " "))


def trend_label(delta) -> Column:
    """up / down / flat around +-1 AQI point; null -> ''."""
    delta = _col(delta)
    return (F.when(delta.isNull(), F.lit(""))
            .when(delta > K.TREND_THRESHOLD, "up")
            .when(delta < -K.TREND_THRESHOLD, "down")
            .otherwise("flat"))
