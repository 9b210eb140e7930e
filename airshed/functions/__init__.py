"""Column-expression building blocks (no Python UDFs): classifiers, numerics, time parts."""

from airshed.functions.classify import (aqi_category, compass_point, congestion_level,
                                        pretty_name, trend_label, uv_band)
from airshed.functions.numeric import (clamp_prediction, congestion_ratio, current_value,
                                       default_fill, exact_avg, round_half_even)
from airshed.functions.timeparts import (iso_utc, local_parts, parse_ts, target_parts,
                                         valid_time)

__all__ = [
    "aqi_category", "compass_point", "congestion_level", "pretty_name", "trend_label",
    "uv_band", "clamp_prediction", "congestion_ratio", "current_value", "default_fill",
    "exact_avg", "round_half_even", "iso_utc", "local_parts", "parse_ts", "target_parts",
    "valid_time",
]
