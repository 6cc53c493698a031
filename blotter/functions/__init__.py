"""Scalar column functions and predicates (all built-in Spark expressions)."""

from .columns import (  # noqa: F401
    any_positive, both_null, both_present, contains_any, content_hash, content_hash128, daylight,
    default_zero, has_lat, hour_of, is_zero, kept, locality, month_number, month_of,
    neither_zero, not_both_zero, round_half_up, safe_cast, season, to_ts,
    with_utm_latlon, year_of,
)
