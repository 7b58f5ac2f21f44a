"""Column expressions of the trip pipeline (steps T3, T7, T9-T13, T16).

Every function returns a built-in ``Column`` so the expressions stay inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Payment type code -> label, as the taxi data dictionary defines it.  Any other
# code (and null) maps to the default label; code 5 is the default's own text.
PAYMENT_TYPE_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DEFAULT_LABEL = "Unknown"
CARD_LABEL = "Credit card"
CARD_CODE = 1

# Distance bands in miles: upper bound (exclusive) -> band name; the rest is the last band.
DISTANCE_BANDS = [(2, "short"), (5, "medium"), (10, "long")]
DISTANCE_BAND_REST = "very_long"

# Rate code of the JFK flat fare.
JFK_RATE_CODE = 2
# Tip share (percent of fare) above which a trip counts as a high tip.
HIGH_TIP_PCT = 20
# ------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_minutes(start="pickup_ts", end="dropoff_ts") -> Column:
    """Whole-second difference / 60 (``unix_timestamp`` drops fractions, works on NTZ)."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / F.lit(60.0)


def duration_minutes_exact(start="pickup_ts", end="dropoff_ts") -> Column:
    """T3 variant keeping sub-second precision (pandas ``total_seconds()/60``)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(60e6)


def speed_mph(distance="trip_distance", minutes="trip_duration_min") -> Column:
    """Distance / hours.  ``try_divide`` so a zero duration yields null, not an error."""
    return F.try_divide(_c(distance), _c(minutes) / F.lit(60.0))


def pickup_hour(ts="pickup_ts") -> Column:
    return F.hour(_c(ts))


def pickup_dow(ts="pickup_ts") -> Column:
    """English full day name (``Monday`` ...)."""
    return F.date_format(_c(ts), "EEEE")


def pickup_date(ts="pickup_ts") -> Column:
    return F.to_date(_c(ts))


def payment_label(code="payment_type", labels: dict | None = None, default: str = PAYMENT_DEFAULT_LABEL) -> Column:
    """Code -> label as one CASE expression; unmapped and null -> default."""
    labels = PAYMENT_TYPE_LABELS if labels is None else labels
    expr = None
    for k, v in labels.items():
        cond = _c(code) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def tip_pct(tip="tip_amount", fare="fare_amount", rounded: bool = True) -> Column:
    """Tip as percent of fare; 0.0 when fare <= 0.  Rounded to 2 places unless ``rounded=False``."""
    raw = _c(tip) / _c(fare) * F.lit(100)
    val = F.round(raw, 2) if rounded else raw
    return F.when(_c(fare) > 0, val).otherwise(F.lit(0.0))


def distance_band(distance="trip_distance") -> Column:
    """``<2 short, <5 medium, <10 long, else very_long``."""
    expr = None
    for bound, name in DISTANCE_BANDS:
        cond = _c(distance) < F.lit(bound)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(DISTANCE_BAND_REST))


def airport_flag(fee="airport_fee", rate_code="rate_code_id") -> Column:
    """Three-valued; NULL when the fee is missing/zero and the rate code is null."""
    return (F.coalesce(_c(fee), F.lit(0)) > 0) | (_c(rate_code) == F.lit(JFK_RATE_CODE))


def airport_flag_01(fee="Airport_fee", rate_code="RatecodeID") -> Column:
    """Null-safe 0/1 variant (missing -> 0)."""
    return F.coalesce(airport_flag(fee, rate_code), F.lit(False)).cast("int")


def high_tip(pct="tip_pct") -> Column:
    """``tip_pct > 20`` as int, NULL kept."""
    return (_c(pct) > F.lit(HIGH_TIP_PCT)).cast("int")


def high_tip_01(pct="tip_pct") -> Column:
    """T16 variant with NULL -> 0 (the pandas builders)."""
    return F.coalesce(high_tip(pct), F.lit(0))


def stable_key_hash(*cols) -> Column:
    """Hex md5 of the key columns: a content key that is stable across runs and engines."""
    return F.md5(F.concat_ws("|", *[_c(c).cast("string") for c in cols]))


def hash_bucket(key, buckets: int = 10000) -> Column:
    """First 32 bits of md5(key) modulo ``buckets`` (same value in DuckDB)."""
    return (F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")
