"""Dimension joins.

A dimension is broadcast only behind a measured bound: one small aggregate job
counts its rows and distinct keys.  Under the bound the join is a
``BroadcastHashJoin`` (no shuffle of the fact table); above it the join falls
back to a shuffled join that AQE may still convert or split when skewed.  The
same job checks key uniqueness, because a duplicate key would multiply fact
rows in a left join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimensions are broadcast only when both bounds hold (265 zones in the reference).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

# Bytes per value of fixed-width types (variable-width ones are measured).
_FIXED_BYTES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
                "date": 4, "timestamp": 8, "timestamp_ntz": 8}


@dataclass(frozen=True)
class DimensionStats:
    rows: int
    distinct_keys: int
    bytes: int = 0
    null_keys: int = 0

    @property
    def unique(self) -> bool:
        """No key twice; rows with a null key match nothing and do no harm."""
        return self.rows - self.null_keys == self.distinct_keys


def _value_bytes(name: str, dtype: str):
    if dtype in _FIXED_BYTES:
        return F.lit(_FIXED_BYTES[dtype])
    if dtype in ("string", "binary"):
        return F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(name)))), F.lit(0))  # nested: JSON size


def dimension_stats(dim: DataFrame, key: str) -> DimensionStats:
    """One aggregate job over the dimension: rows, distinct keys and data bytes (measured, not estimated)."""
    size = sum((_value_bytes(n, t) for n, t in dim.dtypes), F.lit(0))
    row = dim.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(key)).alias("k"),
                  F.sum(size.cast("long")).alias("b"), F.count_if(F.col(key).isNull()).alias("z")).first()
    return DimensionStats(int(row["n"]), int(row["k"]), int(row["b"] or 0), int(row["z"]))


def checked_broadcast(dim: DataFrame, key: str, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      require_unique: bool = True, stats: DimensionStats | None = None,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(dim_or_hinted_dim, broadcasted)`` after checking its size in rows and bytes."""
    stats = dimension_stats(dim, key) if stats is None else stats
    if require_unique and not stats.unique:
        raise ValueError(f"dimension key {key!r} is not unique ({stats.rows} rows, {stats.distinct_keys} keys)")
    if stats.rows <= max_rows and stats.bytes <= max_bytes:
        return F.broadcast(dim), True
    return dim, False


def role_projection(zones: DataFrame, key_alias: str, prefix: str,
                    key: str = "LocationID", borough: str = "Borough", zone: str = "Zone") -> DataFrame:
    """Project the zone dimension for one role (pickup / drop-off), 3 renamed columns."""
    return zones.select(
        F.col(key).alias(key_alias),
        F.col(borough).alias(f"{prefix}_borough"),
        F.col(zone).alias(f"{prefix}_zone"),
    )


def enrich_locations(trips: DataFrame, zones: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """J1 + J2: left-join the zone dimension on pickup and on drop-off id."""
    stats = dimension_stats(zones, "LocationID")
    pu, _ = checked_broadcast(role_projection(zones, "pu_location_id", "pickup"), "pu_location_id",
                              max_broadcast_rows, stats=stats)
    do, _ = checked_broadcast(role_projection(zones, "do_location_id", "dropoff"), "do_location_id",
                              max_broadcast_rows, stats=stats)
    return trips.join(pu, on="pu_location_id", how="left").join(do, on="do_location_id", how="left")


def attach_labels(items: DataFrame, labels: DataFrame, key: str,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left-join a label table to items by reference.

    Labels cover a subset of items and may grow with them; they are broadcast
    only under the bound, else the join shuffles both sides on ``key``.
    """
    lab, _ = checked_broadcast(labels, key, max_broadcast_rows)
    return items.join(lab, on=key, how="left")
