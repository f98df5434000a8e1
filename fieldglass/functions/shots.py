"""Shot zones, turnover buckets, score states: ordered conditions, first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zones in their order, turnover kinds, distances in feet, coordinates in tenths of feet.
ZONES = ("ra", "paint", "short_mid", "long_mid_r", "long_mid_l", "long_mid_c", "c3_l", "c3_r", "heave", "atb_r", "atb_l", "atb_top")
LIVE_TURNOVERS = ("Bad Pass", "Lost Ball")
OUT_OF_BOUNDS = ("Out of Bounds - Bad Pass Turnover", "Out of Bounds Lost Ball", "Step Out of Bounds")
TURNOVER_BUCKETS = ("live", "oob", "ofoul", "viol", "other")


def shot_zone(x: Column, y: Column, value: Column) -> Column:
    """The zone of a shot at (x, y) worth value points; null where a coordinate is."""
    feet = F.sqrt(x * x + y * y) / 10.0
    angle = F.degrees(F.atan2(y, x))
    two = value == 2
    side = lambda right, left, middle: F.when(angle < 60, right).when(angle > 120, left).otherwise(middle)
    zone = (
        F.when(feet <= 4, "ra")
        .when(two & (F.abs(x) <= 80) & (y <= 142.5), "paint")
        .when(two & (feet <= 14), "short_mid")
        .when(two, side("long_mid_r", "long_mid_l", "long_mid_c"))
        .when((F.abs(x) >= 220) & (y <= 92.5), F.when(x < 0, "c3_l").otherwise("c3_r"))
        .when(feet >= 30, "heave")
        .otherwise(side("atb_r", "atb_l", "atb_top"))
    )
    return F.when(x.isNotNull() & y.isNotNull(), zone)


def bucket(kind: Column, groups: dict[str, tuple[str, ...]], other: str = "other") -> Column:
    """The first group that lists kind."""
    out = None
    for name, kinds in groups.items():
        out = F.when(kind.isin(*kinds), name) if out is None else out.when(kind.isin(*kinds), name)
    return out.otherwise(other)


def score_state(margin: Column) -> Column:
    return F.when(margin > 0, "ahead").when(margin < 0, "behind").otherwise("tied")


def is_clutch(period: Column, seconds_left: Column, margin: Column) -> Column:
    """The last five minutes of the fourth period or later, within five points."""
    return (period >= 4) & (seconds_left <= 300) & (F.abs(margin) <= 5)


def is_garbage(period: Column, seconds_left: Column, margin: Column) -> Column:
    """A fourth period that is out of reach."""
    lead = F.abs(margin)
    return (period == 4) & (((seconds_left <= 720) & (lead >= 25)) | ((seconds_left <= 540) & (lead >= 20)) | ((seconds_left <= 360) & (lead >= 10)))


def per(total: Column, mode: str, games: Column, minutes: Column, possessions: Column) -> Column:
    """A total as it is, or by game, 36 minutes or 100 possessions; null over nothing."""
    over = {"total": F.lit(1.0), "game": games, "36": minutes / 36.0, "100": possessions / 100.0}[mode]
    return total / F.nullif(over.cast("double"), F.lit(0.0))
