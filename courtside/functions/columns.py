"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Garbage-time tiers (seconds left at most, margin at least), tightest first, and the first period.
GARBAGE_TIERS = ((180, 12), (360, 18), (720, 25))
GARBAGE_PERIOD = 4


def clock_seconds(clock: Column) -> Column:
    """'MM:SS' or 'MM:SS.f' as seconds."""
    part = F.split(clock, ":")
    return part[0].cast("double") * 60 + part[1].cast("double")


def garbage_time(period: Column, clock: Column, margin: Column) -> Column:
    """Whether a possession starts in garbage time: late, and the margin reaches that of the tightest tier it falls in."""
    seconds, needed = clock_seconds(clock), None
    for most, margin_at_least in GARBAGE_TIERS:
        needed = F.when(seconds <= most, margin_at_least) if needed is None else needed.when(seconds <= most, margin_at_least)
    return F.coalesce((period >= GARBAGE_PERIOD) & (F.abs(margin) >= needed), F.lit(False))


def player_ids(lineup: Column) -> Column:
    return F.transform(F.split(lineup, "-"), lambda p: p.cast("long"))


def dashes(lineup: Column) -> Column:
    return F.length(lineup) - F.length(F.replace(lineup, F.lit("-"), F.lit("")))


def per_100(points: Column, poss: Column) -> Column:
    return F.lit(100.0) * points / poss


def weighted_mean(x: Column, w: Column) -> Column:
    return F.sum(x * w) / F.sum(w)
