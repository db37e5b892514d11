"""Exact percentiles without one task that holds all values.

The rows are counted in bins of equal width between the least and the greatest value, and the bin with the wanted rank in bins
again, until few rows are left; counts are aggregated before the shuffle, and only they and the last values come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

#: Rows whose values are counted one by one, and bins of a round.
FEW, BINS = 100_000, 4096


def _counted(rows: DataFrame) -> list[tuple[float, int]]:
    return [(r["v"], r["times"]) for r in rows.groupBy("v").agg(F.count("*").alias("times")).orderBy("v").collect()]


def _value_at(rows: DataFrame, rank: int, n: int) -> float:
    """The value of a rank, counted from 0, of the n rows of ``v``."""
    while n > FEW:
        low, high = rows.agg(F.min("v"), F.max("v")).first()
        if low == high:
            return low
        infinite = [x for x in (low, high) if math.isinf(x)]
        width = 0.0 if infinite else high / BINS - low / BINS
        if infinite or not width:  # one end apart from all others, or values that no bin tells apart
            end = infinite[0] if infinite else low
            place = F.when(F.col("v") < end, 0).when(F.col("v") == end, 1).otherwise(2)
        else:
            place = F.least(F.floor((F.col("v") - low) / width), F.lit(BINS - 1))
        bins = rows.groupBy(place.alias("place")).agg(F.count("*").alias("times"), F.min("v").alias("low"), F.max("v").alias("high"))
        for r in sorted(bins.collect(), key=lambda r: r["place"]):  # BINS rows at most
            if rank < r["times"]:
                rows, n = rows.filter(F.col("v").between(r["low"], r["high"])), r["times"]
                break
            rank -= r["times"]
    for value, times in _counted(rows):
        if rank < times:
            return value
        rank -= times
    raise ValueError("no such rank")


def exact_percentiles(rows: DataFrame, column: str, shares: tuple[float, ...]) -> list[float | None]:
    """The percentiles of a column, interpolated linearly between neighbours; nulls don't count; NaN if any value is, null
    without values."""
    values = rows.select(F.col(column).cast("double").alias("v")).persist()  # read many times, and may come from spans of whole texts
    try:
        return _percentiles(values.filter("v is not null"), shares)
    finally:
        values.unpersist()


def _percentiles(own: DataFrame, shares: tuple[float, ...]) -> list[float | None]:
    n, odd = own.agg(F.count("*"), F.coalesce(F.max(F.isnan("v")), F.lit(False))).first()
    if not n:
        return [None for _ in shares]
    if odd:
        return [math.nan for _ in shares]
    places = [(n - 1) * p for p in shares]
    ranks = sorted({f(x) for x in places for f in (math.floor, math.ceil)})
    if n <= FEW:
        stops, at = [], 0
        for value, times in _counted(own):
            at += times
            stops.append((at, value))
        found = {k: next(v for stop, v in stops if k < stop) for k in ranks}
    else:
        found = {k: _value_at(own, k, n) for k in ranks}
    return [found[math.floor(x)] + (found[math.ceil(x)] - found[math.floor(x)]) * (x - math.floor(x)) for x in places]
