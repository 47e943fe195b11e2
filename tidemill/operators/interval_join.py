"""Joining points with a table of windows, as equality joins.

A window ``[first, after)`` holds a point ``at`` if ``first <= at < after``. Windows may
overlap, and may be open on either side (null). Comparing every point with every
window would be a nested loop; instead time is cut into bins:

* A window gets the smallest bin width, a power of two, at which it touches at most
  two bins. So every window is a row or two, however long it is.
* A point is in one bin of each width that any window has; there are at most 64
  widths, mostly one to five. Point and window meet by width and bin, and the bounds
  are compared exactly.
* Bins that hold more than a thousandth of the points, at most a thousand for each
  width, are known from partial counts. Their windows are repeated, and their points
  dealt out over the repetitions, so a hot hour is many tasks.

Bounds and points are whole numbers (say, microseconds), within plus or minus 2**61.
Points without a place match nothing; windows that end before they begin hold nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.latest import first_per_key

#: Bins with more than this share of the points are dealt out over ``SALTS`` tasks.
HOT_SHARE = 1000
SALTS = 32
_FAR = 1 << 61
_LEVEL, _BIN, _SALT = "_level", "_bin", "_salt"


def _level(first: Column, after: Column) -> Column:
    """The exponent of the bin width: the least at which the window touches two bins at most."""
    span = F.greatest(after - first, F.lit(1).cast("long"))
    return F.ceil(F.log2(span.cast("double"))).cast("int")


def _binned_windows(windows: DataFrame, first: str, after: str) -> DataFrame:
    lo = F.coalesce(F.col(first), F.lit(-_FAR))
    hi = F.coalesce(F.col(after), F.lit(_FAR))
    held = windows.filter(lo < hi).withColumn(_LEVEL, _level(lo, hi))
    lowest, highest = F.call_function("shiftright", lo, F.col(_LEVEL)), F.call_function("shiftright", hi - 1, F.col(_LEVEL))
    return held.withColumn(_BIN, F.explode(F.sequence(lowest, highest)))


def interval_join(points: DataFrame, windows: DataFrame, at: str, first: str = "first", after: str = "after", keys: list[str] | None = None) -> DataFrame:
    """Every point with every window that holds it (and has equal ``keys``): all columns of both.

    Besides ``keys``, the two must not share column names.
    """
    keys = list(keys or [])
    binned = _binned_windows(windows, first, after)
    levels = sorted(r[0] for r in binned.select(_LEVEL).distinct().collect())  # 64 rows at most
    if not levels:
        return points.join(windows, keys, "inner").limit(0) if keys else points.limit(0).join(windows.limit(0), F.lit(True))
    width = F.explode(F.array(*[F.lit(n) for n in levels]))
    placed = points.filter(F.col(at).isNotNull()).withColumn(_LEVEL, width).withColumn(_BIN, F.call_function("shiftright", F.col(at), F.col(_LEVEL)))
    meet = [*keys, _LEVEL, _BIN]
    counts = placed.groupBy(*meet).agg(F.count(F.lit(1)).alias("_n"))
    total = points.filter(F.col(at).isNotNull()).agg(F.count(F.lit(1)).alias("_n")).scalar()
    hot = counts.filter(F.col("_n") * HOT_SHARE > total).drop("_n").withColumn("_hot", F.lit(True))  # HOT_SHARE rows a width at most
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(*[F.col(c) for c in points.columns]), F.lit(SALTS))).otherwise(0)
    left = _with_hot(placed, hot, meet).withColumn(_SALT, spread.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = _with_hot(binned, hot, meet).withColumn(_SALT, F.explode(copies)).drop("_hot")
    within = (F.col(at) >= F.coalesce(F.col(first), F.lit(-_FAR))) & (F.col(at) < F.coalesce(F.col(after), F.lit(_FAR)))
    return left.join(right, [*meet, _SALT]).filter(within).drop(_LEVEL, _BIN, _SALT)


def _with_hot(df: DataFrame, hot: DataFrame, meet: list[str]) -> DataFrame:
    return df.join(F.broadcast(hot), meet, "left")


def newest_window(points: DataFrame, windows: DataFrame, point_id: list[str], at: str, values: list[str], first: str = "first", after: str = "after", keys: list[str] | None = None) -> DataFrame:
    """Per point that any window holds: ``values`` of the one that begins last.

    Of windows that begin together the one that ends first counts, then the
    smallest values; an open beginning is the earliest, an open end the latest.
    """
    order = [F.desc_nulls_last(first), F.asc_nulls_last(after), *[F.col(v) for v in values]]
    needed = points.select(*point_id, at, *(keys or []))
    return first_per_key(interval_join(needed, windows, at, first, after, keys), point_id, order).select(*point_id, *values)
