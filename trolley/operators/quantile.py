"""Exact quantiles of a column by distributed selection.

Every wanted rank starts between the column's least and greatest value.  Each
round one aggregate samples quantiles within the ranks' ranges and a second one
counts what lies below and in them, so a range shrinks by orders of magnitude
until it holds at most ``bound`` different values; only those are ordered.
Nothing depends on how the values are spread; equal values are one value.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: different values that the driver may order
BOUND = 10_000
_ACCURACY = 1_000


def _between(low: float, high: float):
    return F.col("v").between(F.lit(low), F.lit(high))


def ranked(values: DataFrame, ranks: list[int], bound: int = BOUND) -> dict[int, float]:
    """The values at 0-based ``ranks`` of the one column ``v`` (double, no nulls) in ascending order."""
    edges = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    todo = {r: (edges[0], edges[1], 0, edges[2]) for r in ranks}  # low, high, rows below low, rows in [low, high]
    found: dict[int, float] = {}
    while todo:
        spans = sorted({s for s in todo.values()})
        # different values in each span, and sampled quantiles around the wanted ranks
        aims = {s: sorted({min(max((r - s[2] + d) / max(s[3], 1), 0.0), 1.0) for r, t in todo.items() if t == s
                           for d in (-2 * s[3] / _ACCURACY, 2 * s[3] / _ACCURACY)}) for s in spans}
        row = values.agg(*[c for s in spans for c in (
            F.approx_count_distinct(F.when(_between(*s[:2]), F.col("v")), 0.05),
            F.percentile_approx(F.when(_between(*s[:2]), F.col("v")), aims[s], _ACCURACY))]).first()
        small = [s for i, s in enumerate(spans) if row[2 * i] <= bound // 2 or s[0] == s[1]]
        for s in small:
            own = values.where(_between(*s[:2])).groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy("v").collect()
            at = s[2]
            for v, n in own:
                for r in [r for r, t in todo.items() if t == s and at <= r < at + n]:
                    found[r] = v
                at += n
        todo = {r: s for r, s in todo.items() if s not in small}
        cuts = {}
        for i, s in enumerate(spans):
            if s not in small:
                cuts[s] = sorted({s[0], *(x for x in row[2 * i + 1]), s[1]})
        if not cuts:
            break
        counted = values.agg(*[c for s in cuts for x in cuts[s] for c in (
            F.count_if(F.col("v") < F.lit(x)), F.count_if(F.col("v") <= F.lit(x)))]).first()
        at = 0
        for s, xs in cuts.items():
            below = [(x, counted[at + 2 * k], counted[at + 2 * k + 1]) for k, x in enumerate(xs)]
            at += 2 * len(xs)
            for r in [r for r, t in todo.items() if t == s]:
                on = next((x for x, lt, le in below if lt <= r < le), None)
                if on is not None:
                    found[r] = on
                    del todo[r]
                    continue
                left = max((b for b in below if b[2] <= r), key=lambda b: b[0])
                right = min((b for b in below if b[1] > r), key=lambda b: b[0])
                # the wanted value lies strictly between two cuts
                todo[r] = (math.nextafter(left[0], math.inf), math.nextafter(right[0], -math.inf), left[2], right[1] - left[2])
    return found


def quantiles(df: DataFrame, value: str, probs: list[float], bound: int = BOUND) -> list[float | None]:
    """Exact quantiles, linear between the two values beside a rank (0.5 is the median).

    Nulls and NaN are left out; without values every quantile is None.
    """
    values = df.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    values = values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = values.count()
        if not n:
            return [None] * len(probs)
        places = [p * (n - 1) for p in probs]
        at = ranked(values, sorted({r for x in places for r in (math.floor(x), math.ceil(x))}), bound)
        out = []
        for x in places:
            lo, hi, part = at[math.floor(x)], at[math.ceil(x)], x - math.floor(x)
            out.append((lo + hi) / 2 if part == 0.5 else lo + (hi - lo) * part)
        return out
    finally:
        values.unpersist()


def median_of(df: DataFrame, value: str) -> float | None:
    return quantiles(df, value, [0.5])[0]
