import random

import pytest
from pyspark.sql import functions as F

from trolley.operators.quantile import quantiles
from trolley.operators.scan import numbered

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def exact(values, p):
    values = sorted(values)
    x = p * (len(values) - 1)
    lo, hi = values[int(x)], values[min(int(x) + 1, len(values) - 1)]
    return lo + (hi - lo) * (x - int(x))


@pytest.mark.parametrize("bound", [4, 10_000])
@pytest.mark.parametrize("kind", ["spread", "equal", "ties", "tail", "two", "one"])
def test_quantiles_whatever_the_spread(spark, kind, bound):
    rng = random.Random(kind)
    values = {"spread": [rng.uniform(-1e6, 1e6) for _ in range(3001)], "equal": [7.5] * 900,
              "ties": [float(rng.choice([1, 1, 1, 2, 3, 500])) for _ in range(2000)] + [0.5],
              "tail": [rng.paretovariate(0.3) for _ in range(2000)], "two": [3.0, 9.0], "one": [4.0]}[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double").repartition(4)
    assert quantiles(df, "x", PROBS, bound) == pytest.approx([exact(values, p) for p in PROBS], rel=1e-12)


def test_no_values(spark):
    assert quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]


def test_a_basket_with_a_third_of_all_lines(spark):
    """Its lines are numbered right, by several tasks."""
    rows = [(1, i) for i in range(3000)] + [(2 + i % 700, 10_000 + i) for i in range(6000)] + [(None, 5), (None, 6)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "basket long, at long").repartition(6)
    out = numbered(df, ["basket"], ["at"], "nth")
    got = sorted(((b, a, n) for b, a, n in out.collect()), key=repr)
    seen, want = {}, []
    for b, a in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        seen[b] = seen.get(b, 0) + 1
        want.append((b, a, seen[b]))
    assert got == sorted(want, key=repr)
    ranges = df.repartitionByRange(8, "basket", "at").where("basket = 1").select(F.spark_partition_id()).distinct().count()
    assert ranges > 1
    assert numbered(df.limit(0), ["basket"], ["at"], "nth").collect() == []
