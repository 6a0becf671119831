import random

import pytest
from pyspark.sql import functions as F

from trolley.operators import containment
from trolley.operators import mining as M


def brute(cands, holders):
    return sorted((c, h) for c, cs in cands for h, hs in holders if cs and None not in cs and set(cs) <= set(hs))


@pytest.mark.parametrize(("items", "salt_holders"), [(25, 1 << 18), (25, 3), (5000, 1 << 18), (5000, 2)])
def test_arrays_of_any_domain(spark, monkeypatch, items, salt_holders):
    """The same answer at 25 and at 5,000 items, with and without salts; an item that
    everybody holds, empty sets, items that nobody holds, a holder of everything."""
    monkeypatch.setattr(containment, "SALT_HOLDERS", salt_holders)
    rng = random.Random(items)
    holders = [(i, sorted({0, *(rng.randrange(items) for _ in range(rng.randint(0, 12)))})) for i in range(150)]
    holders += [(900, list(range(items))), (901, [])]
    cands = [(i, sorted({rng.randrange(items) for _ in range(rng.randint(1, 3))} | ({0} if i % 3 == 0 else set()))) for i in range(60)]
    cands += [(70, []), (71, [items + 5]), (72, [0]), (73, [0, items + 5])]
    cands += [(80 + i, h[1:3]) for i, (_, h) in enumerate(holders[:9]) if len(h) > 2]
    index = containment.Index(spark.createDataFrame(holders, "h long, held array<int>"), F.col("held"))
    met = index.contained(spark.createDataFrame(cands, "c long, want array<int>"), "c", F.col("want"),
                          F.size(F.array_except("want", "held")) == 0)
    assert sorted(tuple(r) for r in met.select("c", "h").collect()) == brute(cands, holders)
    assert "NestedLoop" not in met._jdf.queryExecution().executedPlan().toString()


def test_empty_sides(spark):
    none = spark.createDataFrame([], "mask long, n long")
    some = spark.createDataFrame([(3, 2)], "mask long, n long")
    cands = spark.createDataFrame([(1,), (3,), (4,)], "cand long")
    assert M.count_support(cands, M.mask_index(none)).collect() == []
    assert M.count_support(cands.limit(0), M.mask_index(some)).collect() == []
    assert sorted(tuple(r) for r in M.count_support(cands, M.mask_index(some)).collect()) == [(1, 2), (3, 2)]


@pytest.mark.parametrize("name", ["cooccurrence", "rule_stability", "score_layout", "freq_distance"])
def test_no_nested_loop(spark, name):
    from trolley.plans.registry import load_all
    plan = load_all()[0][name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    loops = [line for line in plan.splitlines() if "NestedLoop" in line and "bit" in line.lower() or "CartesianProduct" in line]
    assert loops == []
