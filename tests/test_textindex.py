"""Names found through their grams against every name held against every rule."""

import random
from difflib import SequenceMatcher, get_close_matches

import pytest
from pyspark.sql import functions as F

from trolley.operators import remap as RM
from trolley.operators.textindex import pattern_hits, required_literals, similar_names


def _names(seed, n, alphabet, longest):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest))) for _ in range(n)})


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _mutants(names, seed):
    rng = random.Random(seed)
    for name in names:
        chars = list(name)
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(chars))
            chars[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "xy"])
        yield "".join(chars)


@pytest.mark.parametrize("measure, floor", [("edits", 0.72), ("edits", 0.9), ("edits", 0.5), ("blocks", 0.72), ("blocks", 0.4)])
def test_similar_names(spark, measure, floor):
    names = _names(1, 150, "aab c", 14) + _names(2, 50, "abcdefgh", 9) + ["", "aaaaaaaaaa", "aaaaaaaaab"]
    wanted = [*enumerate([*_mutants(names[::5], 3), "aaaaaaaaa", "", "zzzz"])]
    got = {(r.rule_no, r.name): r.similarity for r in similar_names(
        spark.createDataFrame([*wanted, (-1, None)], "rule_no long, want string"),
        spark.createDataFrame([(n,) for n in [*names, None]], "name string"), floor, measure).collect()}
    want = {}
    for no, w in wanted:
        for n in names:
            if w and n:
                s = 1 - _distance(w, n) / max(len(w), len(n)) if measure == "edits" else SequenceMatcher(None, n, w).ratio()
                if s >= floor:
                    want[no, n] = s
    assert got == want and len(want) > 15


def test_required_literals():
    assert required_literals(r"\bgizmo\b") == ["gizmo"]
    assert required_literals(r"(?:red|green) bolts?") == [" bolt"]
    assert required_literals(r"(anvil|hammer)s?") == ["anvil", "hammer"]
    assert required_literals(r"x(tube)+") == ["tube"]
    for free in (r"a?b?", r"(longword)?", r"(longword|xy)", r"[ab]{3}", r"\Qlit\E", r"(?x) a b c d", r"[a-z&&[^b]]foo", r"\p{L}abc(", None, ""):
        assert required_literals(free) == [""]


def test_pattern_hits_equal_the_nested_loop(spark):
    names = _names(5, 300, "abc ", 12) + ["abcabc", "ABC abc", "", "the Ärabc"]
    patterns = [r"abc", r"\babc\b", r"(abc|bca)", r"(abc|b)", r"^a", r"c.a", r"(cab)?b", r"a b*c", r"(aab|bba|cca)+$", r"[ab]bc", "bc a|ca b", "ärabc"]
    n = spark.createDataFrame([*enumerate(names), (-1, None)], "id long, name string")
    p = spark.createDataFrame([*enumerate(patterns)], "no long, pattern string")
    found = RM.rlike(F.col("name"), F.concat(F.lit("(?i)"), F.col("pattern")))
    got = sorted((r.id, r.no) for r in pattern_hits(n, "name", p, "pattern", found).collect())
    assert got == sorted((r.id, r.no) for r in n.crossJoin(p).filter(found).collect()) and len(got) > 100


def test_no_name_meets_every_rule(spark):
    from trolley.plans.registry import load_all
    for query in ("remap_regex_rules", "audit_flags", "remap_near_miss"):
        plan = load_all()[0][query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, query


def test_close_names_as_the_study_asks(spark):
    names = ["cold gear", "old gears", "cold pear", "gold gear", "SPACED NAME", "cold geaR"]
    p = spark.createDataFrame([(i, n, "A" if i < 5 else "B") for i, n in enumerate(names)], "product_id long, product_name string, category string")
    rules = RM.rules_df(spark, [(1, "name", "A", "cold gearr", "X", None), (2, "name", "*", "SPACEDNAME", "X", None), (3, "name", "*", "cold gearr", "X", None),
                                (4, "name", "B", "SPACEDNAME", "X", None)])
    got = RM.block_near_misses(p, RM.unmatched_rules(p, rules, RM.all_matches(p, rules))).collect()
    assert {r.product_name for r in got if r.rule_no == 1} == set(get_close_matches("cold gearr", names[:5], 3, 0.72))
    assert {r.product_name for r in got if r.rule_no == 3} == set(get_close_matches("cold gearr", names, 3, 0.72))
    assert [(r.rule_no, r.product_name, r.how) for r in got if r.rule_no in (2, 4)] == [(2, "SPACED NAME", "squash")]


def test_a_remap_refuses_rules_that_conflict_or_miss(spark):
    p = spark.createDataFrame([(1, "one thing", "A"), (2, "other", "A")], "product_id long, product_name string, category string")
    lines = p.select("product_id", "category")

    def remap(rules):
        rules = RM.rules_df(spark, rules)
        m = RM.all_matches(p, rules)
        return RM.apply_remap(lines, RM.resolve(m), RM.unmatched_rules(p, rules, m))

    good = [(1, "name", "A", "one thing", "B", None), (2, "regex", "A", "nothing here", "C", None)]
    assert sorted(tuple(r) for r in remap(good).collect()) == [(1, "B", "A"), (2, "A", "A")]
    with pytest.raises(RM.RemapRefused, match="conflict.*one thing"):
        remap([*good, (3, "regex", "*", "thing", "D", None)])
    with pytest.raises(RM.RemapRefused, match="unmatched name.*rule 4, absent"):
        remap([*good, (4, "name", "*", "absent", "D", None)])
