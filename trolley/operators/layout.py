"""Shelf-layout scoring and search against strong rules.

A layout is a DataFrame (layout_id, item, zone_no).  A rule is *captured* by a
layout when all of its items sit in one zone.  With items as bits:
zone mask = bit_or over the zone's items, and a rule is captured iff
rule_mask & zone_mask = rule_mask for some zone.  Zones are disjoint, so a
rule is captured by at most one zone per layout.

Many layouts are scored in one job (random baselines): rules meet the distinct
zones through the containment index, an equi-join on each rule's rarest item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley import params
from trolley.operators.containment import Index
from trolley.operators.mining import bit, set_bits, shl, one


def strong_rule_table(rules: DataFrame, floor: float) -> DataFrame:
    """(rule_id, mask, size, support, lift) for rules with lift >= floor."""
    return (rules.filter(F.col("lift_raw") >= floor)
            .select(F.concat_ws(" -> ", "antecedents", "consequents").alias("rule_id"),
                    F.col("full").alias("mask"), F.bit_count("full").cast("bigint").alias("size"),
                    F.col("n_full").alias("n_full"), "support", "lift"))


def zone_masks(layouts: DataFrame, index: DataFrame) -> DataFrame:
    return (layouts.join(F.broadcast(index), "item")  # index: <= 63 rows
            .groupBy("layout_id", "zone_no").agg(F.bit_or(bit("idx")).alias("zmask")))


def captures(rules: DataFrame, layouts: DataFrame, index: DataFrame) -> DataFrame:
    """(layout_id, rule_id, zone_no) for every captured rule."""
    zm = zone_masks(layouts, index)
    # many layouts share zones, many rules share their items: each mask meets each once
    zones = Index(zm.select("zmask").distinct(), set_bits("zmask"))
    met = zones.contained(rules.select("mask").distinct(), "mask", set_bits("mask"),
                          F.col("mask").bitwiseAND(F.col("zmask")) == F.col("mask"))
    return met.join(zm, "zmask").join(rules.select("rule_id", "mask"), "mask").select("layout_id", "rule_id", "zone_no")


def score_layouts(rules: DataFrame, layouts: DataFrame, index: DataFrame) -> DataFrame:
    """Per layout: rules captured, support captured, capture rate %, totals."""
    cap = captures(rules, layouts, index).join(rules.select("rule_id", "support"), "rule_id")
    per = cap.groupBy("layout_id").agg(F.count(F.lit(1)).alias("rules_captured"),
                                        F.sum("support").alias("support_captured"))
    tot_rules = rules.agg(F.count(F.lit(1))).scalar()
    tot_sup = rules.agg(F.sum("support")).scalar()
    ids = layouts.select("layout_id").distinct()
    return (ids.join(per, "layout_id", "left")
            .select("layout_id",
                    F.coalesce("rules_captured", F.lit(0)).cast("bigint").alias("rules_captured"),
                    F.round(F.coalesce("support_captured", F.lit(0.0)), 8).alias("support_captured"),
                    F.round(F.when(tot_sup > 0, F.lit(100.0) * F.coalesce("support_captured", F.lit(0.0))
                                   / tot_sup).otherwise(F.lit(0.0)), 6).alias("capture_rate"),
                    tot_rules.alias("total_rules"), F.round(tot_sup, 8).alias("total_support")))


def score_detail(rules: DataFrame, layouts: DataFrame, index: DataFrame, zones: DataFrame) -> DataFrame:
    """Every (layout, rule): captured?, capturing zone, intention class."""
    cap = captures(rules, layouts, index)
    ids = layouts.select("layout_id").distinct()
    # the result is every layout x rule pair
    allr = ids.crossJoin(rules.select("rule_id", "support", "lift"))
    z = zones.select("zone_no", "zone_assignment", "intention")
    return (allr.join(cap, ["layout_id", "rule_id"], "left")
            .join(F.broadcast(z), "zone_no", "left")
            .select("layout_id", "rule_id", F.round("support", 8).alias("support"),
                    F.round("lift", 8).alias("lift"), F.col("zone_no").isNotNull().alias("captured"),
                    "zone_no", "zone_assignment", "intention"))


def intention_counts(rules: DataFrame, layouts: DataFrame, index: DataFrame, zones: DataFrame) -> DataFrame:
    """Per layout and intention class of the capturing zone: rules and support."""
    z = zones.select("zone_no", "intention")
    cap = captures(rules, layouts, index).join(rules.select("rule_id", "support"), "rule_id").join(F.broadcast(z), "zone_no")
    return cap.groupBy("layout_id", "intention").agg(F.count(F.lit(1)).alias("rules"), F.round(F.sum("support"), 8).alias("support"))


def zone_breakdown(rules: DataFrame, layouts: DataFrame, index: DataFrame, zones: DataFrame) -> DataFrame:
    """Per (layout, zone): rules captured and share of captured support, zero zones kept."""
    cap = captures(rules, layouts, index).join(rules.select("rule_id", "support"), "rule_id")
    per = cap.groupBy("layout_id", "zone_no").agg(F.count(F.lit(1)).alias("rules_captured"),
                                                   F.sum("support").alias("sup"))
    dom = layouts.select("layout_id").distinct().join(F.broadcast(zones.select("zone_no", "intention")),
                                                      F.lit(True))
    out = dom.join(per, ["layout_id", "zone_no"], "left")
    w = Window.partitionBy("layout_id")
    # nothing captured: no share, and no division by zero
    share = F.try_divide(F.coalesce("sup", F.lit(0.0)), F.sum(F.coalesce("sup", F.lit(0.0))).over(w))
    return out.select("layout_id", "zone_no", "intention",
                      F.coalesce("rules_captured", F.lit(0)).cast("bigint").alias("rules_captured"),
                      F.round(F.coalesce("sup", F.lit(0.0)), 8).alias("support_captured"),
                      F.round(F.lit(100.0) * F.coalesce(share, F.lit(0.0)), 6).alias("support_share_pct"))


# ------------------------------------------------------- layout builders --
def layout_in_order(items: DataFrame, order: list, sizes=params.ZONE_SIZES,
                    layout_id: str = "given") -> DataFrame:
    """Fill zones 1..n with sizes[i] items taken in ``order``."""
    w = Window.orderBy(*order)  # item domain: bounded dimension
    slot = F.row_number().over(w)
    zone, acc = None, 0
    for i, s in enumerate(sizes, start=1):
        acc += s
        zone = F.when(slot <= acc, F.lit(i)) if zone is None else zone.when(slot <= acc, F.lit(i))
    return items.select(F.lit(layout_id).alias("layout_id"), "item", zone.cast("bigint").alias("zone_no"))


def random_layouts(spark: SparkSession, index: DataFrame, n_layouts: int, seed: int = 42,
                   sizes=params.ZONE_SIZES) -> DataFrame:
    """n seeded random layouts with fixed zone sizes, generated in parallel.

    Order inside a layout = md5(item | layout | seed) (portable: DuckDB
    computes the same md5), slot -> zone by the cumulative sizes.
    """
    ids = spark.range(n_layouts).select(F.col("id").alias("layout_no"))
    li = ids.join(F.broadcast(index.select("item")), F.lit(True))  # layouts x domain (<= 63)
    key = F.md5(F.concat_ws("|", "item", F.col("layout_no").cast("string"), F.lit(str(seed))))
    w = Window.partitionBy("layout_no").orderBy(key, "item")
    slot = F.row_number().over(w)
    zone, acc = None, 0
    for i, s in enumerate(sizes, start=1):
        acc += s
        zone = F.when(slot <= acc, F.lit(i)) if zone is None else zone.when(slot <= acc, F.lit(i))
    return li.select(F.concat(F.lit("random_"), F.col("layout_no").cast("string")).alias("layout_id"),
                     "item", zone.cast("bigint").alias("zone_no"))


def random_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(F.count(F.lit(1)).alias("layouts"),
                      F.min("rules_captured").alias("min_captured"),
                      F.round(F.avg("rules_captured"), 6).alias("mean_captured"),
                      F.max("rules_captured").alias("max_captured"),
                      F.round(F.avg("support_captured"), 8).alias("mean_support_captured"))


def before_after(scores: DataFrame, before: str, after: str) -> DataFrame:
    b = scores.filter(F.col("layout_id") == before).select(
        F.lit(1).alias("k"), F.col("rules_captured").alias("rules_before"),
        F.col("support_captured").alias("support_before"), F.col("capture_rate").alias("rate_before"))
    a = scores.filter(F.col("layout_id") == after).select(
        F.lit(1).alias("k"), F.col("rules_captured").alias("rules_after"),
        F.col("support_captured").alias("support_after"), F.col("capture_rate").alias("rate_after"))
    return (b.join(a, "k").drop("k")
            .withColumn("rules_delta", F.col("rules_after") - F.col("rules_before"))
            .withColumn("support_delta", F.round(F.col("support_after") - F.col("support_before"), 8))
            .withColumn("rate_delta", F.round(F.col("rate_after") - F.col("rate_before"), 6)))


# ---------------------------------------------------------- exact (L9) ----
def _or_bits(array, among, cap):
    """The masks of ``array`` with every subset of the bits ``among`` (a column) added, up to ``cap`` bits."""
    return F.aggregate(set_bits(among), array, lambda acc, i: F.concat(
        acc, F.transform(F.filter(acc, lambda m: F.bit_count(m) < cap), lambda m: m.bitwiseOR(shl(one(), i)))))


def _mask(idxs) -> int:
    return sum(1 << i for i in idxs)


def _exact_states(spark: SparkSession, rules: DataFrame, index: DataFrame, capacities: list, locked: dict | None,
                  forbidden: dict | None, max_items: int) -> tuple[DataFrame, dict]:
    """(state, best) after the last zone: per set of placed items the best way there,
    a struct of captured baskets, the zones' masks (negated) and captured support."""
    from trolley.session import cut_lineage
    names = {r["idx"]: r["item"] for r in index.collect()}  # at most 63 items
    at = {v: k for k, v in names.items()}
    locked, forbidden = locked or {}, forbidden or {}
    bearing = rules.agg(F.coalesce(F.bit_or("mask"), F.lit(0).cast("bigint"))).first()[0]
    placed = bearing | _mask({at[v] for v in (*locked, *forbidden)})
    searched = {i: names[i] for i in sorted(names) if placed >> i & 1}
    if len(searched) > max_items:
        raise ValueError(f"{len(searched)} items in rules or constraints exceed the exact limit {max_items}")
    lit = lambda m: F.lit(m).cast("bigint")
    empty = spark.range(1)
    blocks = empty.select(F.explode(_or_bits(F.array(lit(0)), lit(placed), max(capacities))).alias("block"))
    sets = rules.groupBy("mask").agg(F.sum("n_full").alias("n"), F.sum("support").alias("s"))
    met = Index(blocks, set_bits("block")).contained(sets, "mask", set_bits("mask"), F.col("mask").bitwiseAND(F.col("block")) == F.col("mask"))
    value = met.groupBy("block").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    value = cut_lineage(blocks.join(value, "block", "left").select("block", F.coalesce("n", lit(0)).alias("n"), F.coalesce("s", F.lit(0.0)).alias("s")))
    states = empty.select(lit(0).alias("state"), F.struct(lit(0).alias("n"), F.array().cast("array<bigint>").alias("path"), F.lit(0.0).alias("s")).alias("best"))
    for zone, cap in enumerate(capacities, start=1):
        must = _mask(at[v] for v, z in locked.items() if z == zone)
        may = placed & ~_mask(at[v] for v in locked) & ~_mask(at[v] for v, zs in forbidden.items() if zone in zs)
        rest = lit(may).bitwiseAND(F.bitwise_not("state"))
        step = states.withColumn("block", F.explode(_or_bits(F.array(lit(must)), rest, cap))).where(F.bit_count("block") <= cap).join(value, "block")
        path = F.concat("best.path", F.array(F.negative("block")))
        step = step.select(F.col("state").bitwiseOR(F.col("block")).alias("state"),
                           F.struct((F.col("best.n") + F.col("n")).alias("n"), path.alias("path"), (F.col("best.s") + F.col("s")).alias("s")).alias("best"))
        states = cut_lineage(step.groupBy("state").agg(F.max("best").alias("best")))
    return states, {"searched": searched, "placed": placed, "bearing": bearing}


def exact_layout(spark: SparkSession, rules: DataFrame, index: DataFrame, capacities: list,
                 max_items: int = 16, locked: dict | None = None, forbidden: dict | None = None) -> DataFrame:
    """True maximum of captured support, dynamic programming over zones.

    Items that appear in no rule cannot change the score and are left out.
    A zone takes a *block* of at most its capacity; a block's value is the
    support of the rules inside it, found through the containment index.  A
    state is the set of items placed so far; only the subsets of what it leaves
    over are enumerated and joined with their values, 3^n over all states, so
    ``max_items`` guards the searched items.  ``locked`` and ``forbidden`` as in
    ``optimise_layout``.  Where the zones are too small for all items, the best
    that fits is given.
    """
    states, known = _exact_states(spark, rules, index, capacities, locked, forbidden, max_items)
    return states.agg(F.round(F.max("best.s"), 8).alias("best_support"),
                      F.lit(known["bearing"].bit_count()).cast("bigint").alias("rule_bearing_items"))


def exact_assignment(spark: SparkSession, rules: DataFrame, index: DataFrame, capacities: list,
                     locked: dict | None = None, forbidden: dict | None = None, max_items: int = 16) -> DataFrame:
    """(item, zone_no, support): one optimal layout of the items in rules or constraints.

    Most captured baskets wins; among equals the smallest item set (as a mask)
    of zone 1, then of zone 2, and so on.  No row if no layout holds all these
    items under the constraints.  Other items fit wherever there is room.
    """
    states, known = _exact_states(spark, rules, index, capacities, locked, forbidden, max_items)
    best = states.where(F.col("state") == known["placed"]).select("best.path", F.round("best.s", 8).alias("support"))
    zones = best.select("support", F.posexplode("path").alias("z", "neg"))
    items = zones.select("support", (F.col("z") + 1).cast("bigint").alias("zone_no"), F.explode(set_bits(F.negative("neg"))).alias("idx"))
    return items.join(F.broadcast(index), "idx").select("item", "zone_no", "support")  # index: <= 63 rows


# ------------------------------------------------------ local search (L8) --
def _climb(masks, support, n_items: int, home, allowed, room, fixed, start):
    """Steepest ascent from ``start`` (zone of each movable item): the best improving
    move or, where zones are limited, swap, until none improves.  Returns the
    zones, the score and the steps taken."""
    import numpy as np
    movable = np.array(sorted(start), dtype=np.int64)
    n_zones = len(fixed)
    zone = dict(start)
    z = np.array(fixed, dtype=np.int64)
    for i, k in zone.items():
        z[k] |= np.int64(1) << np.int64(i)

    def captured(zone_masks):
        """Support of the rules inside each mask (any shape)."""
        flat = np.asarray(zone_masks, dtype=np.int64).ravel()
        out = np.concatenate([((part[:, None] & masks) == masks) @ support for part in np.array_split(flat, max(1, len(flat) // 512))]) \
            if len(flat) else np.zeros(0)
        return out.reshape(np.shape(zone_masks))

    trace = []
    while True:
        now = captured(z)
        count = np.bincount([zone[i] for i in movable], minlength=n_zones) if len(movable) else np.zeros(n_zones, int)
        cand = []  # kind, item, other item (or -1), from, to
        for i in movable.tolist():
            cand += [(i, -1, zone[i], k) for k in allowed[i] if k != zone[i] and (room is None or count[k] < room[k])]
        if room is not None:
            cand += [(i, j, zone[i], zone[j]) for x, i in enumerate(movable.tolist()) for j in movable.tolist()[x + 1:]
                     if zone[i] != zone[j] and zone[j] in allowed[i] and zone[i] in allowed[j]]
        if not cand:
            break
        c = np.array(cand, dtype=np.int64)
        bit_i = np.int64(1) << c[:, 0]
        bit_j = np.where(c[:, 1] >= 0, np.int64(1) << np.maximum(c[:, 1], 0), np.int64(0))
        gain = (captured(z[c[:, 2]] & ~bit_i | bit_j) + captured(z[c[:, 3]] & ~bit_j | bit_i) - now[c[:, 2]] - now[c[:, 3]])
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9:
            break
        i, j, here, there = cand[best]
        z[here], z[there] = z[here] & ~bit_i[best] | bit_j[best], z[there] & ~bit_j[best] | bit_i[best]
        zone[i] = there
        if j >= 0:
            zone[j] = here
        trace.append((i, j, here, there, float(gain[best])))

    # among equal scores, nearest home: displacements that cost nothing are undone
    moved = True
    while moved:
        moved = False
        count = np.bincount([zone[i] for i in movable], minlength=n_zones) if len(movable) else np.zeros(n_zones, int)
        for i in movable.tolist():
            here, there = zone[i], home[i]
            if here == there or there not in allowed[i] or room is not None and count[there] >= room[there]:
                continue
            b = np.int64(1) << np.int64(i)
            new = captured([z[here] & ~b, z[there] | b])
            if new.sum() >= captured([z[here], z[there]]).sum() - 1e-9:
                z[here], z[there], zone[i], moved = z[here] & ~b, z[there] | b, there, True
                count[here], count[there] = count[here] - 1, count[there] + 1
    return zone, float(captured(z).sum()), trace


def optimise_layout(spark: SparkSession, rules: DataFrame, index: DataFrame, home: DataFrame, n_zones: int,
                    capacities: list | None = None, locked: dict | None = None, forbidden: dict | None = None,
                    restarts: int = 200, seed: int = 42, also_from: list | None = None) -> DataFrame:
    """Local search for the layout that captures most support; a row per restart.

    ``home`` (item, zone_no) is the reference layout: restart 0 starts there, the
    others at random feasible places, further ones at the layouts
    ``also_from`` ({item: zone}).  ``locked`` {item: zone} never move,
    ``forbidden`` {item: [zones]} are banned, ``capacities`` (None: unlimited)
    count all of a zone's items.  Only items in rules are searched; the others
    go home if that is allowed and has room, else to the first zone that is.

    Restarts are independent, so each is one row of a distributed range and
    climbs to its end: no step limit.  What a task is given is the distinct
    rule sets over the domain of at most 63 items and their support.
    """
    import json

    import numpy as np
    import pandas as pd
    names = [r["item"] for r in index.orderBy("idx").collect()]
    at = {n: i for i, n in enumerate(names)}
    sets = rules.groupBy("mask").agg(F.sum("support").alias("support")).orderBy("mask").collect()
    masks, support = np.array([r["mask"] for r in sets], np.int64), np.array([r["support"] for r in sets], float)
    home_of = {at[r["item"]]: r["zone_no"] - 1 for r in home.select("item", "zone_no").collect()}
    lock = {at[k]: v - 1 for k, v in (locked or {}).items()}
    ban = {at[k]: {z - 1 for z in v} for k, v in (forbidden or {}).items()}
    bearing = int(np.bitwise_or.reduce(masks)) if len(masks) else 0
    movable = [i for i in range(len(names)) if bearing >> i & 1 and i not in lock]
    allowed = {i: [z for z in range(n_zones) if z not in ban.get(i, ())] for i in range(len(names))}
    room = None if capacities is None else [c - sum(v == z for v in lock.values()) for z, c in enumerate(capacities)]
    fixed = [0] * n_zones
    for i, z in lock.items():
        fixed[z] |= 1 << i
    warm = [{at[k]: v - 1 for k, v in w.items()} for w in (also_from or [])]

    def place(order, prefer):
        count, zone = [0] * n_zones, {}
        for i in order:
            for z in prefer(i):
                if z in allowed[i] and (room is None or count[z] < room[z]):
                    zone[i] = z
                    count[z] += 1
                    break
            else:
                return None
        return zone

    def one_restart(r: int):
        rng = np.random.default_rng([seed, r])
        if r == 0 or r > restarts - 1:
            base = home_of if r == 0 else warm[r - restarts]
            start = place(movable, lambda i: [base[i], *range(n_zones)])
        else:
            start = next(z for z in (place(rng.permutation(movable).tolist(), lambda i: rng.permutation(n_zones).tolist())
                                     for _ in range(1000)) if z is not None)
        return _climb(masks, support, len(names), home_of, allowed, room, fixed, start)

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf["id"]:
                zone, score, trace = one_restart(int(r))
                zone = dict(zone) | lock
                count = [sum(v == z for v in zone.values()) for z in range(n_zones)]
                for i in range(len(names)):
                    if i not in zone:  # in no rule: home, or the first zone with room
                        for z in [home_of[i], *range(n_zones)]:
                            if z in allowed[i] and (capacities is None or count[z] < capacities[z]):
                                zone[i] = z
                                count[z] += 1
                                break
                named = [{"step": k + 1, "item": names[i], "with": None if j < 0 else names[j], "from": a + 1, "to": b + 1, "gain": round(g, 8)}
                         for k, (i, j, a, b, g) in enumerate(trace)]
                zm = [sum(1 << i for i, v in zone.items() if v == z) for z in range(n_zones)]
                rows.append((int(r), round(score, 8), len(trace), *zm, json.dumps(named)))
            yield pd.DataFrame(rows, columns=["restart", "score", "steps", *zc, "trace"])

    zc = [f"z{k}" for k in range(1, n_zones + 1)]
    schema = "restart long, score double, steps int, " + ", ".join(f"{z} long" for z in zc) + ", trace string"
    total = restarts + len(warm)
    return spark.range(0, total, 1, min(total, 64)).mapInPandas(run, schema)


def best_restart(states: DataFrame, index: DataFrame, n_zones: int, layout_id: str) -> DataFrame:
    """(layout_id, item, zone_no) of the best restart (ties: the first)."""
    best = states.orderBy(F.desc("score"), "restart").limit(1)
    zones = F.array(*[F.struct(F.lit(k).cast("bigint").alias("zone_no"), F.col(f"z{k}").alias("m")) for k in range(1, n_zones + 1)])
    z = best.select(F.explode(zones).alias("z")).select("z.zone_no", F.explode(set_bits(F.col("z.m"))).alias("idx"))
    return z.join(F.broadcast(index), "idx").select(F.lit(layout_id).alias("layout_id"), "item", "zone_no")


def optimise_summary(states: DataFrame) -> DataFrame:
    best = states.agg(F.max("score")).scalar()
    return states.agg(F.count(F.lit(1)).alias("restarts"), F.round(F.max("score"), 8).alias("best_support"),
                      F.count_if(F.abs(F.col("score") - best) < 1e-9).alias("hits"),
                      F.max("steps").alias("max_steps"), F.round(F.avg("score"), 8).alias("mean_support"))
