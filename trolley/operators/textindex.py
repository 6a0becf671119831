"""Inverted indexes over names: which patterns can match, which names can be similar.

Names are posted under their grams; a bounded list (patterns, wanted names) is
broadcast and probes the postings by equality, so no name is held against the
whole list.  What the postings offer is then verified exactly.
"""

from __future__ import annotations

import re
from re import _parser as parser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: length of the grams that names are posted under for patterns
GRAM = 3
#: inline flags, quoting and nested classes may mean something else to Java: such patterns get no literal
_FOREIGN = re.compile(r"\(\?[a-zA-Z-]+[:)]|\\[QE]|\[[^\]]*(\[|&&)")


def _needed(items) -> list[str]:
    """Literals of which every match of the sequence holds at least one; of several such
    lists that whose shortest literal is longest."""
    lists, run = [], ""
    for op, arg in [*items, (None, None)]:
        if op is parser.LITERAL and 32 <= arg < 127:
            run += chr(arg).lower()
            continue
        if run:
            lists.append([run])
            run = ""
        if op is parser.SUBPATTERN:
            lists.append(_needed(arg[-1]))
        elif op is parser.BRANCH:
            branches = [_needed(b) for b in arg[1]]
            lists.append([one for b in branches for one in b] if all(branches) else [])
        elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT, parser.POSSESSIVE_REPEAT) and arg[0] >= 1:
            lists.append(_needed(arg[2]))
    return max(lists, key=lambda found: min(map(len, found), default=0), default=[])


def required_literals(pattern: str | None) -> list[str]:
    """Lower-case literals of at least GRAM characters, one of which is part of whatever
    the pattern finds without regard to case; [""] where there is no such list."""
    if pattern is None or _FOREIGN.search(pattern):
        return [""]
    try:
        found = sorted(set(_needed(parser.parse(pattern))))
    except (re.error, OverflowError, RecursionError):
        return [""]  # Java's own syntax
    return found if found and min(map(len, found)) >= GRAM else [""]


def grams(text: Column, q: int) -> Column:
    """All grams of q characters, in order; none of a shorter text."""
    return F.when(F.length(text) >= q, F.transform(F.sequence(F.lit(1), F.length(text) - (q - 1)), lambda i: text.substr(i, F.lit(q)))
                  ).otherwise(F.array().cast("array<string>"))


def numbered_grams(text: Column, q: int) -> Column:
    """As ``grams``, a repeated gram numbered, so that sets of them intersect like multisets."""
    g = grams(text, q)
    numbered = F.transform(g, lambda x, i: F.concat(x, F.lit("\0"), F.size(F.filter(F.slice(g, 1, i), lambda y: y == x)).cast("string")))
    return F.when(F.size(F.array_distinct(g)) == F.size(g), F.transform(g, lambda x: F.concat(x, F.lit("\0000")))).otherwise(numbered)


def pattern_hits(names: DataFrame, name: str, patterns: DataFrame, pattern: str, found: Column) -> DataFrame:
    """Rows of ``names`` x ``patterns`` for which ``found`` holds, every pair once.

    A pattern is posted under the first gram of each of its required literals, and
    ``found`` is asked only where one of the literals stands in the name; patterns
    without literals stand under the empty gram, which every name has.  ``patterns``
    is a bounded list.  Null names match nothing; equal rows of ``names`` count once.
    """
    literals = F.udf(required_literals, "array<string>")
    posted = (patterns.withColumn("_literal", F.explode(literals(F.col(pattern))))
              .withColumn("_gram", F.substring("_literal", 1, GRAM)))
    low = F.lower(F.col(name))
    probes = names.withColumn("_gram", F.explode(F.array_union(F.array(F.lit("")), grams(low, GRAM))))
    hits = probes.join(F.broadcast(posted), "_gram").filter(F.contains(low, F.col("_literal")) & found)
    # a name that holds several literals of one pattern meets it under each of them
    return hits.drop("_gram", "_literal").dropDuplicates()


def _blocks(a: pd.Series, b: pd.Series) -> pd.Series:
    from difflib import SequenceMatcher
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def similar_names(wanted: DataFrame, names: DataFrame, floor: float, measure: str = "edits") -> DataFrame:
    """Pairs (columns of ``wanted`` and ``names`` and ``similarity``) with similarity >= ``floor``.

    ``wanted`` has rule_no (unique) and want, and is a bounded list; ``names`` has name,
    each once.  ``measure``: "edits" is 1 - Levenshtein distance / longer length,
    "blocks" twice the length of the matching blocks / both lengths.

    Similar names share a least number of grams, known from their lengths: k edits destroy
    at most k*q of them, and what blocks match are common characters.  A wanted
    name probes only as many of its rarest grams as guarantee a hit; lengths, the number of
    common grams and the measure itself then decide.  Null and empty names match nothing.
    """
    if not 0 < floor <= 1:
        raise ValueError("floor must lie in (0, 1]")
    edits = measure == "edits"
    # bigrams, a mark standing before the name, guarantee a common gram only above one half; single characters always do
    q = 2 if edits and floor > 0.51 else 1
    slack = 1e-9
    marked = lambda c: F.concat(F.lit("\1"), c) if q == 2 else c
    if edits:
        shortest, longest = floor, 1 / floor
    else:
        shortest, longest = floor / (2 - floor), (2 - floor) / floor

    def common(a: Column, b: Column) -> Column:
        longer = F.greatest(a, b)
        if edits:
            return longer - q * F.floor((1 - floor) * longer + slack)
        return F.ceil(floor * (a + b) / 2 - slack)

    size = F.length("want")
    w = (wanted.filter(size > 0).withColumn("_want_grams", numbered_grams(marked(F.col("want")), q))
         .withColumn("_least", F.ceil(shortest * size - slack)).withColumn("_most", F.floor(longest * size + slack))
         .withColumn("_common", F.array_min(F.transform(F.sequence("_least", "_most"), lambda b: common(size, b)))))
    n = names.filter(F.length("name") > 0).withColumn("_grams", numbered_grams(marked(F.col("name")), q))
    ends = w.select("rule_no", "_want_grams", "_common", F.explode("_want_grams").alias("_gram"))
    held = (n.select(F.explode("_grams").alias("_gram")).join(F.broadcast(ends.select("_gram").distinct()), "_gram")
            .groupBy("_gram").agg(F.count(F.lit(1)).alias("_held")))
    # one window a wanted name, over its own grams
    rank = F.row_number().over(Window.partitionBy("rule_no").orderBy("_held", "_gram"))
    probes = (ends.join(held, "_gram").withColumn("_rank", rank)
              .withColumn("_spare", F.size("_want_grams") - F.greatest("_common", F.lit(1)) + 1))
    # grams that no name has cost no probe, but count among those that may be missing
    known = F.count(F.lit(1)).over(Window.partitionBy("rule_no"))
    probes = (probes.withColumn("_probes", F.col("_spare") - (F.size("_want_grams") - known)).filter(F.col("_rank") <= F.col("_probes"))
              .groupBy("rule_no").agg(F.collect_list("_gram").alias("_probe")))  # at most a wanted name's own grams
    index = w.join(probes, "rule_no").withColumn("_gram", F.explode("_probe"))
    length = F.length("name")
    met = (n.withColumn("_gram", F.explode("_grams")).join(F.broadcast(index), "_gram")
           .filter(length.between(F.col("_least"), F.col("_most"))
                   # a pair that shares several probes meets under the first of them
                   & (F.get(F.array_intersect("_probe", "_grams"), F.lit(0)) == F.col("_gram"))
                   & (F.size(F.array_intersect("_want_grams", "_grams")) >= common(size, length))))
    if edits:
        met = met.withColumn("similarity", 1 - F.levenshtein("want", "name") / F.greatest(size, length))
    else:
        met = met.withColumn("similarity", F.pandas_udf(_blocks, "double")("name", "want"))
    return met.filter(F.col("similarity") >= floor).drop(*[c for c in met.columns if c.startswith("_")])
