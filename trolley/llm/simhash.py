"""SimHash near-duplicate classes with pivot distance tables."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import cut_lineage, fresh_name, mix64, salted_left_join, text_column
from trolley.llm.graph import connected_components

HASH_SEED = 42
SHINGLE_CHUNK = 1 << 17
#: reference fingerprints: scrambled counters, the same in every run
PIVOTS = [int(p) for p in mix64(np.arange(1, 25, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)]
#: above so many fingerprints under one block key, links are found through midpoints instead of pairs
PAIR_GROUP = 64


def simhash(raw: bytes, shingle: int) -> int:
    """64-bit SimHash of the lower-cased words' shingles, repeats included."""
    words = raw.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    first, last = start[:n], end[min(shingle, len(words)) - 1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLE_CHUNK):
        spans = zip(first[at:at + SHINGLE_CHUNK].tolist(), last[at:at + SHINGLE_CHUNK].tolist())
        h = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, row_key, fp): row_key is a hash of doc_id and text, fp the SimHash as a
    signed long; null and empty texts have fp 0."""
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            text = text_column(batch, "text")
            out = [simhash(v.as_buffer().to_pybytes(), shingle) for v in text]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.array(out, np.uint64).view(np.int64))], schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_key"), "text")
            .mapInArrow(run, "doc_id long, row_key long, fp long"))


def _masks(distance: int) -> list[int]:
    """Masks of all but ``distance`` of ``distance + 3`` blocks of the 64 bits: two
    fingerprints that differ in at most ``distance`` bits agree under one mask at least."""
    n = distance + 3
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, n - distance)]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b) between different fingerprints ``fp`` (one row each).

    Every fingerprint carries its pivot table: its Hamming distances to all
    reference fingerprints.  Candidates share a block key; a pair whose tables
    differ by more than ``distance`` in any coordinate is discarded (triangle
    inequality), the survivors are verified bit by bit.  Under a block key
    with more than PAIR_GROUP fingerprints no pairs are formed: fingerprints
    within two bits share a midpoint one bit away from both, so members are
    linked to the least member of each midpoint (``distance`` 2), or to the
    midpoint itself where it is a member (``distance`` 1); that is exact for
    connectivity and linear in the group.
    """
    if not 0 <= distance <= 2:
        raise ValueError("midpoints serve distances up to 2")
    masks = _masks(distance)
    pivot = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("byte").alias(f"p{i}") for i, p in enumerate(PIVOTS)]
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))
                          .alias("mask", "key"))
    sizes = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = cut_lineage(keyed.join(sizes, ["mask", "key"]), shrink=4)

    small = keyed.where(F.col("n") <= PAIR_GROUP).select("mask", "key", "fp", *pivot)
    left = small.select("mask", "key", F.col("fp").alias("a"), *[F.col(f"p{i}").alias(f"l{i}") for i in range(len(PIVOTS))])
    right = small.withColumnRenamed("fp", "b")
    apart = F.greatest(*[F.abs(F.col(f"l{i}") - F.col(f"p{i}")) for i in range(len(PIVOTS))])
    pairs = (left.join(right, ["mask", "key"])
             .where((F.col("a") < F.col("b")) & (apart <= distance)
                    & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
             .select("a", "b"))

    free = F.element_at(F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1])
                                  for m in masks]), F.col("mask") + 1)
    flips = (keyed.where(F.col("n") > PAIR_GROUP)
             .select("mask", "fp", F.explode(free).alias("bit"))
             .select("mask", "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("mid")))
    if distance < 2:  # neighbours of a midpoint are two bits apart: only a midpoint that is a fingerprint links
        prints_at = flips.where("fp = mid").select("mask", "mid")
        stars = flips.where("fp < mid").join(prints_at, ["mask", "mid"]).select(F.col("fp").alias("a"), F.col("mid").alias("b"))
        return pairs.unionByName(stars).distinct()
    least = flips.groupBy("mask", "mid").agg(F.min("fp").alias("a"), F.max("fp").alias("_top")).where("a < _top").drop("_top")
    stars = (flips.join(least, ["mask", "mid"]).where("fp <> a")
             .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("a"))) <= distance)
             .select("a", F.col("fp").alias("b")))
    return pairs.unionByName(stars).distinct()


def _classes(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprinted rows, and for each fingerprint its smallest doc_id, number
    of rows and class (root, a fingerprint)."""
    rows = cut_lineage(fingerprints(docs, shingle))
    prints = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), shrink=4)
    comp = connected_components(links(prints.select("fp"), distance)).withColumnRenamed("vertex", "fp")
    return rows, prints.join(comp, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    Equal fingerprints are one vertex however many rows have them; classes are
    the connected components of the links.  component_id is the smallest
    doc_id of the class.  Null and empty texts have fingerprint zero and link
    like any other; a null doc_id keeps its row and never becomes a class id
    unless the class has no other; repeated rows stay repeated; other columns
    of ``docs`` are not looked at; an empty table gives an empty result.
    """
    rows, linked = _classes(docs, shingle, distance)
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("_rows")).where("_rows > 1")
    known = salted_left_join(linked.select("fp", "root"), ids.select("root", "component_id"), "root", F.col("fp"), 8)
    known = known.where("component_id is not null").select("fp", "component_id")
    return (salted_left_join(rows, known, "fp", F.col("row_key"), 64)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of ``docs`` for each class of near duplicates, with its columns unchanged.

    The row of the smallest doc_id stays (nulls last); among rows that share it
    a hash of the text decides, and of fully repeated rows any one stays.
    """
    rows, linked = _classes(docs, shingle, distance)
    best = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("best"))
    key = fresh_name(docs.columns, "row_key")
    keepers = cut_lineage(best.join(linked.select("fp", "root"), "fp").groupBy("root").agg(F.min("best").alias("best"))
                          .select(F.col("best.row_key").alias(key)), shrink=4)
    return (docs.withColumn(key, F.xxhash64(F.col("doc_id"), "text")).join(keepers, key, "left_semi")
            .dropDuplicates([key]).select(*[F.col(f"`{c}`") for c in docs.columns]))
