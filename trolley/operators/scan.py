"""Numbering rows within groups by a segmented prefix scan.

Rows are cut into ranges of (group, order), so a group of any size is spread
over as many tasks as it needs.  Each range numbers its part of a group; a group
that crosses ranges is shifted by the counts of its earlier parts, of which a
range has at most two (its first and its last group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.session import written


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... within each ``group`` by ``order`` (nulls first;
    rows that tie in all of it are numbered in any order).  Rows with a null
    group are a group of their own."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written, so that every later step sees the same ranges
    ranged = written(df.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    shift = sizes.withColumn("_before", F.sum("_n").over(before)).where(F.col("_before").isNotNull())
    # at most one shifted group a range: a group that began in an earlier one
    shift = F.broadcast(shift.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_before"))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    local = F.row_number().over(Window.partitionBy("_part", *group).orderBy(*order))
    out = ranged.withColumn("_local", local).join(shift, same, "left")
    return out.select(*df.columns, (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("int").alias(name))
