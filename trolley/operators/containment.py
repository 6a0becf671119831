"""Set containment by an index instead of a nested loop.

Every candidate is posted under its rarest item, every holder under each of its
items; candidates meet only the holders that have their rarest item, in an
equi-join, and the rest is verified on the joined row.  A candidate has one
posting, so no pair is found twice.  The holders of an item that many have are
dealt to salts, as many as its count asks for, and the item's candidates go to
each of them.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: holders of an item that share a salt
SALT_HOLDERS = 1 << 18


class Index:
    """Holders posted under their items; ``keep`` persists the postings for many questions."""

    def __init__(self, holders: DataFrame, items: Column, keep: bool = False):
        held = holders.withColumn("_item", F.explode(items)).where(F.col("_item").isNotNull())
        self.often = held.groupBy("_item").agg(F.count(F.lit(1)).alias("_held"))
        if keep:
            self.often = self.often.persist(StorageLevel.MEMORY_AND_DISK)
        by = F.xxhash64(*[F.col(f"`{c}`") for c in holders.columns])
        self.held = held.withColumn("_by", by).join(self.often, "_item").withColumn("_salt", F.pmod("_by", self._salts("_held"))).drop("_by", "_held")
        if keep:
            self.held = self.held.persist(StorageLevel.MEMORY_AND_DISK)

    @staticmethod
    def _salts(held) -> Column:
        return F.ceil(F.col(held) / F.lit(SALT_HOLDERS))

    def contained(self, cands: DataFrame, key: str, cand_items: Column, verify: Column) -> DataFrame:
        """All pairs (candidate row, holder row) for which ``verify`` holds.

        ``key`` names the candidates' distinct key; the items are arrays without
        repeats; ``verify`` sees the columns of both sides, whose names must
        differ.  A candidate without items is in no posting and meets nobody;
        null keys and nulls among the items meet nobody either; repeated holders
        are holders each.
        """
        # an item that no holder has is the rarest: its candidates are posted nowhere
        rare = (cands.select(key, F.explode(cand_items).alias("_item")).join(self.often, "_item", "left")
                .groupBy(key).agg(F.min(F.struct(F.coalesce("_held", F.lit(0)).alias("_held"), "_item")).alias("_rare"))
                .select(key, "_rare._item", "_rare._held").where(F.col("_held") > 0))
        posted = rare if cands.columns == [key] else cands.join(rare, key)
        posted = posted.withColumn("_salt", F.explode(F.sequence(F.lit(0), self._salts("_held") - 1))).drop("_held")
        return self.held.join(posted, ["_item", "_salt"]).where(verify).drop("_item", "_salt")
