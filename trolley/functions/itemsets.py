"""Itemset text form and bitmask helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = ", "


def itemset_to_text(items) -> Column:
    """Sorted, comma-joined text form of an item array."""
    c = F.col(items) if isinstance(items, str) else items
    return F.array_join(F.array_sort(c), SEP)


def text_to_itemset(text) -> Column:
    """Exact inverse of ``itemset_to_text``: split, trim, drop empties, sort."""
    c = F.col(text) if isinstance(text, str) else text
    parts = F.transform(F.split(c, ","), lambda x: F.trim(x))
    return F.array_sort(F.filter(parts, lambda x: x != F.lit("")))


def mask_items(mask, names) -> Column:
    """Items (from the indexed ``names`` array column) whose bit is set in ``mask``."""
    m = F.col(mask) if isinstance(mask, str) else mask
    n = F.col(names) if isinstance(names, str) else names
    return F.filter(n, lambda x, i: F.shiftleft(F.lit(1).cast("bigint"), i).bitwiseAND(m) != 0)
