"""Column-expression helpers.  All JVM-side built-ins (stay in codegen)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from trolley import params


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_label(c) -> Column:
    """String form, trimmed, upper case, '_' as space, whitespace collapsed."""
    s = F.upper(F.trim(_c(c).cast("string")))
    s = F.regexp_replace(s, "_", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def segment(value, edges=params.SEGMENT_EDGES, labels=params.SEGMENT_LABELS) -> Column:
    """value < edges[0] -> labels[0]; value <= edges[1] -> labels[1]; else labels[2]."""
    v = _c(value)
    return (F.when(v < F.lit(edges[0]), labels[0])
             .when(v <= F.lit(edges[1]), labels[1])
             .otherwise(labels[2]))


def season_of_month(month, mapping=params.MONTH_SEASON, default=params.DEFAULT_SEASON) -> Column:
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in sorted(mapping.items())))
    return F.coalesce(F.try_element_at(m, _c(month).cast("int")), F.lit(default))


def date_key(d) -> Column:
    """YYYYMMDD integer key."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def iso_weekday(d) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(_c(d)) + 1).cast("bigint")


def year_month(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def clip(c, cap) -> Column:
    return F.least(_c(c), F.lit(cap))


def round_money(c) -> Column:
    """Exact decimal sum -> double rounded to cents."""
    return F.round(_c(c).cast("double"), 2)
