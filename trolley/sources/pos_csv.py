"""Raw point-of-sale export (CSV with a letterhead above the header) and
small-artifact writers.

The export has a few letterhead lines, then the header, then data rows.
Reading uses an explicit schema (no inference) and tells data rows by content,
so it works for any number of files and partitions: no "skip the first n
lines of the file" assumption that only holds for a single split.  What is no
data row can be read with its reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXPORT_COLUMNS = ["date", "invoice_no", "customer", "product_group", "product", "unit",
                  "quantity", "rate", "total_amount"]


_CORRUPT = "_corrupt_record"
_QUOTES = {"quote": '"', "escape": '"'}


def write_export(df: DataFrame, path: str, letterhead: list) -> None:
    """Write lines as a raw export: letterhead lines, header, rows (day-first
    dates); fields with commas or quotes are quoted.

    Letterhead and header are prepended as text rows of a single-column
    frame; the body keeps Spark's partitioning (one file per partition)."""
    spark = df.sparkSession
    body = df.select(F.to_csv(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]),
                              {**_QUOTES, "emptyValue": ""}).alias("value"))
    head = spark.createDataFrame([(t,) for t in letterhead + [",".join(df.columns)]], "value string")
    head.unionByName(body).write.mode("overwrite").text(path)


def _parsed(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, list]:
    """Every line with its fields and, if it is no data row, the reason."""
    cols = [c.strip().split(" ")[0] for c in schema.split(",")]
    typed = ", ".join(f"{c} string" for c in cols) + f", {_CORRUPT} string"
    row = F.from_csv(F.col("value"), typed, {**_QUOTES, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    lines = spark.read.text(path).select("value", row.alias("r"))
    first = F.regexp_replace(F.trim(F.col(f"r.{cols[0]}")), "^\ufeff", "")
    reason = (F.when(F.trim("value") == "", "blank line")
              .when(F.lower(first) == cols[0].lower(), "header")
              .when(F.col(f"r.{cols[-1]}").isNull() & F.col(f"r.{_CORRUPT}").isNotNull(), "too few fields")
              .when(F.col(f"r.{_CORRUPT}").isNotNull(), "malformed fields")
              .when(F.try_to_date(first, "dd/MM/yyyy").isNull(), "bad date"))
    return lines.withColumn("reason", reason), cols


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Data rows of a raw export, fields as text by the explicit schema.

    Fields are split by the CSV rules (quoted commas and quotes).  Lines that
    are no data row are not here but, all of them, in ``export_rejects``.
    """
    lines, cols = _parsed(spark, path, schema)
    return lines.filter(F.col("reason").isNull()).select(*[F.col(f"r.{c}").alias(c) for c in cols])


def export_rejects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(reason, value) of every line that ``read_export`` leaves out: letterhead,
    header, blank lines, too few or malformed fields, bad dates."""
    lines, _ = _parsed(spark, path, schema)
    return lines.filter(F.col("reason").isNotNull()).select("reason", "value")


def preview(spark: SparkSession, path: str, n: int = 15) -> DataFrame:
    """First n raw lines without header handling (a sampling operator by design)."""
    return spark.read.text(path).limit(n)


def write_artifact(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Small result table as one file (coalesce(1) is only for results that
    are small by construction: KPI rows, rule tables, histograms)."""
    w = df.coalesce(1).write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
