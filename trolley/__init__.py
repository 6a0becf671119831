"""trolley: retail basket analytics as Spark DataFrame jobs.

Layout:
    sources/    readers, the test-table adapter, sinks (idempotent append, rebuild)
    functions/  column-expression helpers (labels, dates, itemsets, statistics)
    operators/  one module per operator family; every op is DataFrame(s) -> DataFrame
    plans/      end-to-end jobs (daily batch, analytics batch) and the query catalogue
    streaming/  micro-batch incremental load built on the idempotent append
"""

from trolley.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
