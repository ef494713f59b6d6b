"""Places of rows in a global order, group by group, without one task that holds a group."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotejo.llm.common import stored


def ranked(df: DataFrame, groups, order) -> DataFrame:
    """``df`` with ``rank`` (0, 1, 2 … in its group) and ``total`` (rows of the group), both long.

    ``groups`` and ``order`` name columns; ``order`` may hold sort columns too, and should be total for a repeatable
    result (equal rows are interchangeable). Nulls form a group of their own. Rows are dealt by ranges of (groups,
    order), so a hot group spreads over many tasks; what is counted besides is one row per task and group.
    """
    if {"rank", "total"} & {c.lower() for c in df.columns}:
        raise ValueError("ranked adds rank and total: rename the columns of that name")
    keys = [F.col(g).asc_nulls_first() for g in groups] + [o if isinstance(o, Column) else F.col(o).asc_nulls_first() for o in order]
    placed = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place_", F.monotonically_increasing_id()))
    placed = placed.withColumn("task_", F.shiftright("place_", 33))
    runs = placed.groupBy("task_", *groups).agg(F.min("place_").alias("first_"), F.count("*").alias("rows_"))
    group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = F.sum("rows_").over(group.orderBy("task_").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows_")
    runs = runs.select(
        F.col("task_").alias("run_task_"), *[F.col(g).alias(f"run_{g}") for g in groups], (before - F.col("first_")).alias("shift_"),
        F.sum("rows_").over(group).alias("total"),
    )
    here = F.col("task_") == F.col("run_task_")
    for g in groups:
        here = here & F.col(g).eqNullSafe(F.col(f"run_{g}"))
    return placed.join(runs, here).select(*df.columns, (F.col("place_") + F.col("shift_")).alias("rank"), "total")
