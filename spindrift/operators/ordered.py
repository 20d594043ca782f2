"""Running sums over an order, without a task that sees the whole of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindrift.session import checkpoints


def running_sum(df: DataFrame, value: Column, part: list[str], order: list[str], out: str) -> DataFrame:
    """df with out: the sum of value over the rows of the same part that come before in the order, whose rows must differ.

    Rows are dealt by ranges of part and order; only a range's rows meet in a window, and the ranges' sums are summed over
    a table of one row a part and range. So a part of most rows is as many ranges as its size asks for. Nulls are parts.
    """
    checkpoints(df.sparkSession)
    ranged = df.withColumn("_value", value).repartitionByRange(*part, *order).withColumn("_range", F.spark_partition_id()).checkpoint()
    named = {p: f"_part{i}" for i, p in enumerate(part)}
    sums = ranged.groupBy(*[F.col(p).alias(n) for p, n in named.items()], F.col("_range").alias("_of")).agg(F.sum("_value").alias("_own"))
    earlier = Window.partitionBy(*named.values()).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_own").over(earlier), F.lit(0))).drop("_own")
    inner = Window.partitionBy(*part, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = F.col("_range") == F.col("_of")
    for p, n in named.items():
        on = on & F.col(p).eqNullSafe(F.col(n))
    found = ranged.withColumn("_within", F.coalesce(F.sum("_value").over(inner), F.lit(0))).join(sums, on)
    return found.select(*df.columns, (F.col("_base") + F.col("_within")).alias(out))
