"""Places of rows in an order, without a window over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.plans.stored import written


def placed(df: DataFrame, by: list[str], order: list[str], name: str = "place") -> DataFrame:
    """df with each row's place, from 0, among the rows of its group by, in order; order must tell the rows of a group apart.

    Rows are dealt by ranges of (by, order), sorted and stored once with their number within the range; the
    sizes of a group's ranges are added up, so no window goes over rows.
    """
    at = F.monotonically_increasing_id()
    parts = written(df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("__at", at), "placed").withColumn("__part", F.shiftright("__at", 33))
    sizes = parts.groupBy("__part", *by).agg(F.min("__at").alias("__low"), F.count(F.lit(1)).alias("__m"))  # a row per range, and one per further group in it
    before = F.sum("__m").over(Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("__part", *by, (F.coalesce(before, F.lit(0)) - F.col("__low")).alias("__shift"))
    return parts.join(sizes, ["__part", *by]).select(*df.columns, (F.col("__at") + F.col("__shift")).alias(name))
