"""Running numbers in a sort order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.operators.small import pin_small
from flowsift.session import landed

PART_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Add the number of each row, from 0, in the order of the given columns.

    A table of a few rows is numbered by a window. A larger one is sorted by range and
    written; a row's number is its place in its partition plus the rows of the partitions
    before it, of which there is one count each. Both ways give the same numbers.
    """
    table, few = pin_small(df)
    if few is not None:
        every = Window.partitionBy(F.lit(0)).orderBy(*order)
        return table.withColumn(out, (F.row_number().over(every) - 1).cast("bigint"))
    return numbered_by_range(df, order, out)


def numbered_by_range(df: DataFrame, order: list[str], out: str) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = landed(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", PART_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_at") - F.shiftleft("_part", PART_BITS)
    return rows.withColumn("_part", part).join(starts, "_part").withColumn(
        out, F.col("_start") + place).drop("_part", "_at", "_start")
