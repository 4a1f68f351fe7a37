"""Row positions and average ranks without a single-task window over all rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_position(files: DataFrame, name: str = "rank") -> DataFrame:
    """0-based position of each row of a file scan, in file order.

    Rows are counted per file split; only the split counts go through a window, and every row adds its
    offset inside the split to the number of rows before it.
    """
    rows = files.select(
        *files.columns,
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = rows.groupBy("_path", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "_path", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    position = F.col("_before") + F.col("_id") - F.col("_first")
    return rows.join(splits, ["_path", "_start"]).select(position.alias(name), *files.columns)


def average_rank(df: DataFrame, value: str, name: str, width: int = 1_000_000) -> DataFrame:
    """1-based rank of an integer column, ties sharing their mean rank.

    Equal values are counted first. Their cumulative counts run inside value ranges of ``width`` and over
    the totals of those ranges, so no task sorts all values.
    """
    known = df.filter(F.col(value).isNotNull())
    counts = known.groupBy(value).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_range", F.floor(F.col(value) / width))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.groupBy("_range").agg(F.sum("_n").alias("_total"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    smaller = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    ranks = counts.join(ranges, "_range").select(value, (smaller + (F.col("_n") + 1) / 2).alias(name))
    return known.join(ranks, value)
