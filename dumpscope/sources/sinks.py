"""Overwriting writers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write Parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)


def write_counts(df: DataFrame, path: str, key: str = "title", count: str = "n") -> None:
    """Write ``key<TAB>count`` text lines, one file per partition, replacing what is there."""
    df.select(key, count).write.mode("overwrite").csv(path, sep="\t", quote="", escape="")


def write_titles(df: DataFrame, path: str, column: str = "title") -> None:
    """Write a plain text list of titles, replacing what is there; null titles have no line."""
    df.select(F.col(column).alias("value")).filter("value IS NOT NULL").write.mode("overwrite").text(path)
