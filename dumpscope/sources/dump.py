"""Reading dump files as records, one per article end marker."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpscope.constants import END_MARKER, TITLE_MARKER


def kept_marker(end_marker: str = END_MARKER, title_marker: str = TITLE_MARKER) -> str:
    """The piece of the end marker that stays at the end of a complete record.

    Records are separated by the rest of the marker. A record that lacks this piece was cut off at the end
    of its file, so a truncated article shows in the record itself, whatever split it was read in. The piece is the
    longest of at most half the marker whose rest does not stand in the title marker; only a file cut inside an end
    marker, right behind this piece, passes for complete.
    """
    pieces = (end_marker[:n] for n in range(len(end_marker) // 2, 0, -1))
    return next((p for p in pieces if end_marker[len(p) :] not in title_marker), end_marker[:1])


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan by key when it has fewer partitions than the cluster has cores.

    That is so for unsplittable (gz) files, or few row groups; a larger scan is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_dump(
    spark: SparkSession,
    path: str | list[str],
    end_marker: str = END_MARKER,
    title_marker: str = TITLE_MARKER,
) -> DataFrame:
    """Dump files (globs, gz too) as ``article_id``, ``value``: the text up to each end marker.

    The record separator makes the read safe under any file split.
    """
    separator = end_marker[len(kept_marker(end_marker, title_marker)) :]
    if not separator or separator in title_marker:
        raise ValueError("the end marker must not be contained in the title marker")
    records = spark.read.text(path, lineSep=separator)
    return spread(records.select(F.monotonically_increasing_id().alias("article_id"), "value"), "article_id")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Dump files as plain lines, ``value``."""
    return spark.read.text(path)
