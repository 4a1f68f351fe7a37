"""Small tables, whose size is checked before they are shipped to every task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INLINE_LIMIT = 5_000
BROADCAST_LIMIT = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def inline_values(table: DataFrame, limit: int = INLINE_LIMIT) -> list | None:
    """Rows of a small table, or None when it has more than ``limit``; never reads more than that."""
    rows = table.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def sql_list(values: list[str]) -> str:
    """String literals for ``IN``; parsed text, as building a column per literal takes far longer."""
    quoted = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return ", ".join(f"'{v}'" for v in quoted)


def broadcast_if_small(table: DataFrame, rows: int = BROADCAST_LIMIT, size: int = BROADCAST_BYTES) -> DataFrame:
    """The table with a broadcast hint when it has at most so many rows and bytes, else as it is."""
    measured = table.limit(rows + 1).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("size")
    )
    found = measured.first()
    return F.broadcast(table) if found["rows"] <= rows and found["size"] <= size else table
