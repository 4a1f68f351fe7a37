import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def apply(spark):
    """Apply a Column function to each of some values."""
    from pyspark.sql import functions as F

    def run(function, values, type_="string"):
        rows = list(enumerate(values))
        df = spark.createDataFrame(rows, f"i int, v {type_}").select("i", function(F.col("v")).alias("r"))
        return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]

    return run
