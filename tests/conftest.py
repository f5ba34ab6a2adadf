import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """The results of column expressions for one text each."""
    from pyspark.sql import functions as F

    def run(expression, texts, second=None):
        rows = [(i, t, second[i] if second else None) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, t string, u string")
        column = expression(F.col("t"), F.col("u")) if second else expression(F.col("t"))
        return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]

    return run
