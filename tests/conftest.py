import sys
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from series_helpers import START, slots  # noqa: E402

from roadspeed.session import adopt  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield adopt(session)
    session.stop()


@pytest.fixture
def series(spark):
    """series({"a": [1.0, None, ...]}): one slot per value from START on."""
    from pyspark.sql import functions as F

    def make(links, start=START, step=timedelta(minutes=5), col="self_mean"):
        rows = [
            (link, at.isoformat(sep=" "), value)
            for link, values in links.items()
            for at, value in zip(slots(len(values), start, step), values)
        ]
        df = spark.createDataFrame(rows, f"linkid string, at string, {col} double")
        return df.select("linkid", F.col("at").cast("timestamp").alias("datetime"), col)

    return make
