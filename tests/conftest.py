import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


START = dt.datetime(2024, 1, 1)


def ticks_of(spark, rows):
    """(symbol, minutes after the start, price) as RAW-like rows."""
    data = [(s, START + dt.timedelta(minutes=m), p) for s, m, p in rows]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(data, "symbol string, processed_timestamp timestamp, current_price double")
    return df.withColumn("batch_timestamp", F.lit("2024-02-01 00:00:00").cast("timestamp"))


def values(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())
