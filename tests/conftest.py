import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quire.session import get_session

    s = get_session("local[4]", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


def one_col(spark, values, expr, type_="string"):
    """Evaluate a Column function over literal values; returns the results."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]
