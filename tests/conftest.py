import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from depscope.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def apply(spark):
    """Apply a column builder to literal values, in order."""
    from pyspark.sql import functions as F

    def run(build, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]
    return run
