import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = (SparkSession.builder.master("local[8]").appName("starload-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("catalog")))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture()
def warehouse(spark, tmp_path):
    from starload.sources.warehouse import Warehouse
    house = Warehouse(spark, str(tmp_path), prefix=f"t{abs(hash(str(tmp_path))) % 10**9}_")
    house.create_namespaces()
    yield house
    house.reset()


def plan_of(df) -> str:
    """The physical plan, after execution the one that was run."""
    return df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
