import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from accounthealth.session import SQL_DEFAULTS, ensure_checkpoint_dir

    builder = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh_small(spark):
    from accounthealth.plans.warehouse import Warehouse

    return Warehouse.from_testdata(spark, SF0001)


@pytest.fixture(scope="session")
def wh_mid(spark):
    from accounthealth.plans.warehouse import Warehouse

    return Warehouse.from_testdata(spark, SF001)
