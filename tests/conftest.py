import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from medistar.session import configure, ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def small_star(spark):
    from medistar.plans.star import star_from_driver
    return star_from_driver(spark, SF_SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="medistar-test-", dir="/tmp")
