import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .appName("lading-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests own their staging folder; a cluster names its shared one instead
    s.conf.set("lading.staging.dir", tempfile.mkdtemp(prefix="lading-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from lading import session

    return session.new_staging_dir(spark, "test")


def same_rows(a, b):
    """Order-insensitive multiset equality, checked both ways with exceptAll."""
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
