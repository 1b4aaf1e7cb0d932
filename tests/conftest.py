import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="vitrine-test-")
    s = (SparkSession.builder.master("local[8]").appName("vitrine-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.vitrine.store", scratch + "/store")
         .config("spark.sql.warehouse.dir", scratch + "/warehouse")
         .config("spark.checkpoint.dir", scratch + "/ckpt")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
