import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests only: name a checkpoint folder when the environment names none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pf-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="pf-test-", dir="/tmp")
