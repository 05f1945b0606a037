import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("ratelens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ratelens-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from ratelens.session import get_session
    get_session()
    yield s
    from ratelens.session import remove_staged
    remove_staged(s)
    s.stop()


SMALL_DIR = "/root/testdata/sf0.001"
