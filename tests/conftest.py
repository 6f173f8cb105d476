import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from pyspark.sql import SparkSession

    warehouse = tempfile.mkdtemp(prefix="trustgrid-warehouse-", dir="/tmp")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.warehouse.dir", warehouse)
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from trustgrid.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="trustgrid-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    import tempfile
    return tempfile.mkdtemp(prefix="trustgrid-test-", dir="/tmp")
