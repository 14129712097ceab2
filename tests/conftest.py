import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from triploom.session import SESSION_CONF, ensure_checkpoint_dir

    builder = (SparkSession.builder.master("local[*]").appName("triploom-tests")
               .config("spark.sql.shuffle.partitions", "8"))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="triploom-test-")


@pytest.fixture()
def conf(spark):
    """Set session options for one test and restore them afterwards."""
    saved = {}

    def set_(key, value):
        saved.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, str(value))

    yield set_
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


RAW_COLS = "region string, origin_coord string, destination_coord string, datetime string, datasource string"


def pt(x, y):
    return f"POINT ({x} {y})"
