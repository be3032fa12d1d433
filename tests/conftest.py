import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="docspark-tests-", dir="/tmp")
    s = (SparkSession.builder.master("local[4]").appName("docspark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from docspark.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def docs(spark):
    def make(items, col="doc"):
        return spark.createDataFrame([(json.dumps(d) if not isinstance(d, str) else d,) for d in items], f"{col} string")
    return make


@pytest.fixture
def store(spark):
    import uuid
    from docspark.sources.store import DocStore
    db = "t_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db}")
    return DocStore(spark, database=db, default_shards=4)
