"""Session helpers: sensible defaults and a reliable checkpoint folder.

On a cluster the session is built by the platform; docspark only reads its settings. ``spark.checkpoint.dir``
names the shared folder used to cut lineage. Tests and local runs may set one with :func:`ensure_checkpoint_dir`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}
# Bytes of a method that the JVM still compiles; larger ones stay interpreted.
JVM_METHOD_LIMIT = 8000


def compile_in_parts(spark: SparkSession) -> None:
    """Stages whose generated method the JVM would not compile (many declared fields in one projection) run operator by
    operator instead, with the generated code split into methods that it does compile."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(JVM_METHOD_LIMIT))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "docspark",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    compile_in_parts(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the session names; set a local one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
        configured = tempfile.mkdtemp(prefix="docspark-ckpt-", dir=os.environ.get("DOCSPARK_TMP", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
