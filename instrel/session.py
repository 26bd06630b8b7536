"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("instrel")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # No call sites are recorded per expression, which makes building plans cheaper.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_root() -> str:
    """This process's own folder, removed when it ends."""
    root = tempfile.mkdtemp(prefix="run-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder the cluster names.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
