"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}


def build_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chatsieve")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only when the setting is absent, which is the
    case in a bare local session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    key = spark.sparkContext.applicationId
    if key not in _local_dirs:
        _local_dirs[key] = tempfile.mkdtemp(prefix="chatsieve-")
    return _local_dirs[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/chatsieve/{name}-{uuid.uuid4().hex}"
