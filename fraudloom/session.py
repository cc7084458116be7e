"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Cluster sizing (executors, memory,
# shuffle partitions) stays with whoever submits the job.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # hour=07 must come back as the string '07', not as the number 7
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A stateful operator with time to live asks for one empty batch after the
    # other, and a run that should end with its input never would.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: str = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    spark = prepare(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Executors on any machine must be able to read it, so a machine-local
    folder is only used when the master itself is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="fraudloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    app = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/{app}/{name}-{uuid.uuid4().hex[:8]}"
