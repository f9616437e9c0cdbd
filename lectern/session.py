"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Needed for right results: every timestamp in the library is UTC unless it
# says otherwise.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# Good defaults for large inputs: AQE re-plans from real sizes, splits skewed
# join partitions even when that costs one more shuffle, and merges small ones.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

STATE_STORE = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build(app: str = "lectern", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**TUNING, **REQUIRED, **conf}.items():
        b = b.config(k, v)
    return configure(b.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on to a given session."""
    for k, v in {**TUNING, **REQUIRED}.items():
        spark.conf.set(k, v)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, visible to all executors.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is
    made only where that is unset and the session is local, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    known = spark.conf.get("spark.lectern.folder", None)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="lectern-")
    spark.conf.set("spark.lectern.folder", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder; its size is known to Spark from then on."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
