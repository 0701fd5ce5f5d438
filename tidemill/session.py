"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        STATE_STORE: ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are epoch based, so zone-less columns are read as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Keep streaming state on the executors' disks, which keyed state with timers also needs."""
    spark.conf.set(STATE_STORE, ROCKSDB)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session may leave it unset (tests do); then one is made and remembered.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tidemill-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, never used by an earlier run."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, for results that several later passes read.

    It cuts the lineage like a checkpoint, survives lost executors, and later passes read only the columns they need.
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
