"""Session defaults shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # sessions of one map task are merged before they are shuffled
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "streamlab", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, AQE and the RocksDB state store; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a local run gets a folder of its own (kept in the session's setting, so that all
    callers agree); on a cluster that is an error, since executors would write to their own disks.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="streamlab-shared-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there; the lineage ends."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
