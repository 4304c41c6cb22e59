"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

#: Bytes of one Arrow batch sent to a Python worker; long texts make batches of fewer rows.
BATCH_BYTES = 8 << 20
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "dragoman", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on (UTC, AQE, RocksDB state).

    Nothing here fixes partition counts for a cluster: AQE coalesces from
    ``spark.sql.shuffle.partitions``, which a deployment sets to a few times its cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # call sites of every column expression are for debugging; recording them slows plan building
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_settings(spark: SparkSession) -> None:
    """Set what must hold for right results on a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # the stateful streams need a store that holds typed state variables
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the cluster names; make one only for a local master (tests).

    A folder of the driver's machine is not shared with executors, so a cluster without a
    named folder is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="dragoman-ckpt-"))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint folder, for written tables and stream state."""
    ensure_checkpoint_dir(spark)
    jvm = spark.sparkContext._jvm
    base = spark.sparkContext.getCheckpointDir()
    return f"{base}/{purpose}-{jvm.java.util.UUID.randomUUID().toString()}"
