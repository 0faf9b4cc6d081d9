"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Streaming state that outgrows executor memory has to live off-heap.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: What the jobs here rely on.  Shuffle partitions stay with the deployment: AQE merges
#: small ones and splits skewed ones, so the count only needs to be high enough.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on unique keys need no sort of the large side where every partition of the
    # other side was measured to be no more than one task reads anyway.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    **STATE_SETTINGS,
}


def build_session(name: str, master: str | None = None, hive: bool = False, **settings: str) -> SparkSession:
    """Session with :data:`SETTINGS`; ``settings`` use ``__`` for dots and win over them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stateful_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session of the same application for stateful streaming queries.

    The first run of a query fixes its number of state partitions for as long as its
    checkpoint lives, so it is given here and taken neither from what the batch jobs shuffle
    with nor from the cores that happen to be there when it starts.
    """
    session = spark.newSession()
    zone = "spark.sql.session.timeZone"
    for key, value in {
        zone: spark.conf.get(zone),
        "spark.sql.shuffle.partitions": str(state_partitions),
        **STATE_SETTINGS,
    }.items():
        session.conf.set(key, value)
    return session


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach, below ``spark.checkpoint.dir``.

    A machine-local folder is only used in local mode, where one machine is all there is.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/tillwright/{purpose}-{uuid.uuid4().hex}"
