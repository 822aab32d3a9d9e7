"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows costs a lookup for every write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(
    app_name: str = "tillstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the jobs are planned for.

    ``shuffle_partitions`` is the pre-coalesce number: on a cluster give it
    two to three times the total cores and let AQE merge the small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may go without it; there a fresh temporary folder is
    set, because every task runs on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tillstream-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name under the shared root."""
    return f"{checkpoint_root(spark).rstrip('/')}/tillstream/{purpose}-{uuid.uuid4().hex}"


def materialize(df):
    """Write ``df`` to the shared folder and read it back.

    Iterative jobs start from this table, so a lost executor costs a re-read
    of the small written table and not a re-run of everything before it.
    """
    path = work_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session with the streaming settings, leaving ``spark`` as it is."""
    session = spark.newSession()
    for name, value in RECOMMENDED_CONF.items():
        session.conf.set(name, value)
    session.conf.set(
        "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    )
    return session
