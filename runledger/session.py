"""Session construction, shared scratch locations and size guards.

Everything that writes intermediate data (fixture files, evidence stores,
stream checkpoints, versioned upsert tables) writes below the folder the
cluster names in ``spark.checkpoint.dir``.  That folder is shared storage on
a cluster; a machine-local temporary folder is only used when the session is
a local one and nothing is configured (unit tests).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Defaults tuned for a large cluster; tests and bench override partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # AQE sizes post-shuffle partitions to this target and splits skewed
    # ones; the initial shuffle partition count only needs to be generous.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
}
# Folders of ``materialized`` that go with the block they were written in.
_folders: ContextVar[list[str] | None] = ContextVar("folders", default=None)

# Only applied when this process starts the JVM (local runs, tests, bench).
LOCAL_CONF = {"spark.driver.memory": "16g", "spark.ui.enabled": "false"}


def build_session(master: str | None = None, app_name: str = "runledger",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        for key, value in LOCAL_CONF.items():
            conf.setdefault(key, value)
    conf.update(extra or {})
    # Managed tables and databases go to shared storage too, when the
    # cluster names a checkpoint folder and no warehouse folder is set.
    from pyspark import SparkConf
    defaults = SparkConf()
    ckpt = conf.get("spark.checkpoint.dir") or defaults.get(
        "spark.checkpoint.dir", None)
    if ckpt and not defaults.get("spark.sql.warehouse.dir", None):
        conf.setdefault("spark.sql.warehouse.dir",
                        ckpt.rstrip("/") + "/runledger/warehouse")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL options every operator relies on (idempotent).  Sinks
    that need dynamic partition overwrite ask for it per write."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist.  A local session without it gets a
    folder under the machine's temp directory (the only place a local folder
    is acceptable), and the setting is recorded so later calls agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage")
        root = tempfile.mkdtemp(prefix="runledger-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint root (not created eagerly)."""
    return "/".join([checkpoint_root(spark), "runledger", *parts])


def new_run_dir(spark: SparkSession, kind: str) -> str:
    """A fresh, unique folder for one run of one job."""
    return shared_dir(spark, kind, uuid.uuid4().hex)


def materialized(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, where a plan
    would otherwise compute it twice (survives executor loss)."""
    path = new_run_dir(df.sparkSession, kind)
    folders = _folders.get()
    if folders is not None:
        folders.append(path)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def folders_dropped(spark: SparkSession) -> Iterator[None]:
    """What ``materialized`` writes within this block goes when it ends."""
    token = _folders.set([])
    try:
        yield
    finally:
        for path in _folders.get() or []:
            delete_folder(spark, path)
        _folders.reset(token)


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer splits than the cluster has cores.

    A large input already has thousands of splits and is returned as is;
    a small file with a single row group would otherwise put all per-row
    work (JSON encode/decode, text splitting) on one core.  Only the
    partition count of the plan is inspected, nothing is executed, and the
    rows are the same either way.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= target else \
        df.repartition(target)


@contextmanager
def conf_set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """One of the session's settings for as long as the block runs."""
    previous = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def shuffles_dropped(spark: SparkSession):
    """Within this block an execution's shuffle files go when it ends, not
    when the driver happens to collect its garbage.  For writes of rows that
    are computed for that write alone."""
    return conf_set(spark,
                    "spark.sql.classic.shuffleDependency.fileCleanup.enabled",
                    "true")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the library's own tables, in any store that Spark
    writes to."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(conf).delete(target, True)
