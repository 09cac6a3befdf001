"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Remove reliable-checkpoint files once their data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "demand_engine",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one with the engine's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    ``local[N]`` with ``shuffle_partitions`` near N avoids empty tasks.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only on a local master,
    where driver and executors are one process, is a private folder made when
    nothing is named; elsewhere that is an error, since the executors could
    not see each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="demand-engine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


#: Tables written outside any scope live until ``release``.
_PROCESS: list[str] = []
_OPEN: ContextVar[list[str]] = ContextVar("intermediate_tables", default=_PROCESS)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, deleted with the scope that is
    open now (see ``table_scope``), or by ``release`` where none is."""
    path = shared_path(spark, "tables", f"{name}-{uuid.uuid4().hex}")
    _OPEN.get().append(path)
    return path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    It cuts the lineage, any executor can read the files, and later reads
    still prune columns and push filters down.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A query that ends inside leaves no shuffle files: they go with it, not
    when the driver's garbage collector comes to them. For tables that are
    written once and read from their files."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end, also after
    an error. Write what must outlive them elsewhere before. Scopes nest, and
    each thread has its own."""
    held: list[str] = []
    token = _OPEN.set(held)
    try:
        yield
    finally:
        _OPEN.reset(token)
        _delete(spark, held)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str = "table") -> DataFrame:
    """The rows of ``make()`` as a table of the scope open now; the tables
    that ``make`` writes on the way are deleted once that one is complete,
    so they last no longer than their last reader."""
    path = fresh_path(spark, name)
    with table_scope(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables that this process has written outside
    of scopes; call it once the results that read them are written elsewhere."""
    _delete(spark, _PROCESS)
