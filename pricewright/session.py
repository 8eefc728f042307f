"""Session settings and the one way results are cut off from their lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings the session.

    ``shared`` is the folder for written tables.  The rows of the benchmark's one-split files are dealt over the cores.
    """
    builder = SparkSession.builder if shared is None else SparkSession.builder.config("spark.checkpoint.dir", shared)
    if str(cores).isdigit():
        builder = builder.config("spark.pricewright.scanTasks", str(cores))
    return (
        builder.master(f"local[{cores}]")
        .appName("pricewright")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "8m")
        .config("spark.sql.files.openCostInBytes", "256k")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it in ``spark.checkpoint.dir``.

    Where it is unset, a master that runs in this one process gets a folder of this machine; any other is refused.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="pricewright-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)  # tree training cuts its own lineage there
    return folder.rstrip("/")


_OWNERS: ContextVar[list[list[str]]] = ContextVar("owners", default=[])


@contextmanager
def owned_tables(spark: SparkSession) -> Iterator[None]:
    """Removes at its end all tables that were written inside it, so results must be used or stored by then.

    Fits and predictions that are run one after another in a long session belong in one of these each; nested ones
    own what was written in them.
    """
    paths: list[str] = []
    token = _OWNERS.set([*_OWNERS.get(), paths])
    try:
        yield
    finally:
        _OWNERS.reset(token)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def new_table_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/pricewright/{label}-{uuid.uuid4().hex}"
    for paths in _OWNERS.get()[-1:]:
        paths.append(path)
    return path


def materialise(df: DataFrame, label: str = "table", partition_by: str | None = None, files: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives the loss of any executor, is computed once however often it is used, and is
    still columnar, so later steps read only the columns they need.  With ``partition_by`` a filter on that
    column, one of few values, reads only the files that it needs.  ``files`` bounds the files, and the tasks of the
    last step with them; the caller knows from the rows how many they are worth.
    """
    spark = df.sparkSession
    df = df if files is None else df.coalesce(files)
    path = new_table_path(spark, label)
    (df.write if partition_by is None else df.write.partitionBy(partition_by)).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)
