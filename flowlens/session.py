"""Session set-up, shared scratch folder and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", scratch: str | None = None) -> SparkSession:
    """Session for tests and benches on one machine; a cluster brings its own, with ``spark.checkpoint.dir`` set.

    ``scratch`` is the folder for intermediate tables where the session names none.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flowlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # the JVM does not compile methods above 8,000 bytecodes: leave such stages to the smaller generated projections
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if scratch and spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session, or the checkpoint folder it was given."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named.rstrip("/")


_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path below the shared folder, never used before; ``release_scratch`` deletes what lies there."""
    path = f"{shared_folder(spark)}/flowlens/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Deletes the intermediate tables of the jobs so far and drops persisted data.

    Results are lazy and read their intermediates, so only the caller knows when they are no longer needed: call this
    when the results are written.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)
    spark.catalog.clearCache()


def for_many_passes(df: DataFrame, *keys: str, ordered: bool = False) -> DataFrame:
    """Persisted rows in even partitions (sorted inside them on request), for algorithms that read them in every round.

    One shuffle by key up front; without it the rounds would inherit the partitions of the scan or of a coalesced
    aggregate, often far fewer than there are cores.
    """
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    even = df.repartition(n, *keys)
    return (even.sortWithinPartitions(*keys) if ordered else even).persist(StorageLevel.MEMORY_AND_DISK)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Row-level intermediate written once as a columnar table in the shared folder and read back.

    For data that several later steps read: each of them reads only its columns, and lost executors cost no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so an iterative plan stays short and survives lost executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
