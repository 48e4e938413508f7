"""Session helpers shared by every operator: test sessions, the shared folder, written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("mnemolake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share.

    It is the one named in ``spark.checkpoint.dir``; only a local session without that setting (a
    test) gets a temporary folder, which is then kept for the life of the session. On a cluster
    without that setting there is none, and asking for it is an error.
    """
    named = spark.conf.get(SHARED_DIR_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):  # all executors of a local-cluster share this machine
        raise ValueError(f"set {SHARED_DIR_CONF} to a folder that all executors share")
    own = getattr(spark, "_mnemolake_shared_dir", None)
    if own is None:
        own = "file://" + tempfile.mkdtemp(prefix="mnemolake-")
        spark._mnemolake_shared_dir = own
    return own


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{_own_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/mnemolake/{spark.sparkContext.applicationId}"


def forget_written(spark: SparkSession) -> None:
    """Delete what this application wrote into the shared folder; results not yet taken are lost with it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts lineage, survives executor loss."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
