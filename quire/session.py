"""Session factory, table access and lineage cutting shared by every operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(cores: str = "*", partitions: int = 8, name: str = "quire") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a DataFrame; Catalyst prunes its columns."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session. Only a local session, whose executors
    share this machine, gets a folder of its own where that is unset; a cluster without it is an error."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="quire-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        sc.setCheckpointDir(at)
    return at


_folders: set[str] = set()


def _forget(spark: SparkSession, folder: str) -> None:
    """Removes a folder of the shared file system; nothing happens where the session is gone already."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:
        pass


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write df to the shared folder once and read it back.

    Unlike checkpoint(), the plan is computed once, and a lost executor takes nothing with it. The application's folder
    is removed when the driver's process ends.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/quire-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_forget, spark, folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes tables of `written` that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_written_to", None):
            _forget(df.sparkSession, path)
