"""Session factory and the shared folder that operators cut lineage with."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What every session of this engine is built with. Partition values stay strings, as the archive writes them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with DEFAULTS; keyword arguments override them (dots written as double underscores)."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local temporary one where it is unset and the master is local."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc.getCheckpointDir() is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(named)
    return named or sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Run the plan once and cut its lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let go of what finished steps of a loop left: shuffle files and checkpoints go when the driver's objects do."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}/{name}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Hadoop's file system API."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a test-data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
