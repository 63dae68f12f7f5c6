"""Session helpers: local sessions for tests and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def local_session(cores: int = 8, partitions: int = 8, app: str = "hemicycle") -> SparkSession:
    """A local session with the settings the tests and the bench share."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Where the setting is absent a temporary folder is used, in local mode only: on a cluster
    a machine-local folder would lose data together with its machine.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="hemicycle-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder; ``clear_scratch`` removes it."""
    path = f"{shared_dir(spark)}/hemicycle/{uuid.uuid4().hex}/{name}"
    if not _written:
        atexit.register(_clear_at_exit)
    _written[path] = spark
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read again. Survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what ``materialize`` and ``scratch_path`` left; nothing lazy may still read it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in [p for p, s in _written.items() if s is spark]:
        parent = jvm.org.apache.hadoop.fs.Path(path).getParent()
        parent.getFileSystem(conf).delete(parent, True)
        del _written[path]


def _clear_at_exit() -> None:
    for spark in {id(s): s for s in _written.values()}.values():
        try:
            clear_scratch(spark)
        except Exception:  # the JVM has gone already
            return
