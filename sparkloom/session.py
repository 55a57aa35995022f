"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}


def get_spark(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "sparkloom", **conf: str) -> SparkSession:
    """A local session with the settings that tests and the bench use; on a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only where that is unset and all runs on one machine (tests) a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = tempfile.mkdtemp(prefix="sparkloom-")
    return _OWN_DIR[app]


def materialize(df: DataFrame) -> DataFrame:
    """Write df once as Parquet to the shared folder and read it back.

    Cuts lineage for loops and for results used more than once.  Unlike a local
    checkpoint the table survives the loss of any executor; unlike checkpoint()
    the plan runs once and the copy is columnar.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sparkloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._sparkloom_path = path
    return out


def repeatable(df: DataFrame) -> DataFrame:
    """df if reading it again gives the same rows in the same partitions, as far as its plan shows; else a copy that does.

    What is shuffled or sampled may come in another order when a lost task runs again.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return materialize(df) if any(node in plan for node in ("Exchange", "Sample")) else df


def release(df: DataFrame | None) -> None:
    """Delete the table behind a materialize() result that nothing reads any more."""
    path = getattr(df, "_sparkloom_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
