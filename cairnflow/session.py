"""Session defaults and the shared folder for durable intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every query of this package assumes; a cluster's own values for anything else stay untouched.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "cairnflow", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; only where that is unset, a temporary folder of this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cairnflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
        atexit.register(_remove_local, folder)
    return folder.rstrip("/")


def _remove_local(folder: str) -> None:
    import shutil

    shutil.rmtree(folder, ignore_errors=True)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def rename_path(spark: SparkSession, source: str, target: str) -> bool:
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    return bool(a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b))


def _cleanup(spark: SparkSession, path: str) -> None:
    try:
        delete_path(spark, path)
    except Exception:  # noqa: BLE001 - the session may be gone at interpreter exit; the folder is scratch space
        pass


def scratch(spark: SparkSession, *paths: str) -> None:
    """Remove these when the session ends."""
    for path in paths:
        atexit.register(_cleanup, spark, path)


def materialise_at(df: DataFrame, name: str, by: str | None = None) -> tuple[DataFrame, str]:
    """materialise() with the folder, for tables that are deleted as soon as others take their place."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    scratch(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts lineage, survives executor loss, is compressed.

    by: a column of few values whose rows are kept in folders of their own.
    """
    return materialise_at(df, name, by)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
