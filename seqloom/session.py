"""Sessions, table reading and cutting of lineage."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_scratch: dict[str, str] = {}


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; a cluster's own session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("seqloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.files.openCostInBytes", str(256 << 10))  # small tables are still read by all cores
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; a folder of part files or a single file."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where that is unset and the master is local."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.match(r"local($|\[)", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="spark-seqloom-")
        _scratch[app] = f"{base.rstrip('/')}/seqloom-{uuid.uuid4().hex}"
        atexit.register(_drop, spark, _scratch[app])
    return _scratch[app]


def _drop(spark: SparkSession, folder: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may have ended before
        pass


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it back.

    Parquet with zstd is several times smaller than what checkpoint() leaves, and later steps read only
    the columns they need. A lost executor costs nothing, as no block lives on it alone.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more; what was not written stays."""
    for df in tables:
        path = getattr(df, "_written_at", None)
        if path:
            _drop(df.sparkSession, path)


def spread(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the width used where a stage must be spread explicitly."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
