"""Session helpers: a local session for tests, and tables in the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: list[str] = []
_COPIES: set[str] = set()


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fillwatch")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where it is unset, a session with all its threads in one process gets a temporary folder,
    which goes when Python ends; any other session is refused, as its executors would each write
    to a disk of their own. The session's configuration is left as it is.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="fillwatch-"))
        atexit.register(shutil.rmtree, _LOCAL_ROOT[0], ignore_errors=True)
    return _LOCAL_ROOT[0]


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """The name of a fresh folder below ``spark.checkpoint.dir``, readable by every executor.

    ``release`` deletes it.
    """
    path = f"{shared_root(spark)}/fillwatch/{purpose}-{uuid.uuid4().hex}"
    _COPIES.add(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``shared_dir`` named."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _COPIES.discard(path)


def release(spark: SparkSession) -> None:
    """Delete the folders of ``shared_dir`` and ``settled``; results that read them are of no use afterwards."""
    for path in list(_COPIES):
        remove(spark, path)


def settled(df: DataFrame, purpose: str = "settled") -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    For a result that several passes use: it is worked out once, the copy outlives the
    executors that made it, and later passes read only the columns they need. ``release``
    deletes the copies once their results have been used.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
