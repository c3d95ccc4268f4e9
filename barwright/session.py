"""Session settings and the shared folder for tables written between steps."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder = {}


def make_session(app_name: str = "barwright", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the library counts on. Without ``master``, spark-submit decides."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets one temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    key = spark.conf.get("spark.app.id", "local")
    if key not in _own_folder:
        _own_folder[key] = tempfile.mkdtemp(prefix="barwright-")
    return _own_folder[key]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, held: list | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Steps that scan a result more than once use this instead of a cache: the written table cuts the
    lineage and outlives any executor. ``held`` collects the folders, for ``remove`` to take away
    when nothing reads them any more.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    if held is not None:
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders, wherever the session's file systems have them."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
