"""Tables written between the steps of an operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that is unset and Spark runs in one process is a temporary
    folder of this machine used, which goes when the process ends.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if "local" not in _roots:
        folder = tempfile.mkdtemp(prefix="heliograph-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _roots["local"] = f"file://{folder}"
    return _roots["local"]


def _remove(spark: SparkSession, path: str) -> None:
    """Best effort at the end of the process; the JVM may be gone by then."""
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001
        pass


def scratch_folder(spark: SparkSession, tag: str) -> str:
    """The path of a new folder of the shared one, which goes when the process ends."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = f"{shared_dir(spark)}/heliograph-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _roots[app])
    return f"{_roots[app]}/{tag}-{uuid.uuid4().hex}"


def settle(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = scratch_folder(spark, tag)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._settled_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete what settle() wrote for these frames. Only for frames that no later plan reads."""
    for f in frames:
        if path := getattr(f, "_settled_at", None):
            _remove(f.sparkSession, path)
