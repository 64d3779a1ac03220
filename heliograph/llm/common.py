"""What the operators of this subpackage share: scratch tables, folds and small plan helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

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


def _scratch_root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = f"{shared_dir(spark)}/heliograph-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _roots[app])
    return _roots[app]


def _remove(spark: SparkSession, root: str) -> None:
    """Best effort at the end of the process; the JVM may be gone by then."""
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001
        pass


def settle(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a
    recomputation, and later plans see true sizes.
    """
    path = f"{_scratch_root(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._settled_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete what settle() wrote for these frames. Only for frames that no later plan reads."""
    for f in frames:
        if path := getattr(f, "_settled_at", None):
            _remove(f.sparkSession, path)


def small_batches(df: DataFrame, rows: int = 500, size: str = "2m") -> DataFrame:
    """df, after lowering the session's bounds of an Arrow batch to ``rows`` rows and about ``size`` bytes.

    Whole texts can be long, and each Python worker holds a batch or two. The
    bounds are read when a plan is executed, after the operator has returned,
    so they stay as they are; lower ones are left alone.
    """
    conf = df.sparkSession.conf
    now = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if now <= 0 or now > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if _bytes(conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) > _bytes(size):
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def _bytes(size: str) -> int:
    """Of a setting such as 4m; 0 and less count as the most there is."""
    number, unit = size.lower().rstrip("b"), 1
    for k, name in enumerate("kmgt"):
        if number.endswith(name):
            number, unit = number[:-1], 1024 ** (k + 1)
    return int(number) * unit if int(number) > 0 else 1 << 62


def packed(docs: DataFrame, *keys: Column) -> DataFrame:
    """The given columns, and all columns of ``docs`` as the struct ``row``, so that no name of theirs can clash with an operator's."""
    return docs.select(*keys, F.struct("*").alias("row"))


def text_of(text: Column) -> Column:
    """A text as a string; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def text_keys(text: Column, seed: int = 0) -> list[Column]:
    """Two independent 64-bit hashes of a text, text_key and text_key_2."""
    return [F.xxhash64(F.lit(f"first {seed}"), text).alias("text_key"), F.xxhash64(F.lit(f"second {seed}"), text).alias("text_key_2")]


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Bits of the filter of maybe_among(); so it has at most FILTER_BITS / 64 rows, about 3 MB.
FILTER_BITS = 1 << 23


def maybe_among(rows: DataFrame, key: Column, keys: DataFrame, name: str = "_maybe") -> DataFrame:
    """rows with a boolean column that is true wherever the 64-bit hash ``key`` is in the one column of ``keys``, and now and then elsewhere.

    Joins on such keys need to shuffle no more than the rows where it is
    true. What is broadcast is a bitmap of fixed size; with too many keys for
    it the column is true more often, and the join is as wide as without it.
    """
    place = F.pmod(F.col("k"), F.lit(FILTER_BITS))
    bit = lambda c: F.expr(f"shiftleft(1L, cast(pmod({c}, 64) as int))")
    marks = keys.toDF("k").select(place.alias("p")).select(F.expr("p div 64").alias("_word"), bit("p").alias("b")).groupBy("_word").agg(F.bit_or("b").alias("_bits"))
    asked = rows.withColumn("_place", F.pmod(key, F.lit(FILTER_BITS))).withColumn("_word", F.expr("_place div 64"))
    found = asked.join(F.broadcast(marks), "_word", "left")
    return found.withColumn(name, F.coalesce(F.col("_bits").bitwiseAND(bit("_place")) != 0, F.lit(False))).drop("_word", "_place", "_bits")
