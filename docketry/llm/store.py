"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that go to Python at once, but for a longer row.
BATCH_BYTES = 4 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

_fallback: list[str] = []
_tables: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a session of one local process, as in tests, gets a
    scratch folder where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if not _fallback:
        _fallback.append("file://" + tempfile.mkdtemp(prefix="docketry-"))
    return _fallback[0]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: the lineage ends there,
    and a lost executor costs only the tasks that it ran. The table goes when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _goes_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, label: str, width: int, key: str) -> DataFrame:
    """As ``stored``, uncompressed and in ``width`` buckets by ``key``, which joins by it need not shuffle."""
    spark = df.sparkSession
    table = f"docketry_{label}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/tables/{table}"
    df.write.bucketBy(width, key).option("path", path).option("compression", "none").saveAsTable(table)
    _goes_at_exit(spark, path)
    _tables[table] = spark
    return spark.table(table)


def _goes_at_exit(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


@atexit.register
def _forget_tables() -> None:
    """Takes the bucketed tables out of the catalogue, where their session still runs."""
    for table, spark in _tables.items():
        if spark.getActiveSession() is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to Python in batches of about BATCH_BYTES, unless the session has a limit of its own.
    By Spark's default of 10,000 rows or 64 MB each task holds its batch of texts beside the JVM's heap, and its
    worker holds it some times over."""
    if spark.conf.get(_LIMIT, None) is None:
        spark.conf.set(_LIMIT, str(BATCH_BYTES))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(stem: str, taken: list[str]) -> str:
    """A column name like ``stem`` that isn't taken."""
    low = {x.lower() for x in taken}
    while stem.lower() in low:
        stem += "_"
    return stem
