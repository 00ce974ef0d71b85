"""Session settings the results depend on, and where scratch tables go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Wall-clock results need a UTC session; JSON documents that repeat a key keep the last one.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings.  Cluster sizing (cores, shuffle partitions) stays the caller's."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def require_configured(spark: SparkSession) -> None:
    """Fail before any job runs when a setting would silently change results."""
    for key in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys"):
        if spark.conf.get(key, None) != _SETTINGS[key]:
            raise ValueError(
                f"{key} must be {_SETTINGS[key]!r}; call touchtrail.configure(spark) first"
            )


_local_folder: str | None = None


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A folder of this machine is used only when it is unset and Spark runs in one process (tests);
    it goes when the driver ends.
    """
    global _local_folder
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="touchtrail-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


_kept: dict[str, tuple] = {}


def scratch_path(spark: SparkSession) -> str:
    """A fresh folder name below the shared one; removed when the driver ends, or by ``discard``."""
    path = f"{scratch_dir(spark)}/touchtrail-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    _kept[path] = (where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where)
    return path


def discard(path: str) -> None:
    """Remove a scratch folder; a name that is unknown or gone already is no error."""
    if kept := _kept.pop(path, None):
        kept[0].delete(kept[1], True)


@atexit.register
def discard_all() -> None:
    """Remove every scratch folder this driver made."""
    for path in list(_kept):
        try:
            discard(path)
        except Exception:  # noqa: BLE001  the JVM may have gone first
            return


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``df``, written once as Parquet to the shared folder and read from there.

    This cuts the lineage: a lost executor costs no more than the tasks that read the files.
    """
    path = path or scratch_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_table(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as Parquet files in the shared folder, removed at the end of the block."""
    path = scratch_path(df.sparkSession)
    try:
        yield stored(df, path)
    finally:
        discard(path)
