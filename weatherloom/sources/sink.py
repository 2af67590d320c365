"""Writers: partitioned, clustered, slice-replacing and appending; scratch space; markers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.operators.observed import ObservedChecks

SHARED_DIR_CONF = "spark.checkpoint.dir"
SUCCESS_MARKER = "_SUCCESS"


_scratch: list[str] = []
_local: list[str] = []  # the temporary folder of local sessions, once one is needed


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables, in the shared folder the cluster names.

    Only a local session without that setting falls back to a temporary folder, which is removed
    at exit; on a cluster a machine-local folder would not be visible to other executors.
    """
    base = spark.conf.get(SHARED_DIR_CONF, None) or spark.sparkContext.getConf().get(SHARED_DIR_CONF)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SHARED_DIR_CONF} to a folder all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="weatherloom-"))
            atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
        base = _local[0]
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables this process wrote. Call it once their results have been read."""
    while _scratch:
        path, fs = _hadoop_path(spark, _scratch.pop())
        fs.delete(path, True)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    mode: str = "overwrite",
    clustered: bool = False,
    dynamic: bool = False,
    measured: ObservedChecks | None = None,
) -> None:
    """Write Hive-style partitions.

    ``clustered`` sends rows of one partition value together before the write, so a value does not
    get one small file per task; the rebalance still splits a value too large for one task.
    ``dynamic`` replaces only the partition values present in ``df`` and keeps the others.
    ``measured`` sees every row that is written.
    """
    out = df.hint("rebalance", *[F.col(k) for k in keys]) if clustered else df
    out = measured.attach(out) if measured else out
    writer = out.write.mode(mode).partitionBy(*keys)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.parquet(path)


def drop_partitions(spark: SparkSession, path: str, key: str, values: Sequence) -> int:
    """Delete the first-level partitions of ``values`` (None: null); returns how many there were."""
    dropped = 0
    for value in values:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        part, fs = _hadoop_path(spark, f"{path.rstrip('/')}/{key}={name}")
        dropped += bool(fs.exists(part) and fs.delete(part, True))
    return dropped


def replace_slices(df: DataFrame, path: str, keys: Sequence[str], slices: Sequence, measured: ObservedChecks | None = None) -> None:
    """Replace the first-level partitions of ``slices`` (None: null) by the rows of ``df``, which must
    belong to them; those without a row any more disappear, all others keep their files. The rows are
    written aside first, since they may come from the table itself."""
    rows = materialize(df, "slices")
    left = {r[0] for r in rows.select(keys[0]).distinct().collect()}
    write_partitioned(rows, path, keys, clustered=True, dynamic=True, measured=measured)
    drop_partitions(df.sparkSession, path, keys[0], [s for s in slices if s not in left])


def append_audit(df: DataFrame, path: str) -> None:
    """Append a few audit rows as one file. Only for row counts fixed by design."""
    df.coalesce(1).write.mode("append").parquet(path)


def materialize(df: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Write once to shared scratch space and read back: later steps do not recompute ``df`` and
    survive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)
    return spark.read.schema(_reordered(df, keys)).parquet(path).select(*df.columns)


def _reordered(df: DataFrame, keys: Sequence[str]) -> StructType:
    fields = {f.name: f for f in df.schema.fields}
    return StructType([fields[c] for c in df.columns if c not in keys] + [fields[k] for k in keys])


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _hadoop_path(spark, path)
    return bool(fs.exists(jvm_path))


def commit_marker_exists(spark: SparkSession, path: str) -> bool:
    """True when the job that wrote ``path`` committed."""
    return path_exists(spark, f"{path.rstrip('/')}/{SUCCESS_MARKER}")


def data_file_count(df: DataFrame) -> DataFrame:
    """One row: number of files behind a file-based DataFrame."""
    return df.select(F.col("_metadata.file_path").alias("f")).distinct().agg(
        F.count(F.lit(1)).alias("n_files")
    )
