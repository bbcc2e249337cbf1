"""Session helpers shared by every operator: table access, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()
_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the test tables; nothing is read until an action needs it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, whatever the executors' path holds."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="skeinworks-")) / "skeinworks.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"skeinworks/{p.relative_to(root)}")
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where that is unset and all run on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="skeinworks-ck-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage of df by a table in the shared folder and read it back.

    Columnar and compressed, so it costs less disk than a checkpoint, and any executor may be lost
    without losing it. Files are removed by drop_materialized or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/skein-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path, partitionBy=partition_by)
    _written.append((spark, path))
    return _read_back(spark, df.schema, path)


def append(df: DataFrame, to: DataFrame | None, name: str) -> DataFrame:
    """Add the rows of df to a table of materialize(); a new one if there is none yet."""
    if to is None:
        return materialize(df, name)
    df.write.mode("append").option("compression", "zstd").parquet(to._skein_path)
    return _read_back(df.sparkSession, df.schema, to._skein_path)


def _read_back(spark: SparkSession, schema, path: str) -> DataFrame:
    out = spark.read.schema(schema).parquet(path)
    out._skein_path = path
    return out


def drop_materialized(*frames: DataFrame) -> None:
    """Delete tables of materialize(), and those a frame was built on (keep_with), once nothing reads them any more."""
    for df in frames:
        path = getattr(df, "_skein_path", None)
        if path:
            _delete(df.sparkSession, path)
            _written[:] = [x for x in _written if x[1] != path]
        drop_materialized(*getattr(df, "_skein_parts", ()))


def keep_with(df: DataFrame, *parts: DataFrame) -> DataFrame:
    """Note that df reads these tables, so that dropping df drops them."""
    df._skein_parts = [*getattr(df, "_skein_parts", ()), *parts]
    return df


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:
            pass


def bounded_broadcast(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Hint a broadcast only while the counted size keeps below max_rows; else leave the join to shuffle."""
    return F.broadcast(df) if rows <= max_rows else df
