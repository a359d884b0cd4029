"""What the operators of this subpackage share: reading, shared storage, sizes."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where none is named and everything runs on this machine (a test session) is a folder of our own
    set; on a cluster that would be one that executors cannot read, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    own = spark.sparkContext.getCheckpointDir()
    if not own:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"{master}: set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strandline-"))
        own = spark.sparkContext.getCheckpointDir()
    return own.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it again.

    It cuts the lineage, so that a lost executor costs no more than the stage that it ran, and later
    jobs share one computation. Parquet is used rather than checkpoint() because it is several times
    smaller than serialised rows and prunes columns. The table stays until discard() or clean().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strandline/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Remove materialised tables that nothing will read again; other frames are left alone."""
    for df in tables:
        if path := getattr(df, "_written_at", None):
            _remove(df.sparkSession, path)


def clean(spark: SparkSession) -> None:
    """Remove all that this application has materialised: once its results are written or collected."""
    _remove(spark, f"{shared_dir(spark)}/strandline/{spark.sparkContext.applicationId}")


def plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a plan's size, from the files that it reads."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def text_bytes(df: DataFrame, column: str) -> int:
    """The size of a text column: Spark's estimate, or where it has none (no file below) a count of characters."""
    size = plan_bytes(df.select(column))
    if size < 1 << 60:
        return size
    return int(df.agg(F.coalesce(F.sum(F.length(column)), F.lit(0))).first()[0])


def crc_fold(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the fold rule of the learning operators (null id: null)."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5; DuckDB computes the same from the same text."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = 1024) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run on pieces of at most `rows` rows; what the task has freed goes back to the system when it ends.

    Python workers outlive their tasks, so what one stage leaves in their heaps would be missing in the next.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return whole
