"""What the corpus operators share: table access, shared storage, Arrow batches, id buckets."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a documents table, in order.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Bytes of an Arrow batch, unless the session names another size: long texts make batches of few rows.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session gets a folder of this machine, stored in
    the session so that later calls agree on it; on a cluster that would be
    lost to the executors, so it is an error there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        found = "file://" + tempfile.mkdtemp(prefix="barloom-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def store(df: DataFrame, label: str) -> str:
    """Write ``df`` as Parquet into the shared folder, to be deleted when the driver ends; returns the path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/barloom/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    system, at = _hadoop(spark, path)
    system.deleteOnExit(at)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    system, at = _hadoop(spark, path)
    system.delete(at, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    This cuts lineage: a lost executor costs a reread, not a recomputation, and
    whatever is read afterwards is one fixed set of rows.
    """
    return df.sparkSession.read.schema(df.schema).parquet(store(df, label))


def single_threaded() -> None:
    """Keep native libraries of a Python worker on the one core of its task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")


def release() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks, and stages follow each other in them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def bound_batches(spark: SparkSession) -> None:
    """Limit the session's Arrow batches by bytes, unless it has a limit."""
    if spark.conf.get(_BATCH_SETTING, None) in (None, "-1", str(2**31 - 1)):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def map_batches(df: DataFrame, run: Callable[[Iterator], Iterator], fields: str) -> DataFrame:
    """``mapInArrow`` with batches of bounded size, one thread a task, and memory given back at a task's end."""
    bound_batches(df.sparkSession)

    def lean(batches):
        single_threaded()
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(lean, fields)


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def batch_texts(batch, column: str = "text") -> list[str]:
    """Texts of an Arrow batch; null becomes the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def field_types(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
