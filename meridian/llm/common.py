"""Helpers shared by the operators of this subpackage: table access, shared storage, Arrow maps."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from meridian.session import ship

#: ASCII white space, as the contracts define it: 0x20 and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
LOWER_ASCII = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
TRAIN_FOLDS, HELD_OUT = 3, 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch that goes to a Python worker. Spark's own bound lets 10 000 whole texts be held at once, by the JVM and by the worker.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by ``BATCH_BYTES`` from now on, in a session that names no bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where the session names none."""
    where, sc = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if sc.getCheckpointDir() is None:
        if where is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="meridian-checkpoint-"))
    return where or sc.getCheckpointDir()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as a column of ``df`` is called so (letter case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and survives the loss of executors. For narrow rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet to the shared folder and read again; for wide rows. Deleted by ``discard`` or when the process ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stored.append(path)
    if len(_stored) == 1:
        atexit.register(discard, spark)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that ``stored`` has written in this process and that are still there.
_stored: list[str] = []


def bookmark() -> int:
    return len(_stored)


def discard(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Deletes the tables stored since a bookmark, but the last ``keep``. For results that are written already."""
    upto = len(_stored) - keep
    for path in _stored[since:upto]:
        _delete(spark, path)
    _stored[since:upto] = []


def released(spark: SparkSession) -> None:
    """Shuffle files of steps whose results are checkpointed go now: Spark deletes them when their plans are collected.

    For between the large steps of one operator; otherwise they would stay until the driver happens to run out of memory.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session is gone; its shared folder is the cluster's to clean
        return


def arrow_map(df: DataFrame, fn: Callable[[dict[str, list]], dict], schema: str) -> DataFrame:
    """mapInArrow over dicts of Python lists; ``fn`` gets one batch and returns columns for the output batch."""
    names = df.columns
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = fn({n: batch.column(i).to_pylist() for i, n in enumerate(names)})
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels are never learned from: crc32 of the id as text, modulo 3, is 1 (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % TRAIN_FOLDS == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Distinct (doc_id, label) of the training folds, labels 0 and 1 only; a doc labelled twice takes its larger label."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )


def sampled(df: DataFrame, rows: int, total: int, salt: str) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of doc_id (all of them when there are fewer)."""
    if total <= rows:
        return df
    parts = 1_000_003
    return df.where(F.pmod(F.xxhash64(F.lit(salt), F.col("doc_id")), F.lit(parts)) < int(parts * rows / total))


#: What modules keep in a worker from task to task, by name, and how it is dropped.
_kept: dict[str, Callable[[], None]] = {}


def keeps(name: str, drop: Callable[[], None]) -> None:
    _kept[name] = drop


def frugal(keep: str | None = None) -> None:
    """In a Python worker, at a task's start: Arrow allocates from the system, and freed memory goes back to it.

    Workers outlive their tasks and stages: what other operators than ``keep`` hold from task to task is dropped.
    """
    for name, drop in _kept.items():
        if name != keep:
            drop()
    if pa.default_memory_pool().backend_name != "system":
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            libc = ctypes.CDLL(None)
            libc.mallopt(-8, 1)  # one arena
            libc.mallopt(-1, 1 << 20)  # trim from a megabyte on
        except (OSError, AttributeError):  # another C library
            pass
    trimmed()


def trimmed() -> None:
    """Gives freed memory back to the system, after a task or a large batch."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass
